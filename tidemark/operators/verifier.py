"""Attempts to verify orders at their source: queue, results and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.plans.registry import query
from tidemark.sources.journal import NOW, read

ATTEMPTS_SQL = f"""
WITH attempts AS (
  SELECT o_orderkey AS attempt_id, o_custkey AS subject, CASE o_orderkey % 5 WHEN 0 THEN 'CREATED' WHEN 1 THEN 'CLAIMED' WHEN 2 THEN 'REQUEST_PENDING' WHEN 3 THEN 'COMPLETED' ELSE 'FAILED' END AS lifecycle,
         {NOW} + (o_custkey % 41 - 20) * 60000 AS lease_ms, o_orderkey % 6 AS tries, CASE o_custkey % 8 WHEN 0 THEN 404 WHEN 1 THEN 429 WHEN 2 THEN 500 ELSE 200 END AS http,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'ACTIVE' WHEN '2-HIGH' THEN 'CANCELLED' WHEN '3-MEDIUM' THEN 'FILLED' WHEN '5-LOW' THEN 'EXPIRED' END AS provider, CAST(floor(o_totalprice) AS BIGINT) % 4 AS quantity,
         md5(o_custkey || '|' || o_orderstatus) AS evidence
  FROM orders)
"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts derived from the orders table by a fixed rule."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    choose = lambda x, names, other: F.coalesce(*(F.when(x == k, F.lit(v)) for k, v in names.items()), F.lit(other))
    return read(spark, sf_dir, "orders").select(
        key.alias("attempt_id"), customer.alias("subject"), choose(key % 5, {0: "CREATED", 1: "CLAIMED", 2: "REQUEST_PENDING", 3: "COMPLETED"}, "FAILED").alias("lifecycle"),
        (F.lit(NOW) + (customer % 41 - 20) * 60_000).alias("lease_ms"), (key % 6).alias("tries"), choose(customer % 8, {0: 404, 1: 429, 2: 500}, 200).alias("http"),
        choose(F.col("o_orderpriority"), {"1-URGENT": "ACTIVE", "2-HIGH": "CANCELLED", "3-MEDIUM": "FILLED", "5-LOW": "EXPIRED"}, None).alias("provider"), (F.floor("o_totalprice").cast("long") % 4).alias("quantity"),
        F.md5(F.concat_ws("|", customer.cast("string"), "o_orderstatus")).alias("evidence"),
    )


@query("attempt_queue", ATTEMPTS_SQL + f"""
SELECT attempt_id, CASE WHEN lifecycle IN ('COMPLETED', 'FAILED') THEN 'settled' WHEN lifecycle = 'REQUEST_PENDING' AND lease_ms <= {NOW} THEN 'fail_outcome_uncertain' WHEN lifecycle = 'CLAIMED' AND lease_ms <= {NOW} THEN 'reclaim'
       WHEN lifecycle = 'CREATED' AND tries < 3 THEN 'claim' WHEN lifecycle = 'CREATED' THEN 'exhausted' ELSE 'wait' END AS step
FROM attempts""")
def attempt_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the queue does with each attempt now; a request whose lease ran out has an unknown outcome and is not repeated."""
    state, expired = F.col("lifecycle"), F.col("lease_ms") <= NOW
    step = (
        F.when(state.isin("COMPLETED", "FAILED"), "settled").when((state == "REQUEST_PENDING") & expired, "fail_outcome_uncertain").when((state == "CLAIMED") & expired, "reclaim")
        .when((state == "CREATED") & (F.col("tries") < 3), "claim").when(state == "CREATED", "exhausted").otherwise("wait")
    )
    return attempts(spark, sf_dir).select("attempt_id", step.alias("step"))


#: One answer of the provider: the request's outcome, what the body says, and when it was seen.
OBSERVATION = {
    "attempt_id": "o_orderkey", "bound": "o_orderkey % 41 <> 1", "transport": "CASE o_custkey % 29 WHEN 1 THEN 'TIMEOUT' WHEN 2 THEN 'CONNECTION_RESET' ELSE 'HTTP' END",
    "http": "CASE o_custkey % 31 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 500 WHEN 4 THEN 409 WHEN 5 THEN 400 WHEN 6 THEN 403 WHEN 7 THEN 204 WHEN 8 THEN 599 ELSE 200 END", "body": "CASE WHEN o_orderkey % 37 = 3 THEN 'BROKEN' WHEN o_orderkey % 43 = 3 THEN 'UNSUPPORTED' WHEN o_orderkey % 47 = 3 THEN NULL ELSE 'LISTING' END",
    "provider": "CASE o_orderpriority WHEN '1-URGENT' THEN 'ACTIVE' WHEN '2-HIGH' THEN 'CANCELLED' WHEN '3-MEDIUM' THEN 'FULFILLED' WHEN '5-LOW' THEN 'EXPIRED' ELSE 'INACTIVE' END", "quantity": "CASE WHEN o_custkey % 17 = 4 THEN NULL ELSE o_custkey % 5 END",
    "sent_ms": f"CAST({NOW} AS BIGINT)", "received_ms": f"{NOW} + 400", "date_ms": f"CASE WHEN o_orderkey % 53 = 4 THEN NULL WHEN o_orderkey % 59 = 5 THEN {NOW} + 900000 ELSE {NOW} + o_orderkey % 7 * 1000 END",
    "start_ms": f"CASE WHEN o_custkey % 19 = 6 THEN {NOW} + 3600000 ELSE {NOW} - 3600000 END", "end_ms": f"CASE WHEN o_custkey % 23 = 7 THEN NULL WHEN o_orderkey % 3 = 0 THEN {NOW} - 1800000 ELSE {NOW} + 1800000 END",
}
#: The provider's clock is trusted within five minutes of ours, and is a second unsure.
TRUST_MS, UNSURE_MS = 300_000, 1_000
_TRUSTED = f"(date_ms IS NOT NULL AND date_ms >= sent_ms - {TRUST_MS} AND date_ms <= received_ms + {TRUST_MS})"
TEMPORAL_PROOF: R.Rules = (
    ("UNTRUSTED", f"NOT {_TRUSTED} OR start_ms IS NULL OR end_ms IS NULL"),
    ("ACTIVE_WINDOW_CONFIRMED", f"provider = 'ACTIVE' AND start_ms <= date_ms - {UNSURE_MS} AND date_ms + {UNSURE_MS} < end_ms"),
    ("EXPIRED_WINDOW_CONFIRMED", f"provider = 'EXPIRED' AND end_ms <= date_ms - {UNSURE_MS}"),
    ("UNTRUSTED", "provider IN ('ACTIVE', 'EXPIRED')"),
)
_SETTLED = "(proof = 'TRUSTED_OBSERVATION' OR proof = 'ACTIVE_WINDOW_CONFIRMED' OR proof = 'EXPIRED_WINDOW_CONFIRMED')"
#: Status and reason of an answer, tried from the top.
INTERPRETATION: R.Rules = (
    ("PROVENANCE_MISMATCH:HTTP_STATUS_OR_BODY_UNPROVEN", "NOT bound"), ("TRANSPORT_FAILED:REQUEST_TIMEOUT", "transport = 'TIMEOUT'"), ("TRANSPORT_FAILED:CONNECTION_RESET", "transport = 'CONNECTION_RESET'"), ("MALFORMED_RESPONSE:HTTP_STATUS_OR_BODY_UNPROVEN", "http IS NULL OR http < 100 OR http > 599"),
    ("RATE_LIMITED:HTTP_429", "http = 429"), ("TRANSPORT_FAILED:HTTP_500", "http = 500"), ("TRANSPORT_FAILED:HTTP_502", "http = 502"), ("TRANSPORT_FAILED:HTTP_503", "http = 503"), ("TRANSPORT_FAILED:HTTP_504", "http = 504"), ("TRANSPORT_FAILED:HTTP_5XX_PROVIDER_FAILURE", "http > 504"),
    ("AMBIGUOUS:HTTP_409_PROVIDER_CONFLICT", "http = 409"), ("UNSUPPORTED:HTTP_400_UNSUPPORTED_OR_INVALID_REQUEST", "http = 400"), ("UNKNOWN:HTTP_401_ACCESS_FAILURE", "http = 401"), ("UNKNOWN:HTTP_403_ACCESS_FAILURE", "http = 403"), ("UNKNOWN:HTTP_404_NOT_STATE_PROOF", "http = 404"),
    ("UNKNOWN:HTTP_STATUS_OR_BODY_UNPROVEN", "http <> 200 OR body IS NULL"), ("MALFORMED_RESPONSE:MALFORMED_JSON", "body = 'BROKEN'"), ("UNSUPPORTED:UNSUPPORTED_ORDER_SHAPE", "body = 'UNSUPPORTED'"), ("UNKNOWN:UNKNOWN_PROVIDER_STATUS", "provider IS NULL OR provider NOT IN ('ACTIVE', 'INACTIVE', 'FULFILLED', 'CANCELLED', 'EXPIRED')"),
    ("UNKNOWN:ACTIVE_QUANTITY_UNPROVEN", "provider = 'ACTIVE' AND (quantity IS NULL OR quantity <= 0)"), ("UNKNOWN:ACTIVE_TIME_UNPROVEN", "provider = 'ACTIVE' AND proof <> 'ACTIVE_WINDOW_CONFIRMED'"), ("ACTIVE_CONFIRMED:", "provider = 'ACTIVE'"),
    ("EXPIRED_CONFIRMED:", "provider = 'EXPIRED' AND proof = 'EXPIRED_WINDOW_CONFIRMED'"), ("UNKNOWN:OBSERVATION_TIME_INVALID", f"provider = 'EXPIRED' OR NOT {_SETTLED}"), ("INACTIVE_CONFIRMED:", "provider = 'INACTIVE'"),
)
OBSERVED_SQL = f"""WITH o AS ({R.derived_text('orders', OBSERVATION)}), proven AS (SELECT *, {R.first_text(TEMPORAL_PROOF, 'TRUSTED_OBSERVATION')} AS proof FROM o),
read AS (SELECT *, {R.first_text(INTERPRETATION, 'TERMINAL_CONFIRMED:')} AS told FROM proven)
"""
_RETRY = "transport <> 'HTTP' OR http IN (429, 500, 502, 503, 504)"


@query("provider_interpretation", OBSERVED_SQL + f"""SELECT attempt_id, proof, split_part(told, ':', 1) AS status, split_part(told, ':', 2) AS reason, split_part(told, ':', 1) IN ('ACTIVE_CONFIRMED', 'INACTIVE_CONFIRMED', 'TERMINAL_CONFIRMED', 'EXPIRED_CONFIRMED') AS authoritative, bound AND ({_RETRY}) AS retryable FROM read""")
def provider_interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpret(R.derived(read(spark, sf_dir, "orders"), OBSERVATION)).select("attempt_id", "proof", "status", "reason", "authoritative", "retryable")


def interpret(observations: DataFrame) -> DataFrame:
    """The observations with proof, status, reason, authoritative and retryable.

    A confirmed status needs an answer bound to its request, a body that was
    understood, and a time that proves it: an active order has quantity left
    and its window spans the moment, an expired one's window is over, and any
    other needs a window with both ends.
    """
    read_ = observations.withColumn("proof", R.first(TEMPORAL_PROOF, "TRUSTED_OBSERVATION")).withColumn("told", R.first(INTERPRETATION, "TERMINAL_CONFIRMED:"))
    status = F.split_part("told", F.lit(":"), F.lit(1))
    return read_.select("*", status.alias("status"), F.split_part("told", F.lit(":"), F.lit(2)).alias("reason"), status.isin("ACTIVE_CONFIRMED", "INACTIVE_CONFIRMED", "TERMINAL_CONFIRMED", "EXPIRED_CONFIRMED").alias("authoritative"), R.expression(f"bound AND ({_RETRY})").alias("retryable")).drop("told")


@query("evidence_idempotence", ATTEMPTS_SQL + """
SELECT subject, count(*) AS attempts, CASE WHEN bool_or(provider IS NULL) THEN 'INCOMPLETE' WHEN count(DISTINCT evidence) > 1 THEN 'CONFLICT' ELSE 'IDEMPOTENT' END AS verdict FROM attempts GROUP BY subject""")
def evidence_idempotence(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = F.when(F.bool_or(F.col("provider").isNull()), "INCOMPLETE").when(F.count_distinct("evidence") > 1, "CONFLICT").otherwise("IDEMPOTENT")
    return attempts(spark, sf_dir).groupBy("subject").agg(F.count(F.lit(1)).alias("attempts"), verdict.alias("verdict"))


#: What a targeted look at an order is asked with.
CONTEXT = {
    "attempt_id": "o_orderkey", "sweep_id": "CASE WHEN o_orderkey % 31 = 1 THEN '' ELSE 'sweep' END", "order_hash": "CASE WHEN o_orderkey % 37 = 1 THEN 'x' ELSE concat('0x', md5(CAST(o_orderkey AS STRING)), md5(CAST(o_custkey AS STRING))) END",
    "candidate_hash": "CASE WHEN o_custkey % 41 = 1 THEN 'no' ELSE concat(md5(CAST(o_custkey AS STRING)), md5(CAST(o_custkey AS STRING))) END", "barrier_hash": "concat(md5(CAST(o_custkey + 1 AS STRING)), md5(CAST(o_custkey AS STRING)))", "root_hash": "CASE WHEN o_custkey % 43 = 1 THEN NULL ELSE concat(md5(CAST(o_custkey + 2 AS STRING)), md5(CAST(o_custkey AS STRING))) END",
    "candidate_model": "CASE WHEN o_orderkey % 47 = 2 THEN 'v1' ELSE 'v3' END", "generation_model": "CASE WHEN o_orderkey % 53 = 2 THEN 'v1' ELSE 'v2' END", "class": "CASE WHEN o_custkey % 7 = 2 THEN 'PRESENT' ELSE 'ABSENT_CANDIDATE' END", "eligible": "o_custkey % 11 <> 2",
    "candidate_authority": "o_orderkey % 59 = 3", "generation_authority": "o_orderkey % 61 = 3", "versions": "CASE WHEN o_orderkey % 67 = 3 THEN 'old' ELSE 'current' END", "scope": "CASE WHEN o_custkey % 29 = 3 THEN 'other' ELSE 'supported' END", "token_id": "CASE WHEN o_custkey % 31 = 3 THEN 'x1' ELSE CAST(o_custkey AS STRING) END",
    "identity_hash": "CASE WHEN o_orderkey % 37 = 1 THEN 'x' ELSE concat('0x', md5(CAST(o_orderkey AS STRING)), md5(CAST(o_custkey AS STRING))) END", "sources": "CASE WHEN o_custkey % 37 = 3 THEN 0 ELSE 1 END", "fence_ok": "o_orderkey % 71 <> 4", "fence_order": "CASE WHEN o_orderkey % 73 = 4 THEN 'other' WHEN o_orderkey % 37 = 1 THEN 'x' ELSE concat('0x', md5(CAST(o_orderkey AS STRING)), md5(CAST(o_custkey AS STRING))) END",
}
_HASH = lambda c: f"({c} IS NULL OR NOT matches({c}, '^[0-9a-f]{{64}}$'))"
_ORDER = "matches(order_hash, '^0x[0-9a-f]{64}$')"
ELIGIBILITY: R.Rules = (
    ("INVALID_SWEEP_ID", "trim(sweep_id) = ''"), ("INVALID_ORDER_HASH", f"NOT {_ORDER}"), ("INVALID_CANDIDATEARTIFACTHASH", _HASH("candidate_hash")), ("INVALID_BARRIERARTIFACTHASH", _HASH("barrier_hash")), ("INVALID_GENERATIONROOTHASH", _HASH("root_hash")),
    ("CANDIDATE_MODEL_MISMATCH", "candidate_model <> 'v3'"), ("GENERATION_MODEL_MISMATCH", "generation_model <> 'v2'"), ("CANDIDATE_NOT_ABSENT", "class <> 'ABSENT_CANDIDATE'"), ("TARGETED_VERIFIER_NOT_ELIGIBLE", "NOT eligible"), ("CANDIDATE_AUTHORITY_NOT_FALSE", "candidate_authority"),
    ("GENERATION_AUTHORITY_NOT_FALSE", "generation_authority"), ("UNSUPPORTED_VERIFIER_VERSION", "versions <> 'current'"), ("UNSUPPORTED_ORDER_SCOPE", "scope <> 'supported'"), ("INVALID_EXPECTED_IDENTITY", "identity_hash <> order_hash OR NOT matches(token_id, '^(0|[1-9][0-9]*)$')"), ("INVALID_PROVENANCE", "sources = 0"),
    ("INVALID_PRE_VERIFICATION_FENCE", "NOT fence_ok"), ("FENCE_ORDER_MISMATCH", f"{_ORDER} AND fence_ok AND fence_order <> order_hash"),
)


@query("verifier_eligibility", f"WITH c AS ({R.derived_text('orders', CONTEXT)}), told AS (SELECT attempt_id, {R.reasons_text(ELIGIBILITY)} AS reasons FROM c) SELECT *, CASE WHEN reasons = '' THEN 'READY' ELSE 'VERIFIER_NOT_ELIGIBLE' END AS status FROM told")
def verifier_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a targeted look may be asked for, and what forbids it."""
    told = R.derived(read(spark, sf_dir, "orders"), CONTEXT).select("attempt_id", R.reasons(ELIGIBILITY).alias("reasons"))
    return told.select("*", F.when(F.col("reasons") == "", "READY").otherwise("VERIFIER_NOT_ELIGIBLE").alias("status"))


#: A stored attempt: which of its parts are filled in at its point of life.
RECORD = {
    "attempt_id": "o_orderkey", "created_ms": f"{NOW} - o_custkey % 1000 * 60000", "lifecycle": "CASE o_orderkey % 7 WHEN 0 THEN 'NOT_STARTED' WHEN 1 THEN 'REQUEST_PENDING' WHEN 2 THEN 'RESPONSE_OBSERVED' WHEN 3 THEN 'PENDING_FENCE' WHEN 4 THEN 'FAILED' WHEN 5 THEN 'COMPLETE' ELSE CASE WHEN o_custkey % 19 = 1 THEN 'PAUSED' ELSE 'COMPLETE' END END",
    "http": "CASE WHEN o_orderkey % 7 IN (0, 1) AND o_custkey % 13 <> 1 THEN NULL WHEN o_custkey % 17 = 2 THEN 42 ELSE 200 END", "result": "CASE WHEN o_orderkey % 7 IN (0, 1) OR (o_orderkey % 7 = 4 AND o_custkey % 3 = 0) THEN NULL ELSE 'INACTIVE_CONFIRMED' END", "final": "CASE WHEN o_orderkey % 7 < 4 OR (o_orderkey % 7 = 4 AND o_custkey % 3 = 0) THEN NULL WHEN o_custkey % 23 = 3 THEN 'STALE' ELSE 'INACTIVE_CONFIRMED' END",
    "evidence": "CASE WHEN o_orderkey % 7 < 4 OR (o_orderkey % 7 = 4 AND o_custkey % 3 = 0) OR o_custkey % 29 = 4 THEN NULL ELSE 'e' END", "post_fence": "CASE WHEN o_orderkey % 7 < 4 OR (o_orderkey % 7 = 4 AND o_custkey % 3 = 0) OR o_custkey % 31 = 4 THEN NULL ELSE 'p' END",
    "failure": "CASE WHEN o_orderkey % 7 = 4 THEN CASE o_custkey % 3 WHEN 0 THEN 'REQUEST_OUTCOME_UNCERTAIN' WHEN 1 THEN 'RETRY_SCHEDULED' ELSE 'STALE' END WHEN o_orderkey % 7 = 5 AND o_custkey % 11 = 5 THEN 'RETRY_EXHAUSTED' END", "retryable": "o_custkey % 3 = 1 AND o_orderkey % 7 = 4 OR o_custkey % 11 = 5", "authority": "o_custkey % 37 = 5", "lease": "CASE WHEN o_orderkey % 7 IN (1, 2, 3) THEN 'token' END",
    "next_ms": f"CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE {NOW} + (o_orderkey % 9 - 4) * 60000 END",
}
_NONE = "result IS NULL AND final IS NULL AND evidence IS NULL AND post_fence IS NULL"
_ALL = "result IS NOT NULL AND final IS NOT NULL AND evidence IS NOT NULL AND post_fence IS NOT NULL"
ADMISSION: R.Rules = (
    ("UNKNOWN_LIFECYCLE", "lifecycle NOT IN ('NOT_STARTED', 'REQUEST_PENDING', 'RESPONSE_OBSERVED', 'PENDING_FENCE', 'COMPLETE', 'FAILED')"), ("INVALID_HTTP_STATUS", "http < 100 OR http > 599"), ("RESULT_WITHOUT_EVIDENCE", "result IS NULL AND http IS NOT NULL"), ("AUTHORITY_NOT_FALSE", "authority"),
    ("RESULT_BEFORE_REQUEST", f"lifecycle IN ('NOT_STARTED', 'REQUEST_PENDING') AND NOT ({_NONE} AND failure IS NULL)"), ("FENCE_BEFORE_RESULT", "lifecycle IN ('RESPONSE_OBSERVED', 'PENDING_FENCE') AND NOT (result IS NOT NULL AND final IS NULL AND evidence IS NULL AND post_fence IS NULL AND failure IS NULL)"),
    ("INCOMPLETE_RECORD", f"lifecycle = 'COMPLETE' AND NOT ({_ALL} AND (failure IS NULL OR failure = 'RETRY_EXHAUSTED'))"), ("RETRY_AFTER_COMPLETION", "lifecycle = 'COMPLETE' AND failure IS NULL AND retryable"), ("EXHAUSTED_WITHOUT_RETRY", "lifecycle = 'COMPLETE' AND failure = 'RETRY_EXHAUSTED' AND (NOT retryable OR final <> result)"),
    ("FAILURE_INCONSISTENT", f"lifecycle = 'FAILED' AND NOT CASE WHEN failure IN ('REQUEST_OUTCOME_UNCERTAIN', 'EXECUTION_FAILED') THEN {_NONE} WHEN failure = 'RETRY_SCHEDULED' THEN {_ALL} AND final = result AND retryable WHEN failure = 'STALE' THEN {_ALL} AND final = 'STALE' WHEN failure = 'RECONCILIATION_REQUIRED' THEN {_ALL} AND final = 'RECONCILIATION_REQUIRED' ELSE false END"),
)
RECORD_SQL = f"WITH r AS ({R.derived_text('orders', RECORD)}), told AS (SELECT *, {R.reasons_text(ADMISSION)} AS problems FROM r)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.derived(read(spark, sf_dir, "orders"), RECORD).withColumn("problems", R.reasons(ADMISSION))


@query("attempt_admission", RECORD_SQL + " SELECT attempt_id, lifecycle, problems FROM told")
def attempt_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of a stored attempt doesn't go with its point of life; empty if it may be read."""
    return records(spark, sf_dir).select("attempt_id", "lifecycle", "problems")


DUE_LIMIT = 100


@query("attempts_due", RECORD_SQL + f" SELECT attempt_id, created_ms FROM told WHERE lifecycle = 'NOT_STARTED' AND problems = '' AND (next_ms IS NULL OR next_ms <= {NOW}) ORDER BY created_ms, attempt_id LIMIT {DUE_LIMIT}")
def attempts_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest attempts that may start now (a top-k report)."""
    due = records(spark, sf_dir).where("lifecycle = 'NOT_STARTED' AND problems = ''").where(F.col("next_ms").isNull() | (F.col("next_ms") <= NOW))
    return due.orderBy("created_ms", "attempt_id").limit(DUE_LIMIT).select("attempt_id", "created_ms")


#: Evidence of an attempt, bound to the context that asked for it.
BINDING: R.Rules = (("ATTEMPT_MISMATCH", "asked IS NULL"), ("ORDER_MISMATCH", "order_hash <> asked_order"), ("CONTEXT_NOT_READY", "asked_reasons <> ''"), ("RECORD_INVALID", "problems <> ''"))
_MATERIAL = "concat(CAST(attempt_id AS STRING), '|', order_hash, '|', lifecycle, '|', coalesce(result, ''), '|', coalesce(final, ''), '|', coalesce(failure, ''))"


@query("attempt_evidence", f"WITH c AS ({R.derived_text('orders', CONTEXT)}), asked AS (SELECT attempt_id, attempt_id AS asked, order_hash AS asked_order, {R.reasons_text(ELIGIBILITY)} AS asked_reasons FROM c WHERE attempt_id % 13 <> 5)," + RECORD_SQL.removeprefix("WITH")
       + f""", whole AS (SELECT told.*, c.order_hash, asked, asked_order, asked_reasons FROM told JOIN c USING (attempt_id) LEFT JOIN asked USING (attempt_id)), bound AS (SELECT *, {R.reasons_text(BINDING)} AS binding FROM whole)
SELECT attempt_id, binding, CASE WHEN binding = '' AND lifecycle = 'COMPLETE' THEN md5({_MATERIAL}) END AS artifact_hash, binding = '' AND lifecycle = 'COMPLETE' AND final = result AND failure IS NULL AS authoritative FROM bound""")  # fmt: skip
def attempt_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    contexts = R.derived(read(spark, sf_dir, "orders"), CONTEXT)
    own = records(spark, sf_dir).join(contexts.select("attempt_id", "order_hash"), "attempt_id")
    return bind_evidence(own, contexts.where("attempt_id % 13 <> 5"))


def bind_evidence(records: DataFrame, contexts: DataFrame) -> DataFrame:
    """(attempt_id, binding, artifact_hash, authoritative): complete attempts whose context asked for them, as hashed artifacts."""
    asked = contexts.select("attempt_id", F.col("attempt_id").alias("asked"), F.col("order_hash").alias("asked_order"), R.reasons(ELIGIBILITY).alias("asked_reasons"))
    bound = records.join(asked, "attempt_id", "left").withColumn("binding", R.reasons(BINDING))
    done = (F.col("binding") == "") & (F.col("lifecycle") == "COMPLETE")
    return bound.select("attempt_id", "binding", F.when(done, F.md5(R.expression(_MATERIAL))).alias("artifact_hash"), (done & (F.col("final") == F.col("result")) & F.col("failure").isNull()).alias("authoritative"))


#: Whether one absent candidate and one advancement make the context of a targeted look.
TARGETING: R.Rules = (("CANDIDATE_ORDER_NOT_UNIQUE", "matches <> 1"), ("CANDIDATE_NOT_TARGETED", "class <> 'ABSENT_CANDIDATE' OR NOT identity_ok"), ("TARGETED_VERIFIER_NOT_ELIGIBLE", "advances <> 1 OR NOT advancing"))
LISTED = {"sweep_id": "l_suppkey", "order_hash": "l_partkey % 500", "class": "CASE l_linenumber % 3 WHEN 0 THEN 'PRESENT' ELSE 'ABSENT_CANDIDATE' END", "identity_ok": "l_partkey % 31 <> 1", "eligible": "l_partkey % 37 <> 2"}


@query("target_contexts", f"""WITH c AS ({R.derived_text('lineitem', LISTED)}), told AS (SELECT sweep_id, order_hash, count(*) AS matches, min(class) AS class, bool_and(identity_ok) AS identity_ok, count(*) FILTER (WHERE class = 'ABSENT_CANDIDATE') AS advances, coalesce(bool_and(eligible) FILTER (WHERE class = 'ABSENT_CANDIDATE'), false) AS advancing FROM c GROUP BY ALL)
SELECT sweep_id, order_hash, {R.first_text(TARGETING, 'TARGETED')} AS outcome FROM told""")
def target_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a sweep for which a context can be derived, and what stands against it."""
    absent = F.col("class") == "ABSENT_CANDIDATE"
    told = R.derived(read(spark, sf_dir, "lineitem"), LISTED).groupBy("sweep_id", "order_hash").agg(
        F.count(F.lit(1)).alias("matches"), F.min("class").alias("class"), F.bool_and("identity_ok").alias("identity_ok"), F.count_if(absent).alias("advances"), F.coalesce(F.bool_and(F.when(absent, F.col("eligible"))), F.lit(False)).alias("advancing")
    )
    return told.select("sweep_id", "order_hash", R.first(TARGETING, "TARGETED").alias("outcome"))


#: A worker that reports on an attempt, with the lease it believes to hold.
LEASE = {"attempt_id": "o_orderkey", "lifecycle": "CASE o_orderkey % 5 WHEN 3 THEN 'COMPLETE' ELSE 'REQUEST_PENDING' END", "token": "md5(CAST(o_custkey AS STRING))", "given": "CASE WHEN o_orderkey % 7 = 3 THEN 'other' ELSE md5(CAST(o_custkey AS STRING)) END", "lease_ms": f"{NOW} + (o_custkey % 41 - 20) * 60000"}
SETTLEMENT: R.Rules = (("ALREADY_SETTLED", "lifecycle IN ('COMPLETE', 'FAILED')"), ("LEASE_LOST", "token IS NULL OR given IS NULL OR token <> given"), ("LEASE_EXPIRED", f"lease_ms <= {NOW}"))


@query("lease_settlement", f"WITH l AS ({R.derived_text('orders', LEASE)}), told AS (SELECT *, {R.first_text(SETTLEMENT, 'SETTLED')} AS outcome FROM l) SELECT attempt_id, outcome, CASE WHEN outcome = 'SETTLED' THEN 'COMPLETE' ELSE lifecycle END AS lifecycle, CASE WHEN outcome <> 'SETTLED' THEN token END AS token FROM told")
def lease_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results are taken from the holder of an unexpired lease alone; the lease ends with them."""
    told = R.derived(read(spark, sf_dir, "orders"), LEASE).withColumn("outcome", R.first(SETTLEMENT, "SETTLED"))
    taken = F.col("outcome") == "SETTLED"
    return told.select("attempt_id", "outcome", F.when(taken, "COMPLETE").otherwise(F.col("lifecycle")).alias("lifecycle"), F.when(~taken, F.col("token")).alias("token"))


@query("permit_throttle", ATTEMPTS_SQL + """, asked AS (SELECT attempt_id, subject, row_number() OVER (PARTITION BY subject ORDER BY lease_ms, attempt_id) - 1 AS place FROM attempts WHERE lifecycle = 'CREATED')
SELECT attempt_id, subject, place // 2 AS second, CAST(place % 2 AS INTEGER) AS permit FROM asked""")
def permit_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two requests a second for each subject, in the order of their leases."""
    asked = attempts(spark, sf_dir).where("lifecycle = 'CREATED'")
    place = F.row_number().over(Window.partitionBy("subject").orderBy("lease_ms", "attempt_id")) - 1
    return asked.select("attempt_id", "subject", place.alias("place")).select("attempt_id", "subject", F.expr("place div 2").alias("second"), (F.col("place") % 2).alias("permit"))
