"""Audit decisions on attempts to prove an order inactive: presence evidence, later evidence, the ladder, and two passes.

Rules are functions of evidence columns. The tables that feed the queries are
derived from ``orders`` (attempts) and ``lineitem`` (later attempts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, NOW, read

#: Evidence of one attempt: whether its parts are well formed, what generation it belongs to, what the current
#: generation, presence evidence and journal say, and how the attempt itself ended.
ATTEMPT = {
    "attempt_id": "o_orderkey", "order_hash": "md5(CAST(o_custkey AS STRING))",
    "attempt_ok": "o_orderkey % 29 <> 1", "generation_ok": "o_custkey % 31 <> 1", "active_ok": "o_orderkey % 37 <> 2", "journal_ok": "o_custkey % 41 <> 3",
    "later_ok": "o_orderkey % 43 <> 4", "later_complete": "o_orderkey % 4 <> 0", "later_hash": "CASE WHEN o_orderkey % 47 = 5 THEN 'other' ELSE md5(CAST(o_custkey AS STRING)) END",
    "commitment": "o_custkey % 10", "current_commitment": "CASE WHEN o_orderkey % 11 = 3 THEN o_custkey % 10 + 1 ELSE o_custkey % 10 END",
    "publication": "1000 + o_custkey % 10", "sequence": "5 + o_custkey % 10",
    "active_publication": "CASE WHEN o_orderkey % 17 = 4 THEN 1 ELSE 1000 + o_custkey % 10 END", "active_sequence": "CASE WHEN o_orderkey % 19 = 4 THEN 1 ELSE 5 + o_custkey % 10 END",
    "active_hash": "CASE WHEN o_orderkey % 59 = 4 THEN 'other' ELSE md5(CAST(o_custkey AS STRING)) END", "presence": "CASE WHEN o_orderkey % 6 = 0 THEN 'PRESENT' ELSE 'ABSENT' END",
    "pre_fingerprint": "CASE WHEN o_custkey % 13 = 2 THEN 'pre' ELSE md5(CAST(o_custkey AS STRING)) END", "post_fingerprint": "md5(CAST(o_custkey AS STRING))", "ambiguous": "o_orderkey % 83 = 5",
    "journal_fingerprint": "CASE WHEN o_orderkey % 23 = 6 THEN 'changed' ELSE md5(CAST(o_custkey AS STRING)) END",
    "pre_ms": f"{NOW} - {HOUR}", "pre_id": "o_orderkey % 100", "post_ms": f"CAST({NOW} AS BIGINT)", "post_id": "CASE WHEN o_orderkey % 67 = 1 THEN o_orderkey % 100 - 200 ELSE o_orderkey % 100 + 2 END",
    "journal_ms": f"CASE WHEN o_custkey % 27 = 5 THEN {NOW} - {2 * HOUR} ELSE CAST({NOW} AS BIGINT) END", "journal_id": "o_orderkey % 100 + 2 + o_custkey % 3",
    "active_ms": f"CAST({NOW} AS BIGINT)", "active_id": "o_orderkey % 100 + o_custkey % 4",
    "lifecycle": "CASE WHEN o_orderkey % 16 = 9 THEN 'FAILED' ELSE 'COMPLETE' END", "provider_status": "CASE WHEN o_custkey % 18 = 7 THEN 'UNKNOWN' ELSE 'INACTIVE_CONFIRMED' END",
    "final_status": "CASE WHEN o_custkey % 20 = 8 THEN 'STALE' ELSE 'INACTIVE_CONFIRMED' END", "failure": "CASE WHEN o_orderkey % 61 = 8 THEN 'RETRY_EXHAUSTED' END", "retryable": "o_custkey % 71 = 9",
}
#: Later attempts on the same order, numbered in the order in which they are read.
LATER = {
    "attempt_id": "l_orderkey", "entry": "l_linenumber", "identity_ok": "l_partkey % 53 <> 1", "own_commitment": "CASE WHEN l_suppkey % 5 < 3 THEN -1 ELSE l_suppkey % 10 END",
    "published_ok": "l_partkey % 59 <> 2", "later_sequence": "5 + l_partkey % 8", "later_state": "CASE WHEN l_partkey % 9 = 0 THEN 'ACTIVE_CONFIRMED' ELSE 'INACTIVE_CONFIRMED' END",
    "later_final": "CASE WHEN l_partkey % 18 = 9 THEN 'STALE' ELSE CASE WHEN l_partkey % 9 = 0 THEN 'ACTIVE_CONFIRMED' ELSE 'INACTIVE_CONFIRMED' END END", "later_lifecycle": "CASE WHEN l_suppkey % 11 = 3 THEN 'FAILED' ELSE 'COMPLETE' END",
    "later_failure": "CASE WHEN l_suppkey % 13 = 3 THEN 'STALE' END", "later_retryable": "l_suppkey % 17 = 4", "later_fence": "CASE WHEN l_partkey % 36 = 27 THEN 'STALE' ELSE 'ACTIVE_CONFIRMED' END",
    "start_ms": f"CASE WHEN l_linenumber % 3 = 0 THEN {NOW} - {HOUR} WHEN l_linenumber % 3 = 1 THEN CAST({NOW} AS BIGINT) ELSE {NOW} + {HOUR} END", "start_id": "l_orderkey % 100 + 2",
}

_CONFIRMED = "(later_lifecycle = 'COMPLETE' AND later_state = 'ACTIVE_CONFIRMED' AND later_final = 'ACTIVE_CONFIRMED' AND later_failure IS NULL AND NOT later_retryable)"
_SAME = "(CASE WHEN own_commitment = -1 THEN commitment ELSE own_commitment END = commitment)"
_SAME_MOMENT = "(start_ms = post_ms AND start_id = post_id)"
#: What makes one later attempt unusable, tried from the top: state and reason.
LATER_PROBLEMS: R.Rules = (
    ("RECONCILIATION_REQUIRED:LATER_PROVIDER_EVIDENCE_INVALID", "NOT identity_ok"),
    ("UNPROVEN:LATER_PROVIDER_EVIDENCE_INVALID", "NOT published_ok"),
    ("RECONCILIATION_REQUIRED:LATER_PROVIDER_EVIDENCE_INVALID", f"{_CONFIRMED} AND later_fence <> 'ACTIVE_CONFIRMED'"),
    ("RECONCILIATION_REQUIRED:ACTIVE_ORDERING_UNPROVEN", f"{_CONFIRMED} AND CASE WHEN {_SAME} THEN {_SAME_MOMENT} ELSE later_sequence = sequence END"),
)
#: How a later attempt stands to the decision: only confirmed activity after it counts.
ORDER_PROOFS: R.Rules = (
    ("NOT_ACTIVE", f"NOT {_CONFIRMED}"),
    ("SAME_GENERATION_JOURNAL", f"{_SAME} AND {R.later('start', 'post')}"),
    ("NEWER_GENERATION", f"NOT {_SAME} AND later_sequence > sequence"),
)
#: Malformed evidence: nothing can be decided.
UNPROVEN: R.Rules = (
    ("INVALID_CANDIDATE_ATTEMPT", "NOT attempt_ok"), ("INVALID_CURRENT_GENERATION", "NOT generation_ok"), ("INVALID_ACTIVE_EVIDENCE", "NOT active_ok"), ("INVALID_CURRENT_JOURNAL", "NOT journal_ok"),
    ("LATER_PROVIDER_EVIDENCE_UNPROVEN", "NOT later_ok AND NOT later_complete"), ("LATER_PROVIDER_EVIDENCE_INVALID", "NOT later_ok AND later_complete"),
)
#: What the journal did between the two looks at it, for a result that was confirmed before.
FENCE: R.Rules = (("RECONCILIATION_REQUIRED", f"ambiguous OR {R.later('pre', 'post')} OR pre_fingerprint <> post_fingerprint"),)
#: The ladder, tried from the top: state and reason.
LADDER: R.Rules = (
    ("UNPROVEN:LATER_PROVIDER_EVIDENCE_INVALID", "later_hash <> order_hash"),
    ("SUPERSEDED:CURRENT_GENERATION_MISMATCH", "commitment <> current_commitment"),
    ("RECONCILIATION_REQUIRED:ACTIVE_EVIDENCE_PUBLICATION_MISMATCH", "active_publication <> publication OR active_sequence <> sequence OR active_hash <> order_hash"),
    ("RECONCILIATION_REQUIRED:RELEVANT_JOURNAL_CHANGED", "journal_fingerprint <> post_fingerprint"),
    ("RECONCILIATION_REQUIRED:CURRENT_JOURNAL_WATERMARK_REGRESSION", R.later("post", "journal")),
    ("RECONCILIATION_REQUIRED:CURRENT_JOURNAL_BEHIND_ACTIVE_EVIDENCE", R.later("active", "journal")),
    ("RECONCILIATION_REQUIRED:FENCE_A_UNPROVEN", "fence <> 'INACTIVE_CONFIRMED'"),
    ("BLOCKED_BY_LATER_EVIDENCE:CURRENT_ACTIVE_EVIDENCE_PRESENT", "presence = 'PRESENT'"),
    ("SHADOW_INELIGIBLE:CANDIDATE_NOT_COMPLETE", "lifecycle <> 'COMPLETE'"),
    ("SHADOW_INELIGIBLE:ATTEMPT_NOT_INACTIVE_CONFIRMED", "provider_status <> 'INACTIVE_CONFIRMED' OR final_status <> 'INACTIVE_CONFIRMED' OR failure IS NOT NULL OR retryable"),
    ("BLOCKED_BY_LATER_EVIDENCE:LATER_ACTIVE_CONFIRMED", "problem IS NULL AND blocking"),
)
_JOURNAL_ID = "md5(concat(CAST(journal_ms AS STRING), '|', CAST(journal_id AS STRING), '|', journal_fingerprint))"

ATTEMPTS_SQL = f"WITH a AS ({R.derived_text('orders', ATTEMPT)}), l AS ({R.derived_text('lineitem', LATER)})"
ENTRIES_SQL = ATTEMPTS_SQL + f""", entries AS (
  SELECT a.attempt_id, l.entry, {R.first_text(LATER_PROBLEMS, None)} AS problem, {R.first_text(ORDER_PROOFS, 'HISTORICAL')} AS proof FROM a JOIN l USING (attempt_id))"""
DECISIONS_SQL = ENTRIES_SQL + """, told AS (SELECT attempt_id, min(CASE WHEN problem IS NOT NULL THEN {'entry': entry, 'problem': problem} END).problem AS problem, coalesce(bool_or(proof IN ('SAME_GENERATION_JOURNAL', 'NEWER_GENERATION')), false) AS blocking, count(*) AS entries FROM entries GROUP BY attempt_id),""" + f"""
whole AS (SELECT a.*, t.problem, coalesce(t.blocking, false) AS blocking, {R.first_text(FENCE, 'INACTIVE_CONFIRMED')} AS fence, {R.reasons_text(UNPROVEN)} AS unproven FROM a LEFT JOIN told t USING (attempt_id)),
judged AS (SELECT *, CASE WHEN unproven <> '' THEN 'UNPROVEN:' || unproven ELSE coalesce({R.first_text(LADDER, None)}, problem, 'SHADOW_ELIGIBLE:') END AS verdict FROM whole),
decisions AS (SELECT attempt_id, order_hash, split_part(verdict, ':', 1) AS state, split_part(verdict, ':', 2) AS reasons,
  md5(concat(CAST(attempt_id AS STRING), '|', CAST(publication AS STRING), '|', presence, '|', {_JOURNAL_ID}, '|', verdict)) AS decision_id FROM judged)"""


def later_entries(attempts: DataFrame, later: DataFrame) -> DataFrame:
    """(attempt_id, entry, problem, proof): how each later attempt is ordered against the attempt it follows."""
    both = attempts.select("attempt_id", "commitment", "sequence", "post_ms", "post_id").join(later, "attempt_id")
    return both.select("attempt_id", "entry", R.first(LATER_PROBLEMS, None).alias("problem"), R.first(ORDER_PROOFS, "HISTORICAL").alias("proof"))


def decide(attempts: DataFrame, later: DataFrame) -> DataFrame:
    """(attempt_id, order_hash, state, reasons, decision_id) of every attempt.

    Malformed evidence gives UNPROVEN with all its reasons; else the first rung
    that holds decides. Of later attempts the first unusable one (by entry)
    decides, unless a rung above did. The id hashes the attempt, the
    generation, the presence evidence, the journal and the verdict.
    """
    entries = later_entries(attempts, later)
    told = entries.groupBy("attempt_id").agg(
        F.min(F.when(F.col("problem").isNotNull(), F.struct("entry", "problem"))).getField("problem").alias("problem"), F.bool_or(F.col("proof").isin("SAME_GENERATION_JOURNAL", "NEWER_GENERATION")).alias("blocking")
    )
    whole = attempts.join(told, "attempt_id", "left").withColumn("blocking", F.coalesce("blocking", F.lit(False)))
    whole = whole.withColumns({"fence": R.first(FENCE, "INACTIVE_CONFIRMED"), "unproven": R.reasons(UNPROVEN)})
    verdict = F.when(F.col("unproven") != "", F.concat(F.lit("UNPROVEN:"), "unproven")).otherwise(F.coalesce(R.first(LADDER, None), "problem", F.lit("SHADOW_ELIGIBLE:")))
    judged = whole.withColumn("verdict", verdict)
    identity = R.expression(f"md5(concat(CAST(attempt_id AS STRING), '|', CAST(publication AS STRING), '|', presence, '|', {_JOURNAL_ID}, '|', verdict))")
    return judged.select("attempt_id", "order_hash", F.split_part("verdict", F.lit(":"), F.lit(1)).alias("state"), F.split_part("verdict", F.lit(":"), F.lit(2)).alias("reasons"), identity.alias("decision_id"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.derived(read(spark, sf_dir, "orders"), ATTEMPT)


def later_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.derived(read(spark, sf_dir, "lineitem"), LATER)


@query("later_evidence_order", ENTRIES_SQL + " SELECT * FROM entries")
def later_evidence_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return later_entries(attempts(spark, sf_dir), later_attempts(spark, sf_dir))


@query("shadow_decisions", DECISIONS_SQL + " SELECT * FROM decisions")
def shadow_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(attempts(spark, sf_dir), later_attempts(spark, sf_dir))


@query("shadow_ladder", DECISIONS_SQL + " SELECT state, reasons, count(*) AS n, min(attempt_id) AS first_attempt FROM decisions GROUP BY ALL")
def shadow_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many attempts come to each state and reason."""
    return shadow_decisions(spark, sf_dir).groupBy("state", "reasons").agg(F.count(F.lit(1)).alias("n"), F.min("attempt_id").alias("first_attempt"))


#: What a second look finds: the journal of some orders has moved on meanwhile.
SECOND_LOOK = {**ATTEMPT, "journal_fingerprint": "CASE WHEN o_orderkey % 23 = 6 OR o_orderkey % 13 = 1 THEN 'changed' ELSE md5(CAST(o_custkey AS STRING)) END"}
STABILITY: R.Rules = (("UNPROVEN", "first_state = 'UNPROVEN' OR second_state = 'UNPROVEN'"), ("SOURCE_CHANGED_DURING_EVALUATION", "first_id <> second_id"))


@query("two_pass_stability", DECISIONS_SQL + ", one AS (SELECT attempt_id, state AS first_state, decision_id AS first_id FROM decisions), two AS (" + DECISIONS_SQL.replace(R.derived_text("orders", ATTEMPT), R.derived_text("orders", SECOND_LOOK))
       + f" SELECT attempt_id, state AS second_state, decision_id AS second_id FROM decisions) SELECT attempt_id, {R.first_text(STABILITY, 'EVALUATED')} AS outcome FROM one JOIN two USING (attempt_id)")
def two_pass_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = later_attempts(spark, sf_dir)
    return stable(decide(attempts(spark, sf_dir), later), decide(R.derived(read(spark, sf_dir, "orders"), SECOND_LOOK), later))


def stable(first: DataFrame, second: DataFrame) -> DataFrame:
    """(attempt_id, outcome): a decision stands if a second evaluation gives the same id."""
    one, two = (d.select("attempt_id", F.col("state").alias(f"{n}_state"), F.col("decision_id").alias(f"{n}_id")) for n, d in (("first", first), ("second", second)))
    return one.join(two, "attempt_id").select("attempt_id", R.first(STABILITY, "EVALUATED").alias("outcome"))


def corrupt_decisions(stored: DataFrame, attempts: DataFrame, later: DataFrame) -> DataFrame:
    """Stored decisions that their evidence does not give: unknown attempts, or another state, reasons or id."""
    own = decide(attempts, later).select("attempt_id", F.struct("state", "reasons", "decision_id").alias("own"))
    return stored.join(own, "attempt_id", "left").where(~F.struct("state", "reasons", "decision_id").eqNullSafe(F.col("own"))).select("attempt_id")


@query("stored_decision_check", DECISIONS_SQL + " SELECT attempt_id FROM decisions WHERE attempt_id % 50 = 7 AND reasons <> 'CANDIDATE_NOT_COMPLETE'")
def stored_decision_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions whose stored reasons were altered (by the rule of the SQL) are the ones that don't follow from their evidence."""
    given, later = attempts(spark, sf_dir), later_attempts(spark, sf_dir)
    altered = F.when(F.col("attempt_id") % 50 == 7, "CANDIDATE_NOT_COMPLETE").otherwise(F.col("reasons"))
    return corrupt_decisions(decide(given, later).withColumn("reasons", altered), given, later)


#: Candidates of generations: an order as a sweep's bundle lists it.
CANDIDATE = {
    "order_hash": "md5(CAST(l_orderkey % 5000 AS STRING))", "sweep_id": "l_suppkey % 10", "classification": "CASE l_linenumber % 3 WHEN 0 THEN 'PRESENT' WHEN 1 THEN 'ABSENT_CANDIDATE' ELSE 'BLOCKED' END",
    "reasons": "CASE WHEN l_linenumber % 3 = 2 OR l_partkey % 31 = 1 THEN 'PENDING_EVENT' ELSE '' END", "seen": "CASE WHEN l_partkey % 37 = 1 THEN l_linenumber % 3 <> 0 ELSE l_linenumber % 3 = 0 END", "token_id": "l_orderkey % 5000 + CASE WHEN l_partkey % 41 = 1 THEN 1 ELSE 0 END",
}
PUBLICATION = {
    "sweep_id": "CAST(n_nationkey % 10 AS BIGINT)", "publication": "CAST(n_nationkey AS BIGINT)", "sequence": "CAST(n_nationkey AS BIGINT)", "accepted": "n_nationkey < 10", "barrier_state": "CASE WHEN n_nationkey % 7 = 3 THEN 'ABORTED' ELSE 'VERIFIED' END",
    "catch_up": "CASE WHEN n_nationkey % 8 = 4 THEN 'NOT_STABLE' ELSE 'STABLE' END", "stable_ms": f"CASE WHEN n_nationkey = 9 THEN NULL ELSE {NOW} + n_nationkey END",
}
EXPECTED = {"order_hash": "md5(CAST(o_orderkey % 5500 AS STRING))", "attempt_id": "o_orderkey", "sweep_id": "o_custkey % 10", "token_id": "o_orderkey % 5500"}
PRESENCE_PROBLEMS: R.Rules = (
    ("ACTIVE_EVIDENCE_PUBLICATION_MISMATCH", "publication IS NULL OR NOT accepted"), ("ACTIVE_EVIDENCE_ORDER_NOT_FOUND", "matches = 0"), ("ACTIVE_EVIDENCE_IDENTITY_AMBIGUOUS", "matches > 1"),
    ("ACTIVE_EVIDENCE_IDENTITY_MISMATCH", "listed_token <> token_id"), ("ACTIVE_EVIDENCE_BLOCKED", "classification = 'BLOCKED'"),
    ("ACTIVE_EVIDENCE_IDENTITY_MISMATCH", "classification NOT IN ('PRESENT', 'ABSENT_CANDIDATE') OR reasons <> '' OR seen <> (classification = 'PRESENT')"),
    ("ACTIVE_EVIDENCE_WATERMARK_UNPROVEN", "barrier_state <> 'VERIFIED' OR catch_up <> 'STABLE' OR stable_ms IS NULL"),
)


@query("active_evidence", f"""WITH c AS ({R.derived_text('lineitem', CANDIDATE)}), p AS ({R.derived_text('nation', PUBLICATION)}), e AS ({R.derived_text('orders', EXPECTED)}),
bundle AS (SELECT sweep_id, order_hash, count(*) AS matches, min(classification) AS classification, min(reasons) AS reasons, bool_and(seen) AS seen, min(token_id) AS listed_token FROM c GROUP BY sweep_id, order_hash),
current AS (SELECT sweep_id, arg_max(publication, sequence) AS publication, true AS accepted, arg_max(barrier_state, sequence) AS barrier_state, arg_max(catch_up, sequence) AS catch_up, max(stable_ms) AS stable_ms FROM p WHERE accepted GROUP BY sweep_id),
joined AS (SELECT e.attempt_id, e.token_id, b.* EXCLUDE (matches, sweep_id, order_hash), coalesce(b.matches, 0) AS matches, current.* EXCLUDE (sweep_id) FROM e LEFT JOIN bundle b USING (sweep_id, order_hash) LEFT JOIN current USING (sweep_id)),
told AS (SELECT *, {R.first_text(PRESENCE_PROBLEMS, None)} AS problem FROM joined)
SELECT attempt_id, problem, CASE WHEN problem IS NULL THEN CASE WHEN classification = 'PRESENT' THEN 'PRESENT' ELSE 'ABSENT' END END AS presence, CASE WHEN problem IS NULL THEN stable_ms END AS observed_ms FROM told""")
def active_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates, published = R.derived(read(spark, sf_dir, "lineitem"), CANDIDATE), R.derived(read(spark, sf_dir, "nation"), PUBLICATION)
    return derive_presence(R.derived(read(spark, sf_dir, "orders"), EXPECTED), candidates, published)


def derive_presence(expected: DataFrame, candidates: DataFrame, published: DataFrame) -> DataFrame:
    """(attempt_id, problem, presence, observed_ms) of each expected order in the accepted publication of its sweep.

    Presence needs one unblocked entry with the same identity, and a verified
    generation with a stable watermark; else it says what is missing.
    """
    bundle = candidates.groupBy("sweep_id", "order_hash").agg(
        F.count(F.lit(1)).alias("matches"), F.min("classification").alias("classification"), F.min("reasons").alias("reasons"), F.bool_and("seen").alias("seen"), F.min("token_id").alias("listed_token")
    )
    current = published.where("accepted").groupBy("sweep_id").agg(*(F.max_by(c, "sequence").alias(c) for c in ("publication", "accepted", "barrier_state", "catch_up", "stable_ms")))
    joined = expected.join(bundle, ["sweep_id", "order_hash"], "left").join(current, "sweep_id", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    told = joined.withColumn("problem", R.first(PRESENCE_PROBLEMS, None))
    good = F.col("problem").isNull()
    presence = F.when(good, F.when(F.col("classification") == "PRESENT", "PRESENT").otherwise("ABSENT"))
    return told.select("attempt_id", "problem", presence.alias("presence"), F.when(good, F.col("stable_ms")).alias("observed_ms"))
