"""Fences of the journal and identities of attempts: whether a fence is well formed, and which attempts are one and the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.operators.evidence_store import _duck, _text, canonical_object
from tidemark.plans.registry import query
from tidemark.sources.journal import FAMILIES, JOURNAL_SQL, NOW, journal, read

_DECIMAL, _ISO = "^(0|[1-9][0-9]*)$", "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?Z$"
_TYPES = ", ".join(f"'{t}'" for t in (*FAMILIES.values(), "order_revalidate"))

#: What one entry of a fence's fingerprint (a listed id beside an event) has wrong; ``listed_before`` is the id listed before it.
ENTRY_FAULTS: R.Rules = (
    ("bad_listed", f"NOT coalesce(matches(listed_id, '{_DECIMAL}'), false)"),
    ("bad_event", f"NOT coalesce(matches(event_id, '{_DECIMAL}') AND event_type IN ({_TYPES}), false)"),
    ("bad_version", f"event_version IS NOT NULL AND NOT matches(event_version, '{_DECIMAL}')"),
    ("strange_order", "NOT coalesce(entry_hash = order_hash, false)"), ("apart", "NOT coalesce(event_id = listed_id, false)"),
    # decimal texts without leading zeros compare by length, then by digits
    ("unordered", "listed_before IS NOT NULL AND (length(listed_before) > length(listed_id) OR (length(listed_before) = length(listed_id) AND listed_before > listed_id))"),
    ("listed_again", "listed_before = listed_id"),
)
FENCE_REASONS: R.Rules = (
    ("WATERMARK_INVALID", f"NOT coalesce(matches(watermark_id, '{_DECIMAL}') AND matches(watermark_at, '{_ISO}'), false)"), ("ORDERING_AMBIGUITY_UNKNOWN", "ordering_ambiguous IS NULL"), ("FINGERPRINT_EVENT_ID_INVALID", "bad_listed"), ("FINGERPRINT_EVENT_INVALID", "bad_event OR bad_version"),
    ("FINGERPRINT_EVENTS_APART_FROM_IDS", "apart"), ("FINGERPRINT_IDS_UNORDERED", "unordered"), ("FINGERPRINT_IDS_REPEATED", "listed_again"), ("FINGERPRINT_OF_OTHER_ORDER", "strange_order"),
)


def validated_fences(fences: DataFrame, entries: DataFrame) -> DataFrame:
    """(fence_id, entries, reasons) of fences (fence_id, order_hash, watermark_id, watermark_at, ordering_ambiguous) with their
    entries (fence_id, place, listed_id, event_id, event_type, entry_hash, event_version). A fence without entries can be sound.

    Ids are decimal texts of any length. Each entry meets the one before it, so order and repetitions need no list of ids.
    """
    before = F.lag("listed_id").over(Window.partitionBy("fence_id").orderBy("place", "listed_id"))
    placed = entries.withColumn("listed_before", before).join(fences.select("fence_id", "order_hash"), "fence_id")
    flags = placed.groupBy("fence_id").agg(F.count(F.lit(1)).alias("entries"), *(F.bool_or(R.expression(c)).alias(n) for n, c in ENTRY_FAULTS))
    told = fences.join(flags, "fence_id", "left")
    return told.select("fence_id", F.coalesce("entries", F.lit(0)).alias("entries"), R.reasons(FENCE_REASONS).alias("reasons"))


#: Fences of the journal's orders, one an order, as they were stored; some were spoilt.
_FENCE = {
    "fence_id": "order_hash", "order_hash": "order_hash", "watermark_id": "CASE WHEN high % 13 = 1 THEN concat('0', CAST(high AS STRING)) ELSE CAST(high AS STRING) END", "watermark_at": "CASE WHEN high % 17 = 2 THEN 'yesterday' ELSE '2024-01-20T00:00:00.000Z' END",
    "ordering_ambiguous": "CASE WHEN high % 19 = 3 THEN NULL ELSE high % 2 = 0 END",
}
_ENTRY = {
    "fence_id": "order_hash", "place": "CASE WHEN event_id % 211 = 1 THEN -event_id ELSE event_id END", "listed_id": "CASE WHEN event_id % 223 = 2 THEN concat('0', CAST(event_id AS STRING)) ELSE CAST(event_id AS STRING) END",
    "event_id": "CASE WHEN event_id % 223 = 2 THEN concat('0', CAST(event_id AS STRING)) WHEN event_id % 227 = 3 THEN CAST(event_id + 1 AS STRING) ELSE CAST(event_id AS STRING) END", "event_type": "CASE WHEN event_id % 229 = 4 THEN 'item_minted' ELSE event_type END",
    "entry_hash": "CASE WHEN event_id % 233 = 5 THEN 'other' ELSE order_hash END", "event_version": "CASE WHEN event_id % 239 = 6 THEN '1.0' ELSE CAST(event_version AS STRING) END",
}
_TWICE = "event_id % 241 = 7"


@query("fence_validation", JOURNAL_SQL + f""", own AS (SELECT * FROM j WHERE order_hash IS NOT NULL AND received_ms <= {NOW}),
f AS ({R.derived_text('(SELECT order_hash, max(event_id) AS high FROM own GROUP BY order_hash)', _FENCE)}),
e AS ({R.derived_text(f'(SELECT * FROM own UNION ALL SELECT * FROM own WHERE {_TWICE})', _ENTRY)}),
placed AS (SELECT e.*, f.order_hash, lag(listed_id) OVER (PARTITION BY fence_id ORDER BY place, listed_id) AS listed_before FROM e JOIN f USING (fence_id)),
flags AS (SELECT fence_id, count(*) AS entries, {', '.join(f'coalesce(bool_or({R.text_of(c)}), false) AS {n}' for n, c in ENTRY_FAULTS)} FROM placed GROUP BY fence_id)
SELECT fence_id, coalesce(entries, 0) AS entries, {R.reasons_text(FENCE_REASONS)} AS reasons FROM f LEFT JOIN flags USING (fence_id)""")
def fence_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = journal(spark, sf_dir).where(f"order_hash IS NOT NULL AND received_ms <= {NOW}")
    fences = R.derived(own.groupBy("order_hash").agg(F.max("event_id").alias("high")), _FENCE)
    return validated_fences(fences, R.derived(own.unionAll(own.where(_TWICE)), _ENTRY))


#: What identifies an attempt (canonical texts of the request and the order that was expected), and all that its evidence says beside.
_MATERIAL = {
    "sweepId": _text("sweep_id"), "candidateArtifactHash": _text("candidate_hash"), "barrierArtifactHash": _text("barrier_hash"), "generationRootHash": _text("root_hash"), "candidateModelVersion": _text("candidate_model"), "generationModelVersion": _text("generation_model"),
    "verifierSchemaVersion": _text("schema_version"), "verifierPolicyVersion": _text("policy_version"), "providerContractVersion": _text("contract_version"), "normalizerVersion": _text("normalizer_version"), "requestIdentity": "request", "expectedIdentity": "expected", "attemptNumber": "CAST(attempt_number AS STRING)",
}
_FOUND = {"normalizedProviderStatus": _text("provider"), "reasonCodes": "reasons", "responseBodySha256": _text("body_hash")}
ATTEMPT_ID = f"sha2({canonical_object(**_MATERIAL)}, 256)"
SEMANTIC_HASH = f"sha2({canonical_object(**_MATERIAL, **_FOUND)}, 256)"


def identified(attempts: DataFrame) -> DataFrame:
    """Adds attempt_key, the hash of what was asked, and semantic_hash, the hash of that and of what was found."""
    return attempts.withColumn("attempt_key", F.expr(ATTEMPT_ID)).withColumn("semantic_hash", F.expr(SEMANTIC_HASH))


def settled_attempts(attempts: DataFrame) -> DataFrame:
    """(attempt_key, attempts, verdict): ONCE, REPEATED (the same evidence again: writing it changes nothing) or CONFLICT (other evidence under one key)."""
    told = identified(attempts).groupBy("attempt_key").agg(F.count(F.lit(1)).alias("attempts"), F.min("semantic_hash").alias("lo"), F.max("semantic_hash").alias("hi"))
    verdict = F.when(F.col("lo") != F.col("hi"), "CONFLICT").when(F.col("attempts") > 1, "REPEATED").otherwise("ONCE")
    return told.select("attempt_key", "attempts", verdict.alias("verdict"))


_ATTEMPT = {
    "sweep_id": "concat('sweep-', CAST(o_custkey % 7 AS STRING))", "candidate_hash": "md5(CAST(o_custkey AS STRING))", "barrier_hash": "md5(CAST(o_custkey + 1 AS STRING))", "root_hash": "md5(CAST(o_custkey + 2 AS STRING))", "candidate_model": "'v3'", "generation_model": "'v2'", "schema_version": "'schema-4'", "policy_version": "'policy-8'",
    "contract_version": "'contract-3'", "normalizer_version": "'normalizer-5'", "request": """concat('{"method":"GET","orderHash":"', md5(CAST(o_custkey AS STRING)), '"}')""", "expected": """concat('{"tokenId":"', CAST(o_custkey AS STRING), '"}')""", "attempt_number": "o_orderkey % 5",
    "provider": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'ACTIVE' ELSE 'INACTIVE' END", "reasons": "'[]'", "body_hash": "md5(CASE WHEN o_orderpriority = '1-URGENT' THEN 'a' ELSE 'i' END)",
}


@query("attempt_identity", f"""WITH a AS ({R.derived_text('orders', _ATTEMPT)}), k AS (SELECT {_duck(ATTEMPT_ID)} AS attempt_key, {_duck(SEMANTIC_HASH)} AS semantic_hash FROM a)
SELECT attempt_key, count(*) AS attempts, CASE WHEN count(DISTINCT semantic_hash) > 1 THEN 'CONFLICT' WHEN count(*) > 1 THEN 'REPEATED' ELSE 'ONCE' END AS verdict FROM k GROUP BY attempt_key""")
def attempt_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts under one key: the same request asked again, with the same answer or another."""
    return settled_attempts(R.derived(read(spark, sf_dir, "orders"), _ATTEMPT))
