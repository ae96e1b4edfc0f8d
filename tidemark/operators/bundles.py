"""Whole candidate bundles: their header, their orders one after another, their counts, and the events that each order names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.operators.evidence_store import CANDIDATE_MODEL
from tidemark.operators.generations import EVENT_REASONS, ORDER_REASONS
from tidemark.plans.registry import query
from tidemark.sources.journal import FAMILIES, STATUSES, read

_REASONS = ", ".join(f"'{n}'" for n in sorted({n for n, _ in (*ORDER_REASONS, *EVENT_REASONS)}))
_TYPES, _STATUSES = ", ".join(f"'{t}'" for t in (*FAMILIES.values(), "order_revalidate")), ", ".join(f"'{s}'" for s in STATUSES)
_CLASSES = "class IN ('PRESENT', 'ABSENT_CANDIDATE', 'BLOCKED')"

#: Flags of one order; ``hash_before`` and ``reason_before`` belong to the order or reason before it. A flag that is null does not hold.
ORDER_FLAGS: R.Rules = (
    ("bad_hash", "NOT coalesce(matches(order_hash, '^0x[0-9a-f]{64}$'), false)"), ("authority", "NOT coalesce(order_authority = false, false)"), ("bad_identity", "NOT coalesce(identity_status <> 'INVALID_LOCAL_IDENTITY' AND identity_hash = order_hash, false)"),
    ("out_of_scope", "identity_status = 'UNSUPPORTED_LOCAL_SCOPE' AND NOT coalesce(class = 'BLOCKED', false)"), ("bad_class", f"NOT coalesce({_CLASSES}, false)"), ("unseen", "seen IS NULL OR (class = 'PRESENT' AND NOT seen) OR (class = 'ABSENT_CANDIDATE' AND seen)"),
    ("bad_reasons", "reasons IS NULL OR unknown_reasons OR unsorted_reasons OR (class IN ('PRESENT', 'ABSENT_CANDIDATE') AND n_reasons > 0) OR (class = 'BLOCKED' AND n_reasons = 0)"), ("unordered", "hash_before > order_hash"),
)
#: Flags of one entry of an order's events: the id that is listed beside the event that is told.
EVENT_FLAGS: R.Rules = (
    ("bad_entry", f"NOT coalesce(trim(listed_id) <> '' AND told_id = listed_id AND event_type IN ({_TYPES}) AND processing_status IN ({_STATUSES}) AND received_ms IS NOT NULL, false) OR trim(event_version) = ''"), ("entries_unordered", "listed_before >= listed_id"),
)
#: What is wrong with a bundle.
AUDIT_REASONS: R.Rules = (
    ("INVALID_CANDIDATE_AUTHORITY", f"NOT coalesce(model = '{CANDIDATE_MODEL}' AND bundle_authority = false, false) OR authority"),
    (
        "INVALID_CANDIDATE_BUNDLE",
        "NOT coalesce(trim(sweep_name) <> '' AND started_ms <= completed_ms AND sources > 0 AND manifest_eligible, false) OR bad_class OR unseen OR bad_reasons OR unordered OR bad_entry OR entries_unordered"
        " OR NOT coalesce(count_present = present AND count_absent = absent AND count_blocked = blocked AND count_total = present + absent + blocked, false)",
    ),
    ("INVALID_CANDIDATE_IDENTITY", "bad_hash"), ("IDENTITY_AMBIGUOUS", "repeated"), ("INVALID_LOCAL_IDENTITY", "bad_identity"), ("UNSUPPORTED_LOCAL_SCOPE", "out_of_scope"),
)


#: So many places go to one window; the last of them goes to the next window too.
BLOCK = 4096


def beside_the_last(rows: DataFrame, keys: list[str], place: str, value: str, name: str) -> DataFrame:
    """Rows with the value of the row one place before, within the keys, as ``name``; null if there is none.

    A window holds one block of places, so a group of any length is spread; rows that lie by some of the keys are not
    dealt out again. At a place that several rows share, the greatest value counts.
    """
    block = F.expr(f"{place} div {BLOCK}")
    blocks = F.when(F.col(place) % BLOCK == BLOCK - 1, F.array(block, block + 1)).otherwise(F.array(block))
    near = Window.partitionBy(*keys, "block").orderBy(place).rangeBetween(-1, -1)
    return rows.withColumn("block", F.explode(blocks)).withColumn(name, F.when(F.col(place).isNotNull(), F.max(value).over(near))).where(F.col("block").eqNullSafe(block)).drop("block")


def _flagged(rows: DataFrame, flags: R.Rules) -> DataFrame:
    """Bundles in which a flag holds, with all flags; the others need no place in a join."""
    told = rows.groupBy("bundle_id").agg(*(F.bool_or(R.expression(c)).alias(n) for n, c in flags))
    return told.where(" OR ".join(n for n, _ in flags))


def audited_bundles(bundles: DataFrame, orders: DataFrame, entries: DataFrame) -> DataFrame:
    """(bundle_id, orders, reasons) of bundles with their orders (by place, from 1) and the entries of each order (by order's place and nth, from 1).

    An order meets the one before it in a window over a block of places, not over its bundle, so a bundle with most of
    the orders is spread like any other; repeated hashes are counted by hash. Only what is compared with the row before
    is sorted, and nothing is shuffled if orders and entries lie by their bundle.
    """
    listed = F.split("reasons", ",")
    known = F.when(F.col("reasons") == "", F.array().cast("array<string>")).otherwise(listed)
    whole = orders.withColumns({
        "n_reasons": F.size(known), "unknown_reasons": F.exists(known, lambda r: ~r.isin(*(x.strip("'") for x in _REASONS.split(", ")))), "unsorted_reasons": known != F.array_sort(F.array_distinct(known)),
    })
    counted = orders.groupBy("bundle_id").agg(F.count(F.lit(1)).alias("orders"), *(F.count_if(F.col("class") == c).alias(n) for n, c in (("present", "PRESENT"), ("absent", "ABSENT_CANDIDATE"), ("blocked", "BLOCKED"))))
    flags = _flagged(whole, tuple(f for f in ORDER_FLAGS if f[0] != "unordered"))
    copies = _flagged(orders.groupBy("bundle_id", "order_hash").agg(F.count(F.lit(1)).alias("n")), (("repeated", "n > 1"),))
    placed = _flagged(beside_the_last(orders.select("bundle_id", "place", "order_hash"), ["bundle_id"], "place", "order_hash", "hash_before"), tuple(f for f in ORDER_FLAGS if f[0] == "unordered"))
    entry = entries.select("bundle_id", "place", "nth", "listed_id", R.expression(dict(EVENT_FLAGS)["bad_entry"]).alias("bad_entry"))
    events = _flagged(beside_the_last(entry, ["bundle_id", "place"], "nth", "listed_id", "listed_before"), (("bad_entry", "bad_entry"), *(f for f in EVENT_FLAGS if f[0] != "bad_entry")))
    told = bundles
    for found in (counted, flags, copies, placed, events):
        told = told.join(found, "bundle_id", "left")
    return told.na.fill(0, ["orders", "present", "absent", "blocked"]).select("bundle_id", "orders", R.reasons(AUDIT_REASONS).alias("reasons"))


#: Bundles of the orders table, their orders from its lines, as they were stored; some were spoilt since.
_BUNDLE = {
    "bundle_id": "o_orderkey", "sweep_name": "CASE WHEN o_orderkey % 61 = 1 THEN ' ' ELSE concat('sweep-', CAST(o_orderkey AS STRING)) END", "model": f"CASE WHEN o_custkey % 53 = 2 THEN 'v1' ELSE '{CANDIDATE_MODEL}' END", "bundle_authority": "o_orderkey % 67 = 3", "started_ms": "CAST(o_custkey AS BIGINT)",
    "completed_ms": "CASE WHEN o_orderkey % 71 = 4 THEN 0 ELSE CAST(o_custkey AS BIGINT) + 5 END", "sources": "CASE WHEN o_custkey % 59 = 5 THEN 0 ELSE 1 END", "manifest_eligible": "o_orderkey % 73 <> 6",
}
_HASH = "concat('0x', md5(CAST(l_partkey AS STRING)), md5(CAST(l_suppkey AS STRING)))"
_LINE = {"bundle_id": "l_orderkey", "line": "l_linenumber", "part": "l_partkey", "supplier": "l_suppkey", "hash": _HASH}
_BARE = {n: c for n, c in _LINE.items() if n != "hash"}
#: Sorts like the hash, in half the bytes.
_KEY = "concat(unhex(md5(CAST(part AS STRING))), unhex(md5(CAST(supplier AS STRING))))"
_ORDER = {
    "bundle_id": "bundle_id", "place": "CASE WHEN bundle_id % 79 = 7 THEN n + 1 - rank_ ELSE rank_ END", "order_hash": "CASE WHEN part % 211 = 1 THEN upper(hash) ELSE hash END", "class": "CASE WHEN part % 223 = 2 THEN 'LOST' WHEN supplier % 3 = 0 THEN 'PRESENT' WHEN supplier % 3 = 1 THEN 'ABSENT_CANDIDATE' ELSE 'BLOCKED' END",
    "reasons": "CASE WHEN part % 227 = 3 THEN 'SOME_REASON' WHEN supplier % 3 <> 2 THEN '' WHEN part % 229 = 4 THEN 'PENDING_EVENT,FAILED_EVENT' WHEN part % 2 = 0 THEN 'FAILED_EVENT,PENDING_EVENT' ELSE 'ORDER_NOT_ACTIVE' END", "seen": "CASE WHEN part % 233 = 5 THEN NULL ELSE supplier % 3 = 0 END", "order_authority": "part % 239 = 6",
    "identity_status": "CASE WHEN part % 241 = 7 THEN 'INVALID_LOCAL_IDENTITY' WHEN part % 251 = 8 THEN 'UNSUPPORTED_LOCAL_SCOPE' ELSE 'VALID' END", "identity_hash": "CASE WHEN part % 211 = 1 THEN upper(hash) WHEN part % 257 = 9 THEN 'other' ELSE hash END",
}
_ENTRY = {
    "bundle_id": "bundle_id", "place": "CASE WHEN bundle_id % 79 = 7 THEN n + 1 - rank_ ELSE rank_ END", "nth": "nth", "listed_id": "CASE WHEN part % 263 = 1 AND nth = 2 THEN concat('e', CAST(part AS STRING), '-0') ELSE concat('e', CAST(part AS STRING), '-', CAST(nth AS STRING)) END",
    "told_id": "CASE WHEN part % 263 = 1 AND nth = 2 THEN concat('e', CAST(part AS STRING), '-0') WHEN part % 269 = 2 THEN 'other' ELSE concat('e', CAST(part AS STRING), '-', CAST(nth AS STRING)) END", "event_type": "CASE WHEN part % 271 = 3 THEN 'item_minted' ELSE 'item_listed' END",
    "processing_status": "CASE WHEN part % 277 = 4 THEN 'paused' ELSE 'applied' END", "received_ms": "CASE WHEN part % 281 = 5 THEN NULL ELSE CAST(part AS BIGINT) END", "event_version": "CASE WHEN part % 283 = 6 THEN '' WHEN part % 5 = 0 THEN NULL ELSE '1' END",
}
#: Counts as they were written: as they are, but for some.
_COUNTED = {"count_present": "p + CASE WHEN bundle_id % 83 = 8 THEN 1 ELSE 0 END", "count_absent": "a", "count_blocked": "b", "count_total": "p + a + b"}


@query("bundle_audit", f"""WITH l AS ({R.derived_text('lineitem', _LINE)}), ranked AS (SELECT *, row_number() OVER (PARTITION BY bundle_id ORDER BY hash, line, part, supplier) AS rank_, count(*) OVER (PARTITION BY bundle_id) AS n FROM l),
o AS ({R.derived_text('ranked', _ORDER)}), e AS ({R.derived_text('(SELECT *, unnest([1, 2]) AS nth FROM ranked)', _ENTRY)}),
counts AS (SELECT bundle_id, count(*) FILTER (WHERE class = 'PRESENT') AS p, count(*) FILTER (WHERE class = 'ABSENT_CANDIDATE') AS a, count(*) FILTER (WHERE class = 'BLOCKED') AS b FROM o GROUP BY bundle_id),
bundles AS (SELECT x.*, {', '.join(f'{c} AS {n}' for n, c in _COUNTED.items())} FROM ({R.derived_text('orders', _BUNDLE)}) x LEFT JOIN (SELECT bundle_id, p, a, b FROM counts) c USING (bundle_id)),
w AS (SELECT *, CASE WHEN reasons = '' THEN [] ELSE string_split(reasons, ',') END AS known, lag(order_hash) OVER (PARTITION BY bundle_id ORDER BY place) AS hash_before FROM o),
v AS (SELECT *, len(known) AS n_reasons, len(list_filter(known, lambda x: x NOT IN ({_REASONS}))) > 0 AS unknown_reasons, known <> list_sort(list_distinct(known)) AS unsorted_reasons FROM w),
flags AS (SELECT bundle_id, count(*) AS orders, count(*) FILTER (WHERE class = 'PRESENT') AS present, count(*) FILTER (WHERE class = 'ABSENT_CANDIDATE') AS absent, count(*) FILTER (WHERE class = 'BLOCKED') AS blocked, count(*) > count(DISTINCT order_hash) AS repeated,
  {', '.join(f'bool_or({R.text_of(c)}) AS {n}' for n, c in ORDER_FLAGS)} FROM v GROUP BY bundle_id),
f AS (SELECT *, lag(listed_id) OVER (PARTITION BY bundle_id, place ORDER BY nth) AS listed_before FROM e),
events_ AS (SELECT bundle_id, {', '.join(f'bool_or({R.text_of(c)}) AS {n}' for n, c in EVENT_FLAGS)} FROM f GROUP BY bundle_id),
told AS (SELECT b.*, coalesce(orders, 0) AS orders, coalesce(present, 0) AS present, coalesce(absent, 0) AS absent, coalesce(blocked, 0) AS blocked, g.* EXCLUDE (bundle_id, orders, present, absent, blocked), h.* EXCLUDE (bundle_id) FROM bundles b LEFT JOIN flags g USING (bundle_id) LEFT JOIN events_ h USING (bundle_id))
SELECT bundle_id, orders, {R.reasons_text(AUDIT_REASONS)} AS reasons FROM told""")
def bundle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt out once, by whole numbers: every branch below has this shuffle in common, and makes its hashes behind the sort
    bare = R.derived(read(spark, sf_dir, "lineitem"), _BARE).repartition("bundle_id")
    own = Window.partitionBy("bundle_id")
    sorted_ = bare.withColumn("key", F.expr(_KEY)).withColumn("rank_", F.row_number().over(own.orderBy("key", "line", "part", "supplier"))).withColumn("n", F.count(F.lit(1)).over(own))
    ranked = sorted_.withColumn("hash", F.expr(_HASH.replace("l_partkey", "part").replace("l_suppkey", "supplier")))
    orders = R.derived(ranked, _ORDER)
    entries = R.derived(ranked.withColumn("nth", F.explode(F.array(F.lit(1), F.lit(2)))), _ENTRY)
    counts = orders.groupBy("bundle_id").agg(*(F.count_if(F.col("class") == c).alias(n) for n, c in (("p", "PRESENT"), ("a", "ABSENT_CANDIDATE"), ("b", "BLOCKED"))))
    bundles = R.derived(read(spark, sf_dir, "orders"), _BUNDLE).join(counts, "bundle_id", "left")
    return audited_bundles(bundles.withColumns({n: F.expr(c) for n, c in _COUNTED.items()}).drop("p", "a", "b"), orders, entries)
