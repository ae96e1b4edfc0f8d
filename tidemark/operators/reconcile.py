"""Windows of backfilled transfers, snapshots against local orders, and audit decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.inbox import KEYED_SQL, with_dedupe_key
from tidemark.operators.joins import LATEST_SQL, NFT, latest_orders
from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, JOURNAL_SQL, NOW, journal

WINDOW_START, WINDOW_END = NOW - 10 * 24 * HOUR, NOW


@query("window_classification", KEYED_SQL + f""", candidates AS (SELECT *, event_ms // 1000 AS second FROM keyed WHERE event_type = 'item_transferred' AND event_ms >= {WINDOW_START} AND event_ms < {WINDOW_END}),
groups AS (SELECT token_id, second, count(DISTINCT transaction_hash) AS transactions, bool_or(transaction_hash IS NULL) AS incomplete FROM candidates GROUP BY ALL),
classed AS (SELECT c.event_id, CASE WHEN processing_status <> 'pending' THEN 'DUPLICATE_EXISTING' WHEN event_ms >= {WINDOW_END} - {HOUR} THEN 'DEFERRED_BOUNDARY'
  WHEN transaction_hash IS NULL THEN 'NOT_ADMITTED' WHEN incomplete THEN 'UNCERTAIN' WHEN transactions > 1 THEN 'AMBIGUOUS' ELSE 'SAFE' END AS class
  FROM candidates c JOIN groups USING (token_id, second) WHERE source = 'rest')
SELECT event_id, class, class IN ('SAFE', 'AMBIGUOUS') AS released FROM classed""")
def window_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = journal(spark, sf_dir).where(F.col("event_type") == "item_transferred").where((F.col("event_ms") >= WINDOW_START) & (F.col("event_ms") < WINDOW_END))
    classed = classify_window(moves, F.col("source") == "rest", F.col("event_ms") >= WINDOW_END - HOUR)
    return classed.select("event_id", "class", F.col("class").isin("SAFE", "AMBIGUOUS").alias("released"))


def classify_window(moves: DataFrame, target: Column, boundary: Column, coverage_complete: bool = True) -> DataFrame:
    """Class of every targeted transfer, in this order: existing, at the boundary, coverage, identity, group.

    All transfers of a window take part in the groups of one asset and second,
    targets or not.
    """
    rows = moves.withColumn("second", F.expr("event_ms div 1000"))
    groups = rows.groupBy(*NFT, "second").agg(F.count_distinct("transaction_hash").alias("transactions"), F.bool_or(F.col("transaction_hash").isNull()).alias("incomplete"))
    found = (
        F.when(F.col("processing_status") != "pending", "DUPLICATE_EXISTING").when(boundary, "DEFERRED_BOUNDARY").when(F.lit(not coverage_complete), "UNCERTAIN")
        .when(F.col("transaction_hash").isNull(), "NOT_ADMITTED").when(F.col("incomplete"), "UNCERTAIN").when(F.col("transactions") > 1, "AMBIGUOUS").otherwise("SAFE")
    )
    return rows.where(target).join(groups, [*NFT, "second"]).withColumn("class", found)


@query("window_summary", KEYED_SQL + f""", candidates AS (SELECT *, event_ms // 1000 AS second FROM keyed WHERE event_type = 'item_transferred' AND event_ms >= {WINDOW_START} AND event_ms < {WINDOW_END}),
groups AS (SELECT token_id, second, count(DISTINCT transaction_hash) AS transactions, bool_or(transaction_hash IS NULL) AS incomplete FROM candidates GROUP BY ALL),
classed AS (SELECT CASE WHEN processing_status <> 'pending' THEN 'DUPLICATE_EXISTING' WHEN event_ms >= {WINDOW_END} - {HOUR} THEN 'DEFERRED_BOUNDARY'
  WHEN transaction_hash IS NULL THEN 'NOT_ADMITTED' WHEN incomplete THEN 'UNCERTAIN' WHEN transactions > 1 THEN 'AMBIGUOUS' ELSE 'SAFE' END AS class
  FROM candidates c JOIN groups USING (token_id, second) WHERE source = 'rest'),
counted AS (SELECT count(*) AS total, count(*) FILTER (WHERE class = 'SAFE') AS safe, count(*) FILTER (WHERE class = 'AMBIGUOUS') AS ambiguous, count(*) FILTER (WHERE class = 'DEFERRED_BOUNDARY') AS deferred,
  count(*) FILTER (WHERE class = 'UNCERTAIN') AS uncertain, count(*) FILTER (WHERE class = 'DUPLICATE_EXISTING') AS existing FROM classed)
SELECT *, CASE WHEN deferred > 0 OR uncertain > 0 THEN 'PARTIAL' ELSE 'COMPLETE' END AS result FROM counted""")
def window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda c: F.count_if(F.col("class") == c)
    counted = window_classification(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("total"), of("SAFE").alias("safe"), of("AMBIGUOUS").alias("ambiguous"), of("DEFERRED_BOUNDARY").alias("deferred"), of("UNCERTAIN").alias("uncertain"), of("DUPLICATE_EXISTING").alias("existing")
    )
    return counted.select("*", F.when((F.col("deferred") > 0) | (F.col("uncertain") > 0), "PARTIAL").otherwise("COMPLETE").alias("result"))


BASELINE = NOW - 15 * 24 * HOUR
@query("peer_attempt_idempotence", KEYED_SQL + """
SELECT dedupe_key, count(*) AS attempts, CASE WHEN bool_or(transaction_hash IS NULL) AND count(*) > 1 THEN 'INCOMPLETE' WHEN count(DISTINCT md5(coalesce(seller, '') || price_raw)) > 1 THEN 'CONFLICT' ELSE 'IDEMPOTENT' END AS verdict
FROM keyed GROUP BY dedupe_key""")
def peer_attempt_idempotence(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence = F.md5(F.concat(F.coalesce("seller", F.lit("")), F.col("price_raw")))
    grouped = with_dedupe_key(journal(spark, sf_dir)).groupBy("dedupe_key").agg(F.count(F.lit(1)).alias("attempts"), F.bool_or(F.col("transaction_hash").isNull()).alias("missing"), F.count_distinct(evidence).alias("kinds"))
    verdict = F.when(F.col("missing") & (F.col("attempts") > 1), "INCOMPLETE").when(F.col("kinds") > 1, "CONFLICT").otherwise("IDEMPOTENT")
    return grouped.select("dedupe_key", "attempts", verdict.alias("verdict"))


@query("transfer_summary", JOURNAL_SQL + """
SELECT event_id, CASE WHEN from_address = '0x0' THEN 'zero_source' WHEN to_address = '0x0' THEN 'zero_destination' WHEN from_address IS NOT NULL AND to_address IS NOT NULL THEN 'wallet_to_wallet' ELSE 'unknown' END AS hint,
       CASE WHEN source = 'rest' AND event_version IS NULL AND event_type <> 'item_transferred' THEN 'malformed' WHEN event_type = 'order_invalidate' AND source = 'rest' THEN 'unsupported' ELSE 'adapted' END AS adapted
FROM j""")
def transfer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst, rest = F.col("from_address"), F.col("to_address"), F.col("source") == "rest"
    hint = F.when(src == "0x0", "zero_source").when(dst == "0x0", "zero_destination").when(src.isNotNull() & dst.isNotNull(), "wallet_to_wallet").otherwise("unknown")
    adapted = F.when(rest & F.col("event_version").isNull() & (F.col("event_type") != "item_transferred"), "malformed").when((F.col("event_type") == "order_invalidate") & rest, "unsupported").otherwise("adapted")
    return journal(spark, sf_dir).select("event_id", hint.alias("hint"), adapted.alias("adapted"))


@query("adoption_plan", LATEST_SQL + f""", snap AS (SELECT order_hash, count(*) AS listings, count(DISTINCT seller) AS sellers, arg_max(price_raw, event_id) AS price FROM j WHERE event_type = 'item_listed' AND received_ms <= {BASELINE} GROUP BY order_hash)
SELECT coalesce(s.order_hash, l.order_hash) AS order_hash, CASE WHEN l.order_hash IS NULL THEN 'seed' WHEN s.order_hash IS NULL THEN 'leave' WHEN sellers > 1 THEN 'reset' ELSE 'attach' END AS step,
       sha256('adopt|' || coalesce(s.order_hash, l.order_hash) || '|' || coalesce(price, '')) AS receipt
FROM snap s FULL JOIN active l ON s.order_hash = l.order_hash""")
def adoption_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What adopting a snapshot does to each order, with a receipt that hashes what was adopted."""
    rows = journal(spark, sf_dir)
    snap = rows.where((F.col("event_type") == "item_listed") & (F.col("received_ms") <= BASELINE)).groupBy("order_hash").agg(
        F.count_distinct("seller").alias("sellers"), F.max_by("price_raw", F.when(F.col("price_raw").isNotNull(), F.col("event_id"))).alias("price"), F.lit(True).alias("in_snapshot")
    )
    local = latest_orders(rows).where("last_type = 'item_listed'").select("order_hash", F.lit(True).alias("is_local"))
    both = snap.join(local, "order_hash", "full")
    step = F.when(F.col("is_local").isNull(), "seed").when(F.col("in_snapshot").isNull(), "leave").when(F.col("sellers") > 1, "reset").otherwise("attach")
    return both.select("order_hash", step.alias("step"), F.sha2(F.concat(F.lit("adopt|"), "order_hash", F.lit("|"), F.coalesce("price", F.lit(""))), 256).alias("receipt"))
