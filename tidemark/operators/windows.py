"""Ordered rules over rows: caps, samples, runs and lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, JOURNAL_SQL, journal


@query("capture_caps", JOURNAL_SQL + """, typed AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM j),
kept AS (SELECT *, row_number() OVER (ORDER BY event_id) AS overall FROM typed WHERE rn <= 40)
SELECT event_id, event_type, rn, overall, rn = 1 OR rn % 10 = 0 AS sampled FROM kept WHERE overall <= 150""")
def capture_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 40 of each kind, then the first 150 of those; every tenth is sampled.

    The caps are the feature. Each kind's head is a top-k, so the rows that are
    numbered as a whole are 200 at most.
    """
    rows = journal(spark, sf_dir).select("event_id", "event_type")
    kinds = ("item_listed", "item_sold", "item_cancelled", "item_transferred", "order_invalidate")
    heads = [rows.where(F.col("event_type") == k).orderBy("event_id").limit(40) for k in kinds]
    together = heads[0]
    for head in heads[1:]:
        together = together.unionAll(head)
    numbered = together.withColumn("rn", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")))
    kept = numbered.withColumn("overall", F.row_number().over(Window.orderBy("event_id"))).where("overall <= 150")
    return kept.select("event_id", "event_type", F.col("rn").cast("long").alias("rn"), F.col("overall").cast("long").alias("overall"), ((F.col("rn") == 1) | (F.col("rn") % 10 == 0)).alias("sampled"))


@query("error_window", JOURNAL_SQL + f""", marked AS (
SELECT token_id, event_id, received_ms, event_type = 'order_invalidate' AS error, sum(CASE WHEN event_type = 'item_listed' THEN 1 ELSE 0 END) OVER (PARTITION BY token_id ORDER BY received_ms, event_id ROWS UNBOUNDED PRECEDING) AS island FROM j)
SELECT event_id, count(*) FILTER (WHERE error) OVER (PARTITION BY token_id, island ORDER BY received_ms, event_id ROWS UNBOUNDED PRECEDING) AS consecutive,
       count(*) FILTER (WHERE error) OVER (PARTITION BY token_id ORDER BY received_ms RANGE BETWEEN {6 * HOUR} PRECEDING AND CURRENT ROW) AS in_window
FROM marked""")
def error_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors since the last healthy event, and in the last six hours, for each asset."""
    by_asset = Window.partitionBy("token_id")
    arrival = by_asset.orderBy("received_ms", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = journal(spark, sf_dir).select("token_id", "event_id", "received_ms", (F.col("event_type") == "order_invalidate").cast("int").alias("error"), (F.col("event_type") == "item_listed").cast("int").alias("healthy"))
    islands = rows.withColumn("island", F.sum("healthy").over(arrival))
    run = Window.partitionBy("token_id", "island").orderBy("received_ms", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    recent = by_asset.orderBy("received_ms").rangeBetween(-6 * HOUR, 0)
    return islands.select("event_id", F.sum("error").over(run).alias("consecutive"), F.sum("error").over(recent).alias("in_window"))


@query("lineage_check", JOURNAL_SQL + """, linked AS (
SELECT event_id, order_hash, lag(event_id) OVER w AS previous, lag(received_ms) OVER w AS previous_ms, row_number() OVER (PARTITION BY order_hash ORDER BY event_id DESC) AS from_last, received_ms
FROM j WHERE order_hash IS NOT NULL WINDOW w AS (PARTITION BY order_hash ORDER BY event_id))
SELECT event_id, order_hash, previous, from_last = 1 AS latest, from_last = 2 AS prior, coalesce(previous >= event_id OR previous_ms > received_ms, false) AS broken FROM linked""")
def lineage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order event with its predecessor; a chain is broken where ids or arrival times fall."""
    chain = Window.partitionBy("order_hash").orderBy("event_id")
    rows = journal(spark, sf_dir).where("order_hash IS NOT NULL").select("event_id", "order_hash", "received_ms")
    linked = rows.select("*", F.lag("event_id").over(chain).alias("previous"), F.lag("received_ms").over(chain).alias("previous_ms"), F.row_number().over(Window.partitionBy("order_hash").orderBy(F.desc("event_id"))).alias("from_last"))
    broken = F.coalesce((F.col("previous") >= F.col("event_id")) | (F.col("previous_ms") > F.col("received_ms")), F.lit(False))
    return linked.select("event_id", "order_hash", "previous", (F.col("from_last") == 1).alias("latest"), (F.col("from_last") == 2).alias("prior"), broken.alias("broken"))


ROUNDS_SQL = JOURNAL_SQL + """, rounds AS (
SELECT token_id AS sweep, received_ms // 86400000 AS round, max(event_id) AS high_water,
       count(*) FILTER (WHERE processing_status IN ('pending', 'processing', 'failed', 'reconciliation_required') AND attempt_count >= 3) AS open
FROM j GROUP BY ALL)
"""


def catch_up_rounds(rows: DataFrame) -> DataFrame:
    """One round for each sweep (asset) and day: its high-water mark and the rows that are not settled."""
    unsettled = F.col("processing_status").isin("pending", "processing", "failed", "reconciliation_required") & (F.col("attempt_count") >= 3)
    return rows.groupBy(F.col("token_id").alias("sweep"), F.expr("received_ms div 86400000").alias("round")).agg(F.max("event_id").alias("high_water"), F.count_if(unsettled).alias("open"))


@query("catchup_stability", ROUNDS_SQL + """, carried AS (
SELECT sweep, round, open, max(high_water - high_water % 40) OVER (PARTITION BY sweep ORDER BY round) AS mark FROM rounds),
compared AS (SELECT *, lag(mark) OVER (PARTITION BY sweep ORDER BY round) AS previous FROM carried)
SELECT sweep, count(*) AS rounds, bool_or(mark < previous) AS regressed, min(CASE WHEN mark = previous AND open = 0 THEN round END) AS stable_round,
       CASE WHEN count(*) FILTER (WHERE mark = previous AND open = 0) > 0 THEN 'STABLE' ELSE 'CATCHING_UP' END AS state
FROM compared GROUP BY sweep""")
def catchup_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sweep is stable once a later round repeats the high-water mark with nothing open, and stays so."""
    order = Window.partitionBy("sweep").orderBy("round")
    mark = F.max(F.col("high_water") - F.col("high_water") % 40).over(order.rowsBetween(Window.unboundedPreceding, 0))
    compared = catch_up_rounds(journal(spark, sf_dir)).select("sweep", "round", "open", mark.alias("mark")).withColumn("previous", F.lag("mark").over(order))
    settled = (F.col("mark") == F.col("previous")) & (F.col("open") == 0)
    return compared.groupBy("sweep").agg(
        F.count(F.lit(1)).alias("rounds"), F.bool_or(F.col("mark") < F.col("previous")).alias("regressed"), F.min(F.when(settled, F.col("round"))).alias("stable_round"),
        F.when(F.count_if(settled) > 0, "STABLE").otherwise("CATCHING_UP").alias("state"),
    )
