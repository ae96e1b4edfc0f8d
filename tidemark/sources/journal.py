"""The event journal as a view of the ``events`` table.

The table is anonymous click data, so every journal column is derived from it
by a fixed rule; ``JOURNAL_SQL`` states the same rules for the oracle. Times
are milliseconds since 1970, which no session time zone can change. Business
times are whole hours, up to four hours before arrival, so that late and
simultaneous events occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR = 3_600_000
#: The moment that queries on due and stale rows take as now (2024-01-20T00:00:00Z).
NOW = 1_705_708_800_000

#: Processing states, in the order in which the view deals them out (fixed values of the lifecycle).
STATUSES = ("pending", "processing", "applied", "reconciliation_required", "failed", "ignored_duplicate", "ignored_older")

#: Event families of the journal, by the kind of the source table.
FAMILIES = {"view": "item_listed", "purchase": "item_sold", "signup": "item_cancelled", "click": "item_transferred", "error": "order_invalidate"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project(events: DataFrame) -> DataFrame:
    """Journal rows of any DataFrame with the columns of ``events``, batch or streaming."""
    k = F.get_json_object("props", "$.k").cast("int")
    family = F.lit(None).cast("string")
    for kind, name in FAMILIES.items():
        family = F.when(F.col("event_type") == kind, name).otherwise(family)
    status = F.element_at(F.array(*map(F.lit, STATUSES)), (F.col("event_id") % 7 + 1).cast("int"))
    base = events.select(
        "event_id", "user_id", "value", family.alias("event_type"), k.alias("k"),
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast(ts AS TIMESTAMP_NTZ)) div 1000").alias("received_ms"),
        status.alias("processing_status"),
    )
    transfer = F.col("event_type") == "item_transferred"
    traded = F.col("event_type").isin("item_transferred", "item_sold")
    user = F.col("user_id").cast("string")
    hour = F.expr(f"(received_ms div {HOUR} - k % 5) * {HOUR}")
    return base.select(
        "event_id", "event_type", "received_ms", hour.alias("event_ms"),
        F.when(F.col("k") % 10 != 7, F.col("k").cast("long")).alias("event_version"),
        F.when(~transfer, F.concat(user, F.lit("-"), (F.col("k") % 4).cast("string"))).alias("order_hash"),
        F.lit("chain").alias("chain"), F.lit("0xc").alias("contract_address"), user.alias("token_id"), F.concat(F.lit("chain/0xc/"), user).alias("nft_id"),
        F.when(traded & (F.col("k") % 25 != 0), F.md5(F.concat(user, F.lit(":"), F.col("k").cast("string")))).alias("transaction_hash"),
        F.when(F.col("k") % 3 != 1, F.concat(F.lit("u"), (F.col("user_id") % 17).cast("string"))).alias("seller"),
        F.when(F.col("k") % 11 != 0, F.concat(F.round(F.col("value") * 100).cast("long").cast("string"), F.lit("0" * 16))).alias("price_raw"),
        F.when(F.col("k") % 13 != 0, hour + (F.col("k") + 1).cast("long") * 24 * HOUR).alias("expiration_ms"),
        F.concat(F.lit("0x"), (F.col("k") % 9).cast("string")).alias("from_address"), F.concat(F.lit("0x"), (F.col("k") % 8).cast("string")).alias("to_address"),
        F.when(F.col("event_id") % 3 == 0, "rest").otherwise("stream").alias("source"),
        "processing_status", (F.col("event_id") % 6).cast("int").alias("attempt_count"),
        F.when(F.col("event_id") % 5 == 0, F.col("received_ms") + HOUR).alias("next_retry_ms"),
        F.when(F.col("processing_status") == "processing", F.col("received_ms") + 60_000).alias("started_ms"),
        "k",
    )


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "events"))


JOURNAL_SQL = f"""
WITH base AS (
  SELECT event_id, user_id, value, CAST(props->>'$.k' AS INTEGER) AS k, epoch_us(ts) // 1000 AS received_ms,
         CASE event_type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in FAMILIES.items())} END AS event_type,
         [{', '.join(f"'{s}'" for s in STATUSES)}][event_id % 7 + 1] AS processing_status
  FROM events),
j AS (
  SELECT event_id, event_type, received_ms, (received_ms // {HOUR} - k % 5) * {HOUR} AS event_ms,
         CASE WHEN k % 10 <> 7 THEN CAST(k AS BIGINT) END AS event_version,
         CASE WHEN event_type <> 'item_transferred' THEN user_id || '-' || (k % 4) END AS order_hash,
         'chain' AS chain, '0xc' AS contract_address, CAST(user_id AS VARCHAR) AS token_id, 'chain/0xc/' || user_id AS nft_id,
         CASE WHEN event_type IN ('item_transferred', 'item_sold') AND k % 25 <> 0 THEN md5(user_id || ':' || k) END AS transaction_hash,
         CASE WHEN k % 3 <> 1 THEN 'u' || (user_id % 17) END AS seller,
         CASE WHEN k % 11 <> 0 THEN CAST(round(value * 100) AS BIGINT) || '{"0" * 16}' END AS price_raw,
         CASE WHEN k % 13 <> 0 THEN (received_ms // {HOUR} - k % 5) * {HOUR} + CAST(k + 1 AS BIGINT) * {24 * HOUR} END AS expiration_ms,
         '0x' || (k % 9) AS from_address, '0x' || (k % 8) AS to_address,
         CASE WHEN event_id % 3 = 0 THEN 'rest' ELSE 'stream' END AS source,
         processing_status, CAST(event_id % 6 AS INTEGER) AS attempt_count,
         CASE WHEN event_id % 5 = 0 THEN received_ms + {HOUR} END AS next_retry_ms,
         CASE WHEN processing_status = 'processing' THEN received_ms + 60000 END AS started_ms, k
  FROM base)
"""
