"""Same-second conflicts on a stream: each transfer meets its asset's second once it has closed.

Seconds in which several transactions moved one asset are found by a windowed
aggregate; transfers wait in a stream-stream outer join for them. One whose
second had no other transaction comes out alone, as soon as the watermark says
that none can come any more. A transfer meets one row of its second and not
its peers, so a busy second costs no square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.inbox import KEYED_SQL
from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, journal
from tidemark.sources.staging import shared_folder

MOVED = "group string, at timestamp, event_id bigint, transaction_hash string"
JUDGED = "event_id bigint, conflict boolean"


def moved(rows: DataFrame) -> DataFrame:
    """Transfers as the join takes them, batch or stream."""
    return rows.where("event_type = 'item_transferred'").select(F.concat_ws("/", "chain", "contract_address", "token_id").alias("group"), F.timestamp_millis("event_ms").alias("at"), "event_id", "transaction_hash")


def conflict_stream(transfers: DataFrame, again: DataFrame, lateness: str) -> DataFrame:
    """(event_id, conflict) of every transfer; ``again`` is the same stream, read a second time for the seconds.

    A transfer without a transaction conflicts with nothing, and nothing with it.
    """
    second = F.window("at", "1 second").alias("second")
    watched = transfers.withWatermark("at", lateness).select("group", second, "event_id", "transaction_hash")
    ends = again.withWatermark("at", lateness).groupBy("group", second).agg(F.min("transaction_hash").alias("lo"), F.max("transaction_hash").alias("hi"))
    busy = ends.where(F.col("lo") != F.col("hi")).withColumnsRenamed({"group": "busy_group", "second": "busy_second"})
    met = watched.join(busy, (F.col("group") == F.col("busy_group")) & (F.col("second") == F.col("busy_second")), "leftOuter")
    return met.select("event_id", (F.col("busy_group").isNotNull() & F.col("transaction_hash").isNotNull()).alias("conflict"))


def run_conflicts(spark: SparkSession, folder: str, lateness: str, files_per_batch: int = 64) -> DataFrame:
    """All transfers that landed in ``folder``; those too late for their second have a null, as it was judged without them."""
    place = shared_folder(spark)
    transfers, again = (spark.readStream.schema(MOVED).option("maxFilesPerTrigger", files_per_batch).parquet(folder) for _ in range(2))
    conflict_stream(transfers, again, lateness).writeStream.outputMode("append").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{place}/judged").awaitTermination()
    judged = spark.read.schema(JUDGED).parquet(f"{place}/judged").where("event_id >= 0")
    landed = spark.read.schema(MOVED).parquet(folder).where("event_id >= 0").select("event_id")
    return landed.join(judged, "event_id", "left")


def land_moves(rows: DataFrame, files: int) -> str:
    """Transfers in files in no order, and in the last one the row that closes all seconds."""
    spark = rows.sparkSession
    folder, moves = shared_folder(spark), moved(rows)
    moves.repartition(files, F.xxhash64("event_id")).write.parquet(folder)
    end = rows.agg(F.max("event_ms")).first()[0] or 0
    for extra in (90, 91):  # the second one lets the join release what the first one closed
        spark.range(1).select(F.lit("").alias("group"), F.timestamp_millis(F.lit(end + extra * 24 * HOUR)).alias("at"), F.lit(-1).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("transaction_hash")).write.mode("append").parquet(folder)
    return folder


@query("streaming_conflicts", KEYED_SQL + """
SELECT e.event_id, e.transaction_hash IS NOT NULL AND EXISTS (SELECT 1 FROM keyed o WHERE o.event_type = 'item_transferred' AND o.token_id = e.token_id AND o.event_ms // 1000 = e.event_ms // 1000
       AND o.event_id <> e.event_id AND o.transaction_hash <> e.transaction_hash AND o.dedupe_key <> e.dedupe_key) AS conflict
FROM keyed e WHERE e.event_type = 'item_transferred'""")
def streaming_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transfers against their asset's second, in six files in no order, two a batch."""
    return run_conflicts(spark, land_moves(journal(spark, sf_dir), 6), "60 days", files_per_batch=2)
