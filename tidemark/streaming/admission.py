"""Admission without end: a key is admitted once, however late it repeats, with state that does not grow.

Repeats within a horizon are dropped by a stream's state, which forgets a key
that long after the batch that met it. The clock is the batches' own, not the
events', so nothing is ever too late for it. Older repeats are found in the stored journal,
which each batch is compared with before it is appended. A batch that is run
again writes the same place anew and is compared with earlier batches only, so
a crash at any moment admits nothing twice and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.inbox import KEYED_SQL, with_dedupe_key
from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, journal
from tidemark.sources.staging import shared_folder

ARRIVED = "dedupe_key string, event_id bigint, received_ms bigint"


def _admitted(spark: SparkSession, folder: str, before: int) -> DataFrame:
    """The stored journal as it was before a batch; its rows are told apart by the batch that wrote them."""
    stored = spark.read.schema(f"{ARRIVED}, batch bigint").option("ignoreMissingFiles", "true").parquet(folder)
    return stored.where(F.col("batch") < before)


def appender(folder: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch's keys that no earlier batch admitted, under the batch's number."""

    def append(batch: DataFrame, number: int) -> None:
        fresh = batch.select("dedupe_key", "event_id", "received_ms")
        if number:
            fresh = fresh.join(_admitted(batch.sparkSession, folder, number).select("dedupe_key"), "dedupe_key", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return append


def admit(spark: SparkSession, arrivals: str, folder: str, checkpoint: str, horizon: str, files_per_batch: int = 64) -> StreamingQuery:
    """Start admission of what lands in ``arrivals`` into ``folder``, until all there is now is admitted.

    Of repeats in one batch the state lets one row pass, whichever its task
    meets first; between batches the earlier stays.
    """
    stream = spark.readStream.schema(ARRIVED).option("maxFilesPerTrigger", files_per_batch).parquet(arrivals)
    recent = stream.withColumn("at", F.current_timestamp()).withWatermark("at", horizon).dropDuplicatesWithinWatermark(["dedupe_key"])
    return recent.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(appender(folder)).start()


#: How long after its first arrival a key comes again, for every fifth event.
YEARS = 2 * 365 * 24 * HOUR


def land_arrivals(rows: DataFrame, files: int) -> str:
    """Keyed journal rows in files by arrival, and a last file in which every fifth event arrives again, two years on."""
    folder = shared_folder(rows.sparkSession)
    keyed = with_dedupe_key(rows).select("dedupe_key", "event_id", "received_ms")
    keyed.repartitionByRange(files, "received_ms").write.parquet(folder)
    keyed.where("event_id % 5 = 0").withColumn("received_ms", F.col("received_ms") + YEARS).coalesce(1).write.mode("append").parquet(folder)
    return folder


@query("bounded_admission", KEYED_SQL + "SELECT dedupe_key, count(*) AS admitted FROM (SELECT DISTINCT dedupe_key FROM keyed) GROUP BY dedupe_key")
def bounded_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each key of the journal was admitted, with repeats in other batches and two years later: once."""
    place = shared_folder(spark)
    admit(spark, land_arrivals(journal(spark, sf_dir), 4), f"{place}/journal", f"{place}/checkpoint", "2 days", files_per_batch=1).awaitTermination()
    return spark.read.schema(f"{ARRIVED}, batch bigint").parquet(f"{place}/journal").groupBy("dedupe_key").agg(F.count(F.lit(1)).alias("admitted"))
