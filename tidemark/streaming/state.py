"""The same rules on streams: admission and order state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.order_rules import FIELDS, empty, reduce_order
from tidemark.operators.folds import ORDER_EVENT, _STATE_SQL, STATE_COLUMNS, ORDER_ACTION, ORDER_MACHINE, duck_fold
from tidemark.operators.inbox import KEYED_SQL, with_dedupe_key
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, project, read
from tidemark.sources.staging import shared_folder

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """The state store that ``transformWithState`` needs, while a stream runs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 64) -> DataFrame:
    """Journal rows as they arrive in the events folder; a batch takes a bounded number of files, the rest waits."""
    schema = read(spark, sf_dir, "events").schema
    # a pattern, as a plain path to one file would be taken for the folder of a partitioned table
    return project(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{sf_dir}/events.parque[t]"))


def deduplicated(stream: DataFrame) -> DataFrame:
    """The first arrival of each dedupe key. No watermark drops late events; keys are kept as state."""
    return with_dedupe_key(stream).dropDuplicates(["dedupe_key"])


def drain(stream: DataFrame, spark: SparkSession, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now, into a table in the shared folder, and read that."""
    place = shared_folder(spark)
    started = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{place}/table")
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{place}/table")


#: Whole numbers of an event. They travel as text, as pandas would make a column with nulls one of floats, which lose digits and are no whole numbers to the state.
WHOLE = ("at", "id", "ms", "ver", "exp")


class OrderFold(StatefulProcessor):
    """Keeps one order's state and gives it out after each batch of its events."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("order", ", ".join(f"{n} {t}" for n, t in FIELDS.items()))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held = dict(zip(FIELDS, self.state.get(), strict=True)) if self.state.exists() else empty()
        # by lists: a batch has few events of an order, and each operation on a frame costs more than to fold them
        found: list[dict] = []
        for frame in rows:
            columns = [[None if x is None or x != x else x for x in frame[n].tolist()] for n in ORDER_EVENT]
            found += (dict(zip(ORDER_EVENT, values, strict=True)) for values in zip(*columns, strict=True))
        for event in found:
            event.update((n, None if event[n] is None else int(event[n])) for n in WHOLE)
        for event in sorted(found, key=lambda e: (e["at"], e["id"])):
            held = reduce_order(held, event)
        self.state.update(tuple(held.values()))
        if held["here"]:
            yield pd.DataFrame([(key[0], *(held[n] for n in STATE_COLUMNS))], columns=["order_hash", *STATE_COLUMNS], dtype=object)

    def close(self) -> None:
        pass


def order_state_stream(stream: DataFrame) -> DataFrame:
    """State of every order that a batch touched; the last row of an order is its current state.

    A batch's events are folded in arrival order onto the state that all earlier
    batches left. So the state equals the batch fold if no event comes in a later
    batch than one that arrived after it; one that does is folded when it comes.
    """
    values = {n: F.expr(e) for n, e in ORDER_EVENT.items()}
    events = stream.where("order_hash IS NOT NULL").select("order_hash", *((c.cast("string") if n in WHOLE else c).alias(n) for n, c in values.items()))
    schema = "order_hash string, " + ", ".join(f"{n} {FIELDS[n]}" for n in STATE_COLUMNS)
    return events.groupBy("order_hash").transformWithStateInPandas(OrderFold(), schema, outputMode="Update", timeMode="None")


@query("streaming_dedupe", KEYED_SQL + "SELECT dedupe_key FROM keyed GROUP BY dedupe_key")
def streaming_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drain(deduplicated(event_stream(spark, sf_dir)), spark).select("dedupe_key")


@query("streaming_state", JOURNAL_SQL + ", folded AS (SELECT order_hash, " + duck_fold(ORDER_MACHINE, ORDER_ACTION, "", ORDER_EVENT) + f""".s AS s
FROM j WHERE order_hash IS NOT NULL GROUP BY order_hash)
SELECT order_hash, {_STATE_SQL} FROM folded WHERE s.here""")
def streaming_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events there are, through the stateful operator; equal to the batch fold."""
    with rocks_state(spark):
        place = shared_folder(spark)

        def keep(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{place}/table/{number}")

        stream = order_state_stream(event_stream(spark, sf_dir))
        started = stream.writeStream.outputMode("update").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start()
        started.awaitTermination()
    touched = spark.read.parquet(f"{place}/table/*")
    newest = touched.groupBy("order_hash").agg(F.max_by(F.struct(*STATE_COLUMNS), "batch").alias("s"))
    return newest.select("order_hash", "s.*")
