"""The barrier for backfilled transfers on a stream: a second is held until it closes, then judged.

Transfers of one asset and second are one group. The watermark says when no
more of a group is expected; a timer then gives each held target its class, and
only what is SAFE may change state. Of a group, the state holds one row a
target and three facts about all its transfers, so a busy second stays small.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tidemark.operators.folds import ASSET_ACTION, ASSET_EVENT, ASSET_MACHINE, asset_states, duck_fold
from tidemark.operators.inbox import KEYED_SQL
from tidemark.operators.reconcile import WINDOW_END, WINDOW_START
from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, JOURNAL_SQL, journal
from tidemark.sources.staging import shared_folder
from tidemark.streaming.state import rocks_state

#: Rows that a closing second gives out at a time.
CHUNK = 10_000
HELD = "group string, second bigint, at timestamp, event_id bigint, transaction_hash string, is_target boolean, own_class string"
JUDGED = "event_id bigint, class string, released boolean, applies boolean"


class SecondBarrier(StatefulProcessor):
    """Holds one asset's second; ``own_class`` is what a target is whatever its group says."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.group = handle.getValueState("group", "transaction string, several boolean, incomplete boolean")
        self.targets = handle.getListState("targets", "event_id bigint, own_class string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = self.group.exists()
        transaction, several, incomplete = self.group.get() if known else (None, False, False)
        for frame in rows:
            for value in frame["transaction_hash"].tolist():
                if value is None or value != value:
                    incomplete = True
                elif transaction is None:
                    transaction = value
                else:
                    several = several or value != transaction
            # by lists: most seconds have a row or two, and each operation on a frame costs more than to read them
            columns = (frame[n].tolist() for n in ("is_target", "event_id", "own_class"))
            chosen = [(int(i), c if isinstance(c, str) else None) for t, i, c in zip(*columns, strict=True) if t]
            if chosen:
                self.targets.appendList(chosen)
        self.group.update((transaction, bool(several), bool(incomplete)))
        if not known:
            self.handle.registerTimer((int(key[1]) + 1) * 1000)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, several, incomplete = self.group.get()
        of_group = "UNCERTAIN" if incomplete else "AMBIGUOUS" if several else "SAFE"
        chunk: list[tuple] = []
        for event_id, own in self.targets.get() if self.targets.exists() else ():
            found = own or of_group
            chunk.append((event_id, found, found in ("SAFE", "AMBIGUOUS"), found == "SAFE"))
            if len(chunk) == CHUNK:
                yield pd.DataFrame(chunk, columns=["event_id", "class", "released", "applies"])
                chunk = []
        if chunk:
            yield pd.DataFrame(chunk, columns=["event_id", "class", "released", "applies"])
        self.group.clear()
        self.targets.clear()

    def close(self) -> None:
        pass


def held(moves: DataFrame, target: Column, boundary: Column, group: Column) -> DataFrame:
    """Transfers as the barrier takes them, batch or stream: the columns of ``HELD``."""
    own = F.when(F.col("processing_status") != "pending", "DUPLICATE_EXISTING").when(boundary, "DEFERRED_BOUNDARY").when(F.col("transaction_hash").isNull(), "NOT_ADMITTED")
    return moves.select(group.alias("group"), F.expr("event_ms div 1000").alias("second"), F.timestamp_millis("event_ms").alias("at"), "event_id", "transaction_hash", target.alias("is_target"), own.alias("own_class"))


def closing(spark: SparkSession, end_ms: int) -> DataFrame:
    """The row with which a source says that nothing before ``end_ms`` follows; it belongs to no group."""
    return spark.range(1).select(F.lit("").alias("group"), F.lit(end_ms // 1000).alias("second"), F.timestamp_millis(F.lit(end_ms)).alias("at"), F.lit(-1).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("transaction_hash"), F.lit(False).alias("is_target"), F.lit(None).cast("string").alias("own_class"))


def barrier_stream(stream: DataFrame, lateness: str) -> DataFrame:
    """(event_id, class, released, applies) of every target once its second has closed.

    A second closes when the watermark, ``lateness`` behind the newest transfer
    seen, has passed it. What comes later still is not judged again; see ``late``.
    """
    grouped = stream.withWatermark("at", lateness).groupBy("group", "second")
    return grouped.transformWithStateInPandas(SecondBarrier(), JUDGED, outputMode="Append", timeMode="EventTime")


def late(landed: DataFrame, judged: DataFrame) -> DataFrame:
    """Targets that came after their second had closed: UNCERTAIN, and not released, as their group was judged without them."""
    missed = landed.where("is_target").join(judged.select("event_id"), "event_id", "left_anti")
    return missed.select("event_id", F.lit("UNCERTAIN").alias("class"), F.lit(False).alias("released"), F.lit(False).alias("applies"))


def run_barrier(spark: SparkSession, folder: str, lateness: str, files_per_batch: int = 64) -> DataFrame:
    """All transfers that landed in ``folder`` through the barrier, to the end; late ones included."""
    place = shared_folder(spark)
    with rocks_state(spark):
        stream = spark.readStream.schema(HELD).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
        barrier_stream(stream, lateness).writeStream.outputMode("append").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{place}/judged").awaitTermination()
    judged = spark.read.schema(JUDGED).parquet(f"{place}/judged")
    landed = spark.read.schema(HELD).parquet(folder)
    return judged.unionByName(late(landed, judged))


def window_moves(rows: DataFrame) -> DataFrame:
    """The backfill window's transfers, as ``window_classification`` takes them."""
    return rows.where(F.col("event_type") == "item_transferred").where((F.col("event_ms") >= WINDOW_START) & (F.col("event_ms") < WINDOW_END))


def land_shuffled(spark: SparkSession, moves: DataFrame, files: int) -> str:
    """Transfers in files whose order has nothing to do with their times, and the closing row in the last one."""
    folder = shared_folder(spark)
    rows = held(moves, F.col("source") == "rest", F.col("event_ms") >= WINDOW_END - HOUR, F.col("token_id"))
    rows.repartition(files, F.xxhash64("event_id")).write.parquet(folder)
    closing(spark, WINDOW_END + 40 * 24 * HOUR).write.mode("append").parquet(folder)
    return folder


_CLASSED_SQL = f""", candidates AS (SELECT *, event_ms // 1000 AS second FROM {{source}} WHERE event_type = 'item_transferred' AND event_ms >= {WINDOW_START} AND event_ms < {WINDOW_END}),
groups AS (SELECT token_id, second, count(DISTINCT transaction_hash) AS transactions, bool_or(transaction_hash IS NULL) AS incomplete FROM candidates GROUP BY ALL),
classed AS (SELECT c.event_id, CASE WHEN processing_status <> 'pending' THEN 'DUPLICATE_EXISTING' WHEN event_ms >= {WINDOW_END} - {HOUR} THEN 'DEFERRED_BOUNDARY'
  WHEN transaction_hash IS NULL THEN 'NOT_ADMITTED' WHEN incomplete THEN 'UNCERTAIN' WHEN transactions > 1 THEN 'AMBIGUOUS' ELSE 'SAFE' END AS class
  FROM candidates c JOIN groups USING (token_id, second) WHERE source = 'rest')"""


@query("streaming_barrier", KEYED_SQL + _CLASSED_SQL.format(source="keyed") + " SELECT event_id, class, class IN ('SAFE', 'AMBIGUOUS') AS released, class = 'SAFE' AS applies FROM classed")
def streaming_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window's transfers through the barrier, in six files in no order, two a batch."""
    return run_barrier(spark, land_shuffled(spark, window_moves(journal(spark, sf_dir)), 6), "30 days", files_per_batch=2)


@query("gated_owner_fold", JOURNAL_SQL + _CLASSED_SQL.format(source="j") + f""", admitted AS (SELECT * FROM j WHERE event_type = 'item_transferred' AND (source <> 'rest' OR event_ms < {WINDOW_START} OR event_ms >= {WINDOW_END} OR event_id IN (SELECT event_id FROM classed WHERE class = 'SAFE'))),
folded AS (SELECT token_id, """ + duck_fold(ASSET_MACHINE, ASSET_ACTION, "", ASSET_EVENT) + ".s AS s FROM admitted GROUP BY token_id) SELECT token_id, s.owner AS owner, s.last_ms AS last_ms, s.updates AS updates FROM folded")
def gated_owner_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners of assets, where backfilled transfers of the window take part only once the barrier lets them change state."""
    rows = journal(spark, sf_dir)
    judged = run_barrier(spark, land_shuffled(spark, window_moves(rows), 6), "30 days", files_per_batch=2)
    return asset_states(gated(rows, judged)).select("token_id", "owner", "last_ms", "updates")


def gated(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """``rows`` without the judged transfers that may not change state."""
    return rows.join(judged.where("NOT applies").select("event_id"), "event_id", "left_anti")
