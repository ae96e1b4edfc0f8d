"""A topic stream as a data source: numbered offsets, a topic filter, one epoch, and a bound on what may wait.

The stream's log is a folder with ``epoch=<n>/<first offset>.jsonl``; a new
epoch is a new connection, behind which nobody knows what was missed. Two
things end a query for good: another epoch than the one it began in, and more
events since its last batch than it may hold.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow.fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal
from tidemark.sources.staging import shared_folder

SCHEMA = "epoch int, offset bigint, topic string, type string, body string"


class ContinuityLost(RuntimeError):
    """The connection that the query began with is gone."""


class IngressOverload(RuntimeError):
    """More events came since the last batch than the query may hold."""


class StreamLog:
    """The folder behind the source, in any file system that Arrow knows."""

    def __init__(self, folder: str) -> None:
        self.files, self.root = arrow_fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")

    def newest_epoch(self) -> int:
        found = self.files.get_file_info(arrow_fs.FileSelector(self.root, allow_not_found=True))
        return max((int(f.base_name.partition("=")[2]) for f in found if f.base_name.startswith("epoch=")), default=0)

    def segments(self, epoch: int) -> list[tuple[int, str]]:
        """(first offset, path) in order."""
        found = self.files.get_file_info(arrow_fs.FileSelector(f"{self.root}/epoch={epoch}", allow_not_found=True))
        return sorted((int(f.base_name.partition(".")[0]), f.path) for f in found if f.base_name.endswith(".jsonl"))

    def lines(self, path: str) -> list[str]:
        return self.files.open_input_file(path).read().decode().splitlines()

    def end(self, epoch: int) -> int:
        """The offset behind the last event."""
        segments = self.segments(epoch)
        return segments[-1][0] + len(self.lines(segments[-1][1])) if segments else 0

    def append(self, epoch: int, events: Sequence[dict]) -> None:
        self.files.create_dir(f"{self.root}/epoch={epoch}")
        with self.files.open_output_stream(f"{self.root}/epoch={epoch}/{self.end(epoch):012d}.jsonl") as out:
            out.write("".join(json.dumps(e) + "\n" for e in events).encode())


@dataclass
class _Segment(InputPartition):
    path: str
    epoch: int
    first: int
    low: int
    high: int


class _TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.log, self.folder = StreamLog(options["folder"]), options["folder"]
        self.topic, self.types = options["topic"], frozenset(filter(None, options.get("types", "").split(",")))
        self.capacity = int(options.get("capacity", 256))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "log"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, log=StreamLog(state["folder"]))

    def initialOffset(self) -> dict:
        return {"epoch": self.log.newest_epoch(), "at": 0}

    def latestOffset(self) -> dict:
        epoch = self.log.newest_epoch()
        return {"epoch": epoch, "at": self.log.end(epoch)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start["epoch"] != end["epoch"]:
            raise ContinuityLost(f"began in epoch {start['epoch']}, now {end['epoch']}")
        if end["at"] - start["at"] > self.capacity:
            raise IngressOverload(f"{end['at'] - start['at']} events wait, at most {self.capacity} may")
        segments = self.log.segments(end["epoch"])
        following = [first for first, _ in segments[1:]] + [end["at"]]
        return [_Segment(path, end["epoch"], first, max(first, start["at"]), min(last, end["at"])) for (first, path), last in zip(segments, following, strict=True) if last > start["at"] and first < end["at"]]

    def read(self, partition: _Segment) -> Iterator[tuple]:
        lines = StreamLog(self.folder).lines(partition.path)
        for offset in range(partition.low, partition.high):
            event = json.loads(lines[offset - partition.first])
            if event["topic"] == self.topic and (not self.types or event["type"] in self.types):
                yield partition.epoch, offset, event["topic"], event["type"], json.dumps(event.get("body"), sort_keys=True, separators=(",", ":"))

    def commit(self, end: dict) -> None:
        """Nothing to release: the log keeps its segments."""


class TopicEvents(DataSource):
    """``spark.readStream.format("topic_events")`` with options folder, topic, types (all if empty) and capacity."""

    @classmethod
    def name(cls) -> str:
        return "topic_events"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return _TopicReader(dict(self.options))


def topic_stream(spark: SparkSession, folder: str, topic: str, types: Sequence[str] = (), capacity: int = 256) -> DataFrame:
    """Events of a topic, and of the given types, as they come; a query over it fails on overload and on a new epoch."""
    spark.dataSource.register(TopicEvents)
    return spark.readStream.format("topic_events").option("folder", folder).option("topic", topic).option("types", ",".join(types)).option("capacity", capacity).load()


def land_topic(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Start writing a topic's events, each batch under its number, so that a batch that runs again replaces itself; until all there is now has come."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start()


def write_segment(rows: DataFrame, folder: str, first: int) -> int:
    """One segment of the log from journal rows, numbered by arrival from ``first``; gives the offset behind it."""
    place = shared_folder(rows.sparkSession)
    body = F.struct("event_id", "order_hash", "price_raw")
    rows.orderBy("received_ms", "event_id").select(F.concat(F.lit("t"), (F.col("event_id") % 3).cast("string")).alias("topic"), F.col("event_type").alias("type"), body.alias("body")).coalesce(1).write.option("ignoreNullFields", "false").json(place)
    log, written = StreamLog(folder), StreamLog(place)
    (path,) = (f.path for f in written.files.get_file_info(arrow_fs.FileSelector(written.root)) if f.base_name.startswith("part-"))
    log.files.create_dir(f"{log.root}/epoch=1")
    log.files.move(path, f"{log.root}/epoch=1/{first:012d}.jsonl")
    return first + rows.count()


@query("topic_ingress", JOURNAL_SQL + """, numbered AS (SELECT *, row_number() OVER (ORDER BY part, received_ms, event_id) - 1 AS "offset" FROM (SELECT *, ntile(3) OVER (ORDER BY received_ms, event_id) AS part FROM j))
SELECT "offset", event_id, event_type AS type, order_hash FROM numbered WHERE event_id % 3 = 1 AND event_type IN ('item_listed', 'item_sold')""")
def topic_ingress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings and sales of one topic, through three runs of a query over a growing log, each from where the last one ended."""
    place = shared_folder(spark)
    rows = journal(spark, sf_dir)
    n = rows.count()
    bounds = [r[0] for r in spark.range(1, 3).select((F.col("id") * (n // 3) + F.least("id", F.lit(n % 3))).cast("bigint")).orderBy("id").collect()]
    numbered = rows.select("event_id", "event_type", "order_hash", "price_raw", "received_ms")
    cuts = numbered.orderBy("received_ms", "event_id")
    first, at = 0, [0, *bounds, n]
    for low, high in zip(at, at[1:], strict=False):
        first = write_segment(cuts.offset(low).limit(high - low), f"{place}/log", first)
        land_topic(topic_stream(spark, f"{place}/log", "t1", ("item_listed", "item_sold"), capacity=n), f"{place}/landed", f"{place}/checkpoint").awaitTermination()
    body = F.from_json("body", "event_id bigint, order_hash string")
    return spark.read.schema(SCHEMA).parquet(f"{place}/landed").select("offset", body.alias("b"), "type").select("offset", "b.event_id", "type", "b.order_hash")
