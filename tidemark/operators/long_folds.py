"""Folds over histories too long for one row or one task.

Rows are dealt by ranges of (key, arrival), so a key with many rows lies in
several parts. Keys inside one part are folded in the JVM, a row a key. A key
that spans parts is folded in turns: a turn streams a few of its parts, in
order, from the state that the turn before left, and writes the state behind
them. No task holds more of a history than an Arrow batch, none has more of it
to do than a turn's parts, and a lost executor costs the turn it was in.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.order_rules import FIELDS, empty, reduce_order
from tidemark.operators.folds import _STATE_SQL, ORDER_ACTION, ORDER_EVENT, ORDER_MACHINE, STATE_COLUMNS, duck_fold, fold
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal
from tidemark.sources.staging import removed, staged

_ARROW = {"boolean": pa.bool_(), "string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}


def placed(rows: DataFrame, key: str, fields: Mapping[str, str], parts: int) -> DataFrame:
    """(key, part, fields of the event), written: parts hold about equally many rows, and follow each other in (key, arrival)."""
    events = rows.select(key, *(F.expr(e).alias(n) for n, e in fields.items()))
    ranged = events.repartitionByRange(parts, key, "at", "id").withColumn("part", F.spark_partition_id())
    return staged(ranged.sortWithinPartitions(key, "at", "id"))


def _streamed(events: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """(key, state fields): states after all ``events``, from ``states`` (or the empty one); each key's rows stream through one task."""
    names = [n for n in events.columns if n not in (key, "part")]
    begin = states.select(key, F.lit(0).alias("turn"), *(F.lit(None).cast(events.schema[n].dataType).alias(n) for n in names), F.struct(*FIELDS).alias("state"))
    rest = events.select(key, F.lit(1).alias("turn"), *names, F.lit(None).cast(begin.schema["state"].dataType).alias("state"))
    together = begin.unionAll(rest).repartition(key).sortWithinPartitions(key, "turn", "at", "id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, empty()
        finished: list[tuple] = []
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                if row[key] != current:
                    if current is not None:
                        finished.append((current, *state.values()))
                    current, state = row[key], empty()
                state = dict(row["state"]) if row["turn"] == 0 else reduce_order(state, row)
            if finished:
                yield packed(finished)
                finished = []
        if current is not None:
            yield packed([(current, *state.values())])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), *(_ARROW[t] for t in FIELDS.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[key, *FIELDS])

    return together.mapInArrow(task, f"{key} string, " + ", ".join(f"{n} {t}" for n, t in FIELDS.items()))


def long_fold(rows: DataFrame, key: str, parts: int = 512, parts_per_turn: int = 16) -> DataFrame:
    """(key, fields of the order state): as ``fold`` over the order machine, for histories of any length.

    Keys are texts and not null. Rows of a key fold in arrival order (at, id). As many keys as there are parts can
    span parts, at most, and there are as many turns as the longest needs; the driver learns how many are left.
    """
    events = placed(rows, key, ORDER_EVENT, parts)
    span = events.groupBy(key).agg(F.min("part").alias("first"), F.max("part").alias("last"))
    long = staged(span.where(F.col("first") < F.col("last")))
    short = events.join(long.select(key), key, "left_anti").drop("part")
    native = fold(short, key, {n: n for n in ORDER_EVENT}, ORDER_MACHINE, ORDER_ACTION)
    own = events.join(F.broadcast(long), key)  # fewer rows than parts
    states: DataFrame | None = None
    longest = long.agg(F.max(F.col("last") - F.col("first"))).first()[0]
    for turn in range(0 if longest is None else longest // parts_per_turn + 1):
        low = F.col("first") + turn * parts_per_turn
        some = own.where((F.col("part") >= low) & (F.col("part") < low + parts_per_turn)).drop("first", "last")
        before = states if states is not None else native.limit(0)
        following = staged(_streamed(some, before.select(key, *FIELDS), key))
        if states is not None:
            removed(states)
        states = following
    return native if states is None else native.unionByName(states)


#: One order has a third of all events.
_HOT = "CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE order_hash END"


@query("order_state_long", JOURNAL_SQL + ", folded AS (SELECT order_hash, " + duck_fold(ORDER_MACHINE, ORDER_ACTION, "", ORDER_EVENT) + f""".s AS s
FROM (SELECT * REPLACE ({_HOT} AS order_hash) FROM j) WHERE order_hash IS NOT NULL GROUP BY order_hash)
SELECT order_hash, {_STATE_SQL} FROM folded WHERE s.here""")
def order_state_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fold where one order has a third of all events, in turns."""
    rows = journal(spark, sf_dir).withColumn("order_hash", F.expr(_HOT)).where("order_hash IS NOT NULL")
    return long_fold(rows, "order_hash", parts=24, parts_per_turn=4).where("here").select("order_hash", *STATE_COLUMNS)
