"""Weighted rendezvous hashing of records into shards (DataFrame functions only).

Every record scores each shard with ``weight / -ln(u)``, where ``u`` in (0, 1)
is a hash of the record key and the shard's number, and goes to the best one.
A further shard only ever takes records into itself, because the scores of the
others do not change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of the hash range inside one shard; slots are numbered per slice, so
#: that no task ever sorts a whole shard. Fixed, so the table of slice offsets is bounded.
SLICES = 2048


def shard_score(key: Column, shard: int, weight: float) -> Column:
    """Score of one shard for a key; monotone in a uniform hash, scaled by weight."""
    # 53 bits, moved off 0 and 1 so that the logarithm is finite and not zero
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    return F.lit(float(weight)) / -F.log((bits + 0.5) / float(1 << 53))


def choose_shard(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the best score (the lower number if two are equal)."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive and at least one")
    scores = [F.struct(shard_score(key, s, w).alias("score"), F.lit(-s).alias("minus")) for s, w in enumerate(weights)]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["minus"]).cast("int")


def shard_records(df: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 16) -> DataFrame:
    """Shard, slot and size of every row of ``df``.

    Returns ``key``, size, text_crc32, law, shard, slot, grown_shard, where
    grown_shard is the shard after one more of average weight has been added.

    A null key counts as one key of its own and goes to one shard; a null text
    has size 1 and the checksum of the empty text. Rows with the same key share
    a shard and get different slots. Other columns of ``df`` are left behind,
    whatever their names. An empty table gives no rows.
    """
    grown = [*weights, sum(weights) / len(weights)]
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    name = F.coalesce(F.col(key).cast("string"), F.lit("\0null"))
    # the text takes part, so that the rows of one key spread over the slices of their shard
    slice_ = F.pmod(F.xxhash64(name, F.crc32(body)), F.lit(SLICES)).cast("int").alias("slice")
    rows = df.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        choose_shard(name, weights).alias("shard"),
        choose_shard(name, grown).alias("grown_shard"),
        slice_,
    )
    keys = df.select(choose_shard(name, weights).alias("shard"), slice_)
    # at most shards x SLICES rows, whatever the input
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keys.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n")).select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "slice").orderBy(F.col(key), "size", "text_crc32")
    numbered = rows.withColumn("rank", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "slice"]).select(
        F.col(key), "size", "text_crc32", "law", "shard", (F.col("first") + F.col("rank")).cast("long").alias("slot"), "grown_shard"
    )


def write_shards(df: DataFrame, path: str, key: str = "doc_id", weights: Sequence[float] = (1.0,) * 16, column: str = "shard", rows_per_file: int = 100_000) -> None:
    """Write every row of ``df`` below ``path``, one folder a shard.

    The rows are dealt by shard and by a hash of the whole row, over as many
    tasks as their number asks for, so no task holds a whole shard.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit("\0null"))
    files = max(1, -(-df.count() // (len(weights) * rows_per_file)))
    spread = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns if not df.schema[c].dataType.simpleString().startswith("map"))), F.lit(files))
    placed = df.withColumn(column, choose_shard(name, weights))
    placed.repartition(files * len(weights), F.col(column), spread).write.partitionBy(column).parquet(path)
