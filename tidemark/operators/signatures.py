"""Signatures that name what differs: a tree of hashes over ranges of ids.

Level 0 hashes a row; each level above hashes the hashes of at most ``FANOUT``
ranges below it, so no list is longer, however many rows a key has and however
sparse its ids are. Two trees are compared from the top: only the children of
ranges that differ are looked at, one join a level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal
from tidemark.sources.staging import staged

#: Bits of an id that one level takes, and the most levels that whole numbers of 64 bits need.
BITS = 8
FANOUT = 1 << BITS
LEVELS = 8


def levels_for(*tables: DataFrame) -> int:
    """Levels over which the largest id of the tables (key, id, ...) is one range; ids are not negative."""
    largest = max((t.agg(F.max("id")).first()[0] or 0 for t in tables), default=0)
    return max(1, -(-int(largest).bit_length() // BITS))


def tree(rows: DataFrame, key: str, id_column: str, line: Column, levels: int | None = None) -> DataFrame:
    """(key, level, range, n, hash): the ranges of every level that hold rows; range r of level l holds ids from r * FANOUT ** l on.

    Repeated ids lie in one range of level 0, in the order of their lines. Level 0 is a row's own range.
    """
    leaves = rows.select(key, F.col(id_column).alias("id"), line.alias("line"))
    levels = levels or levels_for(leaves)
    level = leaves.groupBy(key, F.col("id").alias("range")).agg(F.count(F.lit(1)).alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list("line")), "\n")).alias("hash"))
    found = [level]
    for _ in range(levels):
        part = F.struct("range", "hash")
        level = level.groupBy(key, F.shiftright("range", BITS).alias("above")).agg(F.sum("n").alias("n"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["hash"]), "\n")).alias("hash")).withColumnRenamed("above", "range")
        found.append(level)
    out = found[0].select(key, F.lit(0).alias("level"), "range", "n", "hash")
    for i, one in enumerate(found[1:], 1):
        out = out.unionAll(one.select(key, F.lit(i).alias("level"), "range", "n", "hash"))
    return out


def roots(built: DataFrame, levels: int) -> DataFrame:
    """(key, n, signature): the top of each key's tree."""
    key = built.columns[0]
    return built.where(F.col("level") == levels).select(key, "n", F.col("hash").alias("signature"))


def differing(before: DataFrame, after: DataFrame, levels: int) -> tuple[DataFrame, list[int]]:
    """((key, low, high, n_before, n_after) of ranges of level 0 that differ; how many ranges were compared at each level).

    Each level compares the children of what differed above, and no others; a
    key that one side lacks differs as a whole. Both trees should be stored,
    as every level reads a part of them.
    """
    key = before.columns[0]
    suspects, compared = None, []
    for level in range(levels, -1, -1):
        sides = [t.where(F.col("level") == level) for t in (before, after)]
        if suspects is not None:
            above = suspects.select(key, F.col("range").alias("above"))
            sides = [s.withColumn("above", F.shiftright("range", BITS)).join(above, [key, "above"], "left_semi").drop("above") for s in sides]
        a, b = (s.select(key, "range", F.col("n").alias(f"n_{name}"), F.col("hash").alias(f"hash_{name}")) for s, name in zip(sides, ("before", "after"), strict=True))
        both = staged(a.join(b, [key, "range"], "full"))
        compared.append(both.count())
        suspects = both.where(~F.col("hash_before").eqNullSafe(F.col("hash_after")))
    told = suspects.select(key, F.col("range").alias("low"), F.col("range").alias("high"), F.coalesce("n_before", F.lit(0)).cast("bigint").alias("n_before"), F.coalesce("n_after", F.lit(0)).cast("bigint").alias("n_after"))
    return told, compared


def line_of(columns: Sequence[str]) -> Column:
    return F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns))


_LINE = ("event_id", "processing_status", "event_version")
#: What a guarded run did to the journal, though it should have changed nothing: rows changed, lost and added.
_CHANGED, _LOST, _ADDED = "event_id % 1511 = 7", "event_id % 1733 = 11", "event_id % 1999 = 5"


@query("signature_differences", JOURNAL_SQL + f""", after_ AS (SELECT token_id, event_id, CASE WHEN {_CHANGED} THEN 'failed' ELSE processing_status END AS processing_status, event_version FROM j WHERE NOT ({_LOST})
  UNION ALL SELECT token_id, event_id + (SELECT max(event_id) + 1 FROM j), processing_status, event_version FROM j WHERE {_ADDED}),
b AS (SELECT token_id, event_id, count(*) AS n_before, md5(event_id || ':' || coalesce(processing_status, '-') || ':' || coalesce(CAST(event_version AS VARCHAR), '-')) AS h FROM j GROUP BY ALL),
a AS (SELECT token_id, event_id, count(*) AS n_after, md5(event_id || ':' || coalesce(processing_status, '-') || ':' || coalesce(CAST(event_version AS VARCHAR), '-')) AS h FROM after_ GROUP BY ALL)
SELECT token_id, event_id AS low, event_id AS high, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after FROM b FULL JOIN a USING (token_id, event_id) WHERE b.h IS DISTINCT FROM a.h""")
def signature_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a run changed, lost or added, found by comparing the signatures of each asset's journal from the top."""
    rows = journal(spark, sf_dir).select("token_id", *_LINE)
    top = rows.agg(F.max("event_id") + 1).first()[0]
    changed = rows.withColumn("processing_status", F.when(F.expr(_CHANGED), "failed").otherwise(F.col("processing_status"))).where(f"NOT ({_LOST})")
    added = rows.where(_ADDED).withColumn("event_id", F.col("event_id") + top)
    after = changed.unionAll(added)
    levels = levels_for(after.select(F.col("event_id").alias("id")), rows.select(F.col("event_id").alias("id")))
    trees = [staged(tree(t, "token_id", "event_id", line_of(_LINE), levels)) for t in (rows, after)]
    return differing(*trees, levels)[0]
