"""Writing results: appends that may be repeated, upserts of keyed state, sequences.

Parquet tables have no MERGE, so a changed state is written as a new version
beside the old one; rows are matched by joins on their keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.normalise import reasons


def append_new(existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` that are not there yet, the first of each key; appending them twice adds nothing."""
    columns = [c for c in incoming.columns if c not in key]
    first = F.min_by(F.struct(*columns), F.struct(*order))
    fresh = incoming.join(existing.select(*key), list(key), "left_anti").groupBy(*key).agg(first.alias("_row"))
    return fresh.select(*key, *(F.col(f"_row.{c}") for c in columns)).select(*incoming.columns)


def conflicts(existing: DataFrame, incoming: DataFrame, key: Sequence[str], content: str) -> DataFrame:
    """Incoming rows whose key is there with other content: not a repetition but a contradiction."""
    there = existing.select(*key, F.col(content).alias("_there"))
    return incoming.join(there, list(key)).where(~F.col("_there").eqNullSafe(F.col(content))).select(*incoming.columns)


def upsert(existing: DataFrame, changes: DataFrame, key: Sequence[str], kept: Sequence[str] = ("created_at",)) -> DataFrame:
    """The next version of a state table: changed rows replace old ones, but for the columns in ``kept``.

    ``changes`` has one row a key at most.
    """
    old = existing.select(*key, *(F.col(c).alias(f"_{c}") for c in existing.columns if c not in key), F.lit(True).alias("_old"))
    new = changes.withColumn("_new", F.lit(True))
    both = old.join(new, list(key), "full")

    def chosen(c: str) -> Column:
        if c in kept:
            return F.coalesce(f"_{c}", c)
        return F.when(F.col("_new").isNotNull(), F.col(c)).otherwise(F.col(f"_{c}"))

    return both.select(*key, *(chosen(c).alias(c) for c in existing.columns if c not in key)).select(*existing.columns)


def compare_and_set(rows: DataFrame, column: str, expected: str, value: str, selected: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``column`` set where the key is selected and the column has the expected value; adds ``changed``."""
    marked = rows.join(selected.select(key).distinct().withColumn("_selected", F.lit(True)), key, "left")
    hit = F.coalesce(F.col("_selected") & (F.col(column) == expected), F.lit(False))
    return marked.withColumn("changed", hit).withColumn(column, F.when(hit, F.lit(value)).otherwise(F.col(column))).drop("_selected")


def allocate_sequence(existing: DataFrame, incoming: DataFrame, scope: str, sequence: str, order: Sequence[str], identity: Sequence[str] = ()) -> DataFrame:
    """``incoming`` with the next sequence numbers of its scope, without gaps, in the given order.

    With ``identity``, rows that are there already, and repetitions among the new ones, are left out: writing the same
    rows again allocates nothing.
    """
    if identity:
        incoming = incoming.dropDuplicates(list(identity)).join(existing.select(*identity), list(identity), "left_anti")
    top = existing.groupBy(scope).agg(F.max(sequence).alias("_top"))
    place = F.row_number().over(Window.partitionBy(scope).orderBy(*order))
    return incoming.withColumn("_place", place).join(top, scope, "left").withColumn(sequence, F.coalesce("_top", F.lit(0)) + F.col("_place")).drop("_top", "_place")


def linked(rows: DataFrame, lineage: Sequence[str], identity: str, sequence: str) -> DataFrame:
    """Rows of an append-only chain with the predecessor that each should name, and whether it does."""
    before = F.lag(identity).over(Window.partitionBy(*lineage).orderBy(sequence))
    return rows.withColumn("expected_previous", before).withColumn("sound", F.col("expected_previous").eqNullSafe(F.col("previous_id")))


def mismatches(rows: DataFrame, payload: str, fields: dict[str, str]) -> DataFrame:
    """Rows whose columns differ from the same facts in their JSON payload, with the names of those that do."""
    checks = ((f"{c}_mismatch", ~F.get_json_object(payload, path).eqNullSafe(F.col(c).cast("string"))) for c, path in fields.items())
    return rows.withColumn("reasons", reasons(*checks)).where("reasons <> ''")


def expect_rows(df: DataFrame, n: int, what: str) -> DataFrame:
    """``df`` if it has ``n`` rows; else an error, as a guarded write must not go on."""
    found = df.count()
    if found != n:
        raise ValueError(f"{what} expected {n} rows, got {found}")
    return df


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def schema_problems(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Columns that are missing, superfluous or of another type."""
    found = dict(df.dtypes)
    missing = [f"missing:{c}" for c in expected if c not in found]
    other = [f"type:{c}:{found[c]}" for c, t in expected.items() if c in found and found[c] != t]
    return sorted([*missing, *other, *(f"unexpected:{c}" for c in found if c not in expected)])
