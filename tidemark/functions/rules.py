"""Rules as data: names with conditions over evidence columns, in SQL text that Spark and other engines read alike.

A condition uses comparisons, AND, OR, NOT, IN, CASE, coalesce, casts and
``matches(text, pattern)``; a condition that is null does not hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = tuple[tuple[str, str], ...]


def expression(text: str) -> Column:
    return F.expr(text.replace("matches(", "regexp_like("))


def text_of(text: str) -> str:
    """The same text for the oracle."""
    return text.replace("matches(", "regexp_matches(")


def reasons(rules: Rules) -> Column:
    """Sorted distinct names of all rules that hold, joined by commas; empty if none does."""
    found = F.array(*(F.when(expression(condition), F.lit(name)) for name, condition in rules))
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(found))), ",")


def reasons_text(rules: Rules) -> str:
    cases = ", ".join(f"CASE WHEN {text_of(condition)} THEN '{name}' END" for name, condition in rules)
    return f"array_to_string(list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL))), ',')"


def first(rules: Rules, otherwise: str | None) -> Column:
    """Name of the first rule that holds."""
    found = F.lit(otherwise).cast("string")
    for name, condition in reversed(rules):
        found = F.when(expression(condition), name).otherwise(found)
    return found


def first_text(rules: Rules, otherwise: str | None) -> str:
    cases = " ".join(f"WHEN {text_of(condition)} THEN '{name}'" for name, condition in rules)
    return f"CASE {cases} ELSE {'NULL' if otherwise is None else repr(otherwise)} END"


def later(a: str, b: str) -> str:
    """Condition that the watermark (``a_id``, ``a_ms``) lies after that of ``b``: by id, and by time where ids are equal."""
    return f"({a}_id > {b}_id OR ({a}_id = {b}_id AND {a}_ms > {b}_ms))"


def derived(table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Evidence columns from a table by fixed expressions."""
    return table.select(*(expression(e).alias(n) for n, e in columns.items()))


def derived_text(table: str, columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{text_of(e)} AS {n}' for n, e in columns.items())} FROM {table}"
