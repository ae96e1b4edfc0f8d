"""Paginated snapshots and windows that were landed as JSON, and content-addressed evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal

PAGE = "sweep_id string, page_number long, next_cursor string, listings array<string>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of sweeps, one JSON object a line; ``listings`` are kept as raw text."""
    return spark.read.schema(PAGE).json(path)


def page_facts(pages: DataFrame) -> DataFrame:
    """Each page with its hash, whether the page or its cursor came before, and its rows counted."""
    content = F.sha2(F.concat_ws("\n", "listings"), 256)
    hashed = pages.select("sweep_id", "page_number", "next_cursor", F.size("listings").alias("n"), content.alias("page_hash"))
    order = Window.orderBy("page_number")
    seen = lambda *by: F.row_number().over(Window.partitionBy("sweep_id", *by).orderBy("page_number")) > 1
    return hashed.select(
        "*", seen("page_hash").alias("repeated"), (F.col("next_cursor").isNotNull() & seen("next_cursor")).alias("cycle"),
        (F.lag("page_number").over(order.partitionBy("sweep_id")) + 1 != F.col("page_number")).alias("gap"),
    )


def manifest(pages: DataFrame, most_pages: int = 100, most_rows: int = 20_000) -> DataFrame:
    """One row for each sweep: what was read, and whether it is complete."""
    facts = page_facts(pages)
    counted = facts.groupBy("sweep_id").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("rows"), F.bool_or("repeated").alias("repeated_page"), F.bool_or("cycle").alias("cursor_cycle"),
        F.coalesce(F.bool_or("gap"), F.lit(False)).alias("gap"), F.max_by("next_cursor", F.struct("page_number", "next_cursor")).alias("last_cursor"),
    )
    truncated = (F.col("pages") > most_pages) | (F.col("rows") > most_rows)
    exhausted = F.col("last_cursor").isNull()
    return counted.select("sweep_id", "pages", "rows", "repeated_page", "cursor_cycle", truncated.alias("truncated"), exhausted.alias("exhausted"), (exhausted & ~truncated & ~F.col("repeated_page") & ~F.col("cursor_cycle") & ~F.col("gap")).alias("complete"))


@query("snapshot_manifest", JOURNAL_SQL + """, pages AS (
SELECT token_id AS sweep_id, received_ms // 259200000 AS page_number, CASE WHEN bool_or(k = 50) THEN NULL ELSE 'c' || (max(k) % 9) END AS next_cursor,
       string_agg(price_raw, chr(10) ORDER BY event_id) AS body, count(price_raw) AS n FROM j GROUP BY ALL),
facts AS (SELECT *, row_number() OVER (PARTITION BY sweep_id, sha256(coalesce(body, '')) ORDER BY page_number) > 1 AS repeated,
  next_cursor IS NOT NULL AND row_number() OVER (PARTITION BY sweep_id, next_cursor ORDER BY page_number) > 1 AS cycle,
  lag(page_number) OVER (PARTITION BY sweep_id ORDER BY page_number) + 1 <> page_number AS gap FROM pages),
counted AS (SELECT sweep_id, count(*) AS pages, CAST(sum(n) AS BIGINT) AS rows, bool_or(repeated) AS repeated_page, bool_or(cycle) AS cursor_cycle, coalesce(bool_or(gap), false) AS gap,
  arg_max(coalesce(next_cursor, '-'), page_number) = '-' AS exhausted FROM facts GROUP BY sweep_id)
SELECT sweep_id, pages, rows, repeated_page, cursor_cycle, pages > 100 OR rows > 20000 AS truncated, exhausted,
       exhausted AND NOT (pages > 100 OR rows > 20000) AND NOT repeated_page AND NOT cursor_cycle AND NOT gap AS complete FROM counted""")
def snapshot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sweeps made of each asset's events, three days to a page."""
    priced = F.when(F.col("price_raw").isNotNull(), F.struct("event_id", "price_raw"))
    grouped = journal(spark, sf_dir).groupBy(F.col("token_id").alias("sweep_id"), F.expr("received_ms div 259200000").alias("page_number")).agg(
        F.when(~F.bool_or(F.col("k") == 50), F.concat(F.lit("c"), (F.max("k") % 9).cast("string"))).alias("next_cursor"), F.array_sort(F.collect_list(priced)).alias("x")
    )
    return manifest(grouped.select("sweep_id", "page_number", "next_cursor", F.col("x.price_raw").alias("listings")))


def write_artifact(df: DataFrame, path: str) -> None:
    """Write rows once as JSON lines; a second write to the same place fails."""
    df.write.mode("errorifexists").json(path)


def artifact_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(name, length, sha256) of every file of an artifact, for a root manifest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.sha2("content", 256).alias("sha256"))


def root_hash(files: DataFrame) -> str:
    """One hash over the sorted names and hashes of a manifest (bounded by the number of files)."""
    line = F.concat(F.col("name"), F.lit("\0"), F.col("sha256"))
    return files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("h")).first()["h"]


def verify_artifact(spark: SparkSession, path: str, declared: DataFrame) -> DataFrame:
    """(name, status) of declared and found files: COMPLETE, INCOMPLETE, CORRUPT or UNDECLARED."""
    found = artifact_manifest(spark, path).select("name", F.col("sha256").alias("found"), F.col("length").alias("found_length"))
    both = declared.join(found, "name", "full")
    status = (
        F.when(F.col("found").isNull(), "INCOMPLETE").when(F.col("sha256").isNull(), "UNDECLARED")
        .when((F.col("found") != F.col("sha256")) | (F.col("found_length") != F.col("length")), "CORRUPT").otherwise("COMPLETE")
    )
    return both.select("name", status.alias("status"))


def transition_chain(rows: DataFrame, key: Column) -> DataFrame:
    """Rows whose ``from_state`` is not the ``to_state`` of the row before (by sequence); empty for a sound chain."""
    chained = rows.withColumn("previous", F.lag("to_state").over(Window.partitionBy(key).orderBy("sequence")))
    return chained.where(F.col("previous").isNotNull() & (F.col("previous") != F.col("from_state")))
