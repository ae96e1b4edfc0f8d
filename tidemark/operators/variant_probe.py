"""Fields that an event's identity may be read from, found in JSON as VARIANT values, without a Python worker.

Each round explodes what is nested one level deeper, and passes on what it told. Patterns and bounds are
data: a table of concepts that paths are matched with, and ``Bounds``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.json_text import CONCEPTS, LARGEST_SAFE
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal


@dataclass(frozen=True)
class Bounds:
    depth: int = 5
    #: Fields that are told of a payload.
    fields: int = 200
    #: Items of a list that are looked at.
    items: int = 5


def kind(value: Column) -> Column:
    """object, array, string, boolean, null, number or unsafe_integer, as ``json_text.kind``; a whole number of over 38 digits counts as number."""
    schema = F.schema_of_variant(value)
    whole = F.try_variant_get(value, "$", "decimal(38,0)")
    unsafe = schema.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$") & (F.abs(whole) > LARGEST_SAFE)
    found = F.when(unsafe, "unsafe_integer").otherwise("number")
    for start, name in (("OBJECT", "object"), ("ARRAY", "array"), ("STRING", "string"), ("BOOLEAN", "boolean"), ("VOID", "null")):
        found = F.when(schema.startswith(start), name).otherwise(found)
    return found


def concepts(path: Column, told: Column, kind_: Column) -> Column:
    """Names of all concepts whose pattern the path matches."""
    names = [F.when(path.rlike(("(?i)" if pattern.flags & 2 else "") + pattern.pattern) | ((told & (path == "transaction") & (kind_ == "string")) if name == "transactionHash" else F.lit(False)), name) for name, pattern in CONCEPTS.items()]
    return F.array_compact(F.array(*names))


def discovered(rows: DataFrame, key: str, payload: str, bounds: Bounds = Bounds()) -> DataFrame:
    """(key, concept, path, kind): a row for every identity field of every payload; none for what is no JSON, or repeats a member.

    Members of an object go by name, items of a list by place; of more fields
    than the bound the first stay, depth first in that order. Keys are unique.
    """
    spark = rows.sparkSession
    level = rows.select(
        F.col(key).alias("key"), F.try_parse_json(payload).alias("v"), F.lit("").alias("path"), F.array().cast("array<int>").alias("place"), F.lit(False).alias("told"), F.lit("").alias("kind")
    ).where("v IS NOT NULL")
    for depth in range(1, bounds.depth + 1):
        # fields that were told have no value left and pass through, so a payload is parsed and opened once
        child = spark.tvf.variant_explode_outer(F.col("v").outer()).toDF("at", "name", "value")
        new, member = F.col("v").isNotNull(), F.col("name").isNotNull()
        inner = level.lateralJoin(child).where(~new | member | (F.col("at") < bounds.items))
        path = F.when(~new, F.col("path")).when(~member, F.concat("path", F.lit("["), F.col("at").cast("string"), F.lit("]"))).when(F.col("path") == "", F.col("name")).otherwise(F.concat_ws(".", "path", "name"))
        fields = inner.select(
            "key", "value", path.alias("path"), F.when(new, F.concat("place", F.array("at"))).otherwise(F.col("place")).alias("place"),
            F.when(new, member).otherwise(F.col("told")).alias("told"), F.when(new, kind(F.col("value"))).otherwise(F.col("kind")).alias("kind"),
        )
        opened = F.col("value").isNotNull() & F.col("kind").isin("object", "array") & F.lit(depth < bounds.depth)
        both = fields.withColumn("open", F.explode(F.when(opened, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        level = both.select("key", F.when(F.col("open"), F.col("value")).alias("v"), "path", "place", "told", "kind")
    told = level.where(F.col("told") | ~F.col("kind").isin("object", "array"))
    found = told.select("key", "path", "place", "kind", F.posexplode(concepts(F.col("path"), F.col("told"), F.col("kind"))).alias("nth", "concept"))
    order = F.row_number().over(Window.partitionBy("key").orderBy("place", "nth"))
    return found.withColumn("rank", order).where(F.col("rank") <= bounds.fields).select(F.col("key").alias(key), "concept", "path", "kind")


@query("variant_path_discovery", JOURNAL_SQL + """, fields(concept, path, kind, n) AS (
SELECT 'version', 'version', 'number', count(event_version) FROM j UNION ALL SELECT 'timestamp', 'payload.event_timestamp', 'number', count(*) FROM j
UNION ALL SELECT 'orderHash', 'payload.order_hash', 'string', count(order_hash) FROM j UNION ALL SELECT 'nftIdentity', 'payload.item.nft_id', 'string', count(*) FROM j
UNION ALL SELECT 'nftIdentity', 'payload.item.chain[0]', 'string', count(*) FROM j UNION ALL SELECT 'nftIdentity', 'payload.item.chain', 'array', count(*) FROM j
UNION ALL SELECT c, 'payload.parties[' || i || '].address', 'string', n FROM (SELECT unnest(['from', 'to']) AS c), (SELECT unnest([0, 1]) AS i), (SELECT count(*) AS n FROM j)
UNION ALL SELECT 'transactionHash', 'payload.transaction.hash', 'string', count(transaction_hash) FROM j UNION ALL SELECT 'orderHash', 'payload.transaction.hash', 'string', count(transaction_hash) FROM j)
SELECT concept, path, kind, n FROM fields WHERE n > 0""")
def variant_path_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity fields of all payloads together, by concept, path and kind."""
    party = lambda c: F.struct(F.col(c).alias("address"))
    inner = F.struct(
        "order_hash", F.col("event_ms").alias("event_timestamp"), F.struct("nft_id", F.array("chain").alias("chain")).alias("item"), F.array(party("from_address"), party("to_address")).alias("parties"),
        F.when(F.col("transaction_hash").isNotNull(), F.struct(F.col("transaction_hash").alias("hash"))).alias("transaction"),
    )
    payloads = journal(spark, sf_dir).select("event_id", F.to_json(F.struct(F.col("event_version").alias("version"), inner.alias("payload"))).alias("payload"))
    return discovered(payloads, "event_id", "payload").groupBy("concept", "path", "kind").agg(F.count(F.lit(1)).alias("n"))
