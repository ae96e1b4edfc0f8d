"""Questions to raw JSON payloads that built-in functions can't answer exactly."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import json_text
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal, read


@query("canonical_hash", "SELECT event_id, sha256('{\"k\":' || CAST(props->>'$.k' AS INTEGER) || '}') AS payload_hash FROM events")
def canonical_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", json_text.canonical_hash("props").alias("payload_hash"))


def discovered(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, concept, path, kind): a row for every identity field of every payload; none for what is not strict JSON."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                try:
                    out += [(k, *f) for f in json_text.discover(json_text.parse(text))] if text is not None else []
                except ValueError:
                    continue
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.column("key").type), *(pa.array(c, pa.string()) for c in columns[1:])], names=["key", "concept", "path", "kind"])

    given = rows.select(F.col(key).alias("key"), F.col(payload).alias("payload"))
    found = given.mapInArrow(task, f"key {given.schema['key'].dataType.simpleString()}, concept string, path string, kind string")
    return found.withColumnRenamed("key", key)


@query("json_path_discovery", JOURNAL_SQL + """, fields(concept, path, kind, n) AS (
SELECT 'version', 'version', 'number', count(event_version) FROM j UNION ALL SELECT 'timestamp', 'payload.event_timestamp', 'number', count(*) FROM j
UNION ALL SELECT 'orderHash', 'payload.order_hash', 'string', count(order_hash) FROM j UNION ALL SELECT 'nftIdentity', 'payload.item.nft_id', 'string', count(*) FROM j
UNION ALL SELECT 'transactionHash', 'payload.transaction.hash', 'string', count(transaction_hash) FROM j UNION ALL SELECT 'orderHash', 'payload.transaction.hash', 'string', count(transaction_hash) FROM j)
SELECT concept, path, kind, n FROM fields WHERE n > 0""")
def json_path_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = F.struct("order_hash", F.col("event_ms").alias("event_timestamp"), F.struct("nft_id").alias("item"), F.when(F.col("transaction_hash").isNotNull(), F.struct(F.col("transaction_hash").alias("hash"))).alias("transaction"))
    payloads = journal(spark, sf_dir).select("event_id", F.to_json(F.struct(F.col("event_version").alias("version"), inner.alias("payload"))).alias("payload"))
    return discovered(payloads, "event_id", "payload").groupBy("concept", "path", "kind").agg(F.count(F.lit(1)).alias("n"))
