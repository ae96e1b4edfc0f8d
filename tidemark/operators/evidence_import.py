"""Import of a snapshot's evidence: raw pages and normalised listings of one JSON document, listing by listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import json_text
from tidemark.functions import rules as R
from tidemark.operators.generations import MANIFEST
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal

_SNAPSHOT = (
    "snapshot struct<result: string, startedAt: bigint, completedAt: bigint, paginationExhausted: boolean, truncatedByPageLimit: boolean, truncatedByListingLimit: boolean, cursorCycleDetected: boolean, counters: struct<malformed: bigint, conflicts: bigint, normalized: bigint>, "
    "rawPages: array<struct<listings: array<string>>>, listings: array<string>, responseHashes: array<string>>, sourceProvenance map<string, string>"
)
#: What ends an import, the first that holds; ``reasons`` are those of the snapshot's manifest.
IMPORT_ERRORS: R.Rules = (
    ("evidence_read_or_json_failed", "NOT coalesce(is_json, false)"), ("evidence_snapshot_missing", "NOT has_snapshot"), ("evidence_not_complete", "reasons <> ''"), ("evidence_payload_missing", "NOT has_payload"), ("evidence_order_identity_missing", "missing > 0"),
    ("evidence_listing_count_mismatch", "n_raw <> n_listings OR n_raw <> coalesce(counted, -1)"),
)


def imported(evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accounts, seen) of evidence (sweep_id, content).

    accounts (sweep_id, error, n_raw, n_listings): one row a document; error is null where it was imported. seen
    (sweep_id, order_hash, page_number, page_hash, material_hash): one row a raw listing of those. A document is
    bounded by the provider's limits on pages and listings; its listings are exploded before they are looked at.
    """
    s = F.from_json("content", _SNAPSHOT)
    parsed = evidence.select("sweep_id", F.try_parse_json("content").isNotNull().alias("is_json"), s["snapshot"].alias("s"), F.size(F.coalesce(F.map_keys(s["sourceProvenance"]), F.array().cast("array<string>"))).alias("sources"))
    facts = parsed.select(
        "*", F.col("s").isNotNull().alias("has_snapshot"), F.col("s.result").alias("transport"), F.lit("TRANSPORT_COMPLETE").alias("generation"), F.col("s.startedAt").alias("started_ms"), F.col("s.completedAt").alias("completed_ms"), F.coalesce("s.paginationExhausted", F.lit(False)).alias("exhausted"),
        F.coalesce(F.col("s.truncatedByPageLimit") | F.col("s.truncatedByListingLimit"), F.lit(True)).alias("truncated"), F.col("s.counters.malformed").alias("malformed"), F.col("s.counters.conflicts").alias("conflicts"), F.coalesce("s.cursorCycleDetected", F.lit(True)).alias("cycle"),
        F.col("s.counters.normalized").alias("counted"), (F.col("s.rawPages").isNotNull() & F.col("s.listings").isNotNull() & F.col("s.responseHashes").isNotNull()).alias("has_payload"),
    ).withColumn("reasons", R.reasons(MANIFEST))
    raw = F.flatten(F.transform("s.rawPages", lambda p, i: F.transform(F.coalesce(p["listings"], F.array().cast("array<string>")), lambda x: F.struct((i + 1).alias("page"), x.alias("raw")))))
    rows = facts.where("has_payload").select("sweep_id", "s", F.posexplode(raw).alias("at", "x")).select(
        "sweep_id", F.col("x.page").alias("page_number"), F.get("s.responseHashes", F.col("x.page") - 1).alias("page_hash"), F.get("s.listings", F.col("at")).alias("listing"), F.get_json_object("x.raw", "$.order_hash").alias("raw_hash")
    )
    rows = rows.withColumn("order_hash", F.lower(F.trim(F.coalesce("raw_hash", F.get_json_object("listing", "$.orderHash")))))
    sound = F.coalesce((F.col("order_hash") != "") & (F.col("page_hash") != "") & F.col("listing").isNotNull(), F.lit(False))
    counts = rows.groupBy("sweep_id").agg(F.count(F.lit(1)).alias("n_raw"), F.count_if(~sound).alias("missing"))
    told = facts.withColumn("n_listings", F.coalesce(F.size("s.listings"), F.lit(0))).join(counts, "sweep_id", "left").na.fill(0, ["n_raw", "missing"])
    error = R.first(IMPORT_ERRORS, None)
    accounts = told.select("sweep_id", F.when(error == "evidence_not_complete", F.concat(error, F.lit(":"), "reasons")).otherwise(error).alias("error"), F.col("n_raw").cast("bigint").alias("n_raw"), F.col("n_listings").cast("bigint").alias("n_listings"))
    seen = rows.join(accounts.where("error IS NULL").select("sweep_id"), "sweep_id", "left_semi")
    return accounts, seen.select("sweep_id", "order_hash", F.col("page_number").cast("bigint").alias("page_number"), "page_hash", json_text.hash_without("listing", F.lit("rawListing")).alias("material_hash"))


#: Documents of the journal's listings, one an asset, ten days a page; t is the asset's number, and spoils some.
_PAGE_MS = 864_000_000
_SPOILT = {"conflicts": "CASE WHEN t % 13 = 1 THEN 1 ELSE 0 END", "exhausted": "t % 17 <> 2", "counted": "n + CASE WHEN t % 23 = 4 THEN 1 ELSE 0 END"}


@query("evidence_import", JOURNAL_SQL + f""", l AS (SELECT token_id AS sweep_id, CAST(token_id AS BIGINT) AS t, order_hash, price_raw, received_ms // {_PAGE_MS} AS page, event_id FROM j WHERE event_type = 'item_listed'),
numbered AS (SELECT *, dense_rank() OVER (PARTITION BY sweep_id ORDER BY page) AS page_number, row_number() OVER (PARTITION BY sweep_id ORDER BY page, event_id) AS place, count(*) OVER (PARTITION BY sweep_id) AS n FROM l),
docs AS (SELECT DISTINCT sweep_id, t, n FROM numbered),
told AS (SELECT *, CASE WHEN t % 31 = 6 THEN 'evidence_read_or_json_failed' WHEN t % 37 = 7 THEN 'evidence_snapshot_missing' WHEN t % 13 = 1 THEN 'evidence_not_complete:SNAPSHOT_NOT_COMPLETE,SNAPSHOT_SEMANTICALLY_UNSAFE' WHEN t % 17 = 2 THEN 'evidence_not_complete:SNAPSHOT_NOT_COMPLETE'
  WHEN t % 29 = 5 THEN 'evidence_payload_missing' WHEN t % 19 = 3 THEN 'evidence_order_identity_missing' WHEN t % 23 = 4 THEN 'evidence_listing_count_mismatch' END AS error FROM docs)
SELECT sweep_id, error, CAST(NULL AS VARCHAR) AS order_hash, CAST(NULL AS BIGINT) AS page_number, CAST(NULL AS VARCHAR) AS page_hash, CAST(NULL AS VARCHAR) AS material_hash FROM told WHERE error IS NOT NULL
UNION ALL SELECT sweep_id, NULL, order_hash, page_number, md5(CAST(page_number AS VARCHAR)), sha256('{{"orderHash":"' || order_hash || '","place":' || place || CASE WHEN price_raw IS NULL THEN '' ELSE ',"price":"' || price_raw || '"' END || '}}') FROM numbered JOIN told USING (sweep_id) WHERE error IS NULL""")
def evidence_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that each asset's evidence shows, and what keeps other evidence from being imported."""
    accounts, seen = imported(evidence_documents(journal(spark, sf_dir)))
    columns = seen.columns[1:]
    failed = accounts.where("error IS NOT NULL").select("sweep_id", "error", *(F.lit(None).cast(seen.schema[c].dataType).alias(c) for c in columns))
    return failed.unionAll(seen.select("sweep_id", F.lit(None).cast("string").alias("error"), *columns))


def evidence_documents(rows: DataFrame) -> DataFrame:
    """(sweep_id, content): evidence of the journal's listings as a collector writes it, some of it spoilt."""
    listed = rows.where("event_type = 'item_listed'")
    pages = listed.groupBy("token_id", F.expr(f"received_ms div {_PAGE_MS}").alias("page")).agg(F.array_sort(F.collect_list(F.struct("event_id", "order_hash", "price_raw"))).alias("x"))
    whole = pages.groupBy("token_id").agg(F.array_sort(F.collect_list(F.struct("page", "x"))).alias("p")).withColumn("flat", F.flatten("p.x")).withColumn("n", F.size("flat").cast("bigint")).withColumn("t", F.col("token_id").cast("bigint"))
    raw = F.transform("p", lambda p: F.struct(F.transform(p["x"], lambda e: F.struct(e["order_hash"].alias("order_hash"))).alias("listings")))
    normal = F.transform("flat", lambda e, i: F.struct(e["order_hash"].alias("orderHash"), (i + 1).alias("place"), e["price_raw"].alias("price"), F.struct(e["event_id"].alias("id")).alias("rawListing")))
    kept = F.when(F.col("t") % 19 == 3, F.slice(normal, F.lit(1), (F.col("n") - 1).cast("int"))).otherwise(normal)
    hashes = F.when(F.col("t") % 29 != 5, F.transform("p", lambda p, i: F.md5((i + 1).cast("string"))))
    no = F.lit(False)
    counters = F.struct(F.lit(0).alias("malformed"), F.expr(_SPOILT["conflicts"]).alias("conflicts"), F.expr(_SPOILT["counted"]).alias("normalized"))
    snapshot = F.struct(
        F.lit("COMPLETE").alias("result"), F.lit(1).alias("startedAt"), F.lit(2).alias("completedAt"), F.expr(_SPOILT["exhausted"]).alias("paginationExhausted"), no.alias("truncatedByPageLimit"), no.alias("truncatedByListingLimit"), no.alias("cursorCycleDetected"), counters.alias("counters"),
        raw.alias("rawPages"), kept.alias("listings"), hashes.alias("responseHashes"),
    )
    text = F.to_json(F.struct(F.when(F.col("t") % 37 != 7, snapshot).alias("snapshot"), F.create_map(F.lit("journal"), F.lit("h")).alias("sourceProvenance")))
    return whole.select(F.col("token_id").alias("sweep_id"), F.when(F.col("t") % 31 == 6, F.substring(text, 1, 20)).otherwise(text).alias("content"))
