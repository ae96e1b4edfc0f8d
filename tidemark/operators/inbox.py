"""The inbox: admission, metrics, queues and retries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import normalise as N
from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, JOURNAL_SQL, NOW, journal

STALE_MS, MAX_ATTEMPTS = 900_000, 5
TERMINAL = ("applied", "reconciliation_required", "failed", "ignored_duplicate", "ignored_older")


def due(now: int) -> Column:
    return (F.col("processing_status") == "pending") & (F.col("next_retry_ms").isNull() | (F.col("next_retry_ms") <= now))


@query("journal_projection", JOURNAL_SQL + """
SELECT event_id, event_type, received_ms, event_ms, event_version, order_hash, split_part(nft_id, '/', 1) AS chain, lower(split_part(nft_id, '/', 2)) AS contract,
       split_part(nft_id, '/', 3) AS token, transaction_hash, seller, processing_status, attempt_count, next_retry_ms
FROM j""")
def journal_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    nft = F.col("nft_id")
    return journal(spark, sf_dir).select(
        "event_id", "event_type", "received_ms", "event_ms", "event_version", "order_hash", N.nft_part(nft, 1).alias("chain"), N.nft_part(nft, 2).alias("contract"),
        N.nft_part(nft, 3).alias("token"), "transaction_hash", "seller", "processing_status", "attempt_count", "next_retry_ms",
    )


@query("inbox_metrics", JOURNAL_SQL + f"""
SELECT count(*) FILTER (WHERE processing_status = 'pending') AS pending_total,
       count(*) FILTER (WHERE processing_status = 'pending' AND (next_retry_ms IS NULL OR next_retry_ms <= {NOW})) AS pending_due,
       count(*) FILTER (WHERE processing_status = 'pending' AND next_retry_ms > {NOW}) AS pending_scheduled,
       count(*) FILTER (WHERE processing_status = 'processing') AS processing_total,
       count(*) FILTER (WHERE processing_status = 'processing' AND started_ms <= {NOW} - {STALE_MS}) AS stale_processing,
       count(*) FILTER (WHERE processing_status = 'failed') AS failed_total,
       count(*) FILTER (WHERE processing_status = 'reconciliation_required') AS reconciliation_required_total,
       count(*) FILTER (WHERE processing_status = 'applied') AS applied_total,
       count(*) FILTER (WHERE processing_status = 'ignored_older') AS ignored_older_total,
       min(received_ms) FILTER (WHERE processing_status = 'pending') AS oldest_pending_ms,
       greatest(0, {NOW} - min(received_ms) FILTER (WHERE processing_status = 'pending' AND (next_retry_ms IS NULL OR next_retry_ms <= {NOW}))) AS oldest_due_age_ms,
       coalesce(max(attempt_count), 0) AS max_attempt_count
FROM j""")
def inbox_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(journal(spark, sf_dir), NOW)


def metrics(rows: DataFrame, now: int, stale_ms: int = STALE_MS) -> DataFrame:
    """One row of counts and ages; all measures come from one scan."""
    status = F.col("processing_status")
    return rows.agg(
        F.count_if(status == "pending").alias("pending_total"),
        F.count_if(due(now)).alias("pending_due"),
        F.count_if((status == "pending") & (F.col("next_retry_ms") > now)).alias("pending_scheduled"),
        F.count_if(status == "processing").alias("processing_total"),
        F.count_if((status == "processing") & (F.col("started_ms") <= now - stale_ms)).alias("stale_processing"),
        *(F.count_if(status == s).alias(f"{s}_total") for s in ("failed", "reconciliation_required", "applied", "ignored_older")),
        F.min(F.when(status == "pending", F.col("received_ms"))).alias("oldest_pending_ms"),
        F.greatest(F.lit(0), F.lit(now) - F.min(F.when(due(now), F.col("received_ms")))).alias("oldest_due_age_ms"),
        F.coalesce(F.max("attempt_count"), F.lit(0)).alias("max_attempt_count"),
    )


@query("readiness", JOURNAL_SQL + f""", m AS (
SELECT count(*) FILTER (WHERE processing_status = 'failed') AS failed,
       count(*) FILTER (WHERE processing_status = 'pending' AND (next_retry_ms IS NULL OR next_retry_ms <= {NOW})) AS due,
       {NOW} - min(received_ms) FILTER (WHERE processing_status = 'pending' AND (next_retry_ms IS NULL OR next_retry_ms <= {NOW})) AS age,
       count(*) FILTER (WHERE processing_status = 'processing' AND started_ms <= {NOW} - {STALE_MS}) AS stale
FROM j)
SELECT array_to_string(list_sort(list_filter([CASE WHEN failed > 0 THEN 'failed_events_present' END, CASE WHEN due > 100 THEN 'due_backlog_too_large' END,
       CASE WHEN age > 3600000 THEN 'oldest_due_too_old' END, CASE WHEN stale > 0 THEN 'stale_processing_present' END], lambda x: x IS NOT NULL)), ',') AS reasons,
       NOT (failed > 0 OR due > 100 OR coalesce(age > 3600000, false) OR stale > 0) AS ready
FROM m""")
def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics(journal(spark, sf_dir), NOW)
    why = N.reasons(
        ("failed_events_present", F.col("failed_total") > 0), ("due_backlog_too_large", F.col("pending_due") > 100),
        ("oldest_due_too_old", F.col("oldest_due_age_ms") > HOUR), ("stale_processing_present", F.col("stale_processing") > 0),
    )
    return found.select(why.alias("reasons"), (why == "").alias("ready"))


@query("lifecycle_distribution", JOURNAL_SQL + """
SELECT processing_status, attempt_count,
       CASE WHEN processing_status LIKE 'ignored_older%' THEN 'ignored_older' WHEN event_type = 'item_transferred' THEN 'reconciliation_required'
            WHEN processing_status LIKE '%reconciliation%' THEN 'reconciliation_required' WHEN processing_status IN ('pending', 'processing') THEN 'pending' ELSE 'applied' END AS migrated,
       count(*) AS n
FROM j GROUP BY ALL""")
def lifecycle_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("processing_status")
    migrated = (
        F.when(status.like("ignored_older%"), "ignored_older").when(F.col("event_type") == "item_transferred", "reconciliation_required")
        .when(status.like("%reconciliation%"), "reconciliation_required").when(status.isin("pending", "processing"), "pending").otherwise("applied")
    )
    return journal(spark, sf_dir).groupBy("processing_status", "attempt_count", migrated.alias("migrated")).agg(F.count(F.lit(1)).alias("n"))


def _identities() -> tuple[tuple[str, Column, list[tuple[str, Column]]], ...]:
    """Families of identities with the rows that have one, tried from the top, and their parts."""
    place = [("eventType", F.col("event_type")), ("chain", F.col("chain")), ("contractAddress", F.col("contract_address"))]
    version, when = F.col("event_version").cast("string"), F.col("event_ms").cast("string")
    content = [("eventType", F.col("event_type")), ("payload", F.col("event_id").cast("string"))]
    is_transfer = F.col("event_type") == "item_transferred"
    return (
        ("transfer", is_transfer & F.col("transaction_hash").isNotNull(), [*place, ("nftId", F.col("nft_id")), ("transactionHash", F.col("transaction_hash"))]), ("transfer-fallback", is_transfer, content),
        ("order", F.col("order_hash").isNotNull() & F.col("event_version").isNotNull(), [*place, ("orderHash", F.col("order_hash")), ("eventTimestamp", when), ("eventVersion", version)]), ("order-fallback", F.lit(True), content),
    )


def with_dedupe_key(rows: DataFrame) -> DataFrame:
    """Structured identity of each event; an event without the parts of one falls back to its own content."""
    key = F.coalesce(*(F.when(has, N.dedupe_key(family, parts)) for family, has, parts in _identities()))
    return rows.withColumn("dedupe_key", key)


def with_identity(rows: DataFrame) -> DataFrame:
    """The same identity as plain text, for comparisons that need no key to store."""
    text = lambda family, parts: F.concat_ws("\0", F.lit(family), *(F.coalesce(value, F.lit("\1")) for _, value in parts))
    return rows.withColumn("identity", F.coalesce(*(F.when(has, text(family, parts)) for family, has, parts in _identities())))


KEYED_SQL = JOURNAL_SQL + """, keyed AS (
SELECT *, CASE
  WHEN event_type = 'item_transferred' AND transaction_hash IS NOT NULL THEN 'transfer:v1:' || sha256('{"components":{"chain":"' || chain || '","contractAddress":"' || contract_address || '","eventType":"' || event_type || '","nftId":"' || nft_id || '","transactionHash":"' || transaction_hash || '"},"family":"transfer","schema":"tidemark-dedupe","version":1}')
  WHEN event_type = 'item_transferred' THEN 'transfer-fallback:v1:' || sha256('{"components":{"eventType":"' || event_type || '","payload":"' || event_id || '"},"family":"transfer-fallback","schema":"tidemark-dedupe","version":1}')
  WHEN event_version IS NOT NULL THEN 'order:v1:' || sha256('{"components":{"chain":"' || chain || '","contractAddress":"' || contract_address || '","eventTimestamp":"' || event_ms || '","eventType":"' || event_type || '","eventVersion":"' || event_version || '","orderHash":"' || order_hash || '"},"family":"order","schema":"tidemark-dedupe","version":1}')
  ELSE 'order-fallback:v1:' || sha256('{"components":{"eventType":"' || event_type || '","payload":"' || event_id || '"},"family":"order-fallback","schema":"tidemark-dedupe","version":1}')
END AS dedupe_key FROM j)
"""


def first_by_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key. An aggregate, so copies of a hot key are combined before they are shuffled."""
    others = [c for c in rows.columns if c not in order]
    first = F.min_by(F.struct(*others), F.struct(*order))
    return rows.groupBy(F.col(key).alias("_key")).agg(first.alias("r"), F.min(F.struct(*order)).alias("o")).select("r.*", "o.*")


@query("dedupe_admission", KEYED_SQL + """
SELECT event_id, dedupe_key, split_part(dedupe_key, ':', 1) AS strategy, contains(dedupe_key, 'fallback') AS fallback,
       CASE WHEN row_number() OVER (PARTITION BY dedupe_key ORDER BY received_ms, event_id) = 1 THEN 'inserted' ELSE 'existing' END AS admission
FROM keyed""")
def dedupe_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event (ids are unique) with its key, and whether it was the first of it.

    The first of each key comes out of the aggregate, so only keys that repeat, usually few, meet their rows again.
    """
    rows = with_dedupe_key(journal(spark, sf_dir)).select("event_id", "received_ms", "dedupe_key")
    firsts = rows.groupBy("dedupe_key").agg(F.min(F.struct("received_ms", "event_id")).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = firsts.where("n > 1").select(F.col("dedupe_key").alias("repeated_key"), F.col("first.event_id").alias("first_id"))
    inserted = firsts.select(F.col("first.event_id").alias("event_id"), "dedupe_key", F.lit("inserted").alias("admission"))
    # keys are not null; a plain equality would have Spark filter by that first, and work every key out once more
    existing = rows.join(repeated, F.col("dedupe_key").eqNullSafe(F.col("repeated_key"))).where("event_id <> first_id").select("event_id", "dedupe_key", F.lit("existing").alias("admission"))
    return inserted.unionAll(existing).select("event_id", "dedupe_key", F.split_part("dedupe_key", F.lit(":"), F.lit(1)).alias("strategy"), F.col("dedupe_key").contains("fallback").alias("fallback"), "admission")


def admit(existing: DataFrame, incoming: DataFrame, key: str = "dedupe_key") -> DataFrame:
    """Rows of ``incoming`` to append: the first of each key that ``existing`` does not have."""
    fresh = incoming.join(existing.select(key), key, "left_anti").select(*incoming.columns)
    return first_by_key(fresh, key, "received_ms", "event_id").select(*incoming.columns)


@query("due_queue", JOURNAL_SQL + f"""
SELECT event_id, received_ms FROM j WHERE processing_status = 'pending' AND (next_retry_ms IS NULL OR next_retry_ms <= {NOW}) AND source <> 'rest'
ORDER BY received_ms, event_id LIMIT 50""")
def due_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal(spark, sf_dir).where(due(NOW) & (F.col("source") != "rest")).orderBy("received_ms", "event_id").limit(50).select("event_id", "received_ms")


@query("stale_recovery", JOURNAL_SQL + f""", stale AS (
SELECT event_id FROM j WHERE processing_status = 'processing' AND started_ms <= {NOW} - {STALE_MS} ORDER BY started_ms, event_id LIMIT 100)
SELECT event_id, CASE WHEN event_id IN (SELECT event_id FROM stale) THEN 'pending' ELSE processing_status END AS processing_status,
       CASE WHEN event_id IN (SELECT event_id FROM stale) THEN NULL ELSE started_ms END AS started_ms
FROM j WHERE processing_status = 'processing'""")
def stale_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = journal(spark, sf_dir).where(F.col("processing_status") == "processing").select("event_id", "processing_status", "started_ms")
    # the batch of one recovery step: at most 100 rows, so it can go to all executors
    stale = running.where(F.col("started_ms") <= NOW - STALE_MS).orderBy("started_ms", "event_id").limit(100).select("event_id", F.lit(True).alias("stale"))
    joined = running.join(F.broadcast(stale), "event_id", "left")
    again = F.col("stale").isNotNull()
    return joined.select("event_id", F.when(again, "pending").otherwise(F.col("processing_status")).alias("processing_status"), F.when(~again, F.col("started_ms")).alias("started_ms"))


@query("retry_schedule", JOURNAL_SQL + f"""
SELECT event_id,
       CASE WHEN processing_status IN ('applied', 'reconciliation_required', 'failed', 'ignored_duplicate', 'ignored_older') THEN 'already_finalized'
            WHEN processing_status <> 'pending' THEN 'not_eligible' WHEN k % 12 = 0 THEN 'non_retryable_failed'
            WHEN attempt_count + 1 >= {MAX_ATTEMPTS} THEN 'retry_exhausted' ELSE 'retry_scheduled' END AS outcome,
       CASE WHEN processing_status = 'pending' AND k % 12 <> 0 AND attempt_count + 1 < {MAX_ATTEMPTS}
            THEN {NOW} + least(delay + delay * (event_id % 101) // 500, 300000) END AS next_retry_ms
FROM (SELECT *, CAST(least(5000 * pow(2, least(attempt_count, 30)), 300000) AS BIGINT) AS delay FROM j)""")
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule_retry(journal(spark, sf_dir), F.col("k") % 12 == 0, NOW, jitter=F.col("event_id") % 101)


def schedule_retry(rows: DataFrame, non_retryable: Column, now: int, most: int = MAX_ATTEMPTS, jitter: Column | None = None) -> DataFrame:
    """What a failed attempt on each row comes to; unknown errors count as retryable."""
    status, attempt = F.col("processing_status"), F.col("attempt_count") + 1
    outcome = (
        F.when(status.isin(*TERMINAL), "already_finalized").when(status != "pending", "not_eligible")
        .when(non_retryable, "non_retryable_failed").when(attempt >= most, "retry_exhausted").otherwise("retry_scheduled")
    )
    return rows.select("event_id", outcome.alias("outcome"), F.when(outcome == "retry_scheduled", F.lit(now) + N.backoff_ms(attempt, jitter=jitter)).alias("next_retry_ms"))


@query("count_pack_before_after", JOURNAL_SQL + f""", packs AS (
SELECT count(*) FILTER (WHERE received_ms < {NOW}) AS events_before, count(*) AS events_after,
       count(*) FILTER (WHERE processing_status = 'pending' AND received_ms < {NOW}) AS pending_before, count(*) FILTER (WHERE processing_status = 'pending') AS pending_after,
       count(*) FILTER (WHERE processing_status = 'pending' AND source = 'rest' AND received_ms < {NOW}) AS rest_pending_before,
       count(*) FILTER (WHERE processing_status = 'pending' AND source = 'rest') AS rest_pending_after FROM j)
SELECT *, events_after - events_before AS events_delta, pending_after - pending_before AS pending_delta, rest_pending_after - rest_pending_before AS rest_pending_delta FROM packs""")
def count_pack_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = F.col("processing_status") == "pending"
    measures = {"events": F.lit(True), "pending": pending, "rest_pending": pending & (F.col("source") == "rest")}
    before = F.col("received_ms") < NOW
    counted = journal(spark, sf_dir).agg(*(F.count_if(c & before).alias(f"{n}_before") for n, c in measures.items()), *(F.count_if(c).alias(f"{n}_after") for n, c in measures.items()))
    return counted.select("*", *((F.col(f"{n}_after") - F.col(f"{n}_before")).alias(f"{n}_delta") for n in measures))


#: Ids of a range that is hashed as one; ranges are hashed in turn, so many of them at a time, so no key's rows or ranges meet in one list.
SIGNED_BLOCK = 4096


@query("journal_signature", JOURNAL_SQL + f""", blocks AS (SELECT token_id, event_id // {SIGNED_BLOCK} AS block, count(*) AS n, md5(string_agg(event_id || ':' || processing_status || ':' || coalesce(event_version, -1), chr(10) ORDER BY event_id)) AS h FROM j GROUP BY ALL)
SELECT token_id, CAST(sum(n) AS BIGINT) AS n, md5(string_agg(h, chr(10) ORDER BY block)) AS signature FROM blocks GROUP BY token_id""")
def journal_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signature of each asset's rows, to be compared before and after a guarded run."""
    line = F.concat_ws(":", F.col("event_id").cast("string"), "processing_status", F.coalesce("event_version", F.lit(-1)).cast("string"))
    return signed(journal(spark, sf_dir), "token_id", {"signature": line}, F.md5)


def signed(rows: DataFrame, key: str, lines: dict[str, Column], digest: Callable[[Column], Column], between: str = "\n") -> DataFrame:
    """(key, n, a digest for each kind of line) over the rows of a key in the order of event_id; a null line is left out."""
    largest = rows.agg(F.max("event_id")).first()[0] or 0
    level = rows.select(key, F.expr(f"event_id div {SIGNED_BLOCK}").alias("block"), "event_id", *(x.alias(f"line_{n}") for n, x in lines.items())).groupBy(key, "block").agg(
        F.count(F.lit(1)).alias("n"), *(_digest(F.when(F.col(f"line_{n}").isNotNull(), F.struct("event_id", F.col(f"line_{n}").alias("line"))), digest, between).alias(n) for n in lines)
    )
    parts = [_digest(F.when(F.col(n).isNotNull(), F.struct("block", F.col(n).alias("line"))), digest, between).alias(n) for n in lines]
    blocks = largest // SIGNED_BLOCK
    while blocks >= SIGNED_BLOCK:
        level, blocks = level.groupBy(key, F.expr(f"block div {SIGNED_BLOCK}").alias("above")).agg(F.sum("n").alias("n"), *parts).withColumnRenamed("above", "block"), blocks // SIGNED_BLOCK
    return level.groupBy(key).agg(F.sum("n").alias("n"), *parts)


def _digest(entry: Column, digest: Callable[[Column], Column], between: str) -> Column:
    found = F.array_sort(F.collect_list(entry))
    return F.when(F.size(found) > 0, digest(F.array_join(found["line"], between)))


@query("type_distribution_map", JOURNAL_SQL + """
SELECT source, string_agg(event_type || '=' || n, ';' ORDER BY event_type) AS counters, CAST(sum(n) AS BIGINT) AS total
FROM (SELECT source, event_type, count(*) AS n FROM j GROUP BY ALL) GROUP BY source""")
def type_distribution_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = journal(spark, sf_dir).groupBy("source", "event_type").agg(F.count(F.lit(1)).alias("n"))
    together = counted.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("event_type", "n"))).alias("x"), F.sum("n").alias("total"))
    return together.select("source", F.array_join(F.transform("x", lambda e: F.concat(e["event_type"], F.lit("="), e["n"].cast("string"))), ";").alias("counters"), "total")


@query("lock_bucket", JOURNAL_SQL + """
SELECT DISTINCT order_hash, CASE WHEN h >= 9223372036854775808 THEN CAST(h - 18446744073709551616 AS BIGINT) ELSE CAST(h AS BIGINT) END AS bucket
FROM (SELECT order_hash, CAST(CAST('0x' || substr(sha256(order_hash), 1, 16) AS UBIGINT) AS HUGEINT) AS h FROM j WHERE order_hash IS NOT NULL)""")
def lock_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = journal(spark, sf_dir).where("order_hash IS NOT NULL").select("order_hash").distinct()
    return orders.select("order_hash", N.lock_bucket(F.col("order_hash")).alias("bucket"))


@query("version_compare", JOURNAL_SQL + """
SELECT a.event_id, CASE WHEN a.event_version < b.event_version THEN -1 WHEN a.event_version = b.event_version THEN 0 WHEN a.event_version > b.event_version THEN 1 END AS compared
FROM j a JOIN j b ON b.event_id = a.event_id + 1""")
def version_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journal(spark, sf_dir).select("event_id", N.event_version(F.col("event_version").cast("string")).alias("v"))
    following = rows.select((F.col("event_id") - 1).alias("event_id"), F.col("v").alias("w"))
    return rows.join(following, "event_id").select("event_id", N.compare_versions(F.col("v"), F.col("w")).alias("compared"))


@query("price_normalisation", JOURNAL_SQL + """
SELECT event_id, price_raw,
       CASE WHEN price_raw IS NOT NULL THEN
         CASE WHEN k % 20 = 0 THEN digits ELSE
         substr(lpad(digits, w, '0'), 1, w - k % 20) || '.' || coalesce(nullif(rtrim(right(lpad(digits, w, '0'), k % 20), '0'), ''), '0') END END AS price
FROM (SELECT *, CAST(greatest(length(digits), k % 20 + 1) AS INTEGER) AS w FROM (SELECT event_id, k, price_raw, coalesce(nullif(ltrim(price_raw, '0'), ''), '0') AS digits FROM j))""")
def price_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal(spark, sf_dir).select("event_id", "price_raw", N.decimal_text(F.col("price_raw"), F.col("k") % 20).alias("price"))


@query("timestamp_normalisation", JOURNAL_SQL + """, texts AS (
SELECT event_id, event_ms, CASE k % 5 WHEN 0 THEN CAST(event_ms // 1000 AS VARCHAR) WHEN 1 THEN CAST(event_ms + 7 AS VARCHAR)
       WHEN 2 THEN ' ' || strftime(make_timestamp_ms(event_ms), '%Y-%m-%dT%H:%M:%S') || '.1234Z' WHEN 3 THEN '12' ELSE 'yesterday' END AS text, k FROM j)
SELECT event_id, text, CASE k % 5 WHEN 0 THEN event_ms WHEN 1 THEN event_ms + 7 WHEN 2 THEN event_ms + 123 END AS business_ms,
       CASE WHEN k % 5 < 3 THEN event_ms END AS second_ms FROM texts""")
def timestamp_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms, kind = F.col("event_ms"), F.col("k") % 5
    iso = F.expr("date_format(timestampadd(MILLISECOND, event_ms, TIMESTAMP_NTZ '1970-01-01 00:00:00'), \"yyyy-MM-dd'T'HH:mm:ss\")")
    text = F.when(kind == 0, F.expr("event_ms div 1000").cast("string")).when(kind == 1, (ms + 7).cast("string")).when(kind == 2, F.concat(F.lit(" "), iso, F.lit(".1234Z"))).when(kind == 3, "12").otherwise("yesterday")
    read = N.business_ms(F.col("text"))
    return journal(spark, sf_dir).select("event_id", text.alias("text")).select("event_id", "text", read.alias("business_ms"), N.floor_second(read).alias("second_ms"))


@query("redaction", JOURNAL_SQL + r"""
SELECT event_id, substr(regexp_replace(regexp_replace('try ' || event_id || ' token=' || coalesce(seller, '?') || ', PASSWORD = x' || k || ' at http://me:' || k || '@host/p', '\b(password|token|secret|api[_-]?key)\s*=\s*[^,\s]+', '\1=<REDACTED>', 'gi'), '://[^/\s:@]+:[^/\s@]+@', '://<REDACTED>@', 'g'), 1, 500) AS message,
       substr(regexp_replace(coalesce(nullif(CASE WHEN k % 4 = 0 THEN '' ELSE 'E ' || k || '/x' END, ''), 'unknown_error'), '[^A-Za-z0-9_.-]', '_', 'g'), 1, 80) AS code
FROM j""")
def redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k").cast("string")
    message = F.concat(F.lit("try "), F.col("event_id").cast("string"), F.lit(" token="), F.coalesce("seller", F.lit("?")), F.lit(", PASSWORD = x"), k, F.lit(" at http://me:"), k, F.lit("@host/p"))
    code = F.when(F.col("k") % 4 == 0, "").otherwise(F.concat(F.lit("E "), k, F.lit("/x")))
    return journal(spark, sf_dir).select("event_id", N.redact(message).alias("message"), N.sanitise_code(code).alias("code"))


@query("marker_predicates", JOURNAL_SQL + """
SELECT event_id, array_to_string(list_sort(list_filter([CASE WHEN lower(coalesce(seller, '')) LIKE 'u1%' THEN 'seller_marker' END, CASE WHEN price_raw ILIKE '%77%' OR price_raw ILIKE '%13%' THEN 'price_marker' END,
       CASE WHEN order_hash LIKE '%-0' OR order_hash LIKE '1%' THEN 'order_marker' END], lambda x: x IS NOT NULL)), ',') AS markers
FROM j""")
def marker_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = (
        ("seller_marker", F.lower(F.coalesce("seller", F.lit(""))).like("u1%")), ("price_marker", F.expr("price_raw ILIKE ANY ('%77%', '%13%')")),
        ("order_marker", F.expr("order_hash LIKE ANY ('%-0', '1%')")),
    )
    return journal(spark, sf_dir).select("event_id", N.reasons(*checks).alias("markers"))
