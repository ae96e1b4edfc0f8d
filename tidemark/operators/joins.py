"""Joins of journal, order and snapshot rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.inbox import KEYED_SQL, SIGNED_BLOCK, signed, with_dedupe_key, with_identity
from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, JOURNAL_SQL, NOW, journal, read

NFT = ["chain", "contract_address", "token_id"]

#: Current orders for the join queries: the latest event of each order by arrival decides.
LATEST_SQL = JOURNAL_SQL + """, latest AS (
SELECT order_hash, chain, contract_address, token_id, arg_max(event_type, (received_ms, event_id)) AS last_type, max(expiration_ms) AS expiration_ms, count(*) AS n_events
FROM j WHERE order_hash IS NOT NULL GROUP BY ALL),
active AS (SELECT * FROM latest WHERE last_type = 'item_listed')
"""


def latest_orders(rows: DataFrame) -> DataFrame:
    arrival = F.struct("received_ms", "event_id")
    return rows.where("order_hash IS NOT NULL").groupBy("order_hash", *NFT).agg(
        F.max_by("event_type", arrival).alias("last_type"), F.max("expiration_ms").alias("expiration_ms"), F.count(F.lit(1)).alias("n_events")
    )


def active_orders(rows: DataFrame) -> DataFrame:
    return latest_orders(rows).where("last_type = 'item_listed'")


@query("pending_left_joined", LATEST_SQL + """, nft AS (SELECT chain, contract_address, token_id, count(*) AS transfers FROM j WHERE event_type = 'item_transferred' GROUP BY ALL)
SELECT e.event_id, e.token_id, n.transfers, o.order_hash, count(o.order_hash) OVER (PARTITION BY e.event_id) AS order_matches
FROM j e LEFT JOIN nft n USING (chain, contract_address, token_id)
LEFT JOIN active o ON o.chain = e.chain AND o.contract_address = e.contract_address AND o.token_id = e.token_id AND o.n_events > 1
WHERE e.processing_status = 'pending' AND e.event_type = 'item_transferred'""")
def pending_left_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journal(spark, sf_dir)
    pending = rows.where("processing_status = 'pending' AND event_type = 'item_transferred'").select("event_id", *NFT)
    transfers = rows.where("event_type = 'item_transferred'").groupBy(*NFT).agg(F.count(F.lit(1)).alias("transfers"))
    orders = active_orders(rows).where("n_events > 1").select(*NFT, "order_hash")
    joined = pending.join(transfers, NFT, "left").join(orders, NFT, "left")
    matches = F.count("order_hash").over(Window.partitionBy("event_id"))
    return joined.select("event_id", "token_id", "transfers", "order_hash", matches.alias("order_matches"))


@query("multi_order_assets", LATEST_SQL + """
SELECT e.event_id, count(*) AS orders FROM j e JOIN active o USING (chain, contract_address, token_id)
WHERE e.event_type = 'item_transferred' AND e.processing_status = 'pending' GROUP BY e.event_id HAVING count(*) > 1""")
def multi_order_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journal(spark, sf_dir)
    pending = rows.where("event_type = 'item_transferred' AND processing_status = 'pending'").select("event_id", *NFT)
    # orders are counted before the join, so that it does not fan out
    counted = active_orders(rows).groupBy(*NFT).agg(F.count(F.lit(1)).alias("orders")).where("orders > 1")
    return pending.join(counted, NFT).select("event_id", "orders")


@query("distinct_assets_active", LATEST_SQL + """
SELECT count(DISTINCT (chain, contract_address, token_id)) AS assets, count(*) AS orders, count(*) FILTER (WHERE n_events = 1) AS single_event_orders FROM active""")
def distinct_assets_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_orders(journal(spark, sf_dir)).agg(F.count_distinct(*NFT).alias("assets"), F.count(F.lit(1)).alias("orders"), F.count_if(F.col("n_events") == 1).alias("single_event_orders"))


@query("same_second_conflict", KEYED_SQL + """
SELECT e.event_id, EXISTS (SELECT 1 FROM keyed o WHERE o.event_type = 'item_transferred' AND o.token_id = e.token_id AND o.event_ms // 1000 = e.event_ms // 1000
       AND o.event_id <> e.event_id AND o.transaction_hash <> e.transaction_hash AND o.dedupe_key <> e.dedupe_key) AS conflict
FROM keyed e WHERE e.event_type = 'item_transferred'""")
def same_second_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether another transaction moved the same asset in the same second.

    The group's least and greatest transactions tell it without a self-join:
    a row conflicts if either differs from its own. Different transactions
    have different structured keys, so the key adds no case of its own.
    """
    moves = with_dedupe_key(journal(spark, sf_dir)).where("event_type = 'item_transferred'").withColumn("second", F.expr("event_ms div 1000"))
    group = [*NFT, "second"]
    ends = moves.groupBy(*group).agg(F.min("transaction_hash").alias("lo"), F.max("transaction_hash").alias("hi"))
    own = F.col("transaction_hash")
    return moves.join(ends, group).select("event_id", F.coalesce((F.col("lo") != own) | (F.col("hi") != own), F.lit(False)).alias("conflict"))


#: The snapshot of the join queries: orders that a sweep of the last listings would have seen.
SNAPSHOT_SQL = LATEST_SQL + """, seen AS (SELECT DISTINCT order_hash FROM j WHERE event_type = 'item_listed' AND seller IS NOT NULL)
"""


def snapshot(rows: DataFrame) -> DataFrame:
    return rows.where("event_type = 'item_listed' AND seller IS NOT NULL").select("order_hash").distinct()


@query("set_reconciliation", SNAPSHOT_SQL + """
SELECT coalesce(l.order_hash, s.order_hash) AS order_hash, CASE WHEN s.order_hash IS NULL THEN 'missing_in_snapshot' WHEN l.order_hash IS NULL THEN 'unexpected_in_snapshot' ELSE 'both' END AS side
FROM active l FULL JOIN seen s ON l.order_hash = s.order_hash""")
def set_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journal(spark, sf_dir)
    local = active_orders(rows).select("order_hash", F.lit(True).alias("is_local"))
    joined = local.join(snapshot(rows).withColumn("is_seen", F.lit(True)), "order_hash", "full")
    return joined.select("order_hash", F.when(F.col("is_seen").isNull(), "missing_in_snapshot").when(F.col("is_local").isNull(), "unexpected_in_snapshot").otherwise("both").alias("side"))


@query("order_event_summary", JOURNAL_SQL + """
SELECT order_hash, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY CAST(event_id AS VARCHAR)) AS event_ids, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) AS n
FROM j WHERE order_hash IS NOT NULL GROUP BY order_hash""")
def order_event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids sort as text here, not as numbers."""
    grouped = journal(spark, sf_dir).where("order_hash IS NOT NULL").groupBy("order_hash").agg(
        F.array_sort(F.collect_list(F.col("event_id").cast("string"))).alias("ids"), F.array_sort(F.collect_set("event_type")).alias("types"), F.count(F.lit(1)).alias("n")
    )
    return grouped.select("order_hash", F.array_join("ids", ",").alias("event_ids"), F.array_join("types", ",").alias("types"), "n")


#: The window of an observation round: after its low-water mark, up to its high-water mark.
WINDOW = (NOW - 5 * 24 * HOUR, NOW)


@query("window_status_tally", JOURNAL_SQL + f"""
SELECT count(*) AS relevant, count(*) FILTER (WHERE processing_status = 'pending') AS pending, count(*) FILTER (WHERE processing_status = 'processing') AS processing,
       count(*) FILTER (WHERE processing_status = 'failed') AS failed, count(*) FILTER (WHERE processing_status = 'reconciliation_required') AS reconciliation_required
FROM j WHERE received_ms > {WINDOW[0]} AND received_ms <= {WINDOW[1]} AND (order_hash IS NOT NULL OR token_id IN (SELECT token_id FROM j WHERE event_type = 'item_listed' AND received_ms <= {WINDOW[0]} AND expiration_ms > {WINDOW[1]}))""")
def window_status_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journal(spark, sf_dir)
    window = rows.where((F.col("received_ms") > WINDOW[0]) & (F.col("received_ms") <= WINDOW[1]))
    scope = rows.where("event_type = 'item_listed'").where((F.col("received_ms") <= WINDOW[0]) & (F.col("expiration_ms") > WINDOW[1])).select(*NFT).distinct()
    transfers = window.where("order_hash IS NULL").join(scope, NFT, "left_semi").select("processing_status")
    relevant = window.where("order_hash IS NOT NULL").select("processing_status").unionAll(transfers)
    statuses = ("pending", "processing", "failed", "reconciliation_required")
    return relevant.agg(F.count(F.lit(1)).alias("relevant"), *(F.count_if(F.col("processing_status") == s).alias(s) for s in statuses))


@query("high_water", JOURNAL_SQL + """
SELECT max(event_id) AS event_id, arg_max(received_ms, event_id) AS received_ms FROM j""")
def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = journal(spark, sf_dir).agg(F.max(F.struct("event_id", "received_ms")).alias("w"))
    return top.select("w.event_id", "w.received_ms")


PUBLICATIONS_SQL = """
WITH pub AS (SELECT o_orderkey AS publication_id, o_custkey AS commitment, o_orderkey % 997 AS sequence, CASE o_orderstatus WHEN 'O' THEN 'ACCEPTED' WHEN 'F' THEN 'REJECTED' ELSE 'DRAFT' END AS state FROM orders)
"""


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "O", "ACCEPTED").when(F.col("o_orderstatus") == "F", "REJECTED").otherwise("DRAFT")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("publication_id"), F.col("o_custkey").alias("commitment"), (F.col("o_orderkey") % 997).alias("sequence"), state.alias("state"))


@query("current_generation", PUBLICATIONS_SQL + """, accepted AS (SELECT commitment, max(sequence) AS sequence FROM pub WHERE state = 'ACCEPTED' GROUP BY commitment)
SELECT commitment, sequence, n AS candidates, CASE WHEN n = 1 THEN 'CURRENT' ELSE 'CONFLICT' END AS verdict, CASE WHEN n = 1 THEN publication_id END AS publication_id
FROM (SELECT p.commitment, p.sequence, count(DISTINCT publication_id) AS n, min(publication_id) AS publication_id FROM pub p JOIN accepted a ON p.commitment = a.commitment AND p.sequence = a.sequence WHERE state = 'ACCEPTED' GROUP BY ALL)""")
def current_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = publications(spark, sf_dir).where("state = 'ACCEPTED'")
    by_sequence = accepted.groupBy("commitment", "sequence").agg(F.count_distinct("publication_id").alias("candidates"), F.min("publication_id").alias("publication_id"))
    top = by_sequence.groupBy("commitment").agg(F.max(F.struct("sequence", "candidates", "publication_id")).alias("t")).select("commitment", "t.*")
    sole = F.col("candidates") == 1
    return top.select("commitment", "sequence", "candidates", F.when(sole, "CURRENT").otherwise("CONFLICT").alias("verdict"), F.when(sole, F.col("publication_id")).alias("publication_id"))


@query("nearest_publication", PUBLICATIONS_SQL + """, attempts AS (SELECT c_custkey AS attempt_id, c_custkey AS commitment, c_custkey % 997 AS current FROM customer),
grouped AS (SELECT attempt_id, current, count(sequence) AS n, min(sequence) AS lo, max(sequence) AS hi
  FROM attempts LEFT JOIN (SELECT DISTINCT commitment, sequence FROM pub WHERE state = 'ACCEPTED') USING (commitment) GROUP BY ALL)
SELECT attempt_id, CASE WHEN n = 0 THEN 'UNPROVEN' WHEN n = 1 OR lo > current OR hi < current THEN 'PROVEN' ELSE 'CONFLICT' END AS verdict,
       CASE WHEN n = 0 THEN NULL WHEN n = 1 OR lo > current THEN lo WHEN hi < current THEN hi END AS sequence FROM grouped""")
def nearest_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accepted publications above: the least; all below: the greatest; on both sides: a conflict."""
    known = publications(spark, sf_dir).where("state = 'ACCEPTED'").groupBy("commitment").agg(F.count_distinct("sequence").alias("n"), F.min("sequence").alias("lo"), F.max("sequence").alias("hi"))
    attempts = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("attempt_id"), F.col("c_custkey").alias("commitment"), (F.col("c_custkey") % 997).alias("current"))
    above, below, one = F.col("lo") > F.col("current"), F.col("hi") < F.col("current"), F.col("n") == 1
    verdict = F.when(F.col("n").isNull(), "UNPROVEN").when(one | above | below, "PROVEN").otherwise("CONFLICT")
    return attempts.join(known, "commitment", "left").select("attempt_id", verdict.alias("verdict"), F.when(one | above, F.col("lo")).when(below, F.col("hi")).alias("sequence"))


PEER_GROUP = ["event_type", "chain", "contract_address", "token_id", "event_ms"]


@query("durable_peer_safety", KEYED_SQL + """, paired AS (
SELECT c.event_id, p.event_id AS peer_id,
       CASE WHEN c.event_version IS NULL OR p.event_version IS NULL THEN 'AMBIGUOUS:same_identity_uncomparable_version' WHEN c.event_version <> p.event_version THEN NULL
            WHEN c.transaction_hash IS NULL OR p.transaction_hash IS NULL THEN 'AMBIGUOUS:same_identity_missing_transaction_hash'
            WHEN c.transaction_hash <> p.transaction_hash THEN 'CONFLICT:same_identity_different_transaction_hash'
            WHEN c.dedupe_key = p.dedupe_key THEN 'EQUIVALENT_DUPLICATE:equivalent_durable_event_duplicate' ELSE 'AMBIGUOUS:same_identity_inconsistent_durable_representation' END AS verdict
FROM keyed c JOIN keyed p ON c.event_type = p.event_type AND c.token_id = p.token_id AND c.event_ms = p.event_ms AND c.event_id <> p.event_id)
SELECT c.event_id, coalesce(split_part(v, ':', 1), 'SAFE_UNIQUE') AS classification, coalesce(split_part(v, ':', 2), '') AS reason
FROM keyed c LEFT JOIN (SELECT event_id, arg_min(verdict, peer_id) AS v FROM paired WHERE verdict IS NOT NULL GROUP BY event_id) USING (event_id)""")
def durable_peer_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first peer (by id) with the same identity and a comparable or missing version decides.

    A row's peer is among the two least ids of its own version, of no version,
    or (for a row without a version) of the whole identity. Those are ranked
    per identity and version, which Spark cuts before the shuffle, so a group
    of many equal rows costs no square.
    """
    rows = with_identity(journal(spark, sf_dir)).select(*PEER_GROUP, "event_id", "event_version", "transaction_hash", "identity")
    two = least_of(rows, [*PEER_GROUP, "event_version"], 2)
    peer = F.struct("event_id", "event_version", "transaction_hash", "identity").alias("peer")
    # at most two rows a version, then two an identity, so these lists are short
    own = two.groupBy(*PEER_GROUP, F.coalesce("event_version", F.lit(-1)).alias("version")).agg(F.collect_list(peer).alias("own"))
    unversioned = two.where("event_version IS NULL").groupBy(*PEER_GROUP).agg(F.collect_list(peer).alias("unversioned"))
    any_version = least_of(two, PEER_GROUP, 2).groupBy(*PEER_GROUP).agg(F.collect_list(peer).alias("any_version"))
    known = rows.withColumn("version", F.coalesce("event_version", F.lit(-1)))
    joined = known.join(own, [*PEER_GROUP, "version"], "left").join(any_version, PEER_GROUP, "left").join(unversioned, PEER_GROUP, "left")
    pool = F.when(F.col("event_version").isNull(), F.col("any_version")).otherwise(F.concat("own", F.coalesce("unversioned", F.array().cast(joined.schema["own"].dataType))))
    others = joined.withColumn("p", F.array_min(F.filter(pool, lambda x: x["event_id"] != F.col("event_id"))))
    v, w, t, u = (F.col(x) for x in ("event_version", "p.event_version", "transaction_hash", "p.transaction_hash"))
    verdict = (
        F.when(F.col("p").isNull(), "SAFE_UNIQUE:").when(v.isNull() | w.isNull(), "AMBIGUOUS:same_identity_uncomparable_version")
        .when(t.isNull() | u.isNull(), "AMBIGUOUS:same_identity_missing_transaction_hash").when(t != u, "CONFLICT:same_identity_different_transaction_hash")
        .when(F.col("identity") == F.col("p.identity"), "EQUIVALENT_DUPLICATE:equivalent_durable_event_duplicate").otherwise("AMBIGUOUS:same_identity_inconsistent_durable_representation")
    )
    return others.select("event_id", F.split_part(verdict, F.lit(":"), F.lit(1)).alias("classification"), F.split_part(verdict, F.lit(":"), F.lit(2)).alias("reason"))


def least_of(rows: DataFrame, group: list[str], most: int) -> DataFrame:
    """The rows with the least ids of each group."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy("event_id"))
    return rows.withColumn("place", place).where(F.col("place") <= most).drop("place")


@query("live_listings", LATEST_SQL + f"""
SELECT order_hash, token_id, expiration_ms, expiration_ms > {NOW} AS visible, CASE WHEN expiration_ms <= {NOW} THEN 'expired' ELSE 'active' END AS status FROM active WHERE expiration_ms IS NOT NULL""")
def live_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = F.col("expiration_ms") > NOW
    return active_orders(journal(spark, sf_dir)).where("expiration_ms IS NOT NULL").select("order_hash", "token_id", "expiration_ms", live.alias("visible"), F.when(live, "active").otherwise("expired").alias("status"))


@query("fence_compare", JOURNAL_SQL + f""", blocks AS (
SELECT token_id, event_id // {SIGNED_BLOCK} AS block, sha256(string_agg(event_id || '/' || processing_status, ',' ORDER BY event_id) FILTER (WHERE received_ms <= {NOW})) AS before_fence,
       sha256(string_agg(event_id || '/' || processing_status, ',' ORDER BY event_id) FILTER (WHERE received_ms <= {NOW + 24 * HOUR})) AS after_fence FROM j GROUP BY ALL),
f AS (SELECT token_id, sha256(string_agg(before_fence, ',' ORDER BY block)) AS pre, sha256(string_agg(after_fence, ',' ORDER BY block)) AS post FROM blocks GROUP BY token_id)
SELECT token_id, pre, post, pre IS NOT DISTINCT FROM post AS unchanged FROM f""")
def fence_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each asset's events at two fences, a day apart; null where there are none yet."""
    text = F.concat(F.col("event_id").cast("string"), F.lit("/"), F.col("processing_status"))
    until = lambda fence: F.when(F.col("received_ms") <= fence, text)
    prints = signed(journal(spark, sf_dir), "token_id", {"pre": until(NOW), "post": until(NOW + 24 * HOUR)}, lambda x: F.sha2(x, 256), ",")
    return prints.select("token_id", "pre", "post", F.col("pre").eqNullSafe(F.col("post")).alias("unchanged"))


_ORDER_BLOCKS = "sha256(string_agg(event_id || '/' || processing_status, ',' ORDER BY event_id) FILTER (WHERE received_ms <= {}))"


@query("order_fence_compare", JOURNAL_SQL + f""", o AS (SELECT order_hash, token_id, event_id // {SIGNED_BLOCK} AS block, {_ORDER_BLOCKS.format(NOW)} AS a, {_ORDER_BLOCKS.format(NOW + 24 * HOUR)} AS b FROM j WHERE order_hash IS NOT NULL GROUP BY ALL),
own AS (SELECT order_hash, token_id, sha256(string_agg(a, ',' ORDER BY block)) AS pre, sha256(string_agg(b, ',' ORDER BY block)) AS post FROM o GROUP BY ALL),
t AS (SELECT token_id, event_id // {SIGNED_BLOCK} AS block, {_ORDER_BLOCKS.format(NOW)} AS a, {_ORDER_BLOCKS.format(NOW + 24 * HOUR)} AS b FROM j WHERE event_type = 'item_transferred' GROUP BY ALL),
moved AS (SELECT token_id, sha256(string_agg(a, ',' ORDER BY block)) AS pre, sha256(string_agg(b, ',' ORDER BY block)) AS post FROM t GROUP BY token_id)
SELECT order_hash, md5(coalesce(o.pre, '') || '|' || coalesce(m.pre, '')) AS pre, md5(coalesce(o.post, '') || '|' || coalesce(m.post, '')) AS post,
       o.pre IS NOT DISTINCT FROM o.post AND m.pre IS NOT DISTINCT FROM m.post AS unchanged FROM own o LEFT JOIN moved m USING (token_id)""")
def order_fence_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of what concerns each order at two fences: its own events, and the transfers of its asset.

    The two are signed apart and their signatures joined, so that no order meets the transfers one by one.
    """
    rows = journal(spark, sf_dir)
    text = F.concat(F.col("event_id").cast("string"), F.lit("/"), F.col("processing_status"))
    lines = {n: F.when(F.col("received_ms") <= fence, text) for n, fence in (("pre", NOW), ("post", NOW + 24 * HOUR))}
    digest = lambda x: F.sha2(x, 256)
    own = signed(rows.where("order_hash IS NOT NULL"), "order_hash", lines, digest, ",").join(rows.where("order_hash IS NOT NULL").groupBy("order_hash").agg(F.min("token_id").alias("token_id")), "order_hash")
    moved = signed(rows.where("event_type = 'item_transferred'"), "token_id", lines, digest, ",").select("token_id", F.col("pre").alias("moved_pre"), F.col("post").alias("moved_post"))
    both = own.join(moved, "token_id", "left")
    joint = lambda n: F.md5(F.concat_ws("|", F.coalesce(n, F.lit("")), F.coalesce(f"moved_{n}", F.lit("")))).alias(n)
    return both.select("order_hash", joint("pre"), joint("post"), (F.col("pre").eqNullSafe(F.col("post")) & F.col("moved_pre").eqNullSafe(F.col("moved_post"))).alias("unchanged"))
