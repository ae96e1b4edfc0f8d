"""One query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ball_kmeans, bpe, conversations, embedding_dedup, language_id, line_dedup, minhash_dedup, mixing, packing, repetition, sharding, suffix_dedup, url_filter
from tidemark.llm.tables import table

URL_RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.predict(docs, language_id.learn(docs))
    return found.select("doc_id", language_id.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_records(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def vocabulary_file() -> str:
    """The public word vocabulary; only its path is used here."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_file(), with_ids=False)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_file())


def toxic_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of pages whose document (the last number of the path) is labelled toxic."""
    url = F.col("url")
    doc = F.regexp_extract(url_filter.url_path(url), r"/([0-9]{1,18})(?:/|\.html)?$", 1)
    pages = table(spark, sf_dir, "pages").select(url_filter.canonical_url(url_filter.url_host(url), url_filter.url_path(url)).alias("canonical"), doc.try_cast("bigint").alias("doc_id"))
    return pages.join(table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id", "left_semi").select("canonical")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), toxic_urls(spark, sf_dir), URL_RULES).drop("possible", "listed")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with the faults that a hash of conversation and number deals out; nulls are one space."""
    whole = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in turns.columns}
    kind = F.crc32(F.concat(whole["conv_id"], F.lit(":"), whole["turn"]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(whole["text"], "[.!?]", "")).otherwise(whole["text"])
    role = F.when(kind == 4, "user").otherwise(whole["role"])
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversations.repair(damaged(turns)).withColumnRenamed("conv_id", "repaired_id")
    known = turns.select("conv_id").distinct()
    both = known.join(repaired, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return both.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_kmeans.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def ball_kmeans_sql(settings: ball_kmeans.Settings = ball_kmeans.Settings()) -> str:
    """The same rounds, all distances in each."""
    dims = settings.dimensions
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({settings.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, p) - 1 AS c, p FROM (SELECT p, sha256('{settings.seed}:' || vec_id) AS h FROM v ORDER BY h, p LIMIT {settings.clusters}))"""]
    for t in range(settings.rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (
  SELECT r, min({{'d': CAST(list_sum(list_transform(v.p, lambda x, i: (x - q.p[i]) * (x - q.p[i]))) AS BIGINT), 'c': c}}) AS m FROM v CROSS JOIN c{t} q GROUP BY r)""")
        if t < settings.rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT q.c, coalesce(n.p, q.p) AS p FROM c{t} q LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS p
    FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT m.c AS c, unnest(p) AS x, unnest(range(1, {dims} + 1)) AS i FROM v JOIN a{t} USING (r)) GROUP BY c, i) GROUP BY c) n ON n.c = q.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(q.p, ',')) AS centroid_sha256
FROM v JOIN a{settings.rounds} USING (r) JOIN c{settings.rounds} q ON q.c = m.c"""


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_sharding": op3_sharding,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_packing": op5_packing,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_bpe": op9_bpe,
    "op10_url_filters": op10_url_filters,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_ball_kmeans": op12_ball_kmeans,
    "op13_mixing": op13_mixing,
}

ORACLE_SQL: dict[str, str] = {
    "op12_ball_kmeans": ball_kmeans_sql(),
    "op10_url_filters": r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
canon AS (SELECT *, host || regexp_replace(path, '(\.html|/)$', '') AS canonical FROM parts),
listed AS (
  SELECT DISTINCT canonical FROM canon
  WHERE canonical <> '' AND try_cast(regexp_extract(path, '/([0-9]{1,18})(/|\.html)?$', 1) AS BIGINT) IN (SELECT doc_id FROM labels WHERE toxic = 1)),
rules(rule_host, rule_path, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (
  SELECT page_id, host, path, canonical, rule_host || rule_path AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS r
  FROM canon LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule,
       coalesce(v, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM fit WHERE r = 1
""",
}
