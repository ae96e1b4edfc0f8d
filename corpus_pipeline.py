"""Documents in, training sequences out: five operators of tidemark.llm one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, line_dedup, minhash_dedup, packing, suffix_dedup
from tidemark.llm.queries import vocabulary_file
from tidemark.llm.tables import cut

#: Documents whose language is less sure than this are rejected, as are those without a letter.
LEAST_SCORE = 0.35


def _as_before(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars (where there is one) counted anew."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*(F.col(f"`{c}`") for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; without labels there is nothing to reject by but letters."""
    net = language_id.learn(docs)
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, net, keep=True)
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*(F.col(f"`{c}`") for c in docs.columns))


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat earlier ones."""
    return _as_before(docs, line_dedup.remove_repeated_lines(docs))


def dedupe_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least number."""
    kept = minhash_dedup.near_duplicates(docs).where("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionAll(docs.where("doc_id IS NULL"))


def dedupe_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that repeat earlier ones."""
    return _as_before(docs, suffix_dedup.remove_repeated_passages(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, neighbours on the curve together."""
    return packing.pack(docs, vocabulary_file())


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedupe_lines),
    ("MinHash near-dedup", dedupe_documents),
    ("suffix-array dedup", dedupe_passages),
    ("packing", pack_sequences),
]

#: SQL can't express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, name.replace(" ", "-"))
    return docs
