import corpus_pipeline as P
from tidemark.llm.queries import QUERIES
from tests.llm.test_line_dedup import brute as lines_of

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    first = P.STAGES[0][1](spark, docs, SMALL)
    assert first.columns == docs.columns and first.count() >= 0.98 * len(given)
    second = P.STAGES[1][1](spark, first, SMALL)
    kept = second.collect()
    assert second.columns == docs.columns
    texts = lines_of([(r["doc_id"], r["text"]) for r in first.collect()])
    assert {r["doc_id"]: r["text"] for r in kept} == texts and all(r["n_chars"] == len(r["text"]) for r in kept)
    third = P.STAGES[2][1](spark, second, SMALL)
    ids = {r["doc_id"] for r in third.collect()}
    by_text: dict = {}
    for r in kept:
        by_text.setdefault(r["text"], []).append(r["doc_id"])
    assert all(len(ids & set(same)) <= 1 for same in by_text.values()) and third.columns == docs.columns
    fourth = P.STAGES[3][1](spark, third, SMALL)
    assert fourth.columns == docs.columns and {r["doc_id"] for r in fourth.collect()} == ids


def test_run_packs_what_is_left(spark):
    pieces = P.run(spark, SMALL)
    lengths: dict = {}
    for r in pieces.collect():
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
