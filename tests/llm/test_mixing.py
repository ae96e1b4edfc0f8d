import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import words
from tidemark.llm import mixing as M
from tidemark.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = M.Settings(block_words=16, shard_slots=64)


def targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Shares by weight; whoever is above its limit stops there, and the rest share anew, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, mix = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in stopped]
        level = (mix - sum(stopped.values())) / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if level * weight[s] > most * sizes[s]]
        if not above:
            return {s: stopped.get(s, level * weight[s]) for s in names}
        stopped |= {s: most * sizes[s] for s in above}


def check(rows, documents):
    """``rows`` of a mix against the contract; documents are (doc_id, text, source)."""
    sizes = Counter()
    for _, text, source in documents:
        sizes[source] += len(WORD.findall(text or ""))
    wanted = targets(sizes)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter((i, s, len(WORD.findall(t or ""))) for i, t, s in documents)
    taken = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - wanted[s]) <= 0.5 + 1e-6 for s in sizes)


def table(spark, documents):
    return spark.createDataFrame([(*d, "en", 1, "x", "y") for d in documents], "doc_id long, text string, source string, lang string, size int, name string, block string").repartition(3)


def some_documents(seed, n=150):
    rng = random.Random(seed)
    return [(i, " ".join(words(rng, rng.choice([0, 1, 3, 40, 300]))), rng.choice(["a", "b", "é", "\U0001f600", "z", None, ""])) for i in range(n)]


def test_query_keeps_the_contract(spark):
    folder = "/root/testdata/sf0.001"
    documents = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = queries.op13_mixing(spark, folder).collect()
    check(rows, documents)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op13_mixing(spark, folder).collect()))


@pytest.mark.parametrize("seed", range(2))
def test_targets_are_met_in_small_blocks(spark, seed):
    documents = some_documents(seed)
    check(M.mix(table(spark, documents), settings=SMALL).collect(), documents)


def test_order_of_rows_and_partitions_changes_nothing(spark):
    documents = some_documents(5)
    one = M.mix(table(spark, documents), settings=SMALL).collect()
    shuffled = documents[::-1]
    assert sorted(map(str, one)) == sorted(map(str, M.mix(table(spark, shuffled).repartition(7), settings=SMALL).collect()))


def test_odd_documents(spark, odd_texts):
    documents = [(i, t, s) for i, t in enumerate(odd_texts) for s in ("a", None)] + [(None, "null id here", "b")] * 4 + [(5, "many copies of this", "hot")] * 9_000
    check(M.mix(table(spark, documents), settings=M.Settings(block_words=64)).collect(), documents)


def test_no_documents_or_no_words(spark):
    assert M.mix(table(spark, [])).collect() == []
    rows = M.mix(table(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 2


def test_slots_use_every_block_as_often_as_the_plan_says(spark):
    laid = M.lay_out(table(spark, some_documents(1)), settings=SMALL)
    plan = {r["name"]: r for r in laid.sources.collect()}
    uses, shards = defaultdict(Counter), Counter()
    for r in M.slots(laid.sources, SMALL).collect():
        uses[r["name"], r["pass"]][r["block"]] += 1
        shards[r["shard"]] += 1
    for (name, turn), blocks in uses.items():
        assert set(blocks.values()) == {1} and set(blocks) <= set(range(plan[name]["blocks"]))
        assert turn == plan[name]["passes"] or len(blocks) == plan[name]["blocks"]
    assert sum(shards.values()) == sum(p["slots"] for p in plan.values()) and set(list(shards.values())[:-1]) <= {64, *shards.values()}
    assert sorted(shards.values())[1:] == [64] * (len(shards) - 1)


def test_permutation_is_one_and_looks_random(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 1000):
        image = [r[0] for r in spark.range(n).select(M.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3), SMALL)).collect()]
        assert sorted(image) == list(range(n))
    assert 0 < sum(a < b for a, b in zip(image, image[1:])) / 999 < 1 and abs(sum(a < b for a, b in zip(image, image[1:])) / 999 - 0.5) < 0.06


def test_draws_follow_the_weights(spark):
    sources = spark.createDataFrame([("+a", 0, 8000), ("+b", 1, 1500), ("+c", 2, 500)], "name string, place int, slots long")
    drawn = Counter()
    for r in M.draw(sources, 10_000, M.Settings(shard_slots=100)).collect():
        drawn[r["name"]] += r["n"]
    assert sum(drawn.values()) == 10_000 and all(abs(drawn[n] - e) < 5 * e**0.5 for n, e in (("+a", 8000), ("+b", 1500), ("+c", 500)))


def test_texts_of_the_mix_are_the_words_that_were_taken(spark):
    documents = some_documents(3, 60)
    frame = table(spark, documents)
    taken = Counter()
    texts = {(i, s): WORD.findall(t) for i, t, s in documents}
    for r in M.mixed_texts(frame, settings=SMALL).collect():
        assert r["text"].split(" ") == texts[r["doc_id"], r["source"]][r["skipped"] : r["skipped"] + r["words"]]
        taken[r["doc_id"], r["source"]] += r["words"]
    assert {(r["doc_id"], r["source"]): r["taken"] for r in M.mix(frame, settings=SMALL).collect() if r["taken"]} == dict(taken)
