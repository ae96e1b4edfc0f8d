import random

import numpy as np
import pytest

from tidemark.llm import language_id as L

SYLLABLES = {"aa": ["ka", "mo", "ti", "lu"], "bb": ["sch", "ung", "ein", "der"], "cc": ["é", "eau", "ou", "ç"]}


def text_in(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def small():
    return L.Settings(window=64, texts_per_language=60, epochs=4)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows = [(i, text_in(rng, lang), lang, f"clash{i}") for i, lang in enumerate(random.Random(3).choices(list(SYLLABLES), k=400))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, row string")


def test_gradients_are_right():
    net = L.Network.fresh(["a", "b"], L.Settings(window=20))
    rng = np.random.default_rng(1)
    windows, labels = rng.integers(1, 255, (6, 20)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])
    loss = lambda: -np.log(net.probabilities(windows)[np.arange(6), labels]).mean()
    for weight, gradient in zip(net.weights, net.gradients(windows, labels), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept = weight[at]
        weight[at] = kept + 1e-2
        up = loss()
        weight[at] = kept - 1e-2
        down = loss()
        weight[at] = kept
        assert (up - down) / 2e-2 == pytest.approx(float(gradient[at]), rel=0.1, abs=2e-4)


def test_held_out_accuracy(labelled, small):
    net = L.learn(labelled, small)
    rows = L.predict(labelled, net, keep=True).collect()
    held = [r for r in rows if L.held_out(r["doc_id"])]
    assert len(held) > 50 and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"]: r["row"] for r in rows} == {i: f"clash{i}" for i in range(400)}


def test_held_out_rows_teach_nothing(spark, labelled, small):
    """Wrong labels on held-out rows change no weight, nor does any label or id at prediction."""
    from pyspark.sql import functions as F

    wrong = labelled.withColumn("lang", F.when(L.is_held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = L.learn(labelled, small), L.learn(wrong, small)
    assert a.languages == b.languages and all((x == y).all() for x, y in zip(a.weights, b.weights, strict=True))
    assert [L.held_out(i) for i in range(50)] == [r["h"] for r in spark.range(50).select(L.is_held_out(F.col("id")).alias("h")).collect()]


def test_whole_texts_count(labelled, small, documents):
    """A long text is judged by most of its bytes, wherever they are."""
    rng = random.Random(7)
    net = L.learn(labelled, small)
    mixed = text_in(rng, "aa", 300) + " " + text_in(rng, "bb", 900)
    assert L.predict(documents([mixed, None]), net).where("doc_id = 0").first()["lang_pred"] == "bb"


def test_odd_rows(labelled, small, documents, odd_texts):
    net = L.learn(labelled, small)
    rows = {r["doc_id"]: r for r in L.predict(documents([*odd_texts, "123 456 !?", "²³"]), net).collect()}
    n = len(odd_texts)
    assert [rows[i]["lang_pred"] for i in (0, 1, 2, 9, n, n + 1)] == ["und"] * 6
    assert rows[3]["lang_pred"] in SYLLABLES and rows[0]["score"] == 0
    assert L.predict(documents([]), net).count() == 0


def test_nothing_to_learn_from(documents):
    docs = documents(["text", None]).withColumn("lang", __import__("pyspark").sql.functions.lit(None).cast("string"))
    assert L.learn(docs) is None
    assert {r["lang_pred"] for r in L.predict(docs, None).collect()} == {"und"}
