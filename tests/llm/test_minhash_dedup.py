import random
from collections import Counter
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import minhash_dedup as M
from tidemark.llm import textgrams


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance_equals_the_full_table():
    rng = random.Random(3)
    for _ in range(3000):
        a = [rng.randint(0, rng.choice([1, 3, 20])) for _ in range(rng.randint(0, 14))]
        b = [x if rng.random() < 0.8 else rng.randint(0, 3) for x in a if rng.random() < 0.9] + [1] * rng.randint(0, 3)
        most = rng.randint(0, 12)
        assert M.band_distance(a, b, most) == min(edit_distance(a, b), most + 1)
        longer = max(len(a), len(b))
        true = 1 - edit_distance(a, b) / longer if longer else 1.0
        found = M.similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.8)
        assert found == pytest.approx(true if true >= 0.8 - 1e-9 else 0)


@pytest.mark.parametrize("kept", [4, 1 << 16])
def test_banded_distance_of_frequent_words(monkeypatch, kept):
    """Words with many places, whose bits are kept or made anew."""
    monkeypatch.setattr(M, "KEPT", kept)
    rng = random.Random(8)
    for _ in range(150):
        a = [rng.randint(0, 2) for _ in range(rng.randint(20, 70))]
        b = [x if rng.random() < 0.9 else rng.randint(0, 3) for x in a if rng.random() < 0.95]
        most = rng.randint(0, 20)
        assert M.band_distance(a, b, most) == min(edit_distance(a, b), most + 1)


def test_long_texts_that_differ_at_both_ends_take_linear_memory():
    rng = random.Random(5)
    a = np.array([int(rng.paretovariate(0.6)) % 50_000 for _ in range(120_000)], np.uint64)
    b = a.copy()
    b[0], b[-1] = 60_000, 60_001
    tracemalloc.start()
    found = M.similarity(a, b, 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == pytest.approx(1 - 2 / 120_000) and peak < 60e6


def test_sketches_follow_order_and_occurrence():
    one = M.Settings(words=1, sketches=40, taken=2)
    texts = textgrams.texts_of(pa.array(["a b c d", "d c b a", "a b c d", "a a a", "a a", "x", None]))
    s = M.sketch_values(*M._shingles(texts, 1), one)
    assert (s[0] == s[2]).all() and (s[0] != s[1]).all()  # reversed order differs in every sketch
    assert not (s[3] == s[4]).all()  # a third occurrence counts


def families(rng, count, size, length=120):
    texts, family = [], []
    for f in range(count):
        base = [f"f{f}w{rng.randint(0, 10**6)}" for _ in range(length)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(length)] = f"e{rng.randint(0, 10**6)}"
            texts.append(" ".join(text))
            family.append(f)
    return texts, family


def test_families_and_only_they(documents):
    rng = random.Random(1)
    texts, family = families(rng, 12, 9)
    shared = " ".join(f"s{i}" for i in range(40))  # a passage that unlike texts share
    texts += [shared + " " + " ".join(f"o{k}x{i}" for i in range(80)) for k in range(30)]
    family += [100 + k for k in range(30)]
    order = rng.sample(range(len(texts)), len(texts))
    docs = documents([texts[i] for i in order])
    least: dict = {}
    for place, i in enumerate(order):
        least.setdefault(family[i], place)
    rows = M.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == {place: least[family[i]] for place, i in enumerate(order)}
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in rows)


def test_members_apart_from_the_least_still_meet(documents):
    """Texts that share all their sketches' k-mers with an unlike least member are found in the second round."""
    same = " ".join(f"s{i}" for i in range(60))
    texts = [same + " " + " ".join(f"a{i}" for i in range(60))] + [same + " " + " ".join(f"b{i}" for i in range(60)) + f" tail{k}" for k in range(6)]
    assert [r["class_id"] for r in sorted(M.near_duplicates(documents(texts)).collect(), key=lambda r: r["doc_id"])] == [0, 1, 1, 1, 1, 1, 1]


def test_pairs_below_many_unlike_members_meet(documents):
    """Boilerplate fills all sketches; each later pair is like nothing before it, in buckets that are small and large."""
    same = " ".join(f"s{i}" for i in range(300))
    for kinds in (9, 40):
        texts = [same + " " + " ".join(f"k{k}x{i}" for i in range(110)) + f" tail{c}" for k in range(kinds) for c in range(2)]
        rows = M.near_duplicates(documents(texts), M.Settings(sketches=4)).collect()
        assert {r["doc_id"]: r["class_id"] for r in rows} == {i: i - i % 2 for i in range(2 * kinds)}


def test_links_beside_the_least_of_a_large_bucket_are_found(documents):
    """Of each pair one text is like the least member and the other is not; all similar texts of one bucket are one class."""
    base = [f"s{i}" for i in range(200)]
    texts = [" ".join(base)]
    for k in range(20):
        own = [f"k{k}x{i}" for i in range(60)]
        texts += [" ".join(base + own[:45]), " ".join(base + own)]  # 200 of 245 and of 260 words are the least one's
    texts += [" ".join(base + [f"far{k}x{i}" for i in range(200)]) for k in range(20)]
    some = M.Settings(sketches=2)
    sketches = M.sketch_values(*M._shingles(textgrams.texts_of(pa.array(texts)), some.words), some)
    least = list(range(len(texts)))
    links = [(i, j) for i, j in all_links(texts) if (sketches[i] == sketches[j]).any()]
    for i, j in links * 4:
        least[i] = least[j] = min(least[i], least[j])
    assert max((sketches[:, j] == sketches[0, j]).sum() for j in range(2)) > some.block
    rows = M.near_duplicates(documents(texts), some).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == dict(enumerate(least))


def test_unlike_pairs_of_words_rule_out_an_alignment(monkeypatch):
    """The same words in another order, where the table of the alignment is not needed."""
    monkeypatch.setattr(M, "band_distance", lambda *_: pytest.fail("aligned"))
    a = np.arange(2000, dtype=np.uint64)
    assert M.similarity(a, np.random.default_rng(1).permutation(a), 0.8) == 0


def all_links(texts):
    """Pairs of unequal texts with an edit similarity of 0.8 or more, all compared with all."""
    words = [textgrams.texts_of(pa.array([t])).word_hashes for t in texts]
    order = sorted((i for i in range(len(texts)) if len(words[i])), key=lambda i: len(words[i]))
    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            if len(words[i]) < 0.8 * len(words[j]) - 1e-9:
                break
            if texts[i] != texts[j] and M.similarity(words[i], words[j], 0.8):
                yield i, j


def test_recall_against_all_pairs_of_a_table(spark):
    """Every link of the small table; a link counts as found if its ends are in one class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = docs.where("text IS NOT NULL").collect()
    classes = {r["doc_id"]: r["class_id"] for r in M.near_duplicates(docs).collect()}
    links = [(rows[i]["doc_id"], rows[j]["doc_id"]) for i, j in all_links([r["text"] for r in rows])]
    assert len(links) > 20
    assert sum(classes[a] == classes[b] for a, b in links) >= 0.95 * len(links)
    least = {d: d for d in classes}  # and no class joins what links, or equal texts, don't
    equal: dict = {}
    for r in rows:
        equal.setdefault(r["text"], r["doc_id"])
    for a, b in [*links, *((r["doc_id"], equal[r["text"]]) for r in rows)] * 6:
        least[a] = least[b] = min(least[a], least[b])
    assert all(least[d] <= c and least[d] == least[c] for d, c in classes.items())


@pytest.mark.parametrize("edited", [0.1, 0.16])
def test_recall_of_edited_copies_that_share_a_passage(documents, edited):
    """Copies with words replaced here and there, half of each text a passage that all texts have."""
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(100)]
    texts = []
    for f in range(60):
        own = [f"f{f}w{i}" for i in range(100)]
        for _ in range(2):
            texts.append(" ".join(w if rng.random() > edited / 2 else f"e{rng.random()}" for w in shared + own))
    classes = {r["doc_id"]: r["class_id"] for r in M.near_duplicates(documents(texts)).collect()}
    links = list(all_links(texts))
    assert len(links) > 40 and sum(classes[a] == classes[b] for a, b in links) >= 0.9 * len(links)


def test_long_unlike_texts_need_no_alignment():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 40, (2, 400_000)).astype(np.uint64)
    assert M.similarity(a, b, 0.8) == 0
    assert M._shared_words(np.array([1, 1, 2, 3], np.uint64), np.array([1, 2, 2, 1, 1], np.uint64)) == 3


def test_odd_rows(documents, odd_texts):
    docs = documents([*odd_texts, None, odd_texts[5] + " more"])
    rows = {r["doc_id"]: r["class_id"] for r in M.near_duplicates(docs).collect()}
    n = len(odd_texts)
    assert rows[0] == 0 and rows[n] == n  # nulls are equal to nothing
    assert rows[6] == rows[7] == 6 and rows[n + 1] == 5
    assert {i: c for i, c in rows.items() if i not in (7, n + 1)} == {i: i for i in rows if i not in (7, n + 1)}
    assert M.near_duplicates(docs.limit(0)).count() == 0


def test_null_keys_and_repeated_rows(documents):
    rows = M.near_duplicates(documents(["x y z", "x y z", "x y z"], ids=[None, 4, 4])).collect()
    assert sorted((r["doc_id"] or -1, r["class_id"] or -1, r["kept"]) for r in rows) == [(-1, -1, True), (4, 4, True), (4, 4, True)]


def test_bitmaps_differ_in_no_more_bits_than_texts_in_words():
    rng = np.random.default_rng(3)
    number = np.array([0, 1, 7, 16, 17, 300, 1000])
    words = rng.integers(0, 400, number.sum()).astype(np.int64)
    bitmaps = M._parities(words, number).to_pylist()
    parts = [Counter(p.tolist()) for p in np.split(words, np.cumsum(number)[:-1])]
    for x, one in zip(bitmaps, parts):
        for y, two in zip(bitmaps, parts):
            assert M._differing(x, y) <= ((one - two) + (two - one)).total()
    far = [M._parities(rng.integers(0, 1 << 32, 1000), np.array([1000])).to_pylist()[0] for _ in range(2)]
    assert M._differing(*far) > 800  # unlike texts are told, long ones too


def test_pairs_of_large_buckets_meet_once_and_bring_no_words(documents, monkeypatch):
    """Texts about a common middle, most of them too far from each other: few rows a pair, and only near ones are aligned."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(300)]
    texts = [" ".join(w if rng.random() > 0.16 else f"e{rng.randint(0, 200)}" for w in base) for _ in range(60)]
    some = M.Settings(sketches=200, taken=1, block=4)
    met, rare_pairs, rare_words = [], M._rare_pairs, M._rare_words

    def counted(*given):
        with monkeypatch.context() as m:
            m.setattr(M, "_rare_words", lambda *x: rare_words(*x).withColumn("before", F.col("id").cast("int")))
            every = rare_pairs(*given).count()
        met.append((rare_pairs(*given).count(), every, rare_pairs(*given).distinct().count()))
        return rare_pairs(*given)

    monkeypatch.setattr(M, "_rare_pairs", counted)
    given, aligned = [], M.align
    monkeypatch.setattr(M, "align", lambda pairs, *rest: given.append(pairs.count()) or aligned(pairs, *rest))
    rows = M.near_duplicates(documents(texts), some).collect()
    ((found, every, pairs),) = met
    assert pairs > 300 and found < 0.8 * every and given[1] < 0.9 * pairs
    words = [textgrams.texts_of(pa.array([t])).word_hashes for t in texts]
    least = list(range(len(texts)))
    for i, j in list(all_links(texts)) * 4:
        least[i] = least[j] = min(least[i], least[j])
    assert {r["doc_id"]: r["class_id"] for r in rows} == dict(enumerate(least))


def test_words_rare_in_one_component_alone_make_no_rows(spark):
    """Large components of their own words: only what two of them share, and each other pair's words, can join texts."""
    sets = [(i, i // 50, [1000 * (i // 50) + j for j in range(40)]) for i in range(200)]
    sets += [(200, 200, [*range(39), 9001]), (201, 201, [7001, 7002]), (202, 202, [7001, 7002])]
    table = spark.createDataFrame(sets, "id long, component long, words array<int>")
    rows = [tuple(r)[:4] for r in M._rare_words(table, 0.8).collect()]
    of = {i: c for i, c, _ in sets}
    parts: dict = {}
    for word, _, i, component in rows:
        assert of[i] == component
        parts.setdefault(word, set()).add(component)
    assert len(rows) < 1000 and parts[7001] == {201, 202}  # 1,800 rows are those of repeated words
    assert all(len(x) > 1 for x in parts.values())
    assert {tuple(sorted(r)) for r in M._rare_pairs(table, 0.8).distinct().collect()} == {(i, 200) for i in range(50)} | {(201, 202)}
