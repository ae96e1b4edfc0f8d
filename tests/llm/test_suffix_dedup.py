import os
import random
import re

from tidemark.llm import suffix_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, least):
    """Word places of each text that lie in a stretch of ``least`` words with an equal one earlier."""
    seen, out = set(), []
    for text in texts:
        found, covered = WORD.findall(text or ""), set()
        for i in range(len(found) - least + 1):
            part = tuple(found[i : i + least])
            if part in seen:
                covered |= set(range(i, i + least))
            seen.add(part)
        out.append(covered)
    return out


def sharing(rng, n=50):
    passages = [[f"p{rng.randint(0, 9)}" for _ in range(rng.randint(4, 40))] for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            parts += p[a:b] if rng.random() < 0.6 else p
            parts += [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 5))]
        texts.append("  ".join(parts) + rng.choice(["", " \n"]))
    return texts


def places(row):
    return {i for s in row["spans"] for i in range(s["start"], s["end"])}


def test_equals_brute_force(documents):
    for seed, least, anchor in ((1, 10, 5), (2, 8, 8), (3, 12, 3)):
        texts = sharing(random.Random(seed))
        expected = brute(texts, least)
        for r in S.remove_repeated_passages(documents(texts), least, anchor).collect():
            i = r["doc_id"]
            found = WORD.findall(texts[i])
            assert places(r) == expected[i]
            assert WORD.findall(r["text"]) == [w for k, w in enumerate(found) if k not in expected[i]]
            assert r["n_words"] == len(found) and r["removed_words"] == len(expected[i])


def test_large_runs_go_by_passages(documents, monkeypatch):
    monkeypatch.setattr(S, "RUN", 3)
    texts = sharing(random.Random(12))
    expected = brute(texts, 10)
    assert all(places(r) == expected[r["doc_id"]] for r in S.remove_repeated_passages(documents(texts), 10, 5).collect())


def test_regular_words_are_told_apart(documents):
    """Words that a polynomial hash modulo 2**64 can't tell apart, in passages that are equal but for them."""
    one, two = "a", "b"
    while len(one) < 2048:
        one, two = one + two, two + one
    same = [f"w{i}" for i in range(60)]
    texts = [" ".join([*same[:30], x, *same[30:]]) for x in (one, two, one)]
    assert [sorted(places(r)) for r in sorted(S.remove_repeated_passages(documents(texts)).collect(), key=lambda r: r["doc_id"])] == [[], [], list(range(61))]


def test_without_broadcasts(documents, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_SUFFIXES", -1)
    texts = sharing(random.Random(8))
    expected = brute(texts, 10)
    assert all(places(r) == expected[r["doc_id"]] for r in S.remove_repeated_passages(documents(texts), 10, 4).collect())


def test_planted_passage_of_fifty_words_goes_but_for_the_first(documents):
    passage = " ".join(f"q{i}" for i in range(50))
    texts = [f"start{i} {passage} end{i}" for i in range(5)] + [" ".join(passage.split()[:49]) + " other"]
    rows = {r["doc_id"]: r["text"] for r in S.remove_repeated_passages(documents(texts)).collect()}
    assert rows[0] == texts[0] and rows[5] == texts[5]
    assert [rows[i] for i in range(1, 5)] == [f"start{i} end{i}" for i in range(1, 5)]


def test_odd_rows(documents, odd_texts):
    texts = [*odd_texts, odd_texts[5]]
    docs = documents(texts)
    result = S.remove_repeated_passages(docs)
    assert result.columns == [*docs.columns, "n_words", "removed_words", "spans"]
    rows = {r["doc_id"]: r for r in result.collect()}
    assert {i: r["text"] for i, r in rows.items() if i < len(odd_texts) and i != 8} == {i: t for i, t in enumerate(odd_texts) if i != 8}
    assert rows[len(odd_texts)]["text"] == "" and rows[0]["text"] is None
    assert places(rows[8]) == brute([texts[8]], 50)[0]
    assert S.remove_repeated_passages(docs.limit(0)).count() == 0


def test_null_keys_and_repeated_rows(documents):
    passage = " ".join(f"q{i}" for i in range(60))
    docs = documents([passage, passage, passage], ids=[None, 1, 1])
    assert all(r["text"] == passage for r in S.remove_repeated_passages(docs).collect())


def test_only_spans_stay_written(spark, documents):
    """Tables on the way are deleted before the texts are joined to what is found."""
    written = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    texts = sharing(random.Random(5))
    rows = S.remove_repeated_passages(documents(texts), 10, 5)
    left = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - written
    assert {name.rsplit("-", 1)[0] for name in left} == {"whole-blocks", "sorted-repeats", "later-passages"}
    assert [places(r) for r in rows.orderBy("doc_id").collect()] == brute(texts, 10)
