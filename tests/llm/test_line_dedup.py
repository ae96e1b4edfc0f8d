import os
import random
import re

from tidemark.llm import line_dedup as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, least=0.8):
    """Kept text by doc: a line with words goes if an earlier line's word set is as similar as ``least``."""
    seen, out = [], {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n") if text is not None else []:
            found = frozenset(WORD.findall(line))
            similar = found and any(len(found & s) >= least * len(found | s) - 1e-9 for s in seen)
            if found:
                seen.append(found)
            if not similar:
                kept.append(line)
        out[doc] = "\n".join(kept) if text is not None else None
    return out


def near_lines(rng):
    base = [[f"w{rng.randint(0, 60)}" for _ in range(rng.randint(1, 14))] for _ in range(12)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base)) if rng.random() < 0.7 else [f"v{rng.randint(0, 400)}" for _ in range(rng.randint(1, 70))]
            for _ in range(rng.randint(0, 2)):
                line[rng.randrange(len(line))] = f"e{rng.randint(0, 30)}"
            lines.append(" ".join(line) + rng.choice(["", " ", "\r"]))
        texts.append("\n".join(lines))
    return texts


def test_equals_brute_force(documents):
    for seed in (1, 2):
        texts = near_lines(random.Random(seed))
        found = {r["doc_id"]: r["text"] for r in L.remove_repeated_lines(documents(texts)).collect()}
        assert found == brute(list(enumerate(texts)))


def test_large_groups_of_near_lines(documents):
    """Variants of one long line about each other: both bitmap widths, and pairs between them."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(50)]
    texts = []
    for _ in range(120):
        line = list(base[: rng.choice([46, 47, 48, 49, 50])])
        for _ in range(rng.randint(0, 6)):
            line[rng.randrange(len(line))] = f"x{rng.randint(0, 1000)}"
        texts.append(" ".join(line))
    found = {r["doc_id"]: r["text"] for r in L.remove_repeated_lines(documents(texts)).collect()}
    assert found == brute(list(enumerate(texts)))


def test_without_broadcasts(documents, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_IDS", -1)
    texts = near_lines(random.Random(3))
    found = {r["doc_id"]: r["text"] for r in L.remove_repeated_lines(documents(texts)).collect()}
    assert found == brute(list(enumerate(texts)))


def test_odd_rows(spark, documents, odd_texts):
    docs = documents(odd_texts)
    result = L.remove_repeated_lines(docs)
    assert result.columns == [*docs.columns, "n_lines", "removed"]
    found = {r["doc_id"]: r for r in result.collect()}
    assert {i: r["text"] for i, r in found.items()} == brute(list(enumerate(odd_texts)))
    assert found[0]["n_lines"] == 0 and found[0]["removed"] == []
    assert found[6]["removed"] == [1, 2] and found[7]["removed"] == [0, 1, 2]
    assert all(r["key"] == f"key{i}" for i, r in found.items())
    assert L.remove_repeated_lines(docs.limit(0)).count() == 0


def test_null_keys_and_repeated_rows(documents):
    docs = documents(["a b\na b", "a b", "c"], ids=[None, 1, 1])
    rows = L.remove_repeated_lines(docs.unionAll(docs.where("text = 'a b'"))).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in rows) == [(-1, "a b\na b"), (1, "a b"), (1, "a b"), (1, "c")]


def test_few_pairs_of_a_group_are_verified(documents, monkeypatch):
    """Near lines whose earliest one is like few of them: a line is done once it is like one, and met by no pair after."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for _ in range(150):
        line = list(base)
        for i in rng.sample(range(60), rng.randint(2, 6)):
            line[i] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(line))
    verified, verify = [], L.later_of
    monkeypatch.setattr(L, "later_of", lambda pairs, *rest: verified.append(pairs.count()) or verify(pairs, *rest))
    found = {r["doc_id"]: r["text"] for r in L.remove_repeated_lines(documents(texts)).collect()}
    assert found == brute(list(enumerate(texts)))
    assert sum(verified) < 150 * 12


def test_near_lines_meet_once_and_leave_no_tables(spark, documents, monkeypatch):
    """Lines with many front words in common make about one row each pair, and only the kept lines stay written."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for _ in range(80):
        line = list(base)
        for i in rng.sample(range(60), 4):
            line[i] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(line))
    joined = []
    candidates = L.candidates
    monkeypatch.setattr(L, "candidates", lambda front, least: joined.append(met(front)) or candidates(front, least))

    def met(front):
        with monkeypatch.context() as m:
            m.setattr(type(front), "distinct", lambda self: self)
            rows = candidates(front, 0.8)
        return rows.count(), rows.dropDuplicates(["a", "b"]).count()

    written = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    found = {r["doc_id"]: r["text"] for r in L.remove_repeated_lines(documents(texts)).collect()}
    left = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - written
    assert found == brute(list(enumerate(texts)))
    ((rows, pairs),) = joined
    assert pairs > 20 and rows < 3 * pairs
    assert {name.rsplit("-", 1)[0] for name in left} <= {"kept-lines", "line-heads"}
