import random
import re
from collections import Counter

import pyarrow as pa

from tidemark.llm import repetition as R
from tidemark.llm import textgrams

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least):
    """Counts by comparing every suffix with every other."""
    w = WORD.findall(text or "")
    n = len(w)
    longest = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and w[i + k] == w[j + k]:
                k += 1
            longest[i] = max(longest[i], k)
    covered = {p for i in range(n) if longest[i] >= least for p in range(i, i + longest[i])}
    windows = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    repeated = {p for i in range(n - 2) if windows[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return [n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeated), len(covered), max([x for x in longest if x >= least], default=0)]


def random_texts(rng, count):
    out = []
    for _ in range(count):
        vocabulary = ["a", "b", "cc", "é", "x\n", "y\n\n", "<z>", "\r\n", "\x0b"][: rng.randint(1, 9)]
        out.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 70))))
    return out


def test_measures_equal_brute_force():
    texts = [None, "", " \n ", "a", "a a a a a a a a a", "é# é| x\né# é| x", *random_texts(random.Random(1), 80)]
    found = R.measure(textgrams.texts_of(pa.array(texts)), R.Limits(repeat_words=4))
    for i, t in enumerate(texts):
        assert [int(found[c][i]) for c in R.COUNTS] == brute(t, 4), t


def unlike_pair(length, one="a", two="b"):
    """Two strings with equal values of any polynomial with an odd base modulo 2**64, if they are long enough."""
    x, y = one, two
    while len(x) < length:
        x, y = x + y, y + x
    return x, y


def test_equal_lines_and_words_are_told_by_their_text_and_not_by_a_hash():
    x, y = unlike_pair(2048)
    found = R.measure(textgrams.texts_of(pa.array([f"{x}\n{y}", f"{x} {y}\n{y} {x}\n{x} {y}", f"{x}\n\n{x}"])), R.Limits())
    assert found["n_dup_lines"].tolist() == [0, 1, 1]
    texts = textgrams.texts_of(pa.array([f"{x} {y}"]))
    assert len(set(texts.word_hashes.tolist())) == 2 and len(set(texts.vocabulary[0].tolist())) == 2


def test_verdicts(documents, odd_texts):
    prose = " ".join(f"p{i}" for i in range(100))
    repeat = " ".join(f"r{i}" for i in range(24))
    half = f"{repeat} {' '.join(f'h{i}' for i in range(52))} {repeat}"
    texts = [prose, half, repeat + " " + repeat + " " + prose, " ".join(["w"] * 80), *odd_texts]
    rows = {r["doc_id"]: r for r in R.judge(documents(texts), with_spans=True).collect()}
    assert rows[0]["kept"] and rows[0]["spans"] == []
    # 48 of 100 words are covered: under the base rule, over the limit of repetition
    assert not rows[1]["base_failed"] and not rows[1]["kept"] and rows[1]["spans"] == [[0, 24], [76, 100]]
    assert rows[2]["kept"] and rows[2]["longest_repeat"] == 24
    assert rows[3]["base_failed"] and not rows[3]["kept"]
    for i, t in enumerate(odd_texts, 4):
        if len(WORD.findall(t or "")) < 1000:
            assert [rows[i][c] for c in R.COUNTS] == brute(t, R.Limits().repeat_words)
    assert R.judge(documents([])).count() == 0


def test_slices_do_not_matter(documents, monkeypatch):
    texts = random_texts(random.Random(3), 60)
    whole = sorted(map(tuple, R.judge(documents(texts)).collect()))
    cut = R.measure(textgrams.texts_of(pa.array(texts)), R.Limits())
    assert [r[1] for r in whole] == cut["n_words"].tolist()
    parts = [t for _, t in textgrams.slices(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]), limit=50)]
    assert sum(len(p) for p in parts) == len(texts)
    assert [int(x) for p in parts for x in R.measure(p, R.Limits())["n_repeat_words"]] == cut["n_repeat_words"].tolist()
