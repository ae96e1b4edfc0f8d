import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import CLASHING
from tidemark.llm import conversations as C
from tidemark.llm import queries

SPACE = " \t\n\x0b\x0c\r"
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [] if kind == 0 else [row, row] if kind == 3 else [row]
    return out


def summary(rows):
    """All of one conversation, by a forward programme that carries the edits and the result of every state as they are."""
    digest = lambda r: hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
    numbers = [r[1] for r in rows if r[1] is not None]
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]

    def better(states, state, found):
        if state not in states or found[:2] < states[state][:2]:
            states[state] = found

    def inserted(states):
        for _ in range(3):
            for state, (cost, audit, turns) in list(states.items()):
                role = FOLLOWS[state]
                better(states, role, (cost + 2, audit + "I", (*turns, (NAMES[role], ""))))
        return states

    states = inserted({"": (0, "", ())})
    for (_, _, role, text), initial, fault in zip(rows, initials, faults, strict=True):
        following = {}
        for state, (cost, audit, turns) in states.items():
            better(following, state, (cost + 3, audit + "D", turns))
            if fault not in ("blank", "duplicate"):
                cost += fault == "truncated"
                wanted = FOLLOWS[state]
                better(following, wanted, (cost + 2, audit + "R", (*turns, (NAMES[wanted], text))))
                if initial == wanted or (initial == "s" and state == ""):
                    better(following, initial, (cost, audit + "K", (*turns, (role, text))))
        states = inserted(following)
    cost, audit, turns = min(states[s] for s in ("", "a") if s in states)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in turns))
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
    )


def brute(rows):
    found = defaultdict(list)
    for row in rows:
        found[row[0]]
    for row in damaged(rows):
        found[row[0]].append(row)
    return {conv: summary(turns) for conv, turns in found.items()}


def bits(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        fault = C.BLANK if not bare else C.DUPLICATE if (role, text) in seen else 0 if bare[-1] in ".!?" else C.TRUNCATED
        seen.add((role, text))
        out.append({"s": C.SYSTEM, "u": C.USER, "a": C.ASSISTANT}.get(role[:1], C.OTHER) + fault)
    return np.array(out, np.int8)


def random_turns(rng, n):
    return [(1, t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), rng.choice(["a.", "b!", "c", " ", f"x{t}.", f"y{t}"])) for t in range(n)]


@pytest.mark.parametrize("window", [1 << 18, 4])
def test_edits_equal_the_forward_programme(monkeypatch, window):
    monkeypatch.setattr(C, "WINDOW", window)
    rng = random.Random(5)
    some = [random_turns(rng, rng.choice([1, 2, 3, 4, 5, 7, 9, 20])) for _ in range(800)]
    for rows, (cost, letters) in zip(some, C.cheapest_edits([bits(r) for r in some]), strict=True):
        expected = summary([(1, i, r[2], r[3]) for i, r in enumerate(rows)])
        repaired = "\n".join(f"{r}:{t}" for r, t, _ in C.applied(letters, iter([(r[2], r[3]) for r in rows])))
        assert (cost, letters.decode(), hashlib.sha256(repaired.encode()).hexdigest()) == expected[5:]


def test_long_conversation_is_traced_by_windows(monkeypatch):
    monkeypatch.setattr(C, "WINDOW", 1000)
    rows = random_turns(random.Random(2), 9_000)
    monkeypatch.setattr(C, "CELLS", 1)
    cost, letters = C.cheapest_edits([bits(rows)])[0]
    monkeypatch.setattr(C, "WINDOW", 1 << 18)
    assert C.cheapest_edits([bits(rows)])[0] == (cost, letters)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r[1:]) for r in queries.op11_conversation_repair(spark, folder).collect()}
    assert found == brute(rows)


def test_odd_rows(spark, tmp_path, odd_texts):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, ""]), rng.choice(odd_texts)) for c in (None, 1, 2, -3) for t in (None, None, 0, 0, 5, 9)]
    rows += [(7, 3, "user", "same.")] * 5 + [(8, 1, None, None)]
    rows += [(9, t, "user", f"{t} " * 20_000 + ".") for t in range(40)]
    extra = [c for c in CLASHING if c not in ("n", "text2")]
    table = spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in extra))
    table.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r[0]: tuple(r[1:]) for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert found == brute(rows)


def test_repaired_turns_are_those_of_the_hash(spark):
    rows = [(c, t, r, x) for c in range(30) for _, t, r, x in random_turns(random.Random(c), 6)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    turns = defaultdict(list)
    for r in sorted(map(tuple, C.repaired_turns(table).collect())):
        turns[r[0]].append(f"{r[2]}:{r[3]}")
    hashed = {r["conv_id"]: r["repaired_sha256"] for r in C.repair(table).collect()}
    assert hashed == {c: hashlib.sha256("\n".join(turns[c]).encode()).hexdigest() for c in range(30)}


def test_empty_table(spark):
    nothing = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair(nothing).collect() == [] and C.repaired_turns(nothing).collect() == []
