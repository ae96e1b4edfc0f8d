"""Repair of conversations: the cheapest edits that make turns alternate.

A conversation should be nothing, or an optional system turn and then pairs of
user and assistant. Each turn is one byte (the initial of its role, and its
faults), so a whole conversation is a short array; a task takes many of
them, puts those of like length together, and runs the dynamic programme
over turns, for all conversations at once.

Texts are shuffled twice: once to be put in order, written as segments of
bounded size, and once to meet the edits of their conversation. A task streams
the segments of a conversation; it never holds more of one than a segment,
its bytes and its edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import bound_batches, cut

SPACE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = (".", "!", "?")

#: Bits of a turn: the initial of its role in the lowest two (other, s, u, a), then its faults and what is counted.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
BLANK, DUPLICATE, TRUNCATED, ILLEGAL, FRESH = 4, 8, 16, 32, 64

#: What came last: nothing, a system turn, a user, an assistant. The next turn must be a user's, or after one, an assistant's.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = np.array([AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER])
WANTED = ("user", "user", "assistant", "user")
INSERT, REROLE, DELETE, LEFT_TRUNCATED = 2, 2, 3, 1
NEVER = 1 << 28

#: Turns of a window whose costs are held at once, and cells (turns times conversations) of a tensor.
WINDOW, CELLS = 1 << 18, 1 << 20


def _with_inserts(cost: np.ndarray) -> np.ndarray:
    """Least costs from each state if turns may be inserted first (conversations x states)."""
    for _ in range(3):  # at most three in a row help
        cost = np.minimum(cost, INSERT + cost[:, NEXT])
    return cost


def _choices(turn: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of deleting, keeping and changing one turn of each conversation, by the state before it, given the costs after it."""
    kind, burden = turn & 3, np.where(turn & TRUNCATED, LEFT_TRUNCATED, 0)
    stays = (turn & (BLANK | DUPLICATE)) == 0
    rerole = np.where(stays[:, None], REROLE + burden[:, None] + after[:, NEXT], NEVER)
    fits = kind[:, None] == np.array([USER, USER, ASSISTANT, USER])
    keep = np.where(fits & stays[:, None], burden[:, None] + after[:, NEXT], NEVER)
    opening = (kind == SYSTEM) & stays
    keep[opening, START] = burden[opening] + after[opening, AFTER_SYSTEM]
    return DELETE + after, keep, rerole


def _costs(turns: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Backward costs, turns first: [t, conversation, state] is the least cost of all from turn t on. A turn of -1 is none."""
    costs = np.empty((len(turns) + 1, *end.shape), np.int32)
    costs[-1] = end
    for t in range(len(turns) - 1, -1, -1):
        found = _with_inserts(np.minimum.reduce(_choices(turns[t], costs[t + 1])))
        costs[t] = np.where(turns[t][:, None] < 0, costs[t + 1], found)
    return costs


#: Costs behind the last turn: nothing and a finished pair are free.
END = _with_inserts(np.array([[0, NEVER, NEVER, 0]]))


def _traced(turns: np.ndarray, costs: np.ndarray, state: np.ndarray, last: bool) -> tuple[list[np.ndarray], np.ndarray]:
    """(one array of letters a step, 0 where a conversation rests; states behind) of the cheapest edits, of several the ASCII-least.

    All conversations step together, each at its own turn. D, I, K, R rank in
    this order, and no choice of cheapest edits is the beginning of another, so
    the least letter that is still cheapest is right at every step. Inserts
    before the first turn of the next window are left to it.
    """
    n, steps = len(state), []
    at, each = np.zeros(n, np.int64), np.arange(n)
    while True:
        inside = at < len(turns)
        here = np.minimum(at, len(turns) - 1)
        turn = turns[here, each] if len(turns) else np.full(n, -1)
        skipping = inside & (turn < 0)
        now, after = costs[at, each], costs[np.minimum(at + 1, len(turns)), each]
        delete, keep, rerole = (c[each, state] for c in _choices(np.maximum(turn, 0), after))
        least, following = now[each, state], now[each, NEXT[state]]
        settled = ~inside & ((state == START) | (state == AFTER_ASSISTANT) if last else True)
        live = ~settled & ~skipping
        edits = inside & live
        d = edits & (delete == least)
        i = live & ~d & (INSERT + following == least)
        k = edits & ~d & ~i & (keep == least)
        r = edits & ~d & ~i & ~k
        if not (live | skipping).any():
            return steps, state
        steps.append(np.select([d, i, k, r], [ord("D"), ord("I"), ord("K"), ord("R")], 0).astype(np.uint8))
        opening = k & (state == START) & ((turn & 3) == SYSTEM)
        state = np.where(opening, AFTER_SYSTEM, np.where(i | k | r, NEXT[state], state))
        at = at + (edits & ~i | skipping)


def cheapest_edits(conversations: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """(cost, letters of the edits) of each conversation, given as arrays of turn bytes.

    Conversations are bucketed by length (a bucket goes up to the next power of
    two) and bounded in number, so tensors stay small. Of a long one, costs are
    held for a window of turns; those at the windows' ends are kept, and a
    window's are worked out again when its edits are traced.
    """
    found: list[tuple[int, bytes]] = [(0, b"")] * len(conversations)
    buckets: dict[int, list[int]] = {}
    for c, turns in enumerate(conversations):
        buckets.setdefault(max(1, 1 << (len(turns) - 1).bit_length()) if len(turns) else 0, []).append(c)
    for longest, members in buckets.items():
        for m in range(0, len(members) if longest else 0, max(1, CELLS // longest)):
            some = members[m : m + max(1, CELLS // longest)]
            for c, cost, letters in _bucket([conversations[c] for c in some], some):
                found[c] = (cost, letters)
    return found


def _bucket(conversations: list[np.ndarray], names: list[int]) -> Iterator[tuple[int, int, bytes]]:
    longest = max(map(len, conversations))
    turns = np.full((longest, len(conversations)), -1, np.int16)
    for n, c in enumerate(conversations):
        turns[: len(c), n] = c
    starts = range(0, longest, WINDOW)
    ends = [np.repeat(END, len(conversations), axis=0)]
    for at in reversed(starts[1:]):
        ends.append(_costs(turns[at : at + WINDOW], ends[-1])[0])
    state, steps, total = np.zeros(len(conversations), np.int64), [], None
    for at, end in zip(starts, reversed(ends), strict=True):
        costs = _costs(turns[at : at + WINDOW], end)
        total = costs[0][:, START] if total is None else total
        letters, state = _traced(turns[at : at + WINDOW], costs, state, at == starts[-1])
        steps += letters
    table = np.array(steps, np.uint8).reshape(-1, len(conversations)).T
    for n, c in enumerate(names):
        row = table[n]
        yield c, int(total[n]), row[row > 0].tobytes()


def applied(letters: bytes, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(role, text, letter) of the repaired turns; deleted ones are left out."""
    state, edits = START, iter(letters)

    def inserted(letter: int) -> Iterator[tuple[str, str, str]]:
        nonlocal state
        while letter == ord("I"):
            yield WANTED[state], "", "I"
            state = int(NEXT[state])
            letter = next(edits, 0)
        return letter

    for role, text in turns:
        letter = yield from inserted(next(edits))
        if letter == ord("D"):
            continue
        opening = letter == ord("K") and state == START and role[:1] == "s"
        yield (role if letter == ord("K") else WANTED[state]), text, chr(letter)
        state = AFTER_SYSTEM if opening else int(NEXT[state])
    yield from inserted(next(edits, 0))


def is_blank(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE)) == ""


def segments(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, segment, bits, low, high, roles, texts): conversations in order, in segments of an Arrow batch at most, written.

    Turns are ordered by number, nulls first, then by a hash of role and text,
    so equal turns lie together; a number that is no whole one counts as null. Null roles and texts are one space; rows with
    a null conversation are one conversation. A hot conversation passes through
    one task, as its repaired text has one hash over all, but sorted on disk
    and a batch at a time. Other columns are left behind, whatever their names.
    """
    bound_batches(df.sparkSession)
    whole = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = df.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").try_cast("bigint").alias("turn"), whole(role).alias("role"), whole(text).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))).repartition("conv_id")
    same = Window.partitionBy("conv_id", "digest").orderBy("turn")
    order = Window.partitionBy("conv_id").orderBy("turn", "digest")
    initial = F.substring("role", 1, 1)
    rows = rows.withColumns({"again": F.row_number().over(same) > 1, "initial": initial}).select(
        "*", F.row_number().over(order).alias("place"), F.lag("initial").over(order).alias("before"), F.lag("turn").over(order).alias("earlier")
    )
    blank, ends = is_blank(F.col("text")), F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1).isin(*SENTENCE_ENDS)
    legal = F.concat("before", "initial").isin("su", "ua", "au")
    fault = F.when(blank, BLANK).when(F.col("again"), DUPLICATE).when(~ends, TRUNCATED).otherwise(0)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fresh = F.col("turn").isNotNull() & ~F.coalesce(F.col("turn") == F.col("earlier"), F.lit(False))
    bits = kind + fault + F.when((F.col("place") > 1) & ~legal, ILLEGAL).otherwise(0) + F.when(fresh, FRESH).otherwise(0)
    sorted_ = rows.select("conv_id", (F.col("place") == 1).alias("first"), "turn", bits.cast("tinyint").alias("bits"), "role", "text", "digest").sortWithinPartitions("conv_id", "turn", "digest")
    kind_of_id = rows.schema["conv_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = -1
        for batch in batches:
            if not batch.num_rows:
                continue
            first = np.asarray(batch.column("first").to_numpy(zero_copy_only=False), bool)
            starts = np.unique(np.concatenate([[0], np.flatnonzero(first)]))
            numbers = [number := 0 if first[s] else number + 1 for s in starts]
            offsets = pa.array(np.append(starts, len(first)), pa.int32())
            lists = {c: pa.ListArray.from_arrays(offsets, batch.column(c)) for c in ("bits", "role", "text")}
            low, high = _ends(batch.column("turn"), starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").take(pa.array(starts)), pa.array(numbers, pa.int64()), lists["bits"], low, high, lists["role"], lists["text"]],
                names=["conv_id", "segment", "bits", "low", "high", "roles", "texts"],
            )

    schema = f"conv_id {kind_of_id}, segment bigint, bits array<tinyint>, low bigint, high bigint, roles array<string>, texts array<string>"
    return cut(sorted_.select("conv_id", "first", "turn", "bits", "role", "text").mapInArrow(task, schema), "turns")


def _ends(turns: pa.Array, starts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Least and greatest number from each start to the next, null where there is none."""
    none = np.asarray(turns.is_null())
    found = []
    for pick, beyond in ((np.minimum, np.iinfo(np.int64).max), (np.maximum, np.iinfo(np.int64).min)):
        known = turns.fill_null(int(beyond)).to_numpy()
        found.append(pa.array(pick.reduceat(known, starts), pa.int64(), mask=np.logical_and.reduceat(none, starts)))
    return found[0], found[1]


SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def edits(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation in ``segments``."""
    each = F.array_sort(F.collect_list(F.struct("segment", "bits")))
    joined = turns.groupBy("conv_id").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.flatten(F.transform(each, lambda s: s["bits"])).alias("bits"))
    kind = turns.schema["conv_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, flat = batch.column("bits").offsets.to_numpy(), np.asarray(batch.column("bits").values, np.int8)
            each = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            counts = [[int(np.count_nonzero(bits & flag)) for bits in each] for flag in (FRESH, BLANK, DUPLICATE, TRUNCATED, ILLEGAL)]
            ends = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), counts[0], strict=True)
            gaps = [0 if low is None else min(high - low + 1 - n, (1 << 63) - 1) for low, high, n in ends]
            cost, letters = zip(*cheapest_edits(each), strict=True) if each else ((), ())
            columns = [pa.array(c, pa.int64()) for c in (gaps, *counts[1:], cost)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns, pa.array([x.decode() for x in letters], pa.string())], names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return joined.mapInArrow(task, f"conv_id {kind}, {SUMMARY}")


def _together(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's edits, then its segments in order, in one task."""
    none = lambda df, like: [F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema if f.name not in df.columns]
    head = found.select("*", F.lit(-1).cast("bigint").alias("segment"), F.lit(None).cast("array<string>").alias("roles"), F.lit(None).cast("array<string>").alias("texts"))
    body = turns.select("conv_id", "segment", "roles", "texts")
    return head.unionByName(body.select("*", *none(body, head))).repartition("conv_id").sortWithinPartitions("conv_id", "segment")


def _streamed(together: DataFrame, schema: str, make: Callable[[dict, Iterator[tuple[str, str, str]]], Iterator[tuple]]) -> DataFrame:
    """Rows that ``make`` gives for each conversation from its summary and its repaired turns, which it must consume."""
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    id_kind = together.schema["conv_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow_id = None
        waiting: list[dict] = []

        def rows() -> Iterator[dict]:
            nonlocal arrow_id
            for batch in batches:
                arrow_id = batch.schema.field("conv_id").type
                for r in range(batch.num_rows):
                    yield {c: batch.column(c)[r].as_py() for c in batch.schema.names}

        stream = rows()

        def turns() -> Iterator[tuple[str, str]]:
            for row in stream:
                if row["segment"] < 0:
                    waiting.append(row)
                    return
                yield from zip(row["roles"], row["texts"], strict=True)

        def made() -> Iterator[tuple]:
            waiting.extend(x for x in [next(stream, None)] if x)
            while waiting:
                head = waiting.pop()
                yield from make(head, applied(head["audit"].encode(), turns()))

        held: list[tuple] = []
        size = 0
        for row in made():
            held.append(row)
            size += sum(len(x) for x in row if isinstance(x, str))
            if len(held) >= 4096 or size > 1 << 22:
                yield packed(held, arrow_id)
                held, size = [], 0
        if held:
            yield packed(held, arrow_id)

    def packed(held: list[tuple], arrow_id: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], arrow_id), *(pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns[1:], schema.split(", "), strict=True))], names=["conv_id", *names])

    return together.mapInArrow(task, f"conv_id {id_kind}, {schema}")


def _hashed(head: dict, turns: Iterator[tuple[str, str, str]]) -> Iterator[tuple]:
    digest, between = hashlib.sha256(), b""
    for role, text, _ in turns:
        digest.update(between + f"{role}:{text}".encode())
        between = b"\n"
    yield (head["conv_id"], *(head[c.split()[0]] for c in SUMMARY.split(", ")), digest.hexdigest())


def _listed(head: dict, turns: Iterator[tuple[str, str, str]]) -> Iterator[tuple]:
    for place, (role, text, letter) in enumerate(turns):
        yield head["conv_id"], place, role, text, letter


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation; see ``segments``.

    Ties between cheapest edits go to the ASCII-least letters. A role is what
    its first character is (s, u or a; any other, or none, fits nowhere).
    Repeated rows are duplicates. Gaps beyond 64 bits are the greatest number
    that fits. An empty table gives no rows.
    """
    turns = segments(df, conv_id, turn, role, text)
    return _streamed(_together(turns, edits(turns)), f"{SUMMARY}, repaired_sha256 string", _hashed).withColumnRenamed("conv_id", conv_id)


def repaired_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, role, text, edit): the repaired conversations themselves; edit is K, R or I."""
    turns = segments(df, conv_id, turn, role, text)
    return _streamed(_together(turns, edits(turns)), "place bigint, role string, text string, edit string", _listed).withColumnRenamed("conv_id", conv_id)
