"""Removing lines that repeat earlier ones, by an exact set-similarity join.

A line is the set of its words. The words of a set are ordered from rare to
frequent; two sets as similar as the threshold must then share a word near the
front of both. Only those front words are joined, under filters on length,
position and a parity bitmap that lose no pair, and what is left is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textgrams
from tidemark.llm.tables import bound_batches, cut, drop

#: Counters of word frequency: words share them by hash, so the table has a fixed size. The order
#: that they give is the same for all lines, which is all that the prefix filter needs.
COUNTERS = 1 << 20
#: Counters that are summed as one row.
BLOCK = 1 << 10
#: Ids of up to this many sets under verification are sent to all executors (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 1 << 21
#: Orders of words by which a line first meets the earliest line with the same least words.
STAR_SALTS = (0x1F83D9AB, 0x5BE0CD19)
#: Sets of more words than this have bitmaps of 128 bits, others of 64.
WIDE = 48


def line_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(same, doc, line, words, size, bitmap, wide, keys): every line with a word.

    ``same`` is a hash of the line's set, words are distinct 32-bit hashes, and size is how many. The
    bitmap has the parity of the words that fall on each bit, so two bitmaps
    differ in no more bits than the sets do in words. ``wide`` is its other half
    for large sets, where 64 bits would tell nothing, and 0 for small ones.
    Each key hashes the two least words under one order; near sets share most.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                starts, _, owner = texts.lines
                line = np.searchsorted(starts, texts.starts, side="right") - 1
                hashes = texts.word_hashes
                short = (hashes >> np.uint64(32)).astype(np.int64)
                packed = (line << 32) | short
                packed.sort()
                packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])] if len(packed) else packed
                line, short = packed >> 32, packed & 0xFFFFFFFF
                begins = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
                ends = np.append(begins[1:], len(line))
                same = textgrams.set_hashes(short.astype(np.uint64) + np.uint64(0x3C6EF372FE94F82B), begins)
                which = line[begins] if len(line) else line
                number = which - np.searchsorted(owner, owner[which])
                lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(line)).astype(np.int32)), pa.array(short.astype(np.uint32).view(np.int32)))
                docs_of = part.column("doc").take(pa.array(owner[which]))
                halves = _bitmaps(short, begins, ends - begins)
                keys = np.stack([_least_two(short, begins, ends - begins, salt) for salt in STAR_SALTS], axis=1).ravel().view(np.int64)
                key_lists = pa.ListArray.from_arrays(pa.array(np.arange(len(begins) + 1, dtype=np.int32) * len(STAR_SALTS)), pa.array(keys))
                columns = [pa.array(same.view(np.int64)), docs_of, pa.array(number.astype(np.int32)), lists, pa.array((ends - begins).astype(np.int32)), *map(pa.array, halves), key_lists]
                yield pa.RecordBatch.from_arrays(columns, names=["same", "doc", "line", "words", "size", "bitmap", "wide", "keys"])

    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL")
    return rows.mapInArrow(task, f"same long, doc {rows.schema['doc'].dataType.simpleString()}, line int, words array<int>, size int, bitmap long, wide long, keys array<long>")


def _bitmaps(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spot = textgrams.mix(words.astype(np.uint64) + np.uint64(0x51ED27))
    bits = np.uint64(1) << (spot & np.uint64(63))
    other = ((spot & np.uint64(64)) != 0) & np.repeat(sizes > WIDE, sizes)
    return tuple(np.bitwise_xor.reduceat(np.where(x, bits, np.uint64(0)), begins).view(np.int64) for x in (~other, other))


def _least_two(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray, salt: int) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    order = textgrams.mix(words.astype(np.uint64) + np.uint64(salt))
    first = np.minimum.reduceat(order, begins)
    rest = np.where(order == np.repeat(first, sizes), np.uint64((1 << 64) - 1), order)  # a set of one word has no second
    return textgrams.mix(first * np.uint64(31) + np.minimum.reduceat(rest, begins) + np.uint64(salt))


def counter(words: np.ndarray) -> np.ndarray:
    return textgrams.mix(words.view(np.uint32).astype(np.uint64)).astype(np.int64) & (COUNTERS - 1)


def word_counts(sets: DataFrame) -> np.ndarray:
    """How many sets have a word of each counter: summed in the tasks, then block by block, over all sets."""

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            total += np.bincount(counter(batch.column("words").flatten().to_numpy()), minlength=COUNTERS)
        yield _blocks({i: x for i, x in enumerate(total.reshape(-1, BLOCK)) if x.any()})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("n").to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(raw, np.int64)
        yield _blocks(sums)

    kind = "block int, n binary"
    counts = np.zeros((COUNTERS // BLOCK, BLOCK), np.int64)
    for row in sets.select("words").mapInArrow(partly, kind).repartition("block").mapInArrow(summed, kind).toArrow().to_pylist():
        counts[row["block"]] = np.frombuffer(row["n"], np.int64)
    return counts.ravel()


def _blocks(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "n"])


def prefix_length(size: np.ndarray, least: float) -> np.ndarray:
    """Front words of a set: a similar set has one of them among its own."""
    return size - np.ceil(least * size - 1e-9).astype(np.int64) + 1


def prefixes(sets: DataFrame, counts: np.ndarray, least: float) -> DataFrame:
    """(word, before, doc, line, bitmap, wide, shape) for the front words of every set, rare words first.

    A word whose counter is 1 is in one set alone and can't be shared. ``shape``
    packs the set's size, the word's place in it, and whether the set is done,
    as these rows are many. Words of one counter keep the order of their values,
    which is the same in all sets. ``before`` is the word next before in the
    set's order, or the word itself if it is the first.
    """
    rank = np.empty(COUNTERS, np.int32)
    rank[np.argsort(counts, kind="stable")] = np.arange(COUNTERS, dtype=np.int32)
    shared = sets.sparkSession.sparkContext.broadcast((rank, counts > 1))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, repeated = shared.value
        for batch in batches:
            lists = batch.column("words")
            words = lists.flatten().to_numpy()
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            spot = counter(words)
            order = _in_order(owner * COUNTERS + rank[spot])
            place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            front = np.flatnonzero(place < prefix_length(sizes, least)[owner])
            front = front[repeated[spot[order[front]]]]
            of = owner[front]
            given = [batch.column(c).take(pa.array(of)) for c in ("doc", "line", "bitmap", "wide")]
            shape = sizes[of] << 32 | place[front] << 1 | batch.column("done").to_numpy(zero_copy_only=False)[of]
            pair = [pa.array(words[order[at]]) for at in (front, front - (place[front] > 0))]
            yield pa.RecordBatch.from_arrays([*pair, *given, pa.array(shape)], names=["word", "before", "doc", "line", "bitmap", "wide", "shape"])

    kind = sets.schema["doc"].dataType.simpleString()
    return sets.select("doc", "line", "words", "bitmap", "wide", "done").mapInArrow(task, f"word int, before int, doc {kind}, line int, bitmap long, wide long, shape long")


def _in_order(keys: np.ndarray) -> np.ndarray:
    """Places of the keys from least to greatest; equal keys stay in their order."""
    bits = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(keys, kind="stable")
    packed = keys << bits | np.arange(len(keys))
    packed.sort()
    return packed & ((1 << bits) - 1)


def _may_be_near(x: str, y: str, size_x: Column, size_y: Column, least: float) -> tuple[Column, Column, Column]:
    """Whether sizes and bitmaps allow two sets to be similar, the words that they must share, and how many they differ in at least."""
    overlap = F.ceil(F.lit(least / (1 + least)) * (size_x + size_y) - 1e-9)
    narrow, wide = (F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")) for c in ("bitmap", "wide"))
    # a word's place among 128 bits and among 64 differ in the half alone, so a large set's halves fold to a small one's
    mixed = (size_x > WIDE) != (size_y > WIDE)
    differing = F.when(mixed, F.bit_count(narrow.bitwiseXOR(wide))).otherwise(F.bit_count(narrow) + F.bit_count(wide))
    near_size = F.least(size_x, size_y) >= F.lit(least) * F.greatest(size_x, size_y) - 1e-9
    return near_size & (differing <= size_x + size_y - 2 * overlap), overlap, differing


def candidates(front: DataFrame, least: float) -> DataFrame:
    """(a, b, apart): pairs of sets that pass all filters, once each, the earlier as a; none whose later set is settled already.

    ``apart`` is the least share of words that the two differ in, so pairs of few are the likely ones. Two sets that
    have the same word before the one that joins them meet there, so sets with many front words in common make few rows.
    """
    one, two = front.alias("x"), front.alias("y")
    size = {s: F.shiftright(f"{s}.shape", 32) for s in "xy"}
    place = {s: F.shiftright(f"{s}.shape", 1).bitwiseAND(F.lit((1 << 31) - 1)) for s in "xy"}
    may, overlap, differing = _may_be_near("x", "y", size["x"], size["y"], least)
    fits = (
        (F.col("x.word") == F.col("y.word"))
        & ((F.col("x.doc") < F.col("y.doc")) | ((F.col("x.doc") == F.col("y.doc")) & (F.col("x.line") < F.col("y.line"))))
        # the later one is open; told with the other's bits, as a condition on one side would be pushed below the shuffle that both share
        & (F.col("y.shape").bitwiseAND(F.col("x.shape").bitwiseOR(F.lit(1))).bitwiseAND(F.lit(1)) == 0)
        # the front words that this pair of sizes must share one of
        & (place["x"] <= size["x"] - overlap)
        & (place["y"] <= size["y"] - overlap)
        & may
        & (F.least(size["x"] - place["x"], size["y"] - place["y"]) + F.least(place["x"], place["y"]) >= overlap)
        & ((F.col("x.before") != F.col("y.before")) | (place["x"] == 0))
    )
    apart = (differing / (size["x"] + size["y"])).cast("float")
    return one.join(two, fits).select(F.struct("x.doc", "x.line").alias("a"), F.struct("y.doc", "y.line").alias("b"), apart.alias("apart")).distinct()


def star_candidates(sets: DataFrame, least: float) -> DataFrame:
    """(a, b): the earliest set of each key with each other that has the key, where they may be similar."""
    rows = sets.select("size", "bitmap", "wide", F.struct("doc", "line").alias("place"), F.explode("keys").alias("key"))
    heads = rows.groupBy("key").agg(F.min(F.struct("place", "size", "bitmap", "wide")).alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # written first, so that Spark deals out both sides of the join and can split a key that many share
    heads = cut(heads.select("key", "h.place", "h.size", "h.bitmap", "h.wide"), "line-heads")
    may, _, _ = _may_be_near("x", "y", F.col("x.size"), F.col("y.size"), least)
    met = rows.alias("x").join(heads.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.place") > F.col("y.place")) & may)
    return met.select(F.col("y.place").alias("a"), F.col("x.place").alias("b")).distinct()


def members_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(place, same, words) of the sets that are in a pair, written, so that all sets are read once for them."""
    ids = cut(pairs.select("a").unionAll(pairs.select("b")).distinct().toDF("place"), "line-ids")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    members = cut(sets.select(F.struct("doc", "line").alias("place"), "same", "words").join(few, "place", "left_semi"), "line-members")
    drop(ids)
    return members


def later_of(pairs: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """(place, same): the later set (b) of every pair that is similar indeed."""
    first = members.select(F.col("place").alias("a"), F.col("words").alias("words_a"))
    second = members.select(F.col("place").alias("b"), "same", F.col("words").alias("words_b"))
    both = F.size(F.array_intersect("words_a", "words_b"))
    total = F.size("words_a") + F.size("words_b") - both
    verified = pairs.join(first, "a").join(second, "b").where(both >= F.lit(least) * total - 1e-9)
    return verified.select(F.col("b").alias("place"), "same").distinct()


def repeated_sets(sets: DataFrame, least: float) -> DataFrame:
    """(same): sets that have an earlier one (by doc, then line) of Jaccard similarity ``least`` or more.

    Sets that are near the earliest of their key are settled first, then those
    near the likeliest of the earlier sets that the join brings them. One such
    set is enough, so only sets that are still open are compared with all that
    the join brings: in a group of near sets, the few that are like none. The
    result is written, and the tables on the way are deleted.
    """
    stars = cut(star_candidates(sets, least), "line-stars")
    members = members_of(stars, sets)
    settled = cut(later_of(stars, members, least), "settled-sets")
    drop(stars, members)
    side = settled.select("same", F.lit(True).alias("done"))
    if settled.count() <= BROADCAST_IDS:
        side = F.broadcast(side)
    marked = sets.select("same", "doc", "line", "words", "bitmap", "wide").join(side, "same", "left").withColumn("done", F.coalesce("done", F.lit(False)))
    pairs = cut(candidates(prefixes(marked, word_counts(sets), least), least), "line-pairs")
    members = members_of(pairs, sets)
    best = cut(pairs.groupBy("b").agg(F.min_by("a", F.struct("apart", "a")).alias("a")).select("a", "b"), "line-best")
    found = cut(later_of(best, members, least), "found-sets")
    rest = cut(pairs.select("a", "b").join(found.select(F.col("place").alias("b")), "b", "left_anti"), "line-rest")
    out = cut(later_of(rest, members, least).unionAll(found).unionAll(settled).select("same").distinct(), "repeated-sets")
    drop(settled, pairs, members, best, found, rest)
    return out


def kept_lines(docs: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, lines): numbers of the lines with a word that stay; documents that keep none have no row."""
    given = ("doc", "line", "words", "size", "bitmap", "wide", "keys")
    sets = line_sets(docs, key, text).groupBy("same").agg(F.min(F.struct(*given)).alias("r"))
    sets = cut(sets.select("same", *(f"r.{c}" for c in given)), "line-sets")
    repeated = repeated_sets(sets, least)
    kept = sets.select("same", "doc", "line").join(repeated, "same", "left_anti")
    kept = cut(kept.groupBy("doc").agg(F.collect_list("line").alias("lines")), "kept-lines")
    drop(sets, repeated)
    return kept


def remove_repeated_lines(docs: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with later matches taken out of its text.

    Adds n_lines (lines of the old text) and removed (numbers of removed lines,
    from 0). A line goes if any earlier line, by key and then line number, has
    a word set of Jaccard similarity ``least`` or more with its own, whether or
    not that one goes too. Lines without a word stay. Null texts stay null with
    no lines; a row with a null key keeps all its lines and is compared with
    none. Rows with the same key share their decisions, so a repeated row keeps
    what the first keeps. Columns named n_lines or removed are replaced.
    """
    plain = docs.drop("n_lines", "removed")
    kept = kept_lines(docs, least, key, text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column("lines").to_pylist()
            out_text, out_n, out_removed = [], [], []
            for doc, body, kept_numbers in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), lines, strict=True):
                if body is None:
                    out_text.append(None), out_n.append(0), out_removed.append([])
                    continue
                parts = body.split("\n")
                stay = set(kept_numbers or ())
                gone = [] if doc is None else [i for i, x in enumerate(parts) if i not in stay and x.strip(" \t\n\v\f\r")]
                skip = set(gone)
                out_text.append("\n".join(x for i, x in enumerate(parts) if i not in skip) if skip else body)
                out_n.append(len(parts))
                out_removed.append(gone)
            columns = [batch.column("doc"), pa.array(out_text, pa.string()), pa.array(out_n, pa.int32()), pa.array(out_removed, pa.list_(pa.int32())), batch.column("rest")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "text", "n_lines", "removed", "rest"])

    others = [c for c in plain.columns if c not in (key, text)]
    rest = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.struct(F.lit(0).alias("none"))
    rows = plain.select(F.col(key).alias("doc"), F.col(text).alias("text"), rest.alias("rest"))
    joined = rows.join(kept, "doc", "left").select("doc", "text", "lines", "rest")
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, text string, n_lines int, removed array<int>, rest {rows.schema['rest'].dataType.simpleString()}"
    done = joined.mapInArrow(task, schema)
    back = {key: F.col("doc"), text: F.col("text")}
    return done.select(*(back.get(c, F.col(f"rest.`{c}`")).alias(c) for c in plain.columns), "n_lines", "removed")
