"""Removing passages that repeat earlier ones, by sparse suffix arrays.

Of all suffixes of a text, only those that begin at a minimiser are kept: the
place with the least hash of ``anchor`` words among the places where a passage
of the least length can have it. A repeated passage has its minimisers at the
same words in every copy. Suffixes whose passages are all alike are one block,
of which the earliest stands for all. The others that begin with the same words
are sorted by all words that follow; the common words of neighbours, to the
right from the suffix and to the left before it, give the classes of equal
passages. Where one beginning has very many different continuations, the
passages are told apart by their hashes instead, so no task holds them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textgrams
from tidemark.llm.tables import bound_batches, cut, drop

#: Words from which on a repeated passage counts, and words that a suffix is first sorted by.
LEAST, ANCHOR = 50, 25
#: Different blocks with the same beginning that are compared in one task.
RUN = 512
#: Up to this many suffixes to extend (some 30 bytes each) are sent to all executors; more are joined by shuffle.
BROADCAST_SUFFIXES = 1 << 18


def minimisers(texts: textgrams.Texts, least: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Text, place, first and last passage start of every minimiser (in words of the slice).

    A passage of ``least`` words belongs to the minimiser among its places with
    ``anchor`` words; the passages of one minimiser begin one after the other.
    """
    hashes = texts.word_hashes
    bounds = texts.word_offsets
    nothing = (np.zeros(0, np.int64),) * 4
    if len(hashes) < least:
        return nothing
    n = len(hashes)
    values = textgrams.mix(textgrams.window_hashes(hashes, anchor) + np.uint64(0x2545F4914F6CDD1D))
    bits = np.uint64(n.bit_length())
    packed = ((values >> bits) << bits) | np.arange(len(values), dtype=np.uint64)  # equal values: the first place
    width, have = least - anchor + 1, 1
    while have < width:  # least of 2, 4, 8 ... places, the last step overlaps
        step = min(have, width - have)
        packed = np.minimum(packed[: len(packed) - step], packed[step:])
        have += step
    place = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    start = np.arange(len(place))
    owner = texts.word_text[: len(place)]
    inside = start + least <= bounds[1:][owner]
    start, place, owner = start[inside], place[inside], owner[inside]
    if not len(start):
        return nothing
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(start)) - 1
    return owner[begins], place[begins], start[begins], start[ends]


def suffixes(docs: DataFrame, least: int, anchor: int, key: str, text: str) -> DataFrame:
    """(first, block, doc, at): the sparse suffixes of all texts.

    ``first`` hashes the words that the suffix begins with, ``block`` all the
    words of its passages and where it lies among them; ``at`` packs the start
    of the first passage in its text, how far behind it the suffix begins, and
    how many more passages begin after the first.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                owner, place, begin, end = minimisers(texts, least, anchor)
                hashes = texts.word_hashes
                first = textgrams.slice_hashes(hashes, place, place + anchor)
                block = textgrams.mix(textgrams.slice_hashes(hashes, begin, end + least) + (place - begin).astype(np.uint64))
                at = (begin - texts.word_offsets[owner]) << 16 | (place - begin) << 8 | (end - begin)
                columns = [pa.array(first.view(np.int64)), pa.array(block.view(np.int64)), part.column("doc").take(pa.array(owner)), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["first", "block", "doc", "at"])

    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL")
    return rows.mapInArrow(task, f"first long, block long, doc {rows.schema['doc'].dataType.simpleString()}, at long")


def _unpacked(part: pa.RecordBatch, texts: textgrams.Texts) -> tuple[np.ndarray, ...]:
    """Of all suffixes that rows list: the row, the first passage's start in the slice, the suffix's offset from it, and how many more."""
    lists = part.column("ats")
    at = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
    return owner, (at >> 16) + texts.word_offsets[owner], at >> 8 & 0xFF, at & 0xFF


def _with_texts(found: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text, ats): the texts of the given suffixes (doc, at), each with all of its own."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    wanted = found.groupBy("doc").agg(F.collect_list("at").alias("ats"))
    if found.count() <= BROADCAST_SUFFIXES:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, "doc").select("doc", "text", "ats")


def passages(found: DataFrame, docs: DataFrame, least: int, key: str, text: str) -> DataFrame:
    """(passage, doc, start): a hash of every passage of the given suffixes (doc, at)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                owner, first, _, more = _unpacked(part, texts)
                which = np.repeat(np.arange(len(owner)), more + 1)
                begin = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
                hashes = textgrams.slice_hashes(texts.word_hashes, begin, begin + least)
                start = begin - texts.word_offsets[owner[which]]
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), part.column("doc").take(pa.array(owner[which])), pa.array(start)], names=["passage", "doc", "start"])

    rows = _with_texts(found, docs, key, text)
    return rows.mapInArrow(task, f"passage long, doc {rows.schema['doc'].dataType.simpleString()}, start long")


def contexts(found: DataFrame, docs: DataFrame, least: int, anchor: int, key: str, text: str) -> DataFrame:
    """(first, right, left, doc, place, before, more) of the given suffixes (doc, at).

    ``right`` has the hashes of the words from the suffix to the end of its
    last passage, ``left`` those before it back to the start of its first one,
    as bytes whose order is that of the words.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                owner, first, before, more = _unpacked(part, texts)
                words, place = texts.word_hashes.astype(">u8"), first + before
                ends = (first + more + least).tolist()
                right = [words[a:b].tobytes() for a, b in zip(place.tolist(), ends)]
                left = [words[a:b][::-1].tobytes() for a, b in zip(first.tolist(), place.tolist())]
                head = textgrams.slice_hashes(texts.word_hashes, place, place + anchor)
                columns = [pa.array(head.view(np.int64)), pa.array(right, pa.binary()), pa.array(left, pa.binary()), part.column("doc").take(pa.array(owner)), pa.array(place - texts.word_offsets[owner]), pa.array(before), pa.array(more)]
                yield pa.RecordBatch.from_arrays(columns, names=["first", "right", "left", "doc", "place", "before", "more"])

    rows = _with_texts(found, docs, key, text)
    return rows.mapInArrow(task, f"first long, right binary, left binary, doc {rows.schema['doc'].dataType.simpleString()}, place long, before long, more long")


def _common(words: list[bytes]) -> np.ndarray:
    """Words that each has in common with the next, at their beginning."""
    lengths = np.array([len(w) // 8 for w in words])
    table = np.frombuffer(b"".join(w.ljust(8 * int(lengths.max()), b"\0") for w in words), ">u8").reshape(len(words), -1) if lengths.max() else np.zeros((len(words), 0), ">u8")
    differ = np.concatenate([table[1:] != table[:-1], np.ones((len(words) - 1, 1), bool)], axis=1)
    return np.minimum(differ.argmax(axis=1), np.minimum(lengths[1:], lengths[:-1]))


def _classes(common: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """For sorted words, a class for each and each needed length: neighbours share it if they have so many words in common."""
    return np.concatenate([np.zeros((1, len(needed)), np.int64), np.cumsum(common[:, None] < needed[None], axis=0)])


def repeats_of_run(run: dict[str, list], least: int, most_left: int) -> Iterator[tuple[int, int, int]]:
    """(row, start, end) of what suffixes that begin alike repeat of earlier ones; rows are sorted by ``right``."""
    n = len(run["doc"])
    reach = np.arange(most_left + 1)  # words of a passage that lie before the suffix
    right = _classes(_common(run["right"]), least - reach)
    order = sorted(range(n), key=run["left"].__getitem__)
    left = np.empty_like(right)
    left[order] = _classes(_common([run["left"][i] for i in order]), reach)
    before, more, place = (np.array(run[c]) for c in ("before", "more", "place"))
    has = (reach[None] <= before[:, None]) & (reach[None] >= (before - more)[:, None])
    rows, columns = np.nonzero(has)
    _, same = np.unique((columns * n + right[rows, columns]) * n + left[rows, columns], return_inverse=True)
    turn = np.empty(n, np.int64)
    turn[sorted(range(n), key=lambda i: (run["doc"][i], run["place"][i]))] = np.arange(n)
    earliest = np.full(int(same.max(initial=0)) + 1, n)
    np.minimum.at(earliest, same, turn[rows])
    again = np.zeros((n, most_left + 2), bool)
    again[rows, columns] = turn[rows] > earliest[same]
    for i in np.flatnonzero(again.any(axis=1)).tolist():
        edge = np.flatnonzero(np.diff(np.concatenate([[False], again[i]]).astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):  # passages that follow each other are one stretch
            yield i, int(place[i]) - (b - 1), int(place[i]) - a + least


def sorted_repeats(found: DataFrame, least: int, anchor: int) -> DataFrame:
    """(doc, start, end) from suffixes with contexts: sorted by their words, a run of equal beginnings at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        out: tuple[list, list, list] = ([], [], [])

        def settled() -> None:
            for i, start, end in repeats_of_run(held, least, least - anchor) if len(held["doc"]) > 1 else ():
                for x, values in zip((held["doc"][i], start, end), out):
                    values.append(x)

        kind = None
        for batch in batches:
            kind = batch.column("doc").type
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            heads = batch.column("first").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(heads)) + 1).tolist(), len(heads)]
            for a, b in zip(bounds, bounds[1:]):
                if held and (a or held["first"][0] != columns["first"][0]):
                    settled()
                    held = {}
                for c, values in columns.items():
                    held.setdefault(c, []).extend(values[a:b])
            if len(out[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], kind), *(pa.array(x, pa.int64()) for x in out[1:])], names=["doc", "start", "end"])
                out = ([], [], [])
        if held:
            settled()
            yield pa.RecordBatch.from_arrays([pa.array(out[0], kind), *(pa.array(x, pa.int64()) for x in out[1:])], names=["doc", "start", "end"])

    ordered = found.repartitionByRange("first").sortWithinPartitions("first", "right", "left", "doc", "place")
    return ordered.mapInArrow(task, f"doc {found.schema['doc'].dataType.simpleString()}, start long, end long")


def repeated_spans(docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, start, end): stretches of words of each text that repeat earlier words (by key, then place).

    Their union is exactly the words of all passages of ``least`` words that
    have an equal one earlier. Stretches may overlap. They are written, and
    every table on the way is deleted once the last step that reads it is over.
    """
    if not 0 < anchor <= least or least - anchor > 0xFF or 2 * least > textgrams.LONGEST_WINDOW:
        raise ValueError("anchor must be positive, and at most least and not far below it")
    all_suffixes = cut(suffixes(docs, least, anchor, key, text), "suffixes")
    runs = all_suffixes.groupBy("first").agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("lo"), F.max("block").alias("hi"))
    # written first, so that Spark deals out both sides of the join and can split a passage that many texts share
    runs = cut(runs.where("n > 1").select("first", (F.col("lo") != F.col("hi")).alias("mixed")), "suffix-heads")
    members = cut(all_suffixes.join(runs, "first"), "suffix-runs")
    drop(all_suffixes, runs)
    earliest = members.groupBy("first", "block", "mixed").agg(F.min(F.struct("doc", "at")).alias("e")).select("first", "block", "mixed", "e.doc", "e.at")
    earliest = cut(earliest, "suffix-classes")
    # equal blocks: all but the earliest repeat it as a whole
    copies = members.join(earliest.select("first", "block", "doc", "at"), ["first", "block", "doc", "at"], "left_anti")
    start = F.shiftright("at", 16)
    whole = cut(copies.select("doc", start.alias("start"), (start + F.col("at").bitwiseAND(F.lit(0xFF)) + least).alias("end")), "whole-blocks")
    drop(members)
    # one of each kind of block that has other kinds beside it
    kinds = cut(earliest.where("mixed").groupBy("first").agg((F.count(F.lit(1)) > RUN).alias("many")), "suffix-kinds")
    single = cut(earliest.where("mixed").join(kinds, "first").select("doc", "at", "many"), "suffix-singles")
    drop(earliest, kinds)
    near = cut(contexts(single.where("not many").select("doc", "at"), docs, least, anchor, key, text), "contexts")
    apart = cut(sorted_repeats(near, least, anchor), "sorted-repeats")
    drop(near)
    # very many kinds with one beginning: passage by passage
    told = cut(passages(single.where("many").select("doc", "at"), docs, least, key, text), "passages")
    firsts = told.groupBy("passage").agg(F.min(F.struct("doc", "start")).alias("e"), F.max(F.struct("doc", "start")).alias("l")).where("e < l").select("passage", "e")
    firsts = cut(firsts, "first-passages")
    later = cut(told.join(firsts, "passage").where(F.struct("doc", "start") > F.col("e")).select("doc", "start", (F.col("start") + least).alias("end")), "later-passages")
    drop(single, told, firsts)
    return whole.unionAll(apart).unionAll(later)


def joined_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that overlap or meet as one, in order."""
    out: list[tuple[int, int]] = []
    for i in np.argsort(starts, kind="stable"):
        if out and starts[i] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], int(ends[i])))
        else:
            out.append((int(starts[i]), int(ends[i])))
    return out


def remove_repeated_passages(docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` without the passages that repeat earlier ones.

    Adds n_words (of the old text), removed_words and spans (start and end of
    each removed stretch, in words). What goes with a stretch is the white
    space after it. The earliest copy of a passage stays, by key and then
    place, within a text too. Texts shorter than ``least`` words stay as they
    are; null texts stay null with no words. A row with a null key keeps its
    text and is compared with none; rows with the same key and text share their
    spans. Columns that are named like the added ones are replaced.
    """
    plain = docs.drop("n_words", "removed_words", "spans")
    gathered = repeated_spans(docs, least, anchor, key, text).groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                out, removed, spans = [], [], []
                for i, (body, starts, ends) in enumerate(zip(*(part.column(c).to_pylist() for c in ("text", "starts", "ends")), strict=True)):
                    found = joined_spans(np.array(starts), np.array(ends)) if starts and body is not None else []
                    if found:
                        first, last, base = texts.offsets[i], texts.offsets[i + 1], texts.word_offsets[i]
                        raw, kept, reached = texts.data, [], first
                        for a, b in found:
                            kept.append(raw[reached : texts.starts[base + a]])
                            reached = texts.starts[base + b] if base + b < texts.word_offsets[i + 1] else last
                        body = np.concatenate([*kept, raw[reached:last]]).tobytes().decode()
                    out.append(body)
                    removed.append(sum(b - a for a, b in found))
                    spans.append([{"start": a, "end": b} for a, b in found])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                columns = [part.column("doc"), pa.array(out, pa.string()), pa.array(np.diff(texts.word_offsets).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(spans, kind), part.column("rest")]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "text", "n_words", "removed_words", "spans", "rest"])

    others = [c for c in plain.columns if c not in (key, text)]
    rest = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.struct(F.lit(0).alias("none"))
    rows = plain.select(F.col(key).alias("doc"), F.col(text).alias("text"), rest.alias("rest"))
    joined = rows.join(gathered, "doc", "left").select("doc", "text", "starts", "ends", "rest")
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, text string, n_words long, removed_words long, spans array<struct<start:long,end:long>>, rest {rows.schema['rest'].dataType.simpleString()}"
    done = joined.mapInArrow(task, schema)
    back = {key: F.col("doc"), text: F.col("text")}
    return done.select(*(back.get(c, F.col(f"rest.`{c}`")).alias(c) for c in plain.columns), "n_words", "removed_words", "spans")
