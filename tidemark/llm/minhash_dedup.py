"""Near-duplicate documents by Order MinHash and banded alignment.

A sketch takes the few least occurrence-labelled k-mers of a text under one
hash function and keeps them in text order, so it is sensitive to edits and
not only to the set of k-mers. Texts that share a sketch are candidates; they
are aligned word by word inside a band, and linked if they differ little. A
bucket's members meet its least one. A bucket that this leaves in more than one
component has pairs left to compare: all of them in a small bucket, and in a
large one those that an exact join on rare words brings together, so a passage
that many texts have costs few alignments and hides no link.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, textgrams
from tidemark.llm.components import components
from tidemark.llm.tables import bound_batches, cut, drop


#: Ids of the texts of up to so many pairs are sent to all executors (8 bytes each); more are joined by shuffle.
BROADCAST_PAIRS = 1 << 18


@dataclass(frozen=True)
class Settings:
    """A pair with shingle overlap J shares a sketch of 2 k-mers about as often as J * J. Words replaced
    here and there at an edit similarity of 0.83 leave J = 0.25, where 40 sketches miss one pair in twelve."""

    words: int = 5
    sketches: int = 40
    taken: int = 2
    similarity: float = 0.8
    #: In a bucket of up to so many, members of other components than the least one's are aligned with all others.
    block: int = 32


def _shingles(texts: textgrams.Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled k-mer hashes in text order, and how many each text has (a short text is one k-mer)."""
    bounds, words = texts.word_offsets, texts.word_hashes
    counts = np.diff(bounds)
    number = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), number)
    start = bounds[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    hashes = textgrams.slice_hashes(words, start, np.minimum(start + k, bounds[1:][owner]))
    # the n-th occurrence in its text gets the label n
    joint = textgrams.mix(hashes ^ (owner.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))
    order = np.argsort(joint, kind="stable")
    same = np.concatenate([[False], joint[order][1:] == joint[order][:-1]]) if len(order) else np.zeros(0, bool)
    if same.any():
        at = np.arange(len(order))
        label = np.zeros(len(order), np.uint64)
        label[order] = at - np.maximum.accumulate(np.where(same, 0, at))
        hashes = textgrams.mix(hashes + label * np.uint64(0xC2B2AE3D27D4EB4F))
    return hashes, number


def sketch_values(hashes: np.ndarray, number: np.ndarray, settings: Settings) -> np.ndarray:
    """One row of sketches for each text's k-mers (in text order); rows of texts without any mean nothing."""
    full = np.flatnonzero(number > 0)
    out = np.zeros((len(number), settings.sketches), np.uint64)
    if not len(full):
        return out
    first = (np.cumsum(number) - number)[full]
    counts = number[full]
    factors = np.random.default_rng(11).integers(0, 1 << 63, settings.sketches, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    highest = np.uint64((1 << 64) - 1)
    for j, factor in enumerate(factors):
        x = hashes * factor
        places = np.full((len(full), settings.taken), np.iinfo(np.int64).max)
        for i in range(settings.taken):
            least = np.minimum.reduceat(x, first)
            hit = np.flatnonzero(x == np.repeat(least, counts))
            owner = np.searchsorted(first, hit, side="right") - 1
            once = np.concatenate([[True], owner[1:] != owner[:-1]])
            hit, owner = hit[once], owner[once]
            more = counts[owner] > i  # a text with fewer k-mers takes those it has
            places[owner[more], i] = hit[more]
            x[hit] = highest
        places.sort(axis=1)
        value = np.full(len(full), j, np.uint64)
        for i in range(settings.taken):
            used = places[:, i] < np.iinfo(np.int64).max
            value = textgrams.mix(value * np.uint64(0x9E3779B97F4A7C15) + np.where(used, hashes[np.where(used, places[:, i], 0)], np.uint64(i)))
        out[full, j] = value
    return out


#: Places of a word up to which its bits are set one by one, and words of a text up to which the bits of other words are
#: kept (a 64th of the square of that number, in bytes, at most); beyond, they are made anew for each column.
FEW, KEPT = 8, 1 << 16


def _bits(places: list[int], width: int) -> int:
    bits = np.zeros(width, bool)
    bits[places] = True
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def band_distance(a: list[int], b: list[int], most: int) -> int:
    """Edit distance of two word sequences if it is at most ``most``, else ``most + 1``.

    One column of the alignment is two integers of 2 * most + 1 bits: where the
    distance rises or falls by one from row to row, along a band about the
    diagonal that moves down by a row with every column. Of the words, only
    their places are kept, sorted by word; bits are made inside the band alone.
    """
    m, n = len(a), len(b)
    if abs(m - n) > most:
        return most + 1
    if not m or not n:
        return m + n
    k = most
    own, other = np.asarray(a), np.asarray(b)
    order = np.argsort(own, kind="stable")
    first, last = (np.searchsorted(own, other, side, sorter=order).tolist() for side in ("left", "right"))
    places, kept = order.tolist(), {}
    width = 2 * k + 1
    mask = (1 << width) - 1
    top = 1 << (width - 1)
    rises, falls = mask ^ ((1 << k) - 1), 0
    distance = min(k, m)
    for j in range(1, n + 1):
        shift, low, high = j - k - 1, first[j - 1], last[j - 1]
        if high - low > FEW and m <= KEPT:
            if low not in kept:
                kept[low] = _bits(places[low:high], m)
            equal = (kept[low] >> shift if shift >= 0 else kept[low] << -shift) & mask
        elif high - low > FEW:
            low = bisect_left(places, shift, low, high)
            equal = _bits([p - shift for p in places[low : bisect_left(places, shift + width, low, high)]], width)
        else:
            equal = 0
            for place in places[low:high]:
                if 0 <= place - shift < width:
                    equal |= 1 << place - shift
        level = ((((equal & rises) + rises) ^ rises) | equal | falls) & mask
        up = falls | (mask & ~(level | rises))
        down = level & rises
        if j + k <= m:
            distance += not level & top
        else:
            row = 1 << (m - j + k)
            distance += bool(up & row) - bool(down & row)
        level >>= 1
        rises = down | (mask & ~(level | up))
        falls = level & up
    return min(distance, most + 1)


def _shared_words(x: np.ndarray, y: np.ndarray) -> int:
    """Words that two sequences have in common, as often as both have them."""
    (one, n), (two, m) = (np.unique(w, return_counts=True) for w in (x, y))
    _, i, j = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def _pairs_of_words(words: np.ndarray) -> np.ndarray:
    return textgrams.mix(words[:-1]) ^ words[1:]


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """1 - edit distance / words of the longer, or 0 if that is below ``least``. Two empty ones are equal."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    most = int((1 - least) * longer + 1e-9)
    shared = min(len(a), len(b))
    if longer - shared > most:
        return 0.0
    differ = np.flatnonzero(a[:shared] != b[:shared])
    head = int(differ[0]) if len(differ) else shared
    x, y = a[head:], b[head:]
    shared = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - shared :][::-1] != y[len(y) - shared :][::-1])
    tail = int(differ[0]) if len(differ) else shared
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    if max(len(x), len(y)) - _shared_words(x, y) > most:  # each edit makes one word more common at most
        return 0.0
    if max(len(x), len(y)) - 1 - _shared_words(_pairs_of_words(x), _pairs_of_words(y)) > 2 * most:  # and two pairs of neighbours
        return 0.0
    x, y = x.tolist(), y.tolist()
    band = min(8, most)
    while True:
        found = band_distance(x, y, band)
        if found <= band:
            return 1 - found / longer
        if band == most:
            return 0.0
        band = min(4 * band, most)


def _sketch_lists(hashes: np.ndarray, number: np.ndarray, settings: Settings) -> pa.Array:
    bounds = np.arange(len(number) + 1, dtype=np.int32) * settings.sketches
    values = sketch_values(hashes, number, settings).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds, mask=np.append(number == 0, False)), pa.array(values.ravel()))


def sketch(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, same, sketches): a digest that equal texts share, and the sketches (null without words)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                lists = _sketch_lists(*_shingles(texts, settings.words), settings)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("same"), lists], names=["id", "same", "sketches"])

    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    # texts that are null are equal to nothing, so their digest is the row's own
    same = F.when(F.col("text").isNull(), F.concat(F.lit("null"), F.col("id").cast("string"))).otherwise(F.md5(F.col("text").cast("binary")))
    return rows.withColumn("same", same).mapInArrow(task, f"id {rows.schema['id'].dataType.simpleString()}, same string, sketches array<long>")


def _distinct_words(column: pa.Array) -> list[np.ndarray]:
    """Word hashes of every text; those of a text that comes again are worked out once."""
    coded = column.dictionary_encode()
    texts = textgrams.texts_of(coded.dictionary)
    words, bounds = texts.word_hashes, texts.word_offsets
    return [words[bounds[i] : bounds[i + 1]] for i in coded.indices.to_numpy()]


def align(pairs: DataFrame, docs: DataFrame, s: Settings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, similarity) of candidate pairs (a, b); similarity is 0 where it is below the least."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in textgrams.slices(batch, "text_a"):
                first, second = (_distinct_words(part.column(c)) for c in ("text_a", "text_b"))
                found = [similarity(x, y, s.similarity) for x, y in zip(first, second, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    pairs = cut(pairs, "pairs")
    bodies = _bodies(docs, pairs.select("a").unionAll(pairs.select("b")).distinct().toDF("id"), pairs.count(), key, text)
    joined = pairs.join(bodies.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(bodies.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    kind = pairs.schema["a"].dataType.simpleString()
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(task, f"a {kind}, b {kind}, similarity double")


def _bodies(docs: DataFrame, ids: DataFrame, number: int, key: str, text: str) -> DataFrame:
    """(id, text), without texts of other rows where the ids are few enough to be sent to all executors."""
    bodies = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return bodies.join(F.broadcast(ids), "id", "left_semi") if number <= BROADCAST_PAIRS else bodies


def _stars(sketched: DataFrame) -> DataFrame:
    """(bucket, a, b, n): every member of a bucket with the bucket's least member, and how many the bucket has."""
    rows = sketched.select("id", F.posexplode("sketches").alias("j", "value")).select(F.xxhash64("j", "value").alias("bucket"), "id")
    least = rows.groupBy("bucket").agg(F.min("id").alias("b"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("b < last").select("bucket", "b", "n")
    return rows.join(least, "bucket").where("id <> b").select("bucket", F.col("id").alias("a"), "b", "n")


def _parities(words: np.ndarray, number: np.ndarray) -> pa.Array:
    """A bitmap for each text, of a power of two and at least four times as many bits as it has words.

    Each bit is the parity of the words that fall on it, so two bitmaps differ
    in no more bits than the texts do in words; the larger one is folded first.
    """
    width = np.left_shift(1, np.maximum(6, np.ceil(np.log2(np.maximum(4 * number, 1))).astype(np.int64)))
    ends = np.cumsum(width)
    spot = (textgrams.mix(words.astype(np.uint64) + np.uint64(0x6A09E667)) >> np.uint64(8)).astype(np.int64) & (np.repeat(width, number) - 1)
    bits = np.bincount(np.repeat(ends - width, number) + spot, minlength=int(ends[-1]) if len(ends) else 0) & 1
    offsets = np.append(0, ends // 8).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(number), [None, pa.py_buffer(offsets), pa.py_buffer(np.packbits(bits.astype(bool), bitorder="little"))])


def _differing(x: bytes, y: bytes) -> int:
    """Bits that two bitmaps differ in."""
    small, large = sorted((np.frombuffer(b, np.uint64) for b in (x, y)), key=len)
    return int(np.bitwise_count(small ^ np.bitwise_xor.reduce(large.reshape(-1, len(small)), axis=0)).sum())


def _word_sets(members: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, component, large, words, bitmap): 32-bit hashes of the members' words, sorted; the n-th occurrence of a word has its own."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                hashes, number = _shingles(texts, 1)
                owner = np.repeat(np.arange(len(number)), number)
                packed = owner << 32 | (textgrams.mix(hashes) >> np.uint64(32)).astype(np.int64)
                packed.sort()
                short = packed & 0xFFFFFFFF
                words = pa.array(short.astype(np.uint32).view(np.int32))
                bounds = pa.array(np.append(0, np.cumsum(number)).astype(np.int32))
                given = [part.column(c) for c in ("id", "component", "large")]
                yield pa.RecordBatch.from_arrays([*given, pa.ListArray.from_arrays(bounds, words), _parities(short, number)], names=["id", "component", "large", "words", "bitmap"])

    bodies = _bodies(docs, members.select("id"), members.count(), key, text)
    kind = members.schema["id"].dataType.simpleString()
    return members.join(bodies, "id").select("id", "component", "large", "text").mapInArrow(task, f"id {kind}, component {kind}, large boolean, words array<int>, bitmap binary")


def _front_words(batch: pa.RecordBatch, rank: np.ndarray, chosen: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """Of the ``chosen`` counters' words among every set's rarest: (word, word before, set in the batch, its size, place)."""
    lists = batch.column("words")
    words, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    counter = line_dedup.counter(words)
    order = np.lexsort((words, rank[counter], owner))
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    front = np.flatnonzero(place < line_dedup.prefix_length(sizes, least)[owner])
    front = front[chosen[counter[order[front]]]]
    of = owner[front]
    return words[order[front]], words[order[front - (place[front] > 0)]], of, sizes[of], place[front]


def _spots(words: np.ndarray) -> np.ndarray:
    """Another counter for each word than ``line_dedup.counter``, so that words which share one seldom share both."""
    return (textgrams.mix(words.view(np.uint32).astype(np.uint64) + np.uint64(0xA54FF53A5F1D)) >> np.uint64(20)).astype(np.int64) & (line_dedup.COUNTERS - 1)


def _in_several(sets: DataFrame, shared: Broadcast, least: float) -> np.ndarray:
    """Spots with front words of more than one component; a word of others joins no pair that is left to compare.

    The least and the greatest hash of the components are kept, in the tasks and then block by block, over all sets.
    """
    block, ends = line_dedup.BLOCK, (np.iinfo(np.int64).max, np.iinfo(np.int64).min)

    def given_out(tables: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(tables), pa.int32()), pa.array([x.tobytes() for x in tables.values()], pa.binary())], names=["block", "ends"])

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = (np.full(line_dedup.COUNTERS, x) for x in ends)
        for batch in batches:
            words, _, of, _, _ = _front_words(batch, *shared.value, least)
            spots, hashes = _spots(words), batch.column("hashed").to_numpy()[of]
            np.minimum.at(low, spots, hashes)
            np.maximum.at(high, spots, hashes)
        yield given_out({i: np.stack(x) for i, x in enumerate(zip(low.reshape(-1, block), high.reshape(-1, block), strict=True)) if (x[0] <= x[1]).any()})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column("block").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                low, high = np.frombuffer(raw, np.int64).reshape(2, -1)
                tables[i] = np.stack([np.minimum(tables[i][0], low), np.maximum(tables[i][1], high)]) if i in tables else np.stack([low, high])
        yield given_out({i: x[0] < x[1] for i, x in tables.items()})

    kind = "block int, ends binary"
    found = np.zeros((line_dedup.COUNTERS // block, block), bool)
    for row in sets.select("words", F.xxhash64("component").alias("hashed")).mapInArrow(partly, kind).repartition("block").mapInArrow(joined, kind).toArrow().to_pylist():
        found[row["block"]] = np.frombuffer(row["ends"], bool)
    return found.ravel()


def _rare_words(sets: DataFrame, least: float) -> DataFrame:
    """(word, before, id, component, size, place) for the rarest words of every set: similar texts share one of those of both.

    ``before`` is the word next before in the set's order, or the word itself if it is the first.
    An edit makes one word more common at most, so texts of n words or fewer have all but (1 - least) * n in common.
    Words that are rare in sets of one component alone are left out, so the rows are at most that share of the words.
    """
    counts = line_dedup.word_counts(sets)
    rank = np.empty(line_dedup.COUNTERS, np.int32)
    rank[np.argsort(counts, kind="stable")] = np.arange(line_dedup.COUNTERS, dtype=np.int32)
    context = sets.sparkSession.sparkContext
    shared = context.broadcast((rank, counts > 1))
    several = context.broadcast(_in_several(sets, shared, least))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, before, of, sizes, place = _front_words(batch, *shared.value, least)
            met = several.value[_spots(words)]
            words, before, of, sizes, place = (x[met] for x in (words, before, of, sizes, place))
            given = [batch.column(c).take(pa.array(of)) for c in ("id", "component")]
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(before), *given, pa.array(sizes.astype(np.int32)), pa.array(place.astype(np.int32))], names=["word", "before", "id", "component", "size", "place"])

    kind = sets.schema["id"].dataType.simpleString()
    return sets.mapInArrow(task, f"word int, before int, id {kind}, component {kind}, size int, place int")


def _rare_pairs(sets: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of different components that may be alike, by their sizes and rare words; some come more than once.

    A pair that has the same word before the one that joins it meets there.
    """
    rare = _rare_words(sets, least)
    x, y = rare.alias("x"), rare.alias("y")
    common = F.ceil(F.lit(least) * F.greatest("x.size", "y.size") - 1e-9)
    fits = (
        (F.col("x.word") == F.col("y.word"))
        & (F.col("x.id") > F.col("y.id"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.col("x.size") - F.col("x.place") >= common)
        & (F.col("y.size") - F.col("y.place") >= common)
        & (F.least(F.expr("x.size - x.place"), F.expr("y.size - y.place")) + F.least("x.place", "y.place") >= common)
        & ((F.col("x.before") != F.col("y.before")) | (F.col("x.place") == 0))
    )
    return x.join(y, fits).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _with_close_bitmaps(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b), once each, whose bitmaps allow them as many words in common as similar texts must have.

    Bitmaps take an eighth of the words' room or a quarter; a text's own is fetched once for all pairs that it is the first of.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            most = n + m - 2 * np.ceil(least * np.maximum(n, m) - 1e-9)
            apart = [_differing(x, y) for x, y in zip(*(batch.column(c).to_pylist() for c in ("bitmap_a", "bitmap_b")), strict=True)]
            stay = pa.array(np.array(apart, np.int64) <= most)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(stay) for c in "ab"], names=["a", "b"])

    of = lambda end: sets.select(F.col("id").alias(end), F.size("words").alias(f"size_{end}"), F.col("bitmap").alias(f"bitmap_{end}"))
    kind = pairs.schema["a"].dataType.simpleString()
    met = pairs.groupBy("a").agg(F.collect_set("b").alias("bs")).join(of("a"), "a")
    met = met.select("a", "size_a", "bitmap_a", F.explode("bs").alias("b")).join(of("b"), "b")
    return met.select("a", "b", "size_a", "size_b", "bitmap_a", "bitmap_b").mapInArrow(task, f"a {kind}, b {kind}")


def bucket_links(chosen: DataFrame, docs: DataFrame, s: Settings, key: str, text: str, spent: list[DataFrame]) -> DataFrame:
    """(a, b): links whose components are the classes. ``chosen`` has id and sketches; ``spent`` gets the tables to drop when the links are written.

    They lose no class: of every two texts that share a bucket and are similar,
    the ends are in one component. Members are aligned with the least one of
    their bucket first; then pairs of one bucket and different components are
    aligned, but for those whose bitmaps differ too much. In buckets of more
    than ``block`` a join on rare words finds those that are not.
    """
    stars = cut(_stars(chosen), "stars")
    first = cut(align(stars.select("a", "b").distinct(), docs, s, key, text), "aligned")
    spent += [stars, first]
    if first.where("similarity = 0").isEmpty():
        return first.where("similarity > 0").select("a", "b")
    named = cut(components(first.where("similarity > 0")), "named")
    for end in "ab":
        stars = stars.join(named.toDF(end, f"in_{end}"), end, "left").withColumn(f"in_{end}", F.coalesce(f"in_{end}", end))
    stars = cut(stars.withColumn("large", F.col("n") > s.block).drop("n"), "named-stars")
    apart = stars.where("in_a <> in_b")
    left = stars.join(apart.select("bucket").distinct(), "bucket", "left_semi")
    members = left.select("a", "in_a", "large").unionAll(left.select("b", "in_b", "large")).toDF("id", "component", "large")
    members = cut(members.groupBy("id", "component").agg(F.max("large").alias("large")), "members")
    sets = cut(_word_sets(members, docs, key, text), "word-sets")
    small = left.where("NOT large").select("bucket", F.col("a").alias("y"), F.col("in_a").alias("in_y"))
    met = apart.where("NOT large").select("bucket", F.col("a").alias("x"), F.col("in_a").alias("in_x")).join(small, "bucket").where("in_x <> in_y")
    pairs = met.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).unionAll(_rare_pairs(sets.where("large"), s.similarity))
    pairs = cut(_with_close_bitmaps(pairs, sets, s.similarity).join(first.select("a", "b"), ["a", "b"], "left_anti"), "left-pairs")
    second = cut(align(pairs, docs, s, key, text), "aligned")
    spent += [named, stars, members, sets, pairs, second]
    return named.where("id <> component").toDF("a", "b").unionAll(second.where("similarity > 0").select("a", "b"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, kept): every row with the least key of its class.

    Rows with equal texts are one class without alignment; one of them stands
    for all. Representatives that share a sketch are aligned with the least one
    of that bucket, and then with those of other components (see
    ``bucket_links``), so that an unlike least member hides no link. Classes
    are the connected components of all links found. Null texts and blank texts are
    linked to nothing but (blank ones) equal texts. A null key gives a row that
    is kept, with a null class. Repeated keys share one row of the result for
    each input row; keys should be unique. Other columns are left behind.
    """
    sketched = cut(sketch(docs, settings, key, text), "sketches")
    groups = sketched.groupBy("same").agg(F.min(F.struct("id", "sketches")).alias("r"))
    chosen = cut(groups.select("same", F.col("r.id").alias("id"), F.col("r.sketches").alias("sketches")), "representatives")
    spent: list[DataFrame] = []
    found = components(bucket_links(chosen, docs, settings, key, text, spent))
    drop(*spent)
    named = chosen.select("same", "id").join(found, "id", "left").select("same", F.coalesce("component", "id").alias("class_id"))
    out = sketched.select("id", "same").join(named, "same").select(F.col("id").alias(key), "class_id", (F.col("id") == F.col("class_id")).alias("kept"))
    nulls = docs.where(F.col(key).isNull()).select(F.col(key), F.col(key).alias("class_id"), F.lit(True).alias("kept"))
    return out.unionAll(nulls)
