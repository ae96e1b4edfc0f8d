"""Quality rules on repetition, from a suffix array over the words of each text.

The words of a text are numbered, and its suffixes are sorted by prefix
doubling; texts of a slice are sorted together, with the text as first key.
Common prefixes of neighbouring suffixes give, for every place, the longest
stretch that occurs elsewhere in the same text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import textgrams
from tidemark.llm.tables import bound_batches

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Fixed rules (as the contract of the digest has them) and limits of repetition."""

    least_words: int = 50
    #: Percent of words in three-word windows that occur twice or more.
    repeat_percent: int = 50
    #: A repeat counts from this many words on.
    repeat_words: int = 10
    #: Share of words that such repeats may cover, all occurrences included.
    covered: float = 0.4
    #: Words in the longest repeat, as a share of the text's words.
    longest: float = 0.25


def suffix_order(codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of all texts, and the ranks by the first 1, 2, 4 ... words.

    Two places have the same rank by ``k`` words if and only if they are in one
    text and the same ``k`` words begin there. Places that are alone in their
    rank are not sorted again.
    """
    n = len(codes)
    key = text * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    levels = [_rank(key, order, np.zeros(n, np.int64))]
    k = 1
    last = np.searchsorted(text, text, side="right")  # end of the text of each place
    while True:
        rank = levels[-1]
        ranked = rank[order]
        alone = np.ones(n, bool)
        same = ranked[1:] == ranked[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        slots = np.flatnonzero(~alone)  # where in the order the places go that need sorting
        if not len(slots):
            return order, levels
        places = order[slots]
        ahead = places + k
        follow = np.where(ahead < last[places], rank[np.minimum(ahead, n - 1)], -1)
        key = rank[places] * (n + 1) + follow + 1
        by = np.argsort(key, kind="stable")
        order = order.copy()
        order[slots] = places[by]
        finer = rank.copy()
        sorted_key = key[by]
        begins = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
        finer[places[by]] = slots[np.maximum.accumulate(np.where(begins, np.arange(len(by)), 0))]
        levels.append(finer)
        k *= 2


def _rank(key: np.ndarray, order: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Rank of every place: the first slot of its equals in the order."""
    ordered = key[order]
    begins = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(order) else np.zeros(0, bool)
    out[order] = np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0)) if len(order) else order
    return out


def longest_repeats(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For every place, the words in the longest stretch from it that begins elsewhere in its text too."""
    n = len(codes)
    if n < 2:
        return np.zeros(n, np.int64)
    order, levels = suffix_order(codes, text)
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        here, there = a + common, b + common
        inside = (here < n) & (there < n)
        common += np.where(inside & (rank[np.minimum(here, n - 1)] == rank[np.minimum(there, n - 1)]), 1 << level, 0)
    out = np.zeros(n, np.int64)
    out[order[:-1]] = common
    out[order[1:]] = np.maximum(out[order[1:]], common)
    return out


def covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Places that lie in a repeat of ``least`` words or more (a text's repeats end within it)."""
    n = len(lengths)
    starts = np.flatnonzero(lengths >= least)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths[starts], -1)
    return np.cumsum(change[:n]) > 0


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])


def measure(texts: textgrams.Texts, limits: Limits) -> dict[str, np.ndarray]:
    """All measures of some texts."""
    bounds, data = texts.word_offsets, texts.data
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    space = textgrams.is_space(data)
    counts = {
        "n_words": np.diff(bounds),
        "word_chars": _per_text(~space & ((data & 0xC0) != 0x80), texts.offsets),
        "n_symbols": _per_text(symbol[data], texts.offsets),
    }
    starts, ends, line_text = texts.lines
    filled = np.concatenate([[0], np.cumsum(~space)])
    with_word = filled[ends] > filled[starts]
    owner = line_text[with_word]
    _, first = np.unique(owner * (len(starts) + 1) + texts.line_codes[with_word], return_index=True)
    counts["n_dup_lines"] = np.bincount(owner, minlength=len(texts)) - np.bincount(owner[first], minlength=len(texts))
    codes, _ = texts.vocabulary
    lengths = longest_repeats(codes, texts.word_text)
    # a window of three words that is found twice covers its own three words only
    counts["n_repeat_words"] = _per_text(covered(np.where(lengths >= 3, 3, 0), 3), bounds)
    long = np.where(lengths >= limits.repeat_words, lengths, 0)
    counts["covered_words"] = _per_text(covered(long, limits.repeat_words), bounds)
    counts["longest_repeat"] = np.zeros(len(texts), np.int64)
    np.maximum.at(counts["longest_repeat"], texts.word_text, long)
    return {k: v.astype(np.int64) for k, v in counts.items()}


def spans_of(texts: textgrams.Texts, least: int) -> list[list[tuple[int, int]]]:
    """The stretches of words [start, end) of each text that repeats cover, joined where they meet."""
    inside = covered(longest_repeats(texts.vocabulary[0], texts.word_text), least)
    out = []
    for a, b in zip(texts.word_offsets, texts.word_offsets[1:]):
        edge = np.diff(np.concatenate([[0], inside[a:b].astype(np.int8), [0]]))
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
    return out


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def judge(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text", with_spans: bool = False) -> DataFrame:
    """Measures and verdict of every row of ``docs``.

    Returns key, the counts, base_failed and kept; ``with_spans`` adds the
    repeated stretches as ``spans``, pairs of word numbers. A null, empty or
    blank text has no words and fails for being short. A text is measured whole
    in one task, whatever its length. Repeated rows are judged one by one; an
    empty table gives no rows. Other columns are left behind.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                found = measure(texts, limits)
                words = found["n_words"]
                failed = (words < limits.least_words) | (100 * found["n_repeat_words"] > limits.repeat_percent * words)
                kept = ~failed & (found["covered_words"] <= limits.covered * words) & (found["longest_repeat"] <= limits.longest * words)
                columns = [part.column("key"), *(pa.array(found[c]) for c in COUNTS), pa.array(failed), pa.array(kept)]
                names = [key, *COUNTS, "base_failed", "kept"]
                if with_spans:
                    columns.append(pa.array(spans_of(texts, limits.repeat_words), pa.list_(pa.list_(pa.int64()))))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    bound_batches(docs.sparkSession)
    rows = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    out = f"`{key}` {rows.schema['key'].dataType.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean"
    return rows.mapInArrow(task, out + ", spans array<array<long>>" * with_spans)
