"""Words, lines and hashes of many texts at once, as numpy arrays over Arrow's own buffers.

Helpers of the Python tasks: Spark deals out the rows, these functions work on
one slice of an Arrow batch. Words are runs of anything but ASCII white space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa

#: A slice of a batch holds about so many bytes of text (one longer text is a slice of its own).
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32
#: Hashes of bytes are polynomials modulo a prime, at a base drawn at random once: no two strings, however regular, are
#: likelier to collide than by their length over the prime.
PRIME = (1 << 61) - 1
_BASE = int(np.random.default_rng(20240229).integers(1 << 32, PRIME))
_P, _30, _31, _32, _61 = np.uint64(PRIME), *map(np.uint64, (30, 31, 32, 61))
_LOW_29, _LOW_30, _LOW_31, _LOW_32 = (np.uint64((1 << n) - 1) for n in (29, 30, 31, 32))
#: Windows of hashes are polynomials modulo 2**64, which is quicker. Two windows of two values alone can collide there,
#: but only if they are longer than this.
LONGEST_WINDOW = 256
_ODD = 0x9E3779B97F4A7C15
#: A longer run of bytes could let a sum of 40-bit terms wrap around.
_LONGEST_RUN = 1 << 23


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def mix(x: np.ndarray) -> np.ndarray:
    """Finish 64-bit values so that all bits depend on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values below it, in halves that don't overflow."""
    xh, xl, yh, yl = x >> _31, x & _LOW_31, y >> _31, y & _LOW_31
    middle = xl * yh + xh * yl
    return _reduced(((xh * yh) << np.uint64(1)) + (middle >> _30) + ((middle & _LOW_30) << _31) + xl * yl)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values below it, in halves that don't overflow."""
    xh, xl, yh, yl = x >> _31, x & _LOW_31, y >> _31, y & _LOW_31
    middle = xl * yh + xh * yl
    return _reduced(((xh * yh) << np.uint64(1)) + (middle >> _30) + ((middle & _LOW_30) << _31) + xl * yl)


def _room(n: int) -> int:
    return max(1 << 16, 1 << int(n).bit_length())


@lru_cache(maxsize=1)
def _prime_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, PRIME)):
        found = np.ones(1, np.uint64)
        while len(found) < size:
            found = np.concatenate([found, _times(found, np.uint64(pow(base, len(found), PRIME)))])
        out.append(found)
    return tuple(out)


@lru_cache(maxsize=1)
def _odd_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _ODD, np.uint64), np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _sums(terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the terms from start to end, modulo 2**64."""
    total = np.zeros(len(terms) + 1, np.uint64)
    np.cumsum(terms, out=total[1:])
    return total[ends] - total[starts]


def _with_length(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end for every pair, in time that does not depend on their lengths.

    A very long run has a hash of another kind. Powers are taken in two parts
    of 32 and 29 bits, so sums over a run don't overflow.
    """
    up, down = _prime_powers(_room(len(data)))
    up, wide = up[: len(data)], data.astype(np.uint64) + np.uint64(1)
    high = _reduced(_sums(wide * (up >> _32), starts, ends))
    low = _reduced(_sums(wide * (up & _LOW_32), starts, ends))
    value = _reduced(((high & _LOW_29) << _32) + (high >> np.uint64(29)) + low)
    out = _with_length(_times(value, down[starts]), starts, ends)
    for i in np.flatnonzero(ends - starts > _LONGEST_RUN).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def slice_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for every pair, of windows that are not too long."""
    if len(starts) and int((ends - starts).max()) > LONGEST_WINDOW:
        raise ValueError(f"windows of more than {LONGEST_WINDOW} values")
    up, down = _odd_powers(_room(len(values)))
    return _with_length(_sums(values * up[: len(values)], starts, ends) * down[starts], starts, ends)


def set_hashes(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Hash of each set of values, whatever their order; a set goes from one begin to the next."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    return _with_length(np.add.reduceat(mix(values), begins), begins, np.append(begins[1:], len(values)))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` values in a row; shorter input gives none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    starts = np.arange(len(hashes) - n + 1)
    return slice_hashes(hashes, starts, starts + n)


@dataclass
class Texts:
    """Some texts side by side: their UTF-8 bytes and where each begins."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        solid = ~_SPACE[self.data]
        before = np.zeros(len(solid), bool)
        before[1:] = solid[:-1]
        after = np.zeros(len(solid), bool)
        after[:-1] = solid[1:]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < len(solid))]
        before[inner] = False
        after[inner - 1] = False
        return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1

    @property
    def starts(self) -> np.ndarray:
        return self._words[0]

    @property
    def ends(self) -> np.ndarray:
        return self._words[1]

    @cached_property
    def word_offsets(self) -> np.ndarray:
        """Words before each text; the last entry counts all."""
        return np.searchsorted(self.starts, self.offsets)

    @cached_property
    def word_text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.word_offsets))

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return byte_hashes(self.data, self.starts, self.ends)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of every line (split at line feeds; a text has one line at least)."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        ends = np.concatenate([self.offsets[1:], breaks])
        text = np.concatenate([np.arange(len(self)), np.searchsorted(self.offsets, breaks, side="right") - 1])
        order = np.lexsort((starts, text))  # the k-th start and the k-th end of a text are one line's
        return starts[order], ends[np.lexsort((ends, text))], text[order]

    @cached_property
    def line_codes(self) -> np.ndarray:
        """A number for every line that equal lines alone share."""
        return _coded(self.data, self.lines[0], int(self.offsets[-1]), b"\n")[0]

    @cached_property
    def vocabulary(self) -> tuple[np.ndarray, list[bytes]]:
        """Code of every word, and the distinct words."""
        return _coded(self.data, self.starts, int(self.offsets[-1]))

    @cached_property
    def pieces(self) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """As ``vocabulary``, with A-Z in lower case, and words cut between letters and signs, and the pieces before each text.

        Only where both neighbours are ASCII and the sign is no apostrophe, so
        every cut is one that a word vocabulary makes too; other words stay
        whole. So do words with ``<|``, in their case, as it may begin a special
        token; and a letter before a character that isn't ASCII keeps its case,
        as a mark there may belong to it. A text's pieces depend on no other text.
        """
        letter, sign = _LETTER[self.data], _SIGN[self.data]
        before_other = np.zeros(len(letter), bool)
        before_other[:-1] = self.data[1:] >= 0x80
        before_other[self.ends - 1] = False
        data = np.where(before_other, self.data, _LOWER[self.data])
        begin = np.zeros(len(data), bool)
        begin[1:] = (letter[1:] & sign[:-1]) | (sign[1:] & letter[:-1])
        marks = np.flatnonzero((self.data[:-1] == 60) & (self.data[1:] == 124))
        word = np.searchsorted(self.starts, marks, side="right") - 1
        for w in np.unique(word[marks + 1 < self.ends[word]]).tolist():
            a, b = self.starts[w], self.ends[w]
            begin[a:b], data[a:b] = False, self.data[a:b]
        begin[self.starts] = True
        starts = np.flatnonzero(begin)
        return *_coded(data, starts, int(self.offsets[-1])), np.searchsorted(starts, self.offsets)


def _coded(data: np.ndarray, starts: np.ndarray, end: int, aside: bytes = b" \t\n\v\f\r") -> tuple[np.ndarray, list[bytes]]:
    """Codes of the runs from start to start, such bytes at their ends aside, and the distinct runs."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    bounds = np.append(starts, end).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    coded = runs.dictionary_encode()
    seen: dict[bytes, int] = {}
    to = [seen.setdefault(w.rstrip(aside), len(seen)) for w in coded.dictionary.to_pylist()]
    return np.array(to, np.int64)[coded.indices.to_numpy()], list(seen)


def texts_of(column: pa.Array) -> Texts:
    """Nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(body[at[0] : at[-1]], at - at[0])


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together until they hold about ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each."""
    if not batch.num_rows:
        return
    whole = texts_of(batch.column(text))
    at = 0
    while at < len(whole):
        end = int(np.searchsorted(whole.offsets, whole.offsets[at] + limit, side="right")) - 1
        end = min(len(whole), max(end, at + 1))
        first, last = whole.offsets[at], whole.offsets[end]
        yield batch.slice(at, end - at), Texts(whole.data[first:last], whole.offsets[at : end + 1] - first)
        at = end
