"""Packing documents into sequences along a Hilbert curve.

A document's hashed word vector is projected to a few dimensions, and its cell
there gives a Hilbert key, so documents with similar words have near keys. The
documents are range-sorted by key, and every range is packed on its own: they
are laid end to end and cut at the sequence length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm import bpe, textgrams
from tidemark.llm.tables import cut

SEQUENCE = 2048
CLOSING_ID = 1
#: Hashed features, projected dimensions and bits of each dimension in the Hilbert key.
FEATURES, DIMENSIONS, BITS = 256, 4, 12
BATCH_BYTES = 6 << 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of every cell (one row of coordinates below 2**bits) along a Hilbert curve.

    Gray-code form: coordinates are rotated and mirrored from the highest bit
    down, then their bits are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(n):
            mirrored = (x[i] & q) != 0
            swap = np.where(mirrored, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(mirrored, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & (1 << b), (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(7).standard_normal((FEATURES, DIMENSIONS))


def curve_keys(texts: textgrams.Texts) -> np.ndarray:
    """Hilbert key of every text; texts without words share the middle of the space."""
    codes, words, bounds = texts.pieces
    hashes = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    sign = np.where(hashes >> 31, 1.0, -1.0)
    vectors = np.bincount(owner * FEATURES + (hashes % FEATURES)[codes], weights=sign[codes], minlength=len(texts) * FEATURES).reshape(len(texts), FEATURES)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    points = (vectors / np.where(norms > 0, norms, 1)) @ _projection()  # each coordinate is about standard normal
    cells = np.clip((points / 8 + 0.5) * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert_keys(cells.astype(np.int64), BITS)


def tokenise(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, curve, ids, width): ids of each whole text and the closing id, in 2 bytes each where the vocabulary allows it, else 4.

    The ids are those of the tokenizers library; see ``bpe`` for how a task makes them.
    """
    file = bpe.content(docs, path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.vocabulary(file.value)
        width = "<u2" if len(model.tokens) <= 1 << 16 else "<u4"
        for batch in textgrams.gathered(batches, BATCH_BYTES):
            for part, texts in textgrams.slices(batch, "text", BATCH_BYTES):
                ids, starts = model.encode(texts)
                closed = np.insert(ids, starts[1:], CLOSING_ID).astype(width)
                bounds = ((starts + np.arange(len(starts))) * closed.itemsize).astype(np.int32)
                blobs = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(bounds), pa.py_buffer(closed)])
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(curve_keys(texts)), blobs, pa.array(np.full(len(texts), closed.itemsize, np.int32))], names=["doc", "curve", "ids", "width"])

    rows = docs.selectExpr(f"`{key}` AS doc", f"`{text}` AS text")
    return rows.mapInArrow(task, f"doc {rows.schema['doc'].dataType.simpleString()}, curve long, ids binary, width int")


Piece = tuple[object, np.ndarray, int, int]


def fill(documents: Iterator[tuple[object, np.ndarray]], size: int = SEQUENCE) -> Iterator[list[Piece]]:
    """Sequences of pieces (document, its ids, start, length) of documents laid end to end.

    All sequences are full, but for what is left at the end: it is cut into
    sequences whose lengths are powers of two, which need no padding.
    """
    held: list[Piece] = []
    filled = 0
    for document, ids in documents:
        start = 0
        while start < len(ids):
            took = min(len(ids) - start, size - filled)
            held.append((document, ids, start, took))
            start, filled = start + took, filled + took
            if filled == size:
                yield held
                held, filled = [], 0
    while held:
        room = 1 << (filled.bit_length() - 1)
        filled -= room
        sequence = []
        while room:
            document, ids, start, length = held.pop(0)
            took = min(length, room)
            sequence.append((document, ids, start, took))
            room -= took
            if took < length:
                held.insert(0, (document, ids, start + took, length - took))
        yield sequence


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """One row for each piece of a document in a sequence.

    Returns key, start, length, ids_crc32, doc_tokens, sequence_id, offset and,
    unless ``with_ids`` is false, the piece's ``ids``. Every id of every
    document, the closing one included, lies in one piece. A null or blank text
    is the closing id alone; repeated rows are packed as often as they come; an
    empty table gives no rows. Each range of the curve fills its own sequences,
    and what it has left over becomes sequences of a power of two ids, so
    nothing is padded. Sequence numbers are unique, but ranges leave gaps
    between them. Other columns are left behind.
    """
    ready = cut(tokenise(docs, path, key, text), "packing")  # ranges are sampled from the keys alone
    ranges = ready.repartitionByRange("curve", "doc").sortWithinPartitions("curve", "doc", "ids")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray]]:
        for batch in batches:
            for doc, blob, width in zip(*(batch.column(c).to_pylist() for c in ("doc", "ids", "width")), strict=True):
                yield doc, np.frombuffer(blob, f"<u{width}")

    def written(rows: list[tuple[int, int, Piece]], kind: pa.DataType) -> pa.RecordBatch:
        ids = [x[start : start + length].astype("<u4") for _, _, (_, x, start, length) in rows]
        columns = {
            key: pa.array([p[0] for _, _, p in rows], kind),
            "start": pa.array([p[2] for _, _, p in rows], pa.int64()),
            "length": pa.array([p[3] for _, _, p in rows], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
            "doc_tokens": pa.array([len(p[1]) for _, _, p in rows], pa.int64()),
            "sequence_id": pa.array([s for s, _, _ in rows], pa.int64()),
            "offset": pa.array([o for _, o, _ in rows], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        kind = first.column("doc").type
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple[int, int, Piece]] = []
        for sequence in fill(documents(chain([first], batches)), size):
            offset = 0
            for piece in sequence:
                rows.append((number, offset, piece))
                offset += piece[3]
            number += 1
            if len(rows) >= 2000:
                yield written(rows, kind)
                rows = []
        if rows:
            yield written(rows, kind)

    kind = ready.schema["doc"].dataType.simpleString()
    out = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranges.mapInArrow(task, out + ", ids array<int>" * with_ids)
