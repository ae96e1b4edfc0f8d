"""Language identification with a byte convolutional network.

A text is cut into windows of fixed length; bytes are embedded, filters of
several widths slide over them, each filter keeps its maximum, and a softmax
gives a probability for each language. A text's probabilities are the mean of
its windows', weighted by their bytes. The network is trained with numpy in
the driver on a bounded sample of windows, and applied in batches in the tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textgrams
from tidemark.llm.tables import bound_batches

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
#: Windows that go through the network together: bounds a task's memory.
TOGETHER = 256


@dataclass(frozen=True)
class Settings:
    """Shape of the network and bounds of its training sample."""

    window: int = 192
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 10
    embedding: int = 6
    #: Expected number of sampled texts of each language, and windows of each; texts with fewer windows give fewer.
    texts_per_language: int = 500
    windows_per_text: int = 3
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 5


@dataclass
class Network:
    """Weights; byte 0 stands for padding."""

    languages: list[str]
    settings: Settings
    embed: np.ndarray = field(repr=False)
    kernels: list[np.ndarray] = field(repr=False)
    biases: list[np.ndarray] = field(repr=False)
    dense: np.ndarray = field(repr=False)
    dense_bias: np.ndarray = field(repr=False)

    @classmethod
    def fresh(cls, languages: list[str], s: Settings) -> Network:
        rng = np.random.default_rng(s.seed)
        draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(
            languages, s, draw(0.5, 256, s.embedding), [draw(1 / np.sqrt(w * s.embedding), w * s.embedding, s.filters) for w in s.widths],
            [np.zeros(s.filters, np.float32) for _ in s.widths], draw(0.3, len(s.widths) * s.filters, len(languages)), np.zeros(len(languages), np.float32),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embed, *self.kernels, *self.biases, self.dense, self.dense_bias]

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Maximum of every filter over each window, and where it was."""
        n, size = windows.shape
        d = self.settings.embedding
        x = self.embed[windows].reshape(n, size * d)
        values, places = [], []
        for width, kernel in zip(self.settings.widths, self.kernels, strict=True):
            steps = size - width + 1
            views = np.lib.stride_tricks.as_strided(x, (n, steps, width * d), (x.strides[0], 4 * d, 4))
            out = np.ascontiguousarray(views).reshape(n * steps, width * d) @ kernel
            out = out.reshape(n, steps, -1)
            places.append(out.argmax(axis=1))
            values.append(np.take_along_axis(out, places[-1][:, None, :], 1)[:, 0])
        return np.concatenate([v + b for v, b in zip(values, self.biases, strict=True)], axis=1), places

    def best(self, windows: np.ndarray) -> np.ndarray:
        """As ``pooled``, without the places: one product for all widths."""
        n, size = windows.shape
        d, widest = self.settings.embedding, max(self.settings.widths)
        x = self.embed[np.pad(windows, ((0, 0), (0, widest - 1)))].reshape(n, (size + widest - 1) * d)
        views = np.lib.stride_tricks.as_strided(x, (n, size, widest * d), (x.strides[0], 4 * d, 4))
        kernel = np.zeros((widest * d, self.settings.filters * len(self.kernels)), np.float32)
        for i, k in enumerate(self.kernels):
            kernel[: len(k), i * self.settings.filters : (i + 1) * self.settings.filters] = k
        out = (np.ascontiguousarray(views).reshape(n * size, widest * d) @ kernel).reshape(n, size, -1)
        f = self.settings.filters
        return np.concatenate([out[:, : size - w + 1, i * f : (i + 1) * f].max(axis=1) + self.biases[i] for i, w in enumerate(self.settings.widths)], axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(np.maximum(self.best(windows), 0) @ self.dense + self.dense_bias)

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy, in the order of ``weights``."""
        s, d = self.settings, self.settings.embedding
        pooled, places = self.pooled(windows)
        hidden = np.maximum(pooled, 0)
        error = softmax(hidden @ self.dense + self.dense_bias)
        error[np.arange(len(labels)), labels] -= 1
        error /= len(labels)
        back = (error @ self.dense.T) * (pooled > 0)
        embed = np.zeros_like(self.embed)
        kernels, biases = [], []
        for i, (width, kernel, place) in enumerate(zip(s.widths, self.kernels, places, strict=True)):
            part = back[:, i * s.filters : (i + 1) * s.filters]
            cells = np.take_along_axis(windows[:, None, :], place[:, :, None] + np.arange(width), 2)  # bytes under each maximum
            seen = self.embed[cells].reshape(len(windows), s.filters, width * d)
            kernels.append(np.einsum("nf,nfk->kf", part, seen))
            biases.append(part.sum(axis=0))
            np.add.at(embed, cells.ravel(), (part[:, :, None] * kernel.T[None]).reshape(-1, d))
        return [embed, *kernels, *biases, hidden.T @ error, error.sum(axis=0)]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], settings: Settings = Settings()) -> Network:
    """Adam over shuffled mini-batches; the same sample gives the same network."""
    net = Network.fresh(languages, settings)
    rng = np.random.default_rng(settings.seed)
    first, second = ([np.zeros_like(w) for w in net.weights] for _ in range(2))
    step = 0
    for epoch in range(settings.epochs):
        rate = settings.rate * 0.6**epoch
        order = rng.permutation(len(labels))
        for at in range(0, len(order), settings.batch):
            rows = order[at : at + settings.batch]
            step += 1
            for w, g, m, v in zip(net.weights, net.gradients(windows[rows], labels[rows]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    return net


def window_rows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text of the windows that cover every text end to end."""
    lengths = np.diff(offsets)
    count = -(-lengths // size)
    text = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][text] + number * size
    return start, np.minimum(size, offsets[1:][text] - start), text


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Windows as rows of bytes, filled up with zeros."""
    if not len(data):
        return np.zeros((len(starts), size), np.uint8)
    at = starts[:, None] + np.arange(size)
    return np.where(np.arange(size) < lengths[:, None], data[np.minimum(at, len(data) - 1)], 0)


def sample(rows: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Training windows of (id, text, lang): a bounded sample, drawn by a hash of the id.

    A language with more texts than ``texts_per_language`` gives about that
    many; the windows of a text are spread over its whole length. What comes to
    the driver is bounded by languages x texts x windows x window bytes.
    """
    sizes = rows.groupBy("lang").count().withColumn("share", F.least(F.lit(1.0), F.lit(float(settings.texts_per_language)) / F.col("count")))
    drawn = (F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), F.lit("train")), 11) / float(1 << 53)) < F.col("share")
    kept = rows.join(F.broadcast(sizes.select("lang", "share")), "lang").where(drawn)
    body, size, n = F.col("text").cast("binary"), settings.window, settings.windows_per_text
    step = F.greatest(F.lit(1), F.floor((F.octet_length("text") - size) / max(1, n - 1)))
    parts = [F.substring(body, 1 + (step * i).cast("int"), F.lit(size)).alias(f"w{i}") for i in range(n)]
    got = kept.select("lang", *parts).orderBy("lang", *(f"w{i}" for i in range(n))).collect()  # one order, however the rows lie
    languages = sorted({r["lang"] for r in got})
    windows, labels = [], []
    for r in got:
        for i in range(n):
            w = bytes(r[f"w{i}"] or b"")
            if w.strip():
                windows.append(np.frombuffer(w.ljust(size, b"\0"), np.uint8))
                labels.append(languages.index(r["lang"]))
    return np.array(windows).reshape(len(windows), size), np.array(labels, np.int64), languages


def predict(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """(key, lang_pred, score) of every whole text; with ``keep``, all columns of ``docs`` and these two.

    A text that is null or has no letter is ``und`` with score 0; with no
    network (nothing to learn from) all are. Equal means go to the language
    that sorts first. Repeated rows are judged one by one. Columns of ``docs``
    that are named like the added ones are replaced.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textgrams.slices(batch):
                lettered = np.array([x is not None and _LETTER.search(x) is not None for x in part.column("text").to_pylist()], bool)
                total = np.zeros((len(texts), len(net.languages) if net else 1))
                if net is not None:
                    starts, lengths, owner = window_rows(texts.data, texts.offsets, net.settings.window)
                    for at in range(0, len(starts), TOGETHER):
                        s, n = starts[at : at + TOGETHER], lengths[at : at + TOGETHER]
                        p = net.probabilities(gather(texts.data, s, n, net.settings.window)) * n[:, None]
                        np.add.at(total, owner[at : at + TOGETHER], p)
                mean = total / np.maximum(1, np.diff(texts.offsets))[:, None]
                known = lettered & (net is not None)
                names = [net.languages[i] if k else UNDETERMINED for i, k in zip(mean.argmax(axis=1), known)] if net else [UNDETERMINED] * len(texts)
                score = np.where(known, np.clip(mean.max(axis=1), 0, 1), 0.0)
                given = [part.column(i) for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays([*given, pa.array(names, pa.string()), pa.array(score)], names=[*part.schema.names, "lang_pred", "score"])

    all_columns = F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if keep else F.struct(F.col(f"`{key}`"))
    rows = docs.select(F.col(f"`{text}`").alias("text"), all_columns.alias("row"))
    found = rows.mapInArrow(task, f"text string, row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")
    return found.select("row.*", "lang_pred", "score")


def is_held_out(key: Column) -> Column:
    """Rows that are never learned from: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def held_out(key: object) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % 4 == 2


def learn(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network from the labelled rows that are not held out; None if there are none."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    windows, labels, languages = sample(rows.where("text IS NOT NULL AND lang IS NOT NULL").where(~is_held_out(F.col("id"))), settings)
    return train(windows, labels, languages, settings) if len(labels) else None
