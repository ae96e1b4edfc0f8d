"""BPE encoding and decoding with a pair occurrence index.

A task gathers the distinct words of its batch as one row of symbols and maps
every adjacent pair to all its positions. The pairs that occur are taken in
ascending rank; a merge is applied at all positions of its pair at once, and
only the lists of the neighbouring pairs change. A word is merged once however
often it occurs, and its ids are laid out for all its occurrences.

Words are lowered and cut by Python's tables of characters. Tables of another
version of Unicode differ from them in characters that one of the two doesn't
know, and in the order of marks that need composing. So words that need it, or
hold a character that is not printable (among them all unknown ones), are
normalised and cut by the rules of the file itself.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm import textgrams
from tidemark.llm.tables import bound_batches

#: Bytes of text in a slice: distinct words are gathered over this much.
BATCH_BYTES = 8 << 20
#: How words are cut before merging (fixed value of the vocabulary file).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A vocabulary file of the word kind: lower case, white space dropped, words end in a mark."""

    def __init__(self, source: str):
        found = json.loads(source)
        model = found["model"]
        self.vocabulary: dict[str, int] = dict(model["vocab"])
        self.special = {x["content"]: x["id"] for x in found["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.vocabulary.values(), *self.special.values()]))
        for token, i in [*self.vocabulary.items(), *self.special.items()]:
            self.tokens[i] = token
        self.encoded_tokens = [t.encode() for t in self.tokens]
        self.end = model["end_of_word_suffix"]
        letters = byte_letters()
        self.byte_of = {x: i for i, x in enumerate(letters)}
        rules = {**found, "model": {**model, "vocab": {}, "merges": []}, "added_tokens": []}
        self.rules = Tokenizer.from_str(json.dumps(rules))
        self.inner = np.array([self.vocabulary[x] for x in letters], np.int64)
        self.last = np.array([self.vocabulary[x + self.end] for x in letters], np.int64)
        self.width = len(self.tokens)
        made, products = {*self.inner.tolist(), *self.last.tolist()}, []
        pairs = np.zeros(len(model["merges"]), np.int64)
        for rank, (left, right) in enumerate(model["merges"]):
            a, b = self.vocabulary[left], self.vocabulary[right]
            if a not in made or b not in made:
                raise ValueError("a merge uses a token that no earlier merge makes")  # the ascending order relies on it
            pairs[rank] = a * self.width + b
            products.append(self.vocabulary[left + right])
            made.add(products[-1])
        self.product = np.array(products, np.int64)
        self.order = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.order]
        self.marks = regex.compile("|".join(regex.escape(x) for x in self.special)) if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, or the number of merges where none joins it."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.order[at], len(self.pairs))

    def pieces(self, word: bytes) -> list[bytes | int]:
        """What a run without white space is cut into: byte strings to merge, and ids of special tokens."""
        text = word.decode("utf-8", "replace")
        if self.marks is not None and "<" in text and self.marks.search(text):
            out: list[bytes | int] = []
            at = 0
            for m in self.marks.finditer(text):
                out += [*self._plain(text[at : m.start()]), self.special[m[0]]]
                at = m.end()
            return out + self._plain(text[at:])
        return self._plain(text)

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii():
            if not text.isprintable() or not unicodedata.is_normalized("NFC", text):
                lowered = self.rules.normalizer.normalize_str(text)
                return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in self.rules.pre_tokenizer.pre_tokenize_str(lowered)]
        # one character at a time where the last letter of a word would be lowered in another way
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return [text.encode()] if text.isalpha() else [x.encode() for x in PIECES.findall(text)]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (byte strings that are not empty) in a row, and how many each has."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        symbol = np.append(self.inner[raw], -1)
        symbol[ends - 1] = self.last[raw[ends - 1]]
        after = np.arange(1, n + 2)  # the place of the next symbol of the word; n: none
        after[ends - 1] = n
        before = np.arange(-1, n)
        before[ends - lengths] = n
        index: dict[int, list[np.ndarray]] = {}
        queue = self._index(symbol, after, np.arange(n), index)
        heapq.heapify(queue)
        while queue:
            rank = heapq.heappop(queue)
            at = index.pop(rank)
            at = _distinct(np.concatenate(at))
            pair = self.pairs_of(rank)
            at = at[(symbol[at] == pair[0]) & (symbol[after[at]] == pair[1])]  # others were merged away meanwhile
            if pair[0] == pair[1]:
                at = _apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            follower = after[gone]
            symbol[at] = self.product[rank]
            symbol[gone] = -1
            after[at] = follower
            before[follower] = at
            before[n] = n
            leader = before[at]
            changed = _distinct(np.concatenate([at, leader[leader < n]]))
            for new in self._index(symbol, after, changed, index):
                heapq.heappush(queue, new)
        kept = symbol[:n] >= 0
        return symbol[:n][kept].astype(np.uint32), np.diff(np.cumsum(kept)[ends - 1], prepend=0)

    def pairs_of(self, rank: int) -> tuple[int, int]:
        if not hasattr(self, "_by_rank"):
            by_rank = np.empty(len(self.pairs), np.int64)
            by_rank[self.order] = self.pairs
            self._by_rank = by_rank
        return divmod(int(self._by_rank[rank]), self.width)

    def _index(self, symbol: np.ndarray, after: np.ndarray, at: np.ndarray, index: dict[int, list[np.ndarray]]) -> list[int]:
        """Add the pairs that begin at ``at`` to the index; returns ranks that it did not have."""
        at = at[after[at] < len(symbol) - 1]
        rank = self.ranks(symbol[at], symbol[after[at]])
        at, rank = at[rank < len(self.pairs)], rank[rank < len(self.pairs)]
        if not len(at):
            return []
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        new = []
        bounds = [0, *cuts.tolist(), len(at)]
        for r, a, b in zip(rank[bounds[:-1]].tolist(), bounds, bounds[1:]):
            if r not in index:
                index[r] = []
                new.append(r)
            index[r].append(at[a:b])
        return new

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs without white space in a row, and how many each has."""
        number: dict[bytes | int, int] = {}
        order: list[int] = []
        counts = np.ones(len(words), np.int64)
        for i, word in enumerate(words):
            if word.islower() and word.isalpha():  # bytes: ASCII alone
                order.append(number.setdefault(word, len(number)))
            else:
                pieces = self.pieces(word)
                counts[i] = len(pieces)
                order.extend([number.setdefault(p, len(number)) for p in pieces])
        marks = {i: p for p, i in number.items() if isinstance(p, int)}
        merged, lengths = self.merge([b"!" if isinstance(p, int) else p for p in number])
        for i, special in marks.items():  # one id each, as the sign that stood in for them
            merged[lengths[:i].sum()] = special
        ids, _ = lay_out(np.array(order, np.int64), merged, lengths, np.zeros(1, np.int64))
        each = np.concatenate([[0], np.cumsum(lengths[order])])
        ends = np.cumsum(counts)
        return ids, each[ends] - each[ends - counts]

    def encode(self, texts: textgrams.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins."""
        codes, words, bounds = texts.pieces
        return lay_out(codes, *self.encode_words(words), bounds)

    def decode(self, ids: list[int]) -> bytes:
        """The file has no decoder, so tokens are written with a space between them."""
        return b" ".join(map(self.encoded_tokens.__getitem__, ids))


def _distinct(at: np.ndarray) -> np.ndarray:
    at.sort()
    return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places in ascending order, those that stay if each takes its follower with it."""
    kept, taken = [], set()
    for place, follower in zip(at.tolist(), after[at].tolist(), strict=True):
        if place not in taken:
            kept.append(place)
            taken.add(follower)
    return np.array(kept, np.int64)


def lay_out(codes: np.ndarray, ids: np.ndarray, lengths: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every occurrence of coded words in a row, and where each text begins in it.

    ``ids`` has those of the distinct words one after the other, ``lengths``
    how many each has, and ``bounds`` the occurrences before each text.
    """
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
    first = np.cumsum(lengths) - lengths
    each = lengths[codes]
    done = np.concatenate([[0], np.cumsum(each)])
    return ids[np.arange(done[-1]) + np.repeat(first[codes] - done[:-1], each)], done[bounds]


_loaded: dict[str, WordBpe] = {}


def vocabulary(source: str) -> WordBpe:
    """The vocabulary of a file's content, built once in each Python process."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = WordBpe(source)
    return _loaded[key]


def content(df: DataFrame, path: str):
    """The vocabulary file (a few MB at most) as a broadcast, so executors need no copy of it."""
    bound_batches(df.sparkSession)
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): every whole text as ids. Null and blank texts have none; rows keep their number."""
    file = content(df, path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(file.value)
        for batch in textgrams.gathered(batches, BATCH_BYTES):
            for part, texts in textgrams.slices(batch, "text", BATCH_BYTES):
                ids, starts = model.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("key"), lists], names=[key, "ids"])

    rows = df.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    return rows.mapInArrow(task, f"`{key}` {rows.schema['key'].dataType.simpleString()}, ids array<int>")


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): the tokens of ``ids`` with a space between them; null for null."""
    file = content(df, path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(file.value)
        for batch in batches:
            texts = [None if x is None else model.decode(x).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], names=[key, "text"])

    rows = df.selectExpr(f"`{key}` AS key", f"`{ids}` AS ids")
    return rows.mapInArrow(task, f"`{key}` {rows.schema['key'].dataType.simpleString()}, text string")


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode every whole text, decode the ids, and keep digests.

    Encoding and decoding happen in one task, so the ids themselves, several
    times the text in size, never leave it. A null or blank text has no tokens
    and the digests of nothing. Repeated rows and keys are rows of their own;
    other columns are left behind. An empty table gives no rows.
    """
    file = content(df, path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(file.value)
        for batch in textgrams.gathered(batches, BATCH_BYTES):
            for part, texts in textgrams.slices(batch, "text", BATCH_BYTES):
                ids, starts = model.encode(texts)
                raw = memoryview(ids.astype("<u4").tobytes())
                bounds = starts.tolist()
                spans = list(zip(bounds, bounds[1:]))
                encoded = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in spans]
                decoded = [hashlib.sha256(model.decode(ids[a:b].tolist())).hexdigest() for a, b in spans]
                columns = [part.column("key"), pa.array(np.diff(starts)), pa.array(encoded), pa.array(decoded)]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = df.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    return rows.mapInArrow(task, f"`{key}` {rows.schema['key'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
