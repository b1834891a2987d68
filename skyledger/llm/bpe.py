"""Byte-pair encoding and decoding with a word-ending vocabulary.

A text is cut at special strings, normalised, split into words, and every word
encoded on its own: its parts stand in one contiguous array beside the ranks of
adjacent parts; the smallest rank is found by scanning, its boundary deleted, and
the two neighbouring ranks refreshed. Words beyond ``SHORT`` symbols use a heap
of ranks over linked parts instead, so that a text without spaces stays far from
quadratic time. Both give the same ids. Distinct words are remembered per worker
process, in two generations of ``REMEMBERED``: when the younger is full it takes the
place of the older, so words that come again are kept. Decoding looks up the tokens'
strings of a whole batch at once.

The vocabulary file is read on the driver and sent to the tasks (a few MB, its
size does not depend on the data). Null texts are empty: no ids, empty decoded
text. Texts of any length are encoded whole. Repeated rows are encoded one by one.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm.common import steps, texts_of

SHORT = 64
REMEMBERED = 250_000
SHIFT = 24
LOWER = (1 << SHIFT) - 1
NO_RANK = 1 << 62
#: How the vocabulary's splitter tells words. No word holds white space, so its kinds need not be told apart.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
#: The same for a text of ASCII characters alone.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\t-\r A-Za-z0-9]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def lower_each(text: str) -> str:
    """Each character on its own, so a final sigma is like any other."""
    return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)


class WordTokens:
    """The tokens' strings alone, which is all that decoding needs."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        named = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        self.tokens = [""] * (1 + max(named.values()))
        for token, i in named.items():
            self.tokens[i] = token
        self.strings = pa.array(self.tokens, pa.string())

    def decode_all(self, ids: Sequence[bytes]) -> pa.Array:
        """For each ids the tokens' strings with a space between; special tokens are not skipped."""
        ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
        tokens = self.strings.take(pa.array(np.frombuffer(b"".join(ids), dtype="<u4")))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens), " ")

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0].as_py()


class WordBpe(WordTokens):
    """The vocabulary in the form that encoding and decoding need."""

    def __init__(self, raw: bytes):
        super().__init__(raw)
        spec = json.loads(raw)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.ending: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        letters = byte_letters()
        self.inner = [self.vocab.get(c) for c in letters]
        self.last = [self.vocab.get(c + self.ending) for c in letters]
        # Both sides in one number, and so are rank and result: a few MB in each worker.
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[left] << SHIFT | self.vocab[right]] = rank << SHIFT | self.vocab[left + right]
        # The four bytes of each id.
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.tokens))]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge_short(self, parts: list[int]) -> list[int]:
        """The contiguous rank array."""
        find = self.merges.get
        ranks = [find(a << SHIFT | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NO_RANK:
            i = ranks.index(best)
            parts[i] = merged = best & LOWER
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find(parts[i - 1] << SHIFT | merged, NO_RANK)
            if i < len(ranks):
                ranks[i] = find(merged << SHIFT | parts[i + 1], NO_RANK)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, from a heap; stale entries are skipped."""
        n, merges = len(parts), self.merges
        after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n

        def entry(i: int):
            j = after[i]
            found = merges.get(parts[i] << SHIFT | parts[j]) if j >= 0 else None
            return None if found is None else (found >> SHIFT, i, parts[i], parts[j])

        heap = [e for i in range(n) if (e := entry(i))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i] = merges[left << SHIFT | right] & LOWER
            alive[j] = False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (e := entry(k)):
                    heapq.heappush(heap, e)
        return [p for p, a in zip(parts, alive) if a]

    def encode_word(self, word: str) -> bytes:
        raw = word.encode("utf-8")
        parts = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        parts = [p for p in parts if p is not None]
        ids = self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)
        return b"".join([self.packed[i] for i in ids])

    def recall(self, word: str) -> bytes:
        """The ids of a word that the younger generation does not have."""
        packed = self.older.get(word)
        if packed is None:
            packed = self.encode_word(word)
        if len(word) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.special:
                out.append(self.packed[self.special[part]])
            elif part:
                if part.isascii():
                    words = ASCII_PIECES.findall(part.lower())
                else:
                    words = PIECES.findall(lower_each(unicodedata.normalize("NFC", part)))
                out += [self.known.get(w) or self.recall(w) for w in words]
        return b"".join(out)


_loaded: dict[tuple[str, type], WordBpe | WordTokens] = {}


def _of(shared: _Shared, kind: type) -> WordBpe | WordTokens:
    """One vocabulary of a kind per worker process."""
    key = (shared.id, kind)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = kind(shared.value)
    return _loaded[key]


class _Shared:
    """The vocabulary file's bytes as a broadcast, and its number."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            self._sent = spark.sparkContext.broadcast(file.read())
        self.id = uuid.uuid4().hex

    @property
    def value(self) -> bytes:
        return self._sent.value


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (binary: little-endian unsigned 32-bit integers) per row."""
    shared = _Shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _of(shared, WordBpe)
        for step in steps(batches, "text"):
            ids = [bpe.encode(t) for t in texts_of(step.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``; null ids are none."""
    shared = _Shared(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _of(shared, WordTokens)
        for step in steps(batches, "ids"):
            texts = tokens.decode_all([i or b"" for i in step.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [step.column(c) for c in ("doc_id", "n_tokens", "ids")] + [texts.cast(pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` and then ``decode`` of its ids, in one worker: ``doc_id``, ``n_tokens``, ``ids``, ``decoded``."""
    shared = _Shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _of(shared, WordBpe)
        for step in steps(batches, "text"):
            ids = [bpe.encode(t) for t in texts_of(step.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                 bpe.decode_all(ids).cast(pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
