"""Ranked lexical search: the k best documents for each item, by exact integer scores.

Method: range-maximum sparse tables per posting list. Documents are dealt to shards of a bounded number
of postings, and every shard answers every item by best-first search. A shard keeps its postings sorted
by (term, place of the document), with one sparse table over them: entry (j, i) is where the largest
impact of the 2^j postings from i lies, so two entries answer the maximum of any range of a list. The
search starts from the interval of all documents. The interval with the highest bound, the sum of its
terms' range maxima by weight, is taken next and split at the document with the largest single impact:
that document is scored, the two intervals beside it are bounded and queued. Intervals of at most
``WHOLE`` documents are scored at once instead of being split further. The search ends when the highest
bound lies below the k-th score found. The documents of a shard stand in the order of their most frequent
query term, so that documents alike (in one language, say) share intervals and fall with one bound.

Only postings of the items' own terms are kept. Items are dealt to blocks, and each block has its own
postings in each shard, so a task's memory depends on neither the number of items nor that of documents;
a shard hands on k rows an item, which are ranked once more over all shards.

Weights use counts over all documents. Scores are sums of integers, so results do not depend on shards.

Defined cases: null and empty texts have no terms, take no part and do not count; an item without terms
or hits has no rows; a repeated row is a document (or an item) of its own; equal scores go by doc_id,
a missing doc_id first; texts of any length are counted whole, in pieces; without documents or items there
are no rows; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import STEP_BYTES, staged, steps
from skyledger.operators import rank_top_per_group

#: Postings of one block of items in one shard, about; a document is never cut.
POSTINGS = 1 << 20
#: Items that share one block.
ITEMS = 256
#: Documents of an interval that is scored whole.
WHOLE = 128

#: The term number of a document's own row, which carries its length.
LENGTH = -1
#: What a missing doc_id counts as.
MISSING = -(1 << 63)

# Terms are runs of ASCII digits and letters and of everything beyond ASCII, with A-Z lowered.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))


def count_terms(text: bytes) -> Counter:
    """How often each term stands in a text, counted piece by piece."""
    text = text.translate(_LETTERS)
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        stop = text.find(b" ", at + STEP_BYTES)
        stop = len(text) if stop < 0 else stop
        counts.update(text[at:stop].split())
        at = stop
    return counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with their counts; a text with any gets one more, the empty term with the length."""
    for batch in steps(batches, "text"):
        terms, counts, ends = [], [], [0]
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            found = count_terms(text) if text else None
            if found:
                terms.append(b"")
                counts.append(found.total())
                terms.extend(found)
                counts.extend(found.values())
            ends.append(len(terms))
        offsets = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), batch.column("id"),
            pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
            pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))], names=["row", "id", "terms", "counts"])


def term_rows(table: DataFrame, key: str) -> DataFrame:
    """(row, id, term, tf): one row per text and term, and one per text with terms for its length, with the empty term."""
    counted = table.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("id"), "text"
    ).mapInArrow(_counted, "row long, id long, terms array<string>, counts array<int>")
    return counted.select("row", "id", F.inline(F.arrays_zip("terms", "counts"))).toDF("row", "id", "term", "tf")


class Lists(NamedTuple):
    """The postings of one shard in (term, place) order, with their sparse table of range maxima."""

    places: int
    keys: np.ndarray
    impacts: np.ndarray
    table: np.ndarray
    terms: np.ndarray


def sparse_table(values: np.ndarray, longest: int) -> np.ndarray:
    """Entry (j, i): the first place of the maximum of ``values[i : i + 2^j]``, for ranges up to ``longest``."""
    levels = max(1, int(longest).bit_length())
    table = np.empty((levels, len(values)), dtype=np.int32)
    table[0] = np.arange(len(values))
    for j in range(1, levels):
        half = 1 << (j - 1)
        table[j] = table[j - 1]
        left, right = table[j - 1][:-half], table[j - 1][half:]
        table[j][:-half] = np.where(values[left] >= values[right], left, right)
    return table


def make_lists(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, norm: np.ndarray) -> tuple[Lists, np.ndarray]:
    """The lists of postings (document number, term, tf), and the document number at each place."""
    terms, local = np.unique(term, return_inverse=True)
    # The order of documents: by their most frequent term, then scattered.
    last = np.lexsort((local, tf, doc))
    last = last[np.append(doc[last][1:] != doc[last][:-1], True)] if len(last) else last
    common = np.full(len(norm), -1, dtype=np.int64)
    common[doc[last]] = local[last]
    scattered = (np.arange(len(norm), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    at_place = np.lexsort((scattered, common))
    place = np.empty(len(norm), dtype=np.int64)
    place[at_place] = np.arange(len(norm))
    impact = (1_000_000_000 * tf) // (1000 * tf + 20 * norm[doc])
    keys = local * len(norm) + place[doc]
    order = np.argsort(keys, kind="stable")
    keys, impact = keys[order], impact[order]
    return Lists(len(norm), keys, impact, sparse_table(impact, len(norm)), terms), at_place


class Interval(NamedTuple):
    """Documents ``low`` to ``high`` with each list's range in it, best bound first."""

    worst: int
    low: int
    high: int
    begins: np.ndarray
    ends: np.ndarray
    pivot: int


_LOG = np.array([max(0, n.bit_length() - 1) for n in range(1 << 12)], dtype=np.int64)


def _floor_log2(n: np.ndarray) -> np.ndarray:
    return np.where(n < len(_LOG), _LOG[np.minimum(n, len(_LOG) - 1)], np.frexp(n.astype(np.float64))[1] - 1)


class Search:
    """Best-first search of one shard for one item."""

    def __init__(self, lists: Lists, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, whole: int = WHOLE):
        at = np.searchsorted(lists.terms, terms)
        known = (at < len(lists.terms)) & (lists.terms[np.minimum(at, len(lists.terms) - 1)] == terms)
        self.lists, self.ids, self.k, self.whole = lists, ids, k, whole
        self.weights = weights[known]
        self.starts = at[known] * lists.places
        self.found: list[tuple[int, int]] = []  # the k best so far: (score, -doc_id), the worst on top

    def bound(self, low: int, high: int, begins: np.ndarray, ends: np.ndarray) -> Interval | None:
        """The interval with its bound, or None where it cannot hold a result."""
        sizes = ends - begins
        some = sizes > 0
        if not some.any():
            return None
        begins, ends = begins[some], ends[some]
        level = _floor_log2(sizes[some])
        lists = self.lists
        left, right = lists.table[level, begins], lists.table[level, ends - (1 << level)]
        maxima = np.where(lists.impacts[left] >= lists.impacts[right], left, right)
        parts = self.weights[some] * lists.impacts[maxima]
        total = int(parts.sum())
        if total <= 0 or total < self.least():
            return None
        pivot = int(lists.keys[maxima[parts.argmax()]] % lists.places)
        whole_begins, whole_ends = np.zeros_like(sizes), np.zeros_like(sizes)
        whole_begins[some], whole_ends[some] = begins, ends
        return Interval(-total, low, high, whole_begins, whole_ends, pivot)

    def least(self) -> int:
        """The score that a document must reach; an equal one may still win by its id."""
        return self.found[0][0] if len(self.found) == self.k else 1

    def keep(self, place: int, score: int) -> None:
        entry = (score, -int(self.ids[place]))
        if len(self.found) < self.k:
            heapq.heappush(self.found, entry)
        else:
            heapq.heappushpop(self.found, entry)

    def score_whole(self, interval: Interval) -> None:
        sizes = interval.ends - interval.begins
        list_of = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(list_of)) + np.repeat(interval.begins - (np.cumsum(sizes) - sizes), sizes)
        place = self.lists.keys[at] - self.starts[list_of] - interval.low
        # Sums of integers far below 2^53, so doubles are exact.
        scores = np.bincount(place, self.weights[list_of] * self.lists.impacts[at]).astype(np.int64)
        for i in np.flatnonzero(scores >= self.least()):
            if scores[i] >= self.least():
                self.keep(interval.low + int(i), int(scores[i]))

    def split(self, interval: Interval) -> Iterator[Interval | None]:
        lists, p = self.lists, interval.pivot
        wanted = self.starts + p
        middle = np.clip(np.searchsorted(lists.keys, wanted), interval.begins, interval.ends)
        here = (middle < interval.ends) & (lists.keys[np.minimum(middle, len(lists.keys) - 1)] == wanted)
        score = int((self.weights[here] * lists.impacts[middle[here]]).sum())
        if score >= self.least():
            self.keep(p, score)
        yield self.bound(interval.low, p, interval.begins, middle)
        yield self.bound(p + 1, interval.high, middle + here, interval.ends)

    def run(self) -> list[tuple[int, int]]:
        """(score, doc_id) of the k best."""
        lists, order = self.lists, 0
        queue: list[tuple[int, int, Interval]] = []
        first = self.bound(
            0, lists.places, np.searchsorted(lists.keys, self.starts),
            np.searchsorted(lists.keys, self.starts + lists.places)) if len(self.starts) else None
        if first:
            queue.append((first.worst, order, first))
        while queue:
            worst, _, interval = heapq.heappop(queue)
            if -worst < self.least():
                break
            if interval.high - interval.low <= self.whole:
                self.score_whole(interval)
                continue
            for part in self.split(interval):
                if part:
                    order += 1
                    heapq.heappush(queue, (part.worst, order, part))
        return [(score, -negative) for score, negative in self.found]


def _searcher(documents: int, length: int, k: int, whole: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search_shard(postings: pa.Table, items: pa.Table) -> pa.Table:
        term, tf, row = (postings.column(c).to_numpy() for c in ("term_no", "tf", "row"))
        lengths = term == LENGTH
        order = np.argsort(row[lengths], kind="stable")
        rows = row[lengths][order]
        ids = postings.column("id").fill_null(MISSING).to_numpy()[lengths][order]
        norm = np.array([100 - 50 + 50 * int(n) * documents // length for n in tf[lengths][order]], dtype=np.int64)
        out: list[tuple[int, int, int, int]] = []
        doc = np.searchsorted(rows, row[~lengths])
        if len(doc) and items.num_rows:
            lists, at_place = make_lists(doc, term[~lengths], tf[~lengths].astype(np.int64), norm)
            for item, item_id, terms, weights in zip(*(items.column(c).to_pylist() for c in ("item", "item_id", "terms", "weights"))):
                search = Search(lists, ids[at_place], np.array(terms, dtype=np.int64), np.array(weights, dtype=np.int64), k, whole)
                out += [(item, item_id, None if i == MISSING else i, score) for score, i in search.run()]
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return search_shard


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int, item_key: str = "item_id", doc_key: str = "doc_id",
    per_shard: int = POSTINGS, per_block: int = ITEMS, whole: int = WHOLE,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the ``k`` documents with the highest score above 0.

    Postings per shard, items per block and documents scored at once set only the cost, not the result.
    """
    spark = docs.sparkSession
    asked = staged(term_rows(items, item_key).where(F.col("term") != ""), "search-items")
    blocks = max(1, -(-asked.select("row").distinct().count() // per_block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    numbers = staged(
        asked.select("term").distinct().withColumn("term_no", F.monotonically_increasing_id()), "search-terms")
    # Written, so that Spark knows its size: a small one is broadcast, and no text's terms are shuffled for it.
    wanted = staged(asked.select("block", "term").distinct().join(numbers, "term").unionByName(
        spark.range(blocks).select(
            F.col("id").cast("int").alias("block"), F.lit("").alias("term"), F.lit(LENGTH).cast("long").alias("term_no"))),
        "search-wanted")
    postings = staged(term_rows(docs, doc_key).join(wanted, "term").select(
        "block", "row", "term_no", "tf", F.when(F.col("term_no") == LENGTH, F.col("id")).alias("id")), "search-postings")

    counts = staged(
        postings.groupBy("block", "term_no").agg(F.count("*").alias("df"), F.sum("tf").alias("total")), "search-counts")
    lengths = counts.where((F.col("term_no") == LENGTH) & (F.col("block") == 0)).first()
    if lengths is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    documents, length = lengths["df"], lengths["total"]
    weight = F.floor(1000 * F.log((2 * F.lit(documents) + 2).cast("double") / (2 * F.col("df") + 1)))
    largest = counts.groupBy("block").agg(F.sum("df").alias("rows")).agg(F.max("rows")).first()[0]
    shards = -(-largest // per_shard)

    weighted = asked.join(numbers, "term").join(
        counts.where(F.col("term_no") != LENGTH), ["block", "term_no"]).withColumn("weight", weight.cast("long"))
    # One order of terms, so that both arrays agree.
    questions = weighted.groupBy("block", F.col("row").alias("item"), F.col("id").alias("item_id")).agg(
        F.sort_array(F.collect_list(F.struct("term_no", "weight"))).alias("terms"))
    questions = questions.select(
        "block", "item", "item_id", F.col("terms.term_no").alias("terms"), F.col("terms.weight").alias("weights"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    found = postings.withColumn("shard", shard).groupBy("block", "shard").cogroup(
        questions.groupBy("block", "shard")).applyInArrow(
        _searcher(documents, length, k, whole), "item long, item_id long, doc_id long, score long")
    ranked = rank_top_per_group(found, ["item"], [F.desc("score"), F.col("doc_id")], k)
    return ranked.select("item_id", "rank", "doc_id", "score")
