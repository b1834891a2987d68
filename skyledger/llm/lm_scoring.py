"""Language-model scores from Brown classes.

Words are counted over all training documents. The ``HEAD`` most frequent words
are units of their own, all others form ``ENDINGS`` units by their last two
letters, so that the exchange has a bounded number of units while every word, and
every pair of neighbours in the corpus, counts. Exchange clustering moves each
unit to the class that raises the mutual information of adjacent classes most:
what a unit has left and right of it, by class, is a grouped sum over the unit
pairs; units are judged in blocks by many tasks against the class matrix of the
round (``CLASSES`` squared numbers), half of them in each round.

A text's score is the sum over tokens of log10 P(class | class before) and log10
P(word | class), both add-one smoothed; a word not seen in training is the one
unknown word of its unit's class. Words the size of ``LOOKUP`` are looked up in
the tasks; counts of all others are joined by grouped (document, word) pairs.

Tokens are the text's words and one end, which also stands before the first. A
null text is empty: one token. Words are told apart by a 64-bit hash. A null
doc_id is in training. Repeated rows are scored, and trained on, one by one.
Without training documents all classes are alike and the scores are those of
add-one smoothing over nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.common import staged, steps
from skyledger.llm.shingles import mixed, words

HEAD = 20_000
LOOKUP = 200_000
ENDINGS = 1024
CLASSES = 64
ROUNDS = 4
JUDGES = 64  # blocks of units
HELD_OUT = 2
GATHER = 8  # steps whose counts are combined in the task before they are sent on

END = np.uint64(0x5DEECE66D1234567)
STOP = HEAD + ENDINGS  # the unit of the end
UNITS = STOP + 1


def fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7


def tokens(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every token, the number of its text, and its word-ending unit (the end: STOP)."""
    word, text, ending = words(data)
    counts = np.bincount(text, minlength=len(data))
    stop = np.cumsum(counts)
    unit = HEAD + (mixed(ending.astype(np.uint64)) % np.uint64(ENDINGS)).astype(np.int64)
    return np.insert(word, stop, END), np.insert(text, stop, np.arange(len(data))), np.insert(unit, stop, STOP)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(where, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch], keys_of: Callable, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Counts of 64-bit keys, combined over some steps at a time."""
    keys, counts = [], []

    def flush():
        k, n = _summed(keys, counts)
        keys.clear()
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], list(names))

    for step in steps(batches, "text"):
        k, n = np.unique(keys_of([t or b"" for t in step.column("text").cast(pa.binary()).to_pylist()]), return_counts=True)
        keys.append(k)
        counts.append(n)
        if len(keys) == GATHER:
            yield flush()
    if keys:
        yield flush()


class Heads:
    """The most frequent words by hash, with their counts; the first ``HEAD`` are units."""

    def __init__(self, word: np.ndarray, count: np.ndarray):
        order = np.argsort(word)
        self.word, self.count = word[order], count[order]
        self.rank = order.astype(np.int64)

    def find(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word stands, and whether it does."""
        if not len(self.word):
            return np.zeros(len(word), dtype=np.int64), np.zeros(len(word), dtype=bool)
        at = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
        return at, self.word[at] == word

    def units(self, word: np.ndarray, ending: np.ndarray) -> np.ndarray:
        at, there = self.find(word)
        if not len(self.word):
            return ending
        rank = self.rank[at]
        return np.where(there & (rank < HEAD) & (ending != STOP), rank, ending)


def _x_log_x(n: np.ndarray) -> np.ndarray:
    return n * np.log(np.maximum(n, 1e-300))


def best_classes(left: np.ndarray, right: np.ndarray, now: np.ndarray, matrix: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """For each unit the class in which the class bigrams' likelihood is largest.

    ``left``/``right``: per unit the counts of the classes before and after it.
    Units that ``moves`` leaves out, and ties, stay.
    """
    classes, out = len(matrix), now.copy()
    before, after = matrix.sum(axis=1), matrix.sum(axis=0)
    for u in np.flatnonzero(moves):
        c, row, col = now[u], right[u], left[u]
        rest = matrix.copy()
        rest[c] -= row
        rest[:, c] -= col
        np.maximum(rest, 0, out=rest)
        b, a = before.copy(), after.copy()
        b[c] -= row.sum()
        a[c] -= col.sum()
        gain = (_x_log_x(rest + row[None, :]) - _x_log_x(rest)).sum(axis=1)
        gain += (_x_log_x(rest + col[:, None]) - _x_log_x(rest)).sum(axis=0)
        gain -= _x_log_x(np.maximum(b, 0) + row.sum()) - _x_log_x(np.maximum(b, 0))
        gain -= _x_log_x(np.maximum(a, 0) + col.sum()) - _x_log_x(np.maximum(a, 0))
        best = int(np.argmax(gain))
        if gain[best] > gain[c] + 1e-9:
            out[u] = best
    return out


def exchange(pairs: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit and the class bigram matrix. ``pairs``: key (first unit in the upper 32 bits), n."""
    classes = np.arange(UNITS) % CLASSES
    both = pairs.select(F.shiftright("key", 32).alias("u"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("v"), "n")

    def matrix_of(now: np.ndarray) -> np.ndarray:
        def count(batches):
            for batch in batches:
                u, v, n = (batch.column(c).to_numpy() for c in ("u", "v", "n"))
                cell = np.bincount(now[u] * CLASSES + now[v], weights=n, minlength=CLASSES * CLASSES)
                at = np.flatnonzero(cell)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cell[at].astype(np.int64))], ["cell", "n"])

        total = both.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros(CLASSES * CLASSES)
        out[total["cell"].to_numpy(dtype=int)] = total["n"].to_numpy(dtype=float)
        return out.reshape(CLASSES, CLASSES)

    def contexts_of(now: np.ndarray) -> Callable:
        """Per unit: what stands after it (slots from 0) and before it (slots from CLASSES), by class."""

        def contexts(batches):
            for batch in batches:
                u, v, n = (batch.column(c).to_numpy() for c in ("u", "v", "n"))
                keys = np.concatenate((u * 2 * CLASSES + now[v], v * 2 * CLASSES + CLASSES + now[u]))
                key, total = _summed([keys], [np.concatenate((n, n))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key // (2 * CLASSES)), pa.array(key % (2 * CLASSES)), pa.array(total)], ["unit", "slot", "n"])

        return contexts

    def judge_of(now: np.ndarray, matrix: np.ndarray, turn: int) -> Callable:
        def judge(block: pa.Table) -> pa.Table:
            unit, slot, n = (block.column(c).to_numpy() for c in ("unit", "slot", "n"))
            own, at = np.unique(unit, return_inverse=True)
            sides = np.zeros((len(own), 2 * CLASSES))
            np.add.at(sides, (at, slot), n)
            moves = (own // JUDGES) % 2 == turn % 2
            found = best_classes(sides[:, CLASSES:], sides[:, :CLASSES], now[own], matrix, moves)
            return pa.table({"unit": own, "class": found})

        return judge

    for turn in range(rounds):
        matrix = matrix_of(classes)
        sides = both.mapInArrow(contexts_of(classes), "unit long, slot long, n long").groupBy("unit", "slot").agg(F.sum("n").alias("n"))
        moved = sides.groupBy((F.col("unit") % JUDGES).alias("judge")).applyInArrow(judge_of(classes, matrix, turn), "unit long, class long").toPandas()
        classes = classes.copy()
        classes[moved["unit"].to_numpy(dtype=int)] = moved["class"].to_numpy(dtype=int)
    return classes, matrix_of(classes)


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words with the largest counts, at most ``most``; words with one count are all in or all out.

    The limit is found on the table of distinct counts, so that no task has to
    send its own ``most`` words anywhere.
    """
    above = Window.orderBy(F.col("n").desc())
    least = (counts.groupBy("n").agg(F.count("*").alias("words"))
             .withColumn("total", F.sum("words").over(above)).where(F.col("total") <= most).agg(F.min("n")).head()[0])
    return counts.where(F.col("n") >= least) if least is not None else counts.limit(0)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
        F.coalesce(fold(doc_id) == HELD_OUT, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    training = rows.where("NOT held_out").select("text")

    def count_words(batches):
        return _gathered(batches, lambda data: tokens(data)[0], ("word", "n"))

    counts = staged(training.mapInArrow(count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    size = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).head()
    n_all, v_all = int(size["n"] or 0), int(size["v"])
    top = frequent(counts, LOOKUP).toPandas().sort_values(["n", "word"], ascending=[False, True])
    heads = Heads(top["word"].to_numpy(dtype=np.int64).view(np.uint64), top["n"].to_numpy(dtype=np.int64))
    sent = docs.sparkSession.sparkContext.broadcast(heads)

    def pair_keys(data):
        word, text_no, ending = tokens(data)
        unit = sent.value.units(word, ending)
        before = np.concatenate(([STOP], unit[:-1]))  # the end of the text before is the start of this one
        return (before.astype(np.uint64) << np.uint64(32)) | unit.astype(np.uint64)

    def count_pairs(batches):
        return _gathered(batches, pair_keys, ("key", "n"))

    pairs = staged(training.mapInArrow(count_pairs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "lm-pairs")
    classes, matrix = exchange(pairs)

    def count_kinds(batches):
        """Distinct training words per unit."""
        for step in steps(batches, "text"):
            word, _, ending = tokens([t or b"" for t in step.column("text").cast(pa.binary()).to_pylist()])
            word, first = np.unique(word, return_index=True)
            unit = sent.value.units(word, ending[first])
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(unit)], ["word", "unit"])

    kinds = training.mapInArrow(count_kinds, "word long, unit long").groupBy("word").agg(F.first("unit").alias("unit"))
    per_unit = kinds.groupBy("unit").agg(F.count("*").alias("v")).toPandas()
    distinct = np.zeros(UNITS)
    distinct[per_unit["unit"].to_numpy(dtype=int)] = per_unit["v"].to_numpy(dtype=float)
    in_class = np.bincount(classes, weights=distinct, minlength=CLASSES)
    moves = np.log10((matrix + 1) / (matrix.sum(axis=1, keepdims=True) + CLASSES))
    room = np.log10(matrix.sum(axis=0) + in_class + 1)

    def score_texts(batches):
        """What the tables in the task can tell, and the words they cannot."""
        for step in steps(batches, "text"):
            data = [t or b"" for t in step.column("text").cast(pa.binary()).to_pylist()]
            word, text_no, ending = tokens(data)
            kind = classes[sent.value.units(word, ending)]
            first = np.concatenate(([True], text_no[1:] != text_no[:-1]))
            before = np.where(first, classes[STOP], np.concatenate(([0], kind[:-1])))
            at, there = sent.value.find(word)
            c = sent.value.count[at] if len(sent.value.word) else np.zeros(len(word))
            add = lambda x: np.bincount(text_no, weights=x, minlength=len(data))
            rare, times = np.unique(np.rec.fromarrays([text_no[~there], word[~there]]), return_counts=True)
            begin = np.searchsorted(rare.f0, np.arange(len(data) + 1)).astype(np.int32)
            lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(begin), pa.array(x, kind))
            yield pa.RecordBatch.from_arrays(
                [step.column("row"), step.column("doc_id"), step.column("held_out"),
                 pa.array(np.bincount(text_no, minlength=len(data))), pa.array(add(there).astype(np.int64)),
                 pa.array(add(np.where(there, np.log10(c + 1.0), 0.0))), pa.array(add(moves[before, kind] - room[kind])),
                 lists(np.ascontiguousarray(rare.f1).view(np.int64), pa.int64()), lists(times, pa.int64())],
                ["row", "doc_id", "held_out", "n_tokens", "known", "counted", "classed", "rare", "times"])

    kind = docs.schema[doc_id].dataType.simpleString()
    told = staged(rows.mapInArrow(
        score_texts, f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, counted double, classed double, "
        "rare array<long>, times array<long>"), "lm-told")
    rare = told.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    joined = rare.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_counted"))
    counted = F.col("counted") + F.coalesce("more_counted", F.lit(0.0))
    return told.select("row", "doc_id", "held_out", "n_tokens", "known", "counted", "classed").join(joined, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * float(np.log10(max(1, n_all + v_all + 1)))).alias("base_score"),
        (counted + F.col("classed")).alias("score"))
