"""Removal of repeated passages by a sparse suffix array over all documents.

A byte goes when a ``WINDOW``-byte string that covers it also starts anywhere
else, in any document. Only suffixes at anchors are sorted: the anchor of a
window is the place of the smallest hash among its first ``SPREAD`` eight-byte
groups, leftmost on ties. It depends on the window's bytes alone, so equal
windows have equal anchors, and the suffixes there share at least ``LEAD`` bytes.

1. Every anchor posts a hash of its leading bytes and one of its whole context
   (the bytes of all its windows). Grouped counts leave the anchors whose lead
   occurs again. Where all contexts of a lead agree, every window is repeated and
   no text moves at all.
2. For the rest, each distinct context is sent once. Sampled splitters (Spark's
   range partitioning) deal suffixes out by their leading bytes into buckets of about
   ``BUCKET``; more contexts make more buckets. Ties are split, so a lead that stands
   in a third of all rows is many buckets.
3. A bucket sorts its suffixes by multikey quicksort (eight bytes are one
   character; a level sorts only what is still tied), and the reversed left
   contexts likewise. Common prefix lengths turn both orders into classes: two
   windows at distance d from their anchors are equal when their suffixes agree on
   ``WINDOW - d`` bytes and their left contexts on d. This is exact.
4. Any two suffixes that can match share ``LEAD`` bytes, so only leads that stand on
   both sides of a boundary are left. Each bucket tells its first and last lead, and
   contexts of those in several buckets are compared across boundaries by halving:
   all windows at distances d to e share the bytes from d before the anchor to
   ``WINDOW - e`` after it. What is alone with these is done; where the bytes
   of all the windows occur again, they are all repeated; the rest is cut in two.
   At a passage's edge that is two rows a level instead of one row a window.

Texts are UTF-8 bytes; null and texts shorter than the window lose nothing. A
repeated row is another occurrence of its text. Rows are told apart by doc_id
(null is a value) and a hash of the text, and rows that agree in both have the
same result. Removal may cut a character; the kept bytes are therefore binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import joined_bytes, shuffle_partitions, staged, steps
from skyledger.session import scratch_dir

WINDOW = 200
SPREAD = 128  # a power of two
GRAM = 8
LEAD = WINDOW - SPREAD + 1
PIECE = 4 << 20
BUCKET = 20_000  # contexts in a bucket, about

ANCHOR_TYPE = "doc_id long, text_hash long, at long, left int, right int, lead long, whole long"


def window_anchors(raw: bytes, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of windows with one anchor: first window, last window, anchor (places in ``raw``).

    ``starts`` bounds the documents in ``raw``. Long input is handled in pieces
    that overlap by a window; a run at the border then comes as two.
    """
    for off in range(0, len(raw), PIECE):
        n = min(len(raw) - off, PIECE + WINDOW - 1)
        if n < WINDOW:
            continue
        grams = np.empty(n - GRAM + 1, dtype=np.uint64)
        for r in range(min(GRAM, len(grams))):
            count = (n - r) // GRAM
            grams[r::GRAM] = np.frombuffer(raw, dtype="<u8", count=count, offset=off + r)[:len(grams[r::GRAM])]
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width < SPREAD:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        windows = n - WINDOW + 1
        valid = np.zeros(windows + 1, dtype=np.int32)
        lo, hi = np.clip(starts[:-1] - off, 0, windows), np.clip(starts[1:] - off - WINDOW + 1, 0, windows)
        some = hi > lo
        np.add.at(valid, lo[some], 1)
        np.add.at(valid, hi[some], -1)
        at = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
        if not len(at):
            continue
        anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)) + 1
        first, last = np.concatenate(([0], new)), np.concatenate((new - 1, [len(at) - 1]))
        yield at[first] + off, at[last] + off, anchor[first] + off


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, "text"):
        data, starts = joined_bytes(step.column("text"))
        raw = data.tobytes()
        view, hash64 = memoryview(raw), xxhash.xxh3_64_intdigest
        for first, last, anchor in window_anchors(raw, starts):
            doc = np.searchsorted(starts, first, side="right") - 1
            f, a, l = first.tolist(), anchor.tolist(), last.tolist()
            lead = np.array([hash64(view[x:x + LEAD]) for x in a], dtype=np.uint64).view(np.int64)
            whole = np.array([hash64(view[x:z + WINDOW], y - x) for x, y, z in zip(f, a, l)], dtype=np.uint64).view(np.int64)
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id").take(take), step.column("text_hash").take(take), pa.array(anchor - starts[doc]),
                 pa.array((anchor - first).astype(np.int32)), pa.array((last + WINDOW - anchor).astype(np.int32)),
                 pa.array(lead), pa.array(whole)],
                ["doc_id", "text_hash", "at", "left", "right", "lead", "whole"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes left and right of each wanted anchor."""
    for step in steps(batches, "text"):
        out: dict[str, list] = {"lead": [], "whole": [], "n": [], "before": [], "after": []}
        raw = step.column("text").cast(pa.binary()).to_pylist()
        for text, wanted in zip(raw, step.column("wanted").to_pylist()):
            for w in wanted:
                at = w["at"]
                out["lead"].append(w["lead"])
                out["whole"].append(w["whole"])
                out["n"].append(w["n"])
                out["before"].append(text[at - w["left"]:at])
                out["after"].append(text[at:at + w["right"]])
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("lead", pa.int64()), ("whole", pa.int64()), ("n", pa.int64()), ("before", pa.binary()), ("after", pa.binary())]))


def sort_suffixes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of byte rows of equal width, and the common prefix length of neighbours in it."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    padded[:, :width] = rows
    letters = padded.view(">u8").astype(np.uint64)
    order = np.argsort(letters[:, 0], kind="stable")
    tied = letters[order[1:], 0] == letters[order[:-1], 0]
    for level in range(1, letters.shape[1]):
        if not tied.any():
            break
        group = np.concatenate(([0], np.cumsum(~tied)))
        inside = np.zeros(n, dtype=bool)
        inside[1:] |= tied
        inside[:-1] |= tied
        at = np.flatnonzero(inside)
        part = order[at]
        order[at] = part[np.lexsort((letters[part, level], group[at]))]
        now = letters[order, level]
        tied &= now[1:] == now[:-1]
    common = np.empty(max(0, n - 1), dtype=np.int64)
    for i in range(0, n - 1, 65536):
        j = min(i + 65536, n - 1)
        differ = rows[order[i + 1:j + 1]] != rows[order[i:j]]
        common[i:j] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


def _padded(values: list[bytes], width: int, backwards: bool = False) -> np.ndarray:
    if backwards:
        values = [v[::-1] for v in values]
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), dtype=np.uint8).reshape(-1, width)


def repeated_extent(before: list[bytes], after: list[bytes], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per context the first and last byte (exclusive) that repeated windows cover, from the anchor; both 0: none.

    Repeated windows of one anchor all cover the anchor, so what they cover is one run.
    """
    rows = len(before)
    left, right = np.array([len(b) for b in before]), np.array([len(a) for a in after])
    order_r, common_r = sort_suffixes(_padded(after, WINDOW))
    order_l, common_l = sort_suffixes(_padded(before, SPREAD, backwards=True))
    most, least = np.full(rows, -1), np.full(rows, SPREAD)
    class_r, class_l = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
    for d in range(SPREAD):
        use = np.flatnonzero((left >= d) & (right >= WINDOW - d))
        if len(use) < 2:
            continue
        class_r[order_r[1:]] = np.cumsum(common_r < WINDOW - d)
        class_l[order_l[1:]] = np.cumsum(common_l < d)
        class_r[order_r[0]] = class_l[order_l[0]] = 0
        _, where, count = np.unique(class_r[use] * rows + class_l[use], return_inverse=True, return_counts=True)
        again = use[count[where] > 1]
        most[again] = d
        least[again] = np.minimum(least[again], d)
    lo, hi = np.where(most >= 0, -most, 0), np.where(most >= 0, WINDOW - least, 0)
    many = n > 1
    return np.where(many, -left, lo), np.where(many, right, hi)


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeats among a bucket's contexts, and (without ``whole``) its first and last lead."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    bucket = pa.Table.from_batches(held).combine_chunks()
    after, number = bucket.column("after").to_pylist(), TaskContext.get().partitionId()
    lo, hi = repeated_extent(bucket.column("before").to_pylist(), after, bucket.column("n").to_numpy())
    found = pa.array(hi > lo)
    table = pa.table({
        "lead": bucket.column("lead"), "whole": bucket.column("whole"), "lo": pa.array(lo), "hi": pa.array(hi),
        "bucket": pa.array(np.full(len(after), number, dtype=np.int32))})
    yield from table.filter(found).to_batches(max_chunksize=50_000)
    ends = [pick(range(len(after)), key=after.__getitem__) for pick in (min, max)]
    edges = table.take(ends)
    yield from edges.set_column(1, "whole", pa.nulls(2, pa.int64())).to_batches()


NODE_TYPE = "lead long, whole long, open boolean, low int, before binary, after binary, core binary, span binary"


def _halves(width: int):
    """Both halves, ``width`` distances each, of every row's distances from ``low`` on.

    ``core`` is what all windows of a half have in common, ``span`` the bytes of all of them together,
    null where the context has only some. Halves without any window of the context are left out.
    """

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, low, core, span = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("low", "before", "after"))
            for k, (first, before, after) in enumerate(zip(*columns)):
                most, least = len(before), WINDOW - len(after)
                for d in (first, first + width):
                    e = d + width - 1
                    if d <= most and least <= e:
                        row.append(k)
                        low.append(d)
                        core.append(before[most - d:] + after[:WINDOW - e])
                        span.append(before[most - e:] + after[:WINDOW - d] if e <= most and least <= d else None)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(take) for c in ("lead", "whole", "open")], pa.array(low, pa.int32()),
                 *[batch.column(c).take(take) for c in ("before", "after")], pa.array(core, pa.binary()), pa.array(span, pa.binary())],
                ["lead", "whole", "open", "low", "before", "after", "core", "span"])

    return halves


def across_boundaries(contexts: DataFrame, within: str) -> list[DataFrame]:
    """Repeats of distinct contexts, wherever they are: lead, whole, lo, hi; a context may come with several.

    A row is open while its own windows are in question. Of rows whose windows all occur again one stays, closed,
    as long as open rows share its bytes, for these may share some of its windows.
    """
    found, width = [], SPREAD
    own, half, whole_span = F.struct("lead", "whole"), ["low", "core"], ["low", "core", "span"]
    rows = contexts.select("lead", "whole", (F.col("n") == 1).alias("open"), F.lit(0).alias("low"), "before", "after")
    while width > 1:
        width //= 2
        nodes = staged(rows.mapInArrow(_halves(width), NODE_TYPE), "repeat-halves", within)
        if not nodes.head(1):
            break
        groups = staged(nodes.groupBy(*whole_span).agg(
            F.count("*").alias("times"), F.max("open").alias("open"), F.min(own).alias("first")), "repeat-groups", within)
        again = groups.where("span IS NOT NULL AND times > 1").select(*whole_span, "first")
        judged = staged(nodes.join(again, whole_span, "left"), "repeat-judged", within)
        found.append(judged.where("open AND first IS NOT NULL").select(
            "lead", "whole", (1 - width - F.col("low")).cast("long").alias("lo"), (WINDOW - F.col("low")).cast("long").alias("hi")))
        asked = groups.groupBy(*half).agg(
            F.sum("times").alias("times"), F.max(F.col("open") & (F.col("span").isNull() | (F.col("times") == 1))).alias("open"))
        asked = asked.where("times > 1 AND open").select(*half)
        rows = judged.where(F.col("first").isNull() | (F.col("first") == own)).join(asked, half, "left_semi").select(
            "lead", "whole", (F.col("open") & F.col("first").isNull()).alias("open"), "low", "before", "after")
    return found


def repeated_extents(contexts: DataFrame) -> DataFrame:
    """Per context with repeated windows what these cover, from the anchor: lead, whole, lo, hi."""
    spark = contexts.sparkSession
    buckets = max(shuffle_partitions(spark), -(-contexts.count() // BUCKET))
    with scratch_dir(spark, "repeat-levels") as within:
        local = staged(contexts.repartitionByRange(buckets, "after", "whole").mapInArrow(
            _bucket, "lead long, whole long, lo long, hi long, bucket int"), "repeat-buckets", within)
        split = staged(local.where("whole IS NULL").groupBy("lead").agg(
            F.min("bucket").alias("a"), F.max("bucket").alias("z")).where("a < z").select("lead"), "repeat-split", within)
        extents = local.where("whole IS NOT NULL").select("lead", "whole", "lo", "hi")
        for found in across_boundaries(contexts.join(split, "lead", "left_semi"), within):
            extents = extents.unionByName(found)
        extents = extents.groupBy("lead", "whole").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        return staged(extents, "repeat-extents")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for step in steps(batches, "text"):
        spans, kept, sizes = [], [], []
        raw = step.column("text").cast(pa.binary()).to_pylist()
        for text, found in zip(raw, step.column("spans").to_pylist()):
            runs = merged([(s["lo"], s["hi"]) for s in found]) if found else []
            edges = [0, *(x for run in runs for x in run), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if runs else text)
            spans.append([{"start": a, "stop": b} for a, b in runs])
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [step.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"])


def _same(a: str, b: str):
    return (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``spans`` (maximal
    removed runs: start, stop) and ``kept`` (the remaining bytes)."""
    whole_text = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(whole_text).alias("text_hash"), whole_text.alias("text"))
    anchors = keyed.where(F.octet_length("text") >= WINDOW).mapInArrow(_anchors, ANCHOR_TYPE)
    leads = anchors.groupBy("lead").agg(
        F.count("*").alias("times"), (F.min("whole") != F.max("whole")).alias("differ")).where("times > 1").drop("times")
    leads = staged(leads, "repeat-leads")  # so the join below is one of its own, whose hot leads can be split
    again = staged(anchors.join(leads, "lead"), "repeat-anchors")

    key = F.struct("doc_id", "text_hash", "at", "left", "right")
    distinct = again.where("differ").groupBy("lead", "whole").agg(F.count("*").alias("n"), F.min(key).alias("k"))
    wanted = distinct.groupBy("k.doc_id", "k.text_hash").agg(
        F.collect_list(F.struct("lead", "whole", "n", "k.at", "k.left", "k.right")).alias("wanted"))
    contexts = keyed.alias("d").join(wanted.alias("w"), _same("d", "w")).select("d.text", "w.wanted").mapInArrow(
        _contexts, "lead long, whole long, n long, before binary, after binary")
    contexts = staged(contexts, "repeat-contexts")
    extents = repeated_extents(contexts)

    place = lambda lo, hi: F.struct((F.col("at") + lo).alias("lo"), (F.col("at") + hi).alias("hi"))
    spans = again.where(~F.col("differ")).select("doc_id", "text_hash", place(-F.col("left"), F.col("right")).alias("s")).unionByName(
        again.where("differ").join(extents, ["lead", "whole"]).select("doc_id", "text_hash", place(F.col("lo"), F.col("hi")).alias("s")))
    by_doc = spans.groupBy("doc_id", "text_hash").agg(F.collect_set("s").alias("spans"))
    return keyed.alias("d").join(by_doc.alias("s"), _same("d", "s"), "left").select(
        "d.doc_id", "d.text", "s.spans").mapInArrow(
        _remove, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
