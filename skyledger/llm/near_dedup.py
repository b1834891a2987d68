"""Near-duplicates by an inverted join over MinHash signature coordinates.

A document's set is its distinct five-word shingles. Documents with equal sets
form a class, and everything after works on classes, so copies cost nothing.
Every class is posted under each (coordinate, value) pair of its ``COORDINATES``
minima. A pair of classes counts as a candidate when at least ``MATCHES``
coordinates agree: at a similarity of 0.75, 48 of 64 are expected, and fewer than
29 come with a probability of 1e-7. Prefix: pairs that only one class has are
skipped, the others ordered rarest first, and the last ``MATCHES - 1`` are not
posted, for two classes with that many agreements must meet in the rest; a class
with too few shared pairs is done. Common passages thus stay out of the postings.

For the classes left, every shingle of the whole texts is counted. What a class
shares with any other bounds what it shares with one, so a class (or a pair) whose
shared shingles are too few for the wanted similarity is out. This is exact.

Large groups are not expanded into pairs. First every class is compared with one
class of each posting it stands in, the one whose shingles are most common (in a
group of edited copies, the original): a star, linear in the postings. The links
are confirmed on whole sets of words, and their components are found. What is left
are classes that meet others outside their own component. In each posting those
not of its largest component are compared with the rest, not pair by pair in a
join but in blocks: classes with one favourite hub form blocks of about ``BLOCK``,
an open class goes once to each block in which it meets anyone, and a task counts
the whole sets' overlaps with all classes of the block. Links found there join the
components. Every candidate pair is thus either compared or already connected, so
no link that would join two components is lost.

No words, null or empty text: an empty set, linked with nothing. Repeated rows
and copies are one class. A null doc_id takes part, but never names a component;
a component of null ids alone has a null id and keeps all its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.common import decided_rows, staged, steps
from skyledger.llm.components import components
from skyledger.llm.shingles import shingle_set, shingles
from skyledger.session import scratch_dir, session_conf

WIDTH = 5
COORDINATES = 64
MATCHES = 29
PERCENT = 75
BLOCK = 512
CHUNK = 4096

#: Rows that a task hands to its Python worker at a time. Texts are wide, and both sides hold whole batches.
BATCH_ROWS = 256

_seeds = np.random.default_rng(20240501)
_XOR = _seeds.integers(0, 1 << 64, COORDINATES, dtype=np.uint64)
_ODD = _seeds.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, "text"):
        data = [t or b"" for t in step.column("text").cast(pa.binary()).to_pylist()]
        hashes, starts = shingles(data, WIDTH)
        some = np.flatnonzero(starts[1:] > starts[:-1])
        least = np.zeros((len(data), COORDINATES), dtype=np.uint64)
        if len(some):
            for k in range(COORDINATES):
                least[some, k] = np.minimum.reduceat((hashes ^ _XOR[k]) * _ODD[k], starts[some])
        sizes, classes = [], []
        for a, b in zip(starts.tolist(), starts[1:].tolist()):
            distinct = np.unique(hashes[a:b])
            sizes.append(len(distinct))
            classes.append(xxhash.xxh3_128_digest(distinct.tobytes()) if b > a else None)
        signature = pa.ListArray.from_arrays(
            pa.array(np.arange(len(data) + 1, dtype=np.int32) * COORDINATES), pa.array(least.view(np.int64).ravel()))
        yield pa.RecordBatch.from_arrays(
            [step.column("doc_id"), step.column("text_hash"), pa.array(sizes, pa.int64()),
             pa.array(classes, pa.binary()), signature],
            ["doc_id", "text_hash", "n_shingles", "class", "signature"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether the whole sets of two texts are similar enough; b comes in runs."""
    last, last_set = None, frozenset()
    for step in steps(batches, "text_a"):
        a_ids, b_ids = step.column("a").to_pylist(), step.column("b").to_pylist()
        texts_a, texts_b = step.column("text_a").cast(pa.binary()), step.column("text_b").cast(pa.binary())
        linked = []
        for i, b in enumerate(b_ids):
            if b != last:
                last, last_set = b, shingle_set(texts_b[i].as_py(), WIDTH)
            own = shingle_set(texts_a[i].as_py(), WIDTH)
            both = len(own & last_set)
            linked.append(100 * both >= PERCENT * (len(own) + len(last_set) - both))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a_ids, pa.binary()), pa.array(b_ids, pa.binary()), pa.array(linked)], ["a", "b", "linked"])


def _compared(pairs: DataFrame, classes: DataFrame, texts: DataFrame, work: str) -> DataFrame:
    """Pairs of classes (a, b) whose signatures agree often enough, with the exact answer."""
    sig = lambda n: classes.select(F.col("class").alias(n), F.col("signature").alias(f"sig_{n}"))
    text = lambda n: texts.select(F.col("class").alias(n), F.col("text").alias(f"text_{n}"))
    agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda same: same))
    close = pairs.join(sig("a"), "a").join(sig("b"), "b").where(agree >= MATCHES).select("a", "b")
    close = staged(close, "near-close", work)
    return staged(close.join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(
        _confirm, "a binary, b binary, linked boolean"), "near-compared", work)


def _shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every distinct shingle of every class."""
    for step in steps(batches, "text"):
        hashes, starts = shingles([t or b"" for t in step.column("text").cast(pa.binary()).to_pylist()], WIDTH)
        each = [np.unique(hashes[a:b]) for a, b in zip(starts.tolist(), starts[1:].tolist())]
        owner = np.repeat(np.arange(len(each)), [len(e) for e in each])
        yield pa.RecordBatch.from_arrays(
            [step.column("class").take(pa.array(owner)), pa.array(np.concatenate(each).view(np.int64))], ["class", "shingle"])


def _reaches(shared, sizes):
    """Whether an overlap of ``shared`` suffices for sets with ``sizes`` shingles together."""
    return (100 + PERCENT) * shared >= PERCENT * sizes


def _comparable(x: str, y: str):
    """What the sizes and the shared shingles of two classes allow."""
    c = lambda side, name: F.col(f"{side}.{name}")
    return (100 * F.least(c(x, "n"), c(y, "n")) >= PERCENT * F.greatest(c(x, "n"), c(y, "n"))) & _reaches(
        F.least(c(x, "shared"), c(y, "shared")), c(x, "n") + c(y, "n"))


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every class with its whole set, as packed hashes."""
    for step in steps(batches, "text"):
        hashes, starts = shingles([t or b"" for t in step.column("text").cast(pa.binary()).to_pylist()], WIDTH)
        packed = [np.unique(hashes[a:b]).tobytes() for a, b in zip(starts.tolist(), starts[1:].tolist())]
        yield pa.RecordBatch.from_arrays([step.column("class"), pa.array(packed, pa.binary())], ["class", "set"])


def _linked_in_block(open_: pa.Table, block: pa.Table) -> pa.Table:
    """Links from open classes to the classes of one block, one for each component met."""
    out: dict[str, list] = {"a": [], "b": []}
    if open_.num_rows and block.num_rows:
        names, roots = block.column("class").to_pylist(), block.column("root").to_pylist()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in block.column("set").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        for own, root, packed in zip(*(open_.column(c).to_pylist() for c in ("class", "root", "set"))):
            x = np.frombuffer(packed, dtype=np.uint64)
            lo, hi = np.searchsorted(every, x, "left"), np.searchsorted(every, x, "right")
            length = hi - lo
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            found = {roots[i]: names[i] for i in np.flatnonzero(_reaches(both, sizes + len(x))) if roots[i] != root}
            out["a"] += [own] * len(found)
            out["b"] += found.values()
    return pa.table(out, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))


def _across(met: DataFrame, roots: DataFrame, texts: DataFrame, work: str) -> DataFrame:
    """Links (a, b) between classes that meet in a posting but have different roots."""
    placed = staged(met.join(roots, met["class"] == roots["node"], "left").select(
        "pair", "class", F.col("hub.class").alias("hub"), F.coalesce("root", "class").alias("root")), "near-placed", work)
    per_root = placed.groupBy("pair", "root").agg(F.count("*").alias("n"))
    largest = staged(per_root.groupBy("pair").agg(
        F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1")
        .select("pair", F.col("most.root").alias("main")), "near-mixed", work)
    meeting = staged(placed.join(largest, "pair"), "near-meeting", work)
    favourite = meeting.groupBy("class", "root", "hub").agg(F.count("*").alias("n")).groupBy("class", "root").agg(
        F.max(F.struct("n", "hub")).alias("best")).select("class", "root", F.col("best.hub").alias("hub"))
    favourite = staged(favourite, "near-favourite", work)
    counts = staged(favourite.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "near-parts", work)
    blocks = favourite.join(counts, "hub").select(
        "class", "root", F.struct("hub", F.pmod(F.xxhash64("class"), F.col("parts")).alias("part")).alias("block"))
    blocks = staged(blocks, "near-blocks", work)
    wanted = meeting.join(blocks.select("class", "block"), "class").select("pair", "block").distinct()
    wanted = staged(wanted, "near-wanted", work)
    visits = staged(meeting.where(F.col("root") != F.col("main")).select("pair", "class", "root").join(wanted, "pair")
                    .select("class", "root", "block").distinct(), "near-visits", work)
    chunks = staged(visits.groupBy("block").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "near-chunks", work)
    sets = staged(texts.join(blocks.select("class"), "class").select("class", "text").mapInArrow(
        _sets_of, "class binary, set binary"), "near-sets", work)
    left = visits.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks"))).join(sets, "class")
    right = blocks.join(chunks, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).join(sets, "class")
    fields = ("block", "chunk", "class", "root", "set")
    left, right = staged(left.select(*fields), "near-left", work), staged(right.select(*fields), "near-right", work)
    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(
        _linked_in_block, "a binary, b binary")


def _text_hash(text: str) -> Column:
    """64 bits that two scans of a table agree in."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents and the links, as ``_found`` gives them; every step in Python is done when they are returned."""
    with session_conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=BATCH_ROWS):
        return _found(docs, doc_id, text)


def _found(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents and the links.

    Documents, one row per row of ``docs``: ``doc_id``, ``text_hash``, ``n_shingles``,
    ``class`` (null: empty set), ``component`` (its least class), ``component_id``.
    Links: pairs of classes (a, b) with similar sets that were confirmed.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _text_hash(text).alias("text_hash"), whole.alias("text"))
    signed = staged(keyed.mapInArrow(
        _signatures, "doc_id long, text_hash long, n_shingles long, class binary, signature array<long>"), "near-signed")
    # All tables but three are deleted at the end: copies of texts among them.
    with scratch_dir(docs.sparkSession, "near") as work:
        classes = staged(signed.where("class IS NOT NULL").groupBy("class").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k"),
            F.first("n_shingles").alias("n"), F.first("signature").alias("signature")
        ).select("class", "k.doc_id", "k.text_hash", "n", "signature"), "near-classes", work)

        # One number per (coordinate, value) pair. Minima are small numbers, so all their 64 bits are hashed:
        # unrelated classes then share no pairs by chance, however many there are.
        posted = classes.select("class", "n", F.posexplode("signature").alias("k", "value")).select(
            "class", "n", F.xxhash64("k", "value").alias("pair"))
        shared = staged(posted.groupBy("pair").agg(F.count("*").alias("times")).where("times > 1"), "near-shared", work)
        ranked = F.array_sort(F.collect_list(F.struct("times", "pair")))
        prefix = posted.join(shared, "pair").groupBy("class").agg(F.first("n").alias("n"), ranked.alias("pairs")).where(
            F.size("pairs") >= MATCHES)
        postings = staged(prefix.select(
            "class", "n", F.explode(F.slice("pairs", F.lit(1), F.size("pairs") - (MATCHES - 1))).alias("p")
        ).select("class", "n", "p.pair"), "near-postings", work)

        members = staged(postings.select("class").distinct().join(classes, "class"), "near-members", work)
        # Ids grow with the table, so they are merged with the texts, at every size alike.
        wanted = staged(members.select("class", "doc_id", "text_hash"), "near-ids", work).hint("merge")
        m, d = wanted.alias("m"), keyed.alias("d")
        texts = staged(d.join(m, F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_hash") == F.col("m.text_hash")))
                       .select("m.class", "d.text").dropDuplicates(["class"]), "near-texts", work)

        told = texts.mapInArrow(_shingles_of, "class binary, shingle long")
        common = staged(told.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1"), "near-common", work)
        support = staged(told.join(common, "shingle").groupBy("class").agg(
            F.count("*").alias("shared"), F.sum(F.log("times")).alias("weight")), "near-support", work)
        postings = staged(postings.join(support, "class").where(100 * F.col("shared") >= PERCENT * F.col("n")), "near-supported", work)

        hubs = staged(postings.groupBy("pair").agg(
            F.max(F.struct((F.col("weight") / F.col("n")).alias("share"), "class", "n", "shared")).alias("hub"),
            F.min("n").alias("least_n"), F.count("*").alias("times")).where("times > 1"), "near-hubs", work)
        met = staged(postings.join(hubs, "pair").where(_reaches(F.col("shared"), F.col("n") + F.col("least_n"))).select(
            "pair", "class", "n", "shared", "hub"), "near-met", work)
        stars = met.alias("x").where(F.col("class") != F.col("hub.class")).where(_comparable("x", "hub")).select(
            F.col("class").alias("a"), F.col("hub.class").alias("b")).distinct()
        compared = _compared(stars, members, texts, work)
        links = compared.where("linked").select("a", "b")
        roots = staged(components(links.toDF("u", "v"), work), "near-roots", work)

        links = staged(links.union(_across(met, roots, texts, work)).distinct(), "near-links")
        roots = staged(components(links.toDF("u", "v"), work), "near-roots", work)

        rooted = classes.join(roots, classes["class"] == roots["node"], "left").select(
            "class", "doc_id", F.coalesce("root", "class").alias("component"))
        names = rooted.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        named = staged(rooted.select("class", "component").join(staged(names, "near-names", work), "component"), "near-named")
    rows = signed.select("doc_id", "text_hash", "n_shingles", "class")
    return rows.join(named, "class", "left").select(
        "doc_id", "text_hash", "n_shingles", "class", "component",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")), links


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with
    the least doc_id (nulls last) stays, and of rows that tie, one.

    They are found again by doc_id and 64 bits of their text; rows that share both are copies
    of one another but for their other columns.
    """
    found, _ = near_duplicates(docs, doc_id, text)
    found = staged(found.select("doc_id", "text_hash", "component"), "near-found")
    # A row without words is no copy of another, so it is not one of several.
    alone = found.where("component IS NULL").select("doc_id", "text_hash").distinct().withColumn("times", F.lit(1).cast("long"))
    rows = found.where("component IS NOT NULL").groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("times"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "times")).alias("best")
    kept = staged(rows.groupBy("component").agg(best).select("best.doc_id", "best.text_hash", "best.times").union(alone), "near-kept")
    return decided_rows(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "text_hash": _text_hash(text)}, kept).select("doc.*")
