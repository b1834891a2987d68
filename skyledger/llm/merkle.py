"""Merkle manifest of a table: a digest per row, one per source, one for all, and a proof for each row.

Method: time-forward processing. A node's label is its tree, its level and its place. The external
priority queue that is ordered by label is Spark's sorted shuffle: it deals the digests of a round out
in blocks of 3^7 neighbours, whose common ancestor lies seven levels higher (``height``, a parameter). Inside a block a heap
delivers children's digests to their parents in the order of labels; the digest that the block ends
with is its message to the next round. A round thus leaves a row for each 2,187 of the round
before, so a few rounds reach the roots, of every source at once, and then of the tree over the sources.
The sweep is then reversed: the roots' empty proof is sent down, and each block adds its own siblings
to the proof suffix it is handed, one row a block, and delivers the result to its members. A block is
never larger than 2,187 digests, however large its source is.

Places come from one range partitioning by (source, doc_id): running numbers within partitions plus the
number of rows in the partitions before, so a source with most of the rows is still in many tasks.

Defined cases: a null field is ``-``, a null source is a tree of its own and the first one; rows with
one doc_id stand in the order of their leaf digests, equal rows are leaves of their own; texts
of any length are hashed whole in the JVM; a table without rows gives none; other columns, whatever their
names, take no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.common import shuffle_partitions, staged

# Fixed values of the manifest: the fields of a leaf in their order, and the children of a node.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3

#: Levels that one round climbs: a block holds the descendants of one node so far down.
HEIGHT = 7

NODE = "tree string, pos long, n long, digest string"
SUFFIX = "tree string, pos long, subroot string, lefts array<string>, rights array<string>"
PROVEN = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


class Manifest(NamedTuple):
    """``leaves`` in their places, the ``rounds`` above them, and the same for the tree over the sources."""

    leaves: DataFrame
    rounds: list[DataFrame]
    sources: list[DataFrame]
    root: str | None
    height: int


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(docs: DataFrame, **replaced: Column) -> Column:
    """H of a row's fields, each as its byte count, a colon and its value, or ``-`` for null."""
    fields = []
    for name in FIELDS:
        value = replaced.get(name, F.col(f"`{name}`")).cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def tampered() -> Column:
    """The rows whose copy is tampered with: those with an even crc32 of their decimal doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0


def _running_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``within``: a row's number among those of its tree in this partition, whose rows come sorted by tree."""
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        trees = batch.column("tree")
        new = np.ones(batch.num_rows, dtype=bool)
        new[1:] = pc.not_equal(trees.slice(1), trees.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        at = np.arange(batch.num_rows)
        within = at - starts[np.cumsum(new) - 1]
        if trees[0].as_py() == last:
            stop = starts[1] if len(starts) > 1 else batch.num_rows
            within[:stop] += seen
        last, seen = trees[-1].as_py(), int(within[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(within, pa.int64())], names=[*batch.schema.names, "within"])


def in_places(nodes: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``nodes`` with ``pos``, their place from 0 in their ``tree`` by ``order``, and ``n``, its number of nodes."""
    spark = nodes.sparkSession
    dealt = (
        nodes.repartitionByRange(shuffle_partitions(spark), "tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("part", F.spark_partition_id())
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    counted = staged(dealt.mapInArrow(_running_numbers, f"{fields}, within long"), label)
    parts = counted.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "tree", "part",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    return counted.join(offsets, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("within")).drop(
        "part", "before", "within")


def climb(digests: Sequence[str], levels: int) -> list[list[str]]:
    """The digests of all levels of one block, lowest first, by a queue ordered by (level, place)."""
    queue = [(0, place, d) for place, d in enumerate(digests)]
    layers: list[list[str]] = [[] for _ in range(levels + 1)]
    run: list[str] = []
    while queue:
        level, place, d = heapq.heappop(queue)
        layers[level].append(d)
        if level == levels:
            continue
        run.append(d)
        following = queue[0][:2] if queue else None
        if following != (level, place + 1) or len(run) == FAN:
            heapq.heappush(queue, (level + 1, place // FAN, digest("".join(run))))
            run = []
    return layers


def levels_of(n: int, height: int) -> int:
    """The levels a round climbs in a tree of ``n`` nodes: all of a block, or up to the only node left."""
    levels = 0
    while n > 1 and levels < height:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _layers(block: pa.Table, height: int) -> list[list[str]]:
    return climb(block.column("digest").to_pylist(), levels_of(block.column("n")[0].as_py(), height))


def _risen(height: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def risen(key: tuple, block: pa.Table) -> pa.Table:
        left = -(-block.column("n")[0].as_py() // FAN ** height)
        top = _layers(block.sort_by("pos"), height)[-1][0]
        return pa.table({"tree": [key[0].as_py()], "pos": [key[1].as_py()], "n": [left], "digest": [top]})

    return risen


def _by_block(nodes: DataFrame, height: int):
    return nodes.withColumn("block", F.expr(f"pos div {FAN ** height}")).groupBy("tree", "block")


def rise(nodes: DataFrame, height: int, label: str) -> list[DataFrame]:
    """The forward sweep: the rounds from ``nodes`` up to one node a tree, each a written table but the first."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds = [nodes]
    while most > 1:
        rounds.append(staged(_by_block(rounds[-1], height).applyInArrow(_risen(height), NODE), label))
        most = -(-most // FAN ** height)
    return rounds


def manifest(docs: DataFrame, height: int = HEIGHT) -> Manifest:
    """The trees of all sources and the tree over them; a round climbs ``height`` levels, with the same result."""
    source = F.col("source")
    leaves = staged(docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("x"), source), F.lit("")).alias("tree"),
        leaf_digest(docs).alias("digest"),
        F.when(tampered(), leaf_digest(docs, text=F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("forged"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    placed = in_places(leaves, ["doc_id", "digest", "row"], "merkle-places").drop("row")
    rounds = rise(placed, height, "merkle-round")
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    sources = rise(in_places(subroots, ["source"], "merkle-sources"), height, "merkle-top")
    top = sources[-1].select("digest").first()
    return Manifest(placed, rounds, sources, top[0] if top else None, height)


def _paths(layers: list[list[str]]) -> Iterator[tuple[list[str], list[str]]]:
    """For each node of the lowest layer, what stands left and right of its ancestors (itself first) in their runs."""
    beside = []
    for layer in layers[:-1]:
        row = []
        for start in range(0, len(layer), FAN):
            run = layer[start:start + FAN]
            row += [("".join(run[:i]), "".join(run[i + 1:])) for i in range(len(run))]
        beside.append(row)
    for place in range(len(layers[0])):
        lefts, rights = [], []
        for row in beside:
            left, right = row[place]
            lefts.append(left)
            rights.append(right)
            place //= FAN
        yield lefts, rights


def _lowered(height: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The proof suffixes of a block's nodes, from the one of the node it ends in."""
    def lowered(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        subroot, lefts, rights = (above.column(c)[0].as_py() for c in ("subroot", "lefts", "rights"))
        paths = list(_paths(_layers(block, height)))
        return pa.table({
            "tree": block.column("tree"), "pos": block.column("pos"),
            "subroot": pa.array([subroot] * len(paths), pa.string()),
            "lefts": pa.array([left + lefts for left, _ in paths], pa.list_(pa.string())),
            "rights": pa.array([right + rights for _, right in paths], pa.list_(pa.string())),
        })

    return lowered


def fold(leaf: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights):
        leaf = digest(left + leaf + right)
    return leaf


def _prover(root: str, height: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([
        ("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
        ("verified", pa.bool_())])

    def proven(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        subroot, lefts, rights = (above.column(c)[0].as_py() for c in ("subroot", "lefts", "rights"))
        tail = "".join(left + right for left, right in zip(lefts, rights))
        leaves, forged = block.column("digest").to_pylist(), block.column("forged").to_pylist()
        proofs, folded = [], []
        for leaf, copy, (left, right) in zip(leaves, forged, _paths(_layers(block, height))):
            proofs.append(digest("".join(a + b for a, b in zip(left, right)) + tail))
            folded.append(fold(fold(copy or leaf, left, right), lefts, rights))
        n = len(leaves)
        return pa.table([
            block.column("doc_id").cast(pa.int64()), pa.array(leaves, pa.string()), pa.array([subroot] * n, pa.string()),
            pa.array([root] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
            pa.array([f == root for f in folded], pa.bool_())], schema=schema)

    return proven


def _descend(rounds: Sequence[DataFrame], suffixes: DataFrame, height: int) -> DataFrame:
    """The reversed sweep through ``rounds``, from the proof suffixes of their last one to those of the first."""
    for nodes in reversed(rounds[:-1]):
        blocks = _by_block(nodes.select("tree", "pos", "n", "digest"), height)
        suffixes = staged(
            blocks.cogroup(suffixes.groupBy("tree", "pos")).applyInArrow(_lowered(height), SUFFIX), "merkle-down")
    return suffixes


def prove(made: Manifest) -> DataFrame:
    """Each leaf with its digest, its roots, the digest of its proof, and what its copy, tampered or not, folds to.

    The last step of the reversed sweep folds the proofs instead of handing them on, so no row carries one.
    """
    if made.root is None:
        return made.leaves.sparkSession.createDataFrame([], PROVEN)
    none = F.array().cast("array<string>")
    start = made.sources[-1].select("tree", "pos", F.lit("").alias("subroot"), none.alias("lefts"), none.alias("rights"))
    over = _descend(made.sources, start, made.height)
    # What stands over a source's subroot goes to the only node of its tree's last round.
    tops = made.sources[0].select("tree", "pos", "source", "digest").join(over, ["tree", "pos"]).select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "lefts", "rights")
    leaves, *higher = made.rounds
    suffixes = _descend(higher, tops, made.height) if higher else tops
    return _by_block(leaves.select("tree", "pos", "n", "digest", "forged", "doc_id"), made.height).cogroup(
        suffixes.groupBy("tree", "pos")).applyInArrow(_prover(made.root, made.height), PROVEN)
