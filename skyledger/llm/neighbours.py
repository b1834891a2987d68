"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt into shards by a hash; each shard builds a tree over its unit
vectors (chord distance, a metric that orders as the cosine does). A block of
queries walks down a tree together: at each node the nearer side is searched
first, and the other side only for queries whose ball, shrunk by ``factor``,
reaches across the vantage point's sphere. Factor 1 is exact search; larger
factors prune more. Whatever comes within ``TIE`` of the k-th distance is scored on
the original vectors before anything is cut, so rounding of unit vectors decides
nothing: the k best by score stay, and scores tie when they are equal doubles.
Shards' answers are merged by grouped ranking. Shards and
query blocks are sized by count, whatever the size of the table.

Vectors that are null, zero, or hold null or non-finite components take no part.
Of equal vectors only those with the ``k + 1`` smallest ids can be in an answer, and of
one id ``k`` rows, so the others are not indexed (they still ask). Equal scores rank by smaller id. A
repeated id is a row of its own, but no row with the query's id is its neighbour.
Null ids take no part. Vectors are compared with those of their own length only. A
table without usable vectors gives no rows. Other columns, whatever their names, take
no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from skyledger.llm.common import staged

SHARD = 8192
BLOCK = 4096
LEAF = 64
TIE = 1e-7  # more than the rounding of a distance
SLACK = 1e-6  # so rounding never prunes a tie
PAIRS = 1 << 16  # vectors scored at a time


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id`` and ``vec`` of the vectors that can take part."""
    v = F.col("vec")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


class VpTree:
    """A tree over the unit vectors; nodes are split at the median distance from a vantage point."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        self.unit = unit_vectors(vectors)
        self.root = self._built(np.arange(len(vectors)))

    def _built(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        middle = self.unit[rows].mean(axis=0)
        point = rows[np.argmax(((self.unit[rows] - middle) ** 2).sum(axis=1))]
        rest = rows[rows != point]
        away = chord(self.unit[rest] @ self.unit[point])
        radius = np.median(away)
        inside = away <= radius
        if inside.all():  # equal distances: a leaf of any size is right
            return rows
        return point, radius, self._built(rest[inside]), self._built(rest[~inside])

    def search(self, asked: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The ids and scores of the k best per query, without the query's own id; a score of -inf is no answer."""
        queries = unit_vectors(asked)
        best_s = np.full((len(asked), k), -np.inf)
        best_d = np.full((len(asked), k), np.inf)
        best_i = np.full((len(asked), k), np.iinfo(np.int64).max)
        reach = np.full(len(asked), np.inf)  # the distance that an answer may have

        def offer(q: np.ndarray, rows: np.ndarray) -> None:
            d = chord(queries[q] @ self.unit[rows].T)
            i = np.broadcast_to(self.ids[rows], d.shape)
            d = np.where(i == own[q][:, None], np.inf, d)
            least = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] >= k else np.full(len(q), np.inf)
            x, y = np.nonzero(np.isfinite(d) & (d <= (np.minimum(reach[q], least) + TIE)[:, None]))
            s = np.full(d.shape, -np.inf)
            s[x, y] = cosines(asked, q[x], self.vectors, rows[y])
            d = np.where(np.isfinite(s), d, np.inf)
            some = np.unique(x)
            s, d, i = (np.concatenate((b[q[some]], n[some]), axis=1) for b, n in ((best_s, s), (best_d, d), (best_i, i)))
            order = np.lexsort((i, -s), axis=1)[:, :k]
            for kept, new in ((best_s, s), (best_d, d), (best_i, i)):
                kept[q[some]] = np.take_along_axis(new, order, 1)
            reach[q[some]] = best_d[q[some]].max(axis=1)

        def visit(node, q: np.ndarray) -> None:
            if not len(q):
                return
            if isinstance(node, np.ndarray):
                if len(node):
                    offer(q, node)
                return
            point, radius, inner, outer = node
            offer(q, np.array([point]))
            d = chord(queries[q] @ self.unit[point])
            near = d <= radius
            visit(inner, q[near])
            visit(outer, q[~near])
            ball = reach[q] / factor + SLACK
            visit(outer, q[near & (d + ball >= radius)])
            visit(inner, q[~near & (d - ball <= radius)])

        visit(self.root, np.arange(len(queries)))
        return best_i, best_s


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosines(left: np.ndarray, i: np.ndarray, right: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The cosines of rows ``i`` of one matrix with rows ``j`` of the other."""
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        x, y = left[i[at:at + PAIRS]], right[j[at:at + PAIRS]]
        out[at:at + PAIRS] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
    return out


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def nearest(
    rows: DataFrame, k: int = 5, factor: float = 1.0, vec_id: str = "vec_id", vector: str = "embedding", every: int = 50,
) -> DataFrame:
    """For each row whose id is divisible by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score`` (cosine)."""
    good = staged(usable(rows, vec_id, vector), "vectors")
    among, copies = Window.partitionBy("vec").orderBy("id"), Window.partitionBy("vec", "id").orderBy(F.lit(0))
    nearest_ids = good.withColumn("n", F.dense_rank().over(among)).where(F.col("n") <= k + 1)
    indexed = staged(nearest_ids.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k).select("id", "vec"), "vectors-indexed")
    queries = good.where(F.col("id") % every == 0).dropDuplicates(["id", "vec"])
    shards = max(1, -(-indexed.count() // SHARD))
    blocks = max(1, -(-queries.count() // BLOCK))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = indexed.select("id", "vec", F.pmod(F.xxhash64("id", "vec"), F.lit(shards)).cast("int").alias("shard"), spread(blocks).alias("block"))
    right = queries.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), spread(shards).alias("shard"))

    def search(shard: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, np.ndarray] = {}
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if shard.num_rows and asked.num_rows:
            lengths = lambda t: pc.list_value_length(t.column("vec")).to_numpy()
            for width in np.unique(lengths(asked)):  # only vectors of one length have a cosine
                s, a = shard.filter(pa.array(lengths(shard) == width)), asked.filter(pa.array(lengths(asked) == width))
                if not s.num_rows:
                    continue
                vectors, wanted = _matrix(s, "vec"), _matrix(a, "vec")
                ids, own = s.column("id").to_numpy(), a.column("id").to_numpy()
                best, score = VpTree(vectors, ids).search(wanted, own, k, factor)
                row, col = np.nonzero(np.isfinite(score))
                found.append((own[row], best[row, col], score[row, col]))
        for j, name in enumerate(("query_id", "vec_id", "score")):
            kind = np.float64 if name == "score" else np.int64
            out[name] = np.concatenate([f[j] for f in found]).astype(kind) if found else np.zeros(0, dtype=kind)
        return pa.table(out)

    fields = ["shard", "block", "id", "vec"]
    left, right = staged(left.select(fields), "vectors-shards"), staged(right.select(fields), "vectors-asked")
    answers = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
