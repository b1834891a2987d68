"""Neighbours among ties, repeated ids and odd tables, against every pair in numpy."""

import numpy as np
import pytest

from skyledger.llm import neighbours

ROWS = "vec_id long, embedding array<double>"


def every_pair(rows, k=5):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v]
    out = []
    for q, x in usable:
        if q % 50 == 0:
            told = [(-(x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())), i) for i, y in usable if i != q and len(x) == len(y)]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(told)[:k])]
    return out


def answers(found):
    return sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in found.collect())


@pytest.mark.parametrize("seed", range(4))
def test_parallel_vectors_are_ranked_by_their_scores(spark, seed):
    say = np.random.default_rng(seed)
    one = say.normal(size=16)
    rows = [(i, (one * say.uniform(0.1, 9)).tolist()) for i in range(1, 400)] + [(100_000, one.tolist())]
    rows += [(i, say.normal(size=16).tolist()) for i in range(400, 600)]
    assert answers(neighbours.nearest(spark.createDataFrame(rows, ROWS))) == sorted(every_pair(rows))


def test_an_id_with_several_vectors_is_scored_by_each(spark):
    say = np.random.default_rng(3)
    rows = [(i % 40 + 1, say.normal(size=8).tolist()) for i in range(200)] + [(50, say.normal(size=8).tolist()), (50_000, [1.0, 2.0])]
    rows += [(None, [1.0] * 8), (60, None), (61, []), (62, [3.0, 1.0])]
    assert answers(neighbours.nearest(spark.createDataFrame(rows, ROWS))) == sorted(every_pair(rows))


def test_empty_table_and_clashing_columns(spark):
    assert neighbours.nearest(spark.createDataFrame([], ROWS)).count() == 0
    rows = [(50, [1.0, 0.0], 7, 1, 2), (51, [1.0, 1.0], 7, 1, 2), (52, [0.0, 1.0], 7, 1, 2)]
    found = neighbours.nearest(spark.createDataFrame(rows, ROWS + ", id int, shard int, block int"))
    assert [(r["rank"], r["vec_id"]) for r in found.orderBy("rank").collect()] == [(1, 51), (2, 52)]


def test_a_factor_above_one_finds_most(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 1000)
    say = np.random.default_rng(1)
    centres = say.normal(size=(50, 12))
    rows = spark.createDataFrame(
        [(i, (centres[i % 50] + 0.3 * say.normal(size=12)).tolist()) for i in range(3000)], ROWS)
    pairs = lambda factor: {(r["query_id"], r["vec_id"]) for r in neighbours.nearest(rows, factor=factor).collect()}
    exact, loose = pairs(1.0), pairs(1.5)
    assert 0.9 <= len(exact & loose) / len(exact) <= 1
