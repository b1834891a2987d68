"""Top-k, over everything and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def rank_top(df: DataFrame, order: Sequence[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows with their 1-based position.

    ``orderBy().limit()`` keeps k rows per partition and merges those, so only k
    rows reach the unpartitioned window. ``order`` must be total.
    """
    first = df.orderBy(*order).limit(k)
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def rank_top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of every group with their position.

    Spark cuts each group to k rows per map task before the shuffle, so a group
    of any size sends a bounded number of rows to the task that ranks it.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
