"""Five of the questions from one pass over the flights.

The summary has one row per (origin, destination, carrier) with the counts and
exact sums that the questions need, so its size does not grow with the flights. A job
that wants several answers reads the flights once and the summary often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import in_parts
from skyledger.operators import merge_exact_state
from skyledger.operators.aggregates import popularity_of_routes
from skyledger.plans.questions import (
    TOP,
    finish_routes,
    pack_origin,
    rank_airports,
    rank_carriers,
    rank_within_origin,
)


# A missing carrier is a group of its own, so that its flights count.
SUMMARY_KEYS = ("Origin", "Dest", "UniqueCarrier")


def flight_summary(flights: DataFrame) -> DataFrame:
    dep, arr = in_parts(F.col("DepDelay")), in_parts(F.col("ArrDelay"))
    return flights.groupBy(*SUMMARY_KEYS).agg(
        F.count("*").alias("flights"),
        F.sum(dep).alias("dep_total"),
        F.count(dep).alias("dep_n"),
        F.sum(arr).alias("arr_total"),
        F.count(arr).alias("arr_n"),
    )


def _mean_dep(summary: DataFrame, key: str) -> DataFrame:
    return merge_exact_state(summary, ["Origin", key], "dep_total", "dep_n", "mean")


def _packed(summary: DataFrame, key: str, k: int, style: str) -> DataFrame:
    return pack_origin(rank_within_origin(_mean_dep(summary, key), key, k), key, style)


def answers_from_summary(
    summary: DataFrame, k: int = TOP, style: str = "flat", round_before_rank: bool = True
) -> dict[str, DataFrame]:
    """Result table name to its rows; the defaults are those of the batch questions."""
    carriers = merge_exact_state(summary, ["UniqueCarrier"], "arr_total", "arr_n", "mean")
    routes = merge_exact_state(summary, ["Origin", "Dest"], "arr_total", "arr_n", "mean")
    return {
        "results11": rank_airports(popularity_of_routes(summary, "flights"), k),
        "results12": rank_carriers(carriers, k, round_before_rank),
        "results21": _packed(summary, "UniqueCarrier", k, style),
        "results22": _packed(summary, "Dest", k, style),
        "results24": finish_routes(routes),
    }
