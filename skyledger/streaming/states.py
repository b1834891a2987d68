"""Running aggregates over a flight stream: one keyed state each, kept for good.

They are the batch operators; on a stream Spark keeps their groups in the state
store and merges each micro-batch's partial rows into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from skyledger.operators import (
    airport_visits,
    best_legs,
    complete_rows,
    count_by,
    mean_state,
)


def running_visits(flights: DataFrame) -> DataFrame:
    """(airport, popularity): take-offs plus landings so far."""
    return count_by(airport_visits(flights), ["airport"], "popularity")


def running_mean(flights: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, total, n, mean) of the values present so far."""
    return mean_state(flights, keys, value)


def running_best(flights: DataFrame) -> DataFrame:
    """The flight with the smallest arrival delay so far, per route and day."""
    return best_legs(complete_rows(flights, ["ArrDelay"]))
