"""Keyed aggregates.

Each is one ``groupBy``: Spark combines on the map side before the shuffle, so a
key that holds a large share of the rows sends one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import in_parts, mean_of, unit_of
from skyledger.operators.filters import with_value


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def endpoint_counts(flights: DataFrame) -> DataFrame:
    """Departures per origin and arrivals per destination, as one bag of (airport, n).

    An airport that is both appears twice. The flights are read once: they are
    counted per route, and only the route counts are doubled into endpoints.
    """
    ends = F.array(
        F.struct(F.lit("origin").alias("side"), F.col("Origin").alias("airport")),
        F.struct(F.lit("dest").alias("side"), F.col("Dest").alias("airport")),
    )
    return (
        count_by(flights, ["Origin", "Dest"])
        .select(F.inline(ends), "n")
        .groupBy("side", "airport")
        .agg(F.sum("n").alias("n"))
        .select("airport", "n")
    )


def popularity(flights: DataFrame) -> DataFrame:
    """Departures plus arrivals per airport, summed over the route counts."""
    routes = count_by(flights, ["Origin", "Dest"])
    return popularity_of_routes(routes)


def popularity_of_routes(routes: DataFrame, count: str = "n") -> DataFrame:
    return (
        routes.select(F.explode(F.array("Origin", "Dest")).alias("airport"), count)
        .groupBy("airport")
        .agg(F.sum(count).alias("popularity"))
    )


def airport_visits(flights: DataFrame) -> DataFrame:
    """One row per take-off and per landing: the single-aggregate form a stream needs."""
    return flights.select(F.explode(F.array("Origin", "Dest")).alias("airport"))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean of ``value`` per key; nulls do not count, and an all-null group has a null mean.

    Sums are exact, so the mean does not depend on how the rows are cut into files and tasks.
    """
    parts = in_parts(F.col(value))
    return df.groupBy(*keys).agg(mean_of(F.sum(parts), F.count(parts)).alias(name))


def mean_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum, count and mean of the present values per key.

    The state is an exact sum and a count, so no cut into micro-batches changes the results.
    """
    parts = in_parts(F.col(value))
    return (
        with_value(df, value)
        .groupBy(*keys)
        .agg(
            unit_of(F.sum(parts)).alias("total"),
            F.count(parts).alias("n"),
            mean_of(F.sum(parts), F.count(parts)).alias("mean"),
        )
    )


def merge_mean_state(states: DataFrame, keys: Sequence[str], total: str, count: str, name: str) -> DataFrame:
    """Mean per coarser key from (sum, count) rows of finer keys, as ``mean_state`` gives them."""
    return merge_exact_state(states.withColumn(total, in_parts(F.col(total))), keys, total, count, name)


def merge_exact_state(states: DataFrame, keys: Sequence[str], total: str, count: str, name: str) -> DataFrame:
    """Mean per coarser key from (sum of ``in_parts``, count) rows of finer keys."""
    return states.groupBy(*keys).agg(mean_of(F.sum(total), F.sum(count)).alias(name))


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key; ``order`` is a total order over the kept columns.

    A null would sort lowest, so drop rows without the leading column first.
    """
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*order)).alias("_best"))
        .select(*keys, "_best.*")
    )
