"""The flight questions as compositions of operators, over a batch of flights.

The ``rank_*`` and ``finish_*`` halves start from an aggregate, so the streaming
questions reuse them on their running state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import round2
from skyledger.operators import (
    TwoLegBounds,
    TwoLegSets,
    afternoon_flights,
    all_legs,
    best_legs,
    best_of_each_leg,
    bounded_legs,
    bounded_legs_by_tables,
    complete_rows,
    mean_by,
    morning_flights,
    pack_top,
    pair_legs,
    popularity,
    rank_top,
    rank_top_per_group,
    split_legs,
    with_keys,
)
from skyledger.operators.legs import LEG_KEYS, of_year

# Fixed value: how many rows a ranking keeps.
TOP = 10


def rank_airports(counts: DataFrame, k: int = TOP) -> DataFrame:
    """(rank, airport, popularity), busiest first, equal counts by name."""
    ranked = rank_top(counts, [F.desc("popularity"), F.col("airport")], k)
    return ranked.select("rank", "airport", "popularity")


def airport_popularity(flights: DataFrame, k: int = TOP) -> DataFrame:
    """The busiest airports by departures plus arrivals."""
    return rank_airports(popularity(flights), k)


def rank_carriers(means: DataFrame, k: int = TOP, round_before_rank: bool = True) -> DataFrame:
    """(rank, airline, avgarrdelay), smallest mean first, equal means by carrier.

    ``means`` is (UniqueCarrier, mean). A carrier without a single delay has no
    mean and no rank. The batch question ranks the rounded mean, the continuous
    one the exact mean; both give the rounded one.
    """
    known = complete_rows(means, ["mean"])
    exact = known.select(
        F.col("UniqueCarrier").alias("airline"), round2(F.col("mean")).alias("avgarrdelay"), "mean")
    order = ["avgarrdelay" if round_before_rank else "mean", "airline"]
    return rank_top(exact, order, k).select("rank", "airline", "avgarrdelay")


def carrier_punctuality(flights: DataFrame, k: int = TOP, round_before_rank: bool = True) -> DataFrame:
    """The carriers with the smallest mean arrival delay."""
    return rank_carriers(mean_by(flights, ["UniqueCarrier"], "ArrDelay", "mean"), k, round_before_rank)


def rank_within_origin(means: DataFrame, key: str, k: int = TOP) -> DataFrame:
    """(airport, rank, key, avgdepdelay) from (Origin, key, mean): ranked exact, then rounded."""
    ranked = rank_top_per_group(complete_rows(means), ["Origin"], ["mean", key], k)
    return ranked.select(
        F.col("Origin").alias("airport"), "rank", key, round2(F.col("mean")).alias("avgdepdelay"))


def origin_top(flights: DataFrame, key: str, k: int = TOP) -> DataFrame:
    """Per origin, the ``key`` values (carriers, destinations) with the smallest mean departure delay."""
    return rank_within_origin(mean_by(flights, ["Origin", key], "DepDelay", "mean"), key, k)


# The text column that holds an origin's ranking, by ranked key.
PACKED_COLUMNS = {"UniqueCarrier": "topcarrier", "Dest": "topdest"}


def pack_origin(ranked: DataFrame, key: str, style: str) -> DataFrame:
    return pack_top(ranked, "airport", key, "avgdepdelay", PACKED_COLUMNS[key], style)


def origin_packed(flights: DataFrame, key: str, k: int = TOP, style: str = "flat") -> DataFrame:
    """``origin_top`` with each origin's ranking as one text."""
    return pack_origin(origin_top(flights, key, k), key, style)


def finish_routes(means: DataFrame) -> DataFrame:
    """(origin, dest, arrdelay) from (Origin, Dest, mean)."""
    return complete_rows(means).select(
        F.col("Origin").alias("origin"), F.col("Dest").alias("dest"),
        round2(F.col("mean")).alias("arrdelay"))


def route_mean_arr_delay(flights: DataFrame) -> DataFrame:
    """The mean arrival delay of every route."""
    return finish_routes(mean_by(flights, ["Origin", "Dest"], "ArrDelay", "mean"))


def first_legs(flights: DataFrame, year: int, require: Sequence[str] | None = None) -> DataFrame:
    """Best morning flight per route and day of ``year``; ``require`` defaults to every column."""
    return best_legs(complete_rows(morning_flights(of_year(flights, year)), require))


def second_legs(flights: DataFrame, year: int, require: Sequence[str] | None = None) -> DataFrame:
    """Best afternoon flight per route and day of ``year``."""
    return best_legs(complete_rows(afternoon_flights(of_year(flights, year)), require))


def two_leg_all(flights: DataFrame, year: int, require: Sequence[str] | None = None) -> DataFrame:
    """Every itinerary of ``year``: each route pair that meets, with the best flight of either leg."""
    known = [key for key in LEG_KEYS if require is None or key in require]
    candidates = with_keys(complete_rows(of_year(flights, year), require), known)
    return pair_legs(*split_legs(best_of_each_leg(all_legs(candidates))))


def two_leg_bounded(
    flights: DataFrame, bounds: TwoLegBounds, require: Sequence[str] | None = ("ArrDelay",)
) -> DataFrame:
    """The itineraries whose airports and first day are in the given sets."""
    return pair_legs(*split_legs(bounded_legs(flights, bounds, require)))


def two_leg_by_tables(
    flights: DataFrame, sets: TwoLegSets, require: Sequence[str] | None = ("ArrDelay",)
) -> DataFrame:
    """``two_leg_bounded`` with the sets given as tables."""
    return pair_legs(*split_legs(bounded_legs_by_tables(flights, sets, require)))
