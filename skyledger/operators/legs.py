"""Two-leg itineraries X -> Y -> Z: a morning flight, then an afternoon one some days later."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import as_day, day_text
from skyledger.operators.aggregates import best_per_group
from skyledger.operators.filters import complete_rows

# The clock time that parts the legs, and the days between them.
NOON = 1200
STOPOVER_DAYS = 2

LEG_KEYS = ("Origin", "Dest", "FlightDate")
# Smallest delay first; the rest makes the order total, so the choice never
# depends on the order in which rows arrive.
LEG_ORDER = ("ArrDelay", "UniqueCarrier", "FlightNum", "CRSDepTime")


class TwoLegBounds(NamedTuple):
    """Independent sets: any combination of their members is an answer."""

    xs: Sequence[str]
    ys: Sequence[str]
    zs: Sequence[str]
    dates: Sequence[str | datetime.date]
    year: int


def morning_flights(flights: DataFrame) -> DataFrame:
    return flights.where(F.col("CRSDepTime") < NOON)


def afternoon_flights(flights: DataFrame) -> DataFrame:
    return flights.where(F.col("CRSDepTime") > NOON)


def all_legs(flights: DataFrame) -> DataFrame:
    """Every flight that can be a leg, with its ``leg``, 1 or 2. Noon parts them, so a flight is at most one."""
    clock = F.col("CRSDepTime")
    return flights.where(clock != NOON).withColumn("leg", F.when(clock < NOON, 1).otherwise(2))


def of_year(flights: DataFrame, year: int) -> DataFrame:
    return flights.where(F.col("Year") == year)


def best_legs(flights: DataFrame, keys: Sequence[str] = LEG_KEYS) -> DataFrame:
    """The flight with the smallest arrival delay per route and day."""
    return best_per_group(flights, keys, LEG_ORDER)


def with_keys(flights: DataFrame, keys: Sequence[str] = LEG_KEYS) -> DataFrame:
    """Rows with a value in each of ``keys``, as conditions of the form that the join of the legs
    implies: it then adds none of its own to one leg alone, and both still read one aggregate.
    """
    for key in keys:
        flights = flights.where(F.col(key).isNotNull())
    return flights


def best_of_each_leg(legs: DataFrame) -> DataFrame:
    """The best flight per (leg, route, day), from rows with their ``leg``.

    The leg that is handed on comes out of the aggregate, beside the flight, and not
    from its key. A filter on it stays above the aggregate, so both legs of a trip
    read one aggregate, whose flights are scanned and shuffled once.
    """
    best = best_per_group(legs.withColumn("which", F.col("leg")), ("leg", *LEG_KEYS), (*LEG_ORDER, "which"))
    return best.drop("leg").withColumnRenamed("which", "leg")


def day_range(bounds: TwoLegBounds) -> tuple[datetime.date, datetime.date]:
    """The first and the last day of any leg; without dates, a range without days."""
    if not bounds.dates:
        return datetime.date(bounds.year, 1, 2), datetime.date(bounds.year, 1, 1)
    days = [as_day(d) for d in bounds.dates]
    return min(days), max(days) + datetime.timedelta(days=STOPOVER_DAYS)


def bounded_legs(
    flights: DataFrame, bounds: TwoLegBounds, require: Sequence[str] | None = ("ArrDelay",)
) -> DataFrame:
    """Best flight per (leg, route, day) among the flights ``bounds`` allows.

    Both legs share one aggregate, which also is the form that a stream can keep as
    state. The sets filter before it, at the scan of stored flights; a view over
    other tables takes the ``day_range``.
    """
    origin, dest, day, clock = (F.col(c) for c in ("Origin", "Dest", "FlightDate", "CRSDepTime"))
    first_days = [as_day(d) for d in bounds.dates]
    second_days = [d + datetime.timedelta(days=STOPOVER_DAYS) for d in first_days]
    first = (
        origin.isin(*bounds.xs) & dest.isin(*bounds.ys) & day.isin(*first_days) & (clock < NOON)
    )
    second = (
        origin.isin(*bounds.ys) & dest.isin(*bounds.zs) & day.isin(*second_days) & (clock > NOON)
    )
    candidates = with_keys(of_year(complete_rows(flights, require), bounds.year)).where(first | second)
    return best_of_each_leg(all_legs(candidates))


class TwoLegSets(NamedTuple):
    """The sets as tables: ``roles`` has (airport, role), role being "x", "y" or "z"; ``days`` has the first days."""

    roles: DataFrame
    days: DataFrame
    year: int


def bounded_legs_by_tables(
    flights: DataFrame, sets: TwoLegSets, require: Sequence[str] | None = ("ArrDelay",)
) -> DataFrame:
    """``bounded_legs`` with sets of any size, which stay tables.

    A flight's leg follows from its clock, so each set is one semi-join on (airport or day, leg) as one key, and the
    flights are scanned once. Spark broadcasts small sets; for large ones it puts a bloom filter of the members
    on the scan. The first and the last day are looked up first and bound the scan.
    """
    role, day = F.col("role"), F.to_date("day")
    origins = sets.roles.where(role.isin("x", "y")).select(
        F.struct(F.col("airport").alias("at"), F.when(role == "x", 1).otherwise(2).alias("leg")).alias("member"))
    dests = sets.roles.where(role.isin("y", "z")).select(
        F.struct(F.col("airport").alias("at"), F.when(role == "y", 1).otherwise(2).alias("leg")).alias("member"))
    first_days = sets.days.select(day.alias("day"))
    days = first_days.select(F.explode(F.array(
        F.struct(F.col("day").alias("at"), F.lit(1).alias("leg")),
        F.struct(F.date_add("day", STOPOVER_DAYS).alias("at"), F.lit(2).alias("leg")))).alias("member"))
    ends = first_days.agg(F.min("day").alias("low"), F.date_add(F.max("day"), STOPOVER_DAYS).alias("high"))
    legs = all_legs(with_keys(of_year(complete_rows(flights, require), sets.year)))
    legs = legs.where(
        (F.col("FlightDate") >= ends.select("low").scalar()) & (F.col("FlightDate") <= ends.select("high").scalar()))
    for key, members in (("Origin", origins), ("Dest", dests), ("FlightDate", days)):
        legs = legs.join(members, F.struct(F.col(key).alias("at"), F.col("leg")) == members["member"], "left_semi")
    return best_of_each_leg(legs)


def split_legs(legs: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = legs.where(F.col("leg") == 1).drop("leg")
    second = legs.where(F.col("leg") == 2).drop("leg")
    return first, second


def pair_legs(
    first: DataFrame, second: DataFrame, stopover_days: int = STOPOVER_DAYS, changed: str | None = None
) -> DataFrame:
    """Join legs that meet in Y with the second flown ``stopover_days`` after the first.

    Both join conditions are equalities, so the join hashes on (Y, day). Each side
    has one row per route and day; a hub's rows spread over its days. ``changed`` names
    a flag of the legs, one of which must then carry it.
    """
    flag = F.col(changed) if changed else F.lit(True)
    left = first.select(
        F.col("Origin").alias("airportx"),
        F.col("Dest").alias("airporty"),
        F.col("FlightDate").alias("day1"),
        F.col("UniqueCarrier").alias("uniquecarrier1"),
        F.col("FlightNum").alias("flightnum1"),
        F.col("CRSDepTime").alias("crsdeptime1"),
        F.col("ArrDelay").alias("arrdelay1"),
        flag.alias("changed1"),
    )
    right = second.select(
        F.col("Origin").alias("origin2"),
        F.col("Dest").alias("airportz"),
        F.col("FlightDate").alias("day2"),
        F.col("UniqueCarrier").alias("uniquecarrier2"),
        F.col("FlightNum").alias("flightnum2"),
        F.col("CRSDepTime").alias("crsdeptime2"),
        F.col("ArrDelay").alias("arrdelay2"),
        flag.alias("changed2"),
    )
    meets = (left["airporty"] == right["origin2"]) & (
        left["day1"] == F.date_sub(right["day2"], stopover_days)
    )
    if changed:
        meets = meets & (left["changed1"] | right["changed2"])
    return left.join(right, meets, "inner").select(
        "airportx", "airporty", "airportz",
        day_text(F.col("day1")).alias("flightdate1"),
        "uniquecarrier1", "flightnum1", "crsdeptime1", "arrdelay1",
        day_text(F.col("day2")).alias("flightdate2"),
        "uniquecarrier2", "flightnum2", "crsdeptime2", "arrdelay2",
        (F.col("arrdelay1") + F.col("arrdelay2")).alias("totaldelay"),
    )
