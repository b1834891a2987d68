"""Flights derived from the order tables, which hold the test and bench data."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.session import path_size

# The columns a flight is made of. Naming them spares a pass over
# the files' footers for each table.
TABLES = {
    "nation": "n_nationkey INT, n_name STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "part": "p_partkey BIGINT, p_brand STRING",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
        " l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ"
    ),
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


# The test data's rules for clock times and missing delays.
MINUTE = "(l_orderkey * 7 + l_partkey * 13 + l_linenumber * 61) % 1440"
NO_DEPARTURE_DELAY = "l_partkey % 53 = 0"
NO_ARRIVAL_DELAY = "l_partkey % 53 = 0 OR l_partkey % 47 = 0"

FLIGHT_COLUMNS = (
    "year(l_shipdate) AS Year",
    "weekday(l_shipdate) + 1 AS DayOfWeek",
    "CAST(l_shipdate AS DATE) AS FlightDate",
    "p_brand AS UniqueCarrier",
    "CAST(l_partkey AS STRING) AS FlightNum",
    "Origin",
    "Dest",
    f"CAST({MINUTE} DIV 60 * 100 + {MINUTE} % 60 AS INT) AS CRSDepTime",
    f"CASE WHEN NOT ({NO_DEPARTURE_DELAY}) THEN CAST(l_quantity - 20 AS FLOAT) END AS DepDelay",
    f"CASE WHEN NOT ({NO_ARRIVAL_DELAY})"
    " THEN CAST(l_quantity - 24 + l_orderkey % 9 AS FLOAT) END AS ArrDelay",
)


# Files of suppliers up to this size are broadcast: their join with the nations looks far larger to Spark than it
# is, so the lines were shuffled by supplier for it.
SMALL_FILES = 16 << 20


def _small(spark: SparkSession, sf_dir: str, table: str) -> bool:
    """Whether a table is below ``SMALL_FILES``; never, where broadcasts are switched off."""
    if str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).startswith("-"):
        return False
    return path_size(spark, f"{sf_dir}/{table}.parquet") <= SMALL_FILES


def flights_view(
    spark: SparkSession,
    sf_dir: str,
    year: int | None = None,
    days: tuple[datetime.date, datetime.date] | None = None,
) -> DataFrame:
    """One flight per order line: supplier nation to customer nation, flown on the ship date.

    The dimension chains are joined first, so that the line table is shuffled by
    order and part key and never by a customer key. Suppliers come last and are
    broadcast up to ``SMALL_FILES``; for the others Spark broadcasts below its size
    threshold, sort-merges above it, and splits skewed keys at run time. ``year``
    and ``days`` (the first and the last) become ranges of ship dates, which reach
    the parquet scan.
    """
    nation = _read(spark, sf_dir, "nation")
    origin = (
        _read(spark, sf_dir, "supplier")
        .join(nation, F.expr("s_nationkey = n_nationkey"))
        .selectExpr("s_suppkey", "n_name AS Origin")
    )
    if _small(spark, sf_dir, "supplier"):
        origin = F.broadcast(origin)
    dest = (
        _read(spark, sf_dir, "customer")
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .selectExpr("c_custkey", "n_name AS Dest")
    )
    order_dest = (
        _read(spark, sf_dir, "orders")
        .join(dest, F.expr("o_custkey = c_custkey"))
        .select("o_orderkey", "Dest")
    )
    lines = _read(spark, sf_dir, "lineitem")
    if year is not None:
        lines = lines.where(
            f"l_shipdate >= TIMESTAMP_NTZ '{year:04d}-01-01' AND l_shipdate < TIMESTAMP_NTZ '{year + 1:04d}-01-01'")
    if days is not None:
        after = days[1] + datetime.timedelta(days=1)
        lines = lines.where(f"l_shipdate >= TIMESTAMP_NTZ '{days[0]}' AND l_shipdate < TIMESTAMP_NTZ '{after}'")
    return (
        lines
        .join(order_dest, F.expr("l_orderkey = o_orderkey"))
        .join(_read(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .join(origin, F.expr("l_suppkey = s_suppkey"))
        .selectExpr(*FLIGHT_COLUMNS)
    )
