"""The two-leg trips, continuously, by a delta join.

The best leg per (route, day) is running state. A micro-batch hands over only the legs that it changed. They
are set in a keyed table, dealt to buckets by where and when the legs of a trip meet, (Y, day of the first
leg). Only the buckets of the changed legs are read, only the legs that meet one of them are joined, and
only pairs with a changed leg are made: changed first legs with all second ones, and the others with changed
second ones. Their trips replace those with the same key in the result, a keyed table as well. The work
of a batch thus follows its changes and what they meet, not the calendar.

Legs only get better, and never vanish, so no trip has to be taken back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from skyledger.operators import TwoLegBounds, bounded_legs, pair_legs, split_legs
from skyledger.operators.legs import LEG_KEYS, LEG_ORDER, STOPOVER_DAYS
from skyledger.schema import FLIGHT_SCHEMA, RESULT_TABLES, conform
from skyledger.sinks import Store, write_to_store
from skyledger.sinks.keyed import (
    BUCKETS,
    KeyedTable,
    changed_buckets,
    changes_writer,
    newest_rows,
    open_table,
    read_rows,
    read_versions,
)
from skyledger.streaming.runner import start_batches

TABLE = "results32"

MEETING = ("meet_at", "meet_day")
LEG_SCHEMA = StructType([
    *(FLIGHT_SCHEMA[name] for name in (*LEG_KEYS, *LEG_ORDER)),
    StructField("leg", IntegerType()), StructField("meet_at", StringType()), StructField("meet_day", DateType())])


def with_meeting(legs: DataFrame) -> DataFrame:
    """Legs with the airport and day they can be joined on: the first leg's destination and day."""
    first = F.col("leg") == 1
    return legs.withColumns({
        "meet_at": F.when(first, F.col("Dest")).otherwise(F.col("Origin")),
        "meet_day": F.when(first, F.col("FlightDate")).otherwise(F.date_sub("FlightDate", STOPOVER_DAYS))})


def legs_table(spark: SparkSession, root: str, buckets: int = BUCKETS) -> KeyedTable:
    return open_table(spark, f"{root}/legs", LEG_SCHEMA, ("leg", *LEG_KEYS), MEETING, buckets)


def trips_table(spark: SparkSession, root: str, buckets: int = BUCKETS, make: bool = True) -> KeyedTable:
    schema, keys = RESULT_TABLES[TABLE]
    return open_table(spark, f"{root}/{TABLE}", schema, keys, ("flightdate1", "airporty"), buckets, make)


def legs_met(spark: SparkSession, legs: KeyedTable, changed: DataFrame, batch_id: int) -> DataFrame:
    """The newest legs that meet one of ``changed`` (these included), with ``changed`` where batch ``batch_id`` set them.

    After a replay of a batch that is folded already, ``changed`` may hold for more legs of the
    bucket; their trips are then set again as they are.
    """
    near = newest_rows(legs, read_versions(spark, legs, changed_buckets(spark, legs, [batch_id])))
    meetings = changed.select(*MEETING).distinct()
    return near.join(meetings, list(MEETING), "left_semi").withColumn("changed", F.col("batch_id") == batch_id)


def changed_trips(near: DataFrame) -> DataFrame:
    """The trips with a changed leg, or two."""
    return pair_legs(*split_legs(near), changed="changed")


def start_trips(
    flights: DataFrame,
    root: str,
    bounds: TwoLegBounds,
    trigger: dict | None = None,
    show: int = 0,
    store: Store | None = None,
    partitions: int | None = None,
    fold_every: int = 100,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the trips within ``bounds`` under ``root``; the options are those of ``start_question``."""
    spark = flights.sparkSession
    legs, trips = legs_table(spark, root, buckets), trips_table(spark, root, buckets)

    def join(changed: DataFrame, batch_id: int) -> None:
        made = changed_trips(legs_met(changed.sparkSession, legs, changed, batch_id))
        set_trips(conform(made, trips.schema), batch_id)

    set_trips = changes_writer(
        trips, lambda made: made, fold_every, show,
        also=(lambda stored, _: write_to_store(stored, TABLE, store)) if store else None)
    take_in = changes_writer(legs, with_meeting, fold_every, also=join)
    return start_batches(
        bounded_legs(flights, bounds), f"{root}/_checkpoints/{TABLE}", take_in, "update", trigger,
        rocksdb=True, partitions=partitions)


def read_trips(spark: SparkSession, root: str) -> DataFrame:
    return read_rows(spark, trips_table(spark, root, make=False))
