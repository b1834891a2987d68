"""The flight questions, answered continuously.

A question is a running aggregate plus the finishing step that turns its state
into the result table; the finishing steps are those of the batch questions.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators import TwoLegBounds, bounded_legs
from skyledger.plans.questions import (
    finish_routes,
    pack_origin,
    rank_airports,
    rank_carriers,
    rank_within_origin,
)
from skyledger.plans.summary import SUMMARY_KEYS, answers_from_summary, flight_summary
from skyledger.schema import RESULT_TABLES, conform
from skyledger.session import session_conf
from skyledger.sinks import (
    Store,
    batch_writer,
    carry_forward,
    has_results,
    prune_results,
    read_latest,
    write_to_store,
)
from skyledger.sinks.keyed import KeyedTable, changes_writer, open_table, read_rows
from skyledger.streaming.runner import start_batches, start_query
from skyledger.streaming.states import running_mean, running_visits
from skyledger.streaming.trips import changed_trips, read_trips, start_trips


class StreamQuestion(NamedTuple):
    table: str
    state: Callable[..., DataFrame]
    finish: Callable[[DataFrame], DataFrame]
    partitions: int | None = None
    mode: str = "complete"
    rocksdb: bool = False


def _packed(key: str) -> Callable[[DataFrame], DataFrame]:
    def finish(state: DataFrame) -> DataFrame:
        means = state.select("Origin", key, "mean")
        return pack_origin(rank_within_origin(means, key), key, "tuple")

    return finish


# State partitions of the states whose keys do not grow with the flights: airports, carriers
# and their pairs. Each map task sends at most one row per key to these partitions.
# ``start_question`` takes another number.
FEW_KEYS = 8
PAIRED_KEYS = 32

# A continuous query tidies its table after every so many batches: old whole
# results are deleted, changed rows are folded.
TIDY_EVERY = 100
KEEP_RESULTS = 10

# Whole states are handed over each time, but route means, the largest of them,
# hand over changes only. Trips have a state that grows with the calendar: it is kept outside
# the heap, in the session's partitions, and hands over changes, which ``trips`` joins.
STREAM_QUESTIONS = {
    "airport_popularity": StreamQuestion("results11", running_visits, rank_airports, FEW_KEYS),
    "carrier_punctuality": StreamQuestion(
        "results12",
        lambda flights: running_mean(flights, ["UniqueCarrier"], "ArrDelay"),
        lambda state: rank_carriers(state, round_before_rank=False),
        FEW_KEYS),
    "origin_carrier": StreamQuestion(
        "results21",
        lambda flights: running_mean(flights, ["Origin", "UniqueCarrier"], "DepDelay"),
        _packed("UniqueCarrier"),
        PAIRED_KEYS),
    "origin_dest": StreamQuestion(
        "results22",
        lambda flights: running_mean(flights, ["Origin", "Dest"], "DepDelay"),
        _packed("Dest"),
        PAIRED_KEYS),
    "route_mean": StreamQuestion(
        "results24",
        lambda flights: running_mean(flights, ["Origin", "Dest"], "ArrDelay"),
        lambda state: finish_routes(state.select("Origin", "Dest", "mean")),
        PAIRED_KEYS, mode="update"),
    "two_leg": StreamQuestion("results32", bounded_legs, changed_trips, mode="update", rocksdb=True),
}


class Upkeep(NamedTuple):
    """How often a continuous query tidies its tables, and how many whole results it then keeps."""

    every: int
    keep: int


def _upkeep(given: Upkeep | None) -> Upkeep:
    return given or Upkeep(TIDY_EVERY, KEEP_RESULTS)


def _prune(spark: SparkSession, path: str, batch_id: int, upkeep: Upkeep) -> None:
    if (batch_id + 1) % upkeep.every == 0:
        prune_results(spark, path, upkeep.keep)


def _to_store(store: Store | None, table: str) -> Callable[[DataFrame, int], None] | None:
    return (lambda stored, _: write_to_store(stored, table, store)) if store else None


def _keyed(spark: SparkSession, root: str, table: str, make: bool = True) -> KeyedTable:
    schema, keys = RESULT_TABLES[table]
    return open_table(spark, f"{root}/{table}", schema, keys, make=make)


def start_question(
    name: str,
    flights: DataFrame,
    root: str,
    trigger: dict | None = None,
    bounds: TwoLegBounds | None = None,
    show: int = 0,
    store: Store | None = None,
    partitions: int | None = None,
    upkeep: Upkeep | None = None,
) -> StreamingQuery:
    """Start one question on a flight stream, with result and checkpoint under ``root``.

    With a ``store``, every result is also written there, to be merged by key.
    ``partitions`` of the state replace the question's own number; the checkpoint keeps them.
    """
    kept, spark = _upkeep(upkeep), flights.sparkSession
    if name == "two_leg":
        return start_trips(flights, root, bounds, trigger, show, store, partitions, kept.every)
    question = STREAM_QUESTIONS[name]
    table, checkpoint = question.table, f"{root}/_checkpoints/{question.table}"
    also = _to_store(store, table)
    schema = RESULT_TABLES[table].schema

    def finish(batch: DataFrame) -> DataFrame:
        return conform(question.finish(batch), schema)

    if question.mode == "update":
        take_in = changes_writer(_keyed(spark, root, table), finish, kept.every, show, also)
        return start_batches(
            question.state(flights), checkpoint, take_in, "update", trigger, question.rocksdb, partitions or question.partitions)

    def end(stored: DataFrame, batch_id: int) -> None:
        if also:
            also(stored, batch_id)
        _prune(spark, f"{root}/{table}", batch_id, kept)

    return start_query(
        question.state(flights), f"{root}/{table}", checkpoint, finish, question.mode, trigger, question.rocksdb,
        partitions or question.partitions, show=show, also=end)


def start_summary(
    flights: DataFrame,
    root: str,
    trigger: dict | None = None,
    show: int = 0,
    store: Store | None = None,
    partitions: int | None = PAIRED_KEYS,
    upkeep: Upkeep | None = None,
) -> StreamingQuery:
    """The five questions but the two-leg one from one running summary: one read of the input, one state.

    A micro-batch stores the summary's changed rows, and the whole summary from that of the
    batch before it and these rows. From it the answers are made and stored under the id of the
    batch, so a replayed batch overwrites its own; of the routes only the changed ones.
    ``read_question`` reads the answers. A root on which single questions were started before
    cannot be carried on: its batch ids are others.
    """
    path, kept = f"{root}/summary", _upkeep(upkeep)
    keyed = {
        question.table: _keyed(flights.sparkSession, root, question.table)
        for name, question in STREAM_QUESTIONS.items() if question.mode == "update" and name != "two_leg"}

    def answer(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        with session_conf(spark, spark__sql__adaptive__enabled="true"):
            summary = carry_forward(spark, f"{path}-newest", changed, SUMMARY_KEYS, batch_id)
            routes = changed.select("Origin", "Dest").distinct()
            same = summary["Origin"].eqNullSafe(routes["Origin"]) & summary["Dest"].eqNullSafe(routes["Dest"])
            answers = answers_from_summary(summary, style="tuple", round_before_rank=False)
            answers |= {table: made for table, made in answers_from_summary(
                summary.join(routes, same, "left_semi")).items() if table in keyed}
            for table, made in answers.items():
                also, rows = _to_store(store, table), conform(made, RESULT_TABLES[table].schema)
                if table in keyed:
                    changes_writer(keyed[table], lambda df: df, kept.every, show, also)(rows, batch_id)
                else:
                    batch_writer(f"{root}/{table}", lambda df: df, show=show, also=also)(rows, batch_id)
                    _prune(spark, f"{root}/{table}", batch_id, kept)
        _prune(spark, path, batch_id, kept)

    return start_query(
        flight_summary(flights), path, f"{root}/_checkpoints/summary", lambda batch: batch,
        "update", trigger, partitions=partitions, also=answer)


def start_all(
    flights: DataFrame,
    root: str,
    bounds: TwoLegBounds,
    trigger: dict | None = None,
    show: int = 0,
    store: Store | None = None,
    upkeep: Upkeep | None = None,
) -> list[StreamingQuery]:
    """All questions over one input, which is read twice: for the summary and for the two-leg trips."""
    return [
        start_summary(flights, root, trigger, show, store, upkeep=upkeep),
        start_question("two_leg", flights, root, trigger, bounds, show, store, upkeep=upkeep),
    ]


def read_question(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The current answer of a question started under ``root``; before its first batch, no rows."""
    question = STREAM_QUESTIONS[name]
    if name == "two_leg":
        return read_trips(spark, root)
    if question.mode == "update":
        return read_rows(spark, _keyed(spark, root, question.table, make=False))
    path = f"{root}/{question.table}"
    if not has_results(spark, path):
        return spark.createDataFrame([], RESULT_TABLES[question.table].schema)
    return read_latest(spark, path)
