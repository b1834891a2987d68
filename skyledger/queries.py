"""The registered queries: every operator over the whole given tables.

``b_*`` queries are lazy batch plans over ``flights_view``. ``s_*`` queries
replay the same flights as message lines, run a streaming query over them to the
end in several micro-batches, and return its stored answer.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger import plans
from skyledger.functions import mean_of, unit_of
from skyledger.jobs.batch import run_batch
from skyledger.operators import TwoLegBounds, TwoLegSets, complete_rows, day_range, endpoint_counts
from skyledger.operators.legs import LEG_KEYS
from skyledger.plans.summary import answers_from_summary, flight_summary
from skyledger.schema import FLIGHT_SCHEMA, RESULT_TABLES, conform
from skyledger.session import new_dir, path_exists
from skyledger.sinks import read_changes, read_latest, read_table, write_table
from skyledger.sources import (
    decode_flights,
    flights_view,
    read_flights_csv,
    read_messages,
    read_scan,
    replay_lines,
    scan_flights_csv,
    write_scan,
)
from skyledger.streaming import (
    AVAILABLE_NOW,
    STREAM_QUESTIONS,
    read_question,
    running_best,
    running_mean,
    running_visits,
    read_flight_log,
    read_rejects,
    read_state,
    start_all,
    start_from_log,
    start_query,
    start_question,
    start_state,
    start_summary,
)
from skyledger.streaming.questions import FEW_KEYS

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 1998
BOUNDS = TwoLegBounds(
    xs=[f"NATION_{i}" for i in range(0, 10)],
    ys=[f"NATION_{i}" for i in range(5, 15)],
    zs=[f"NATION_{i}" for i in range(10, 20)],
    dates=[datetime.date(1998, 1, 1) + datetime.timedelta(days=i) for i in range(100)],
    year=YEAR,
)
# The same question with its days as text.
TEXT_BOUNDS = BOUNDS._replace(dates=[f"{d:%d/%m/%Y}" for d in BOUNDS.dates])

# Lines of a replayed file, and what a micro-batch takes in, at most.
LINES_PER_FILE = 5_000_000
INTAKE = {"maxBytesPerTrigger": str(1 << 30)}


# --- batch ---------------------------------------------------------------

def _csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "csv")
    flights_view(spark, sf_dir).write.option("header", True).csv(path)
    return read_flights_csv(spark, path)


def _csv_two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the flights with their columns turned round and one more between them, in one folder with the rest."""
    path, flights = new_dir(spark, "csv"), flights_view(spark, sf_dir)
    odd = F.col("CRSDepTime") % 2 == 1
    turned = flights.where(odd).select(*reversed(flights.columns)).withColumns({"Note": F.lit("a, b")})
    for part in (flights.where(~odd), turned.select("Note", *turned.columns[:-1])):
        part.write.mode("append").option("header", True).csv(path)
    return read_flights_csv(spark, path)


BAD_LINE = "no flight: "


def _csv_with_bad_lines(spark: SparkSession, sf_dir: str) -> str:
    """Headed files of all flights, with a line that is none after some of them."""
    path, flights = new_dir(spark, "csv"), flights_view(spark, sf_dir)
    bad = F.when(F.col("FlightNum").cast("long") % 11 == 0, F.concat(F.lit(BAD_LINE), "FlightNum"))
    # A task writes one file, and its first row brings the header: the id counts the rows of a task from 0 in its
    # lower 33 bits. Nothing is gathered or sorted, so files grow in number with the flights, and tasks hold a row.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = flights.select(
        F.when(first, F.lit(",".join(flights.columns))).alias("header"),
        F.to_csv(F.struct(*flights.columns)).alias("line"), bad.alias("bad"))
    whole = lines.select(F.explode(F.array_compact(F.array("header", "line", "bad"))).alias("value"))
    whole.write.option("maxRecordsPerFile", 0).text(path)
    return path


def _scanned(rejects: bool) -> Query:
    """The flights of a stored scan of files with bad lines, or those lines."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = write_scan(scan_flights_csv(spark, _csv_with_bad_lines(spark, sf_dir)), new_dir(spark, "scan"))
        return read_scan(spark, path)[rejects]

    return query


def _table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "tables")
    write_table(plans.route_mean_arr_delay(flights_view(spark, sf_dir)), "results24", root)
    return read_table(spark, "results24", root)


def _on_flights(question: Callable[[DataFrame], DataFrame], year: int | None = None) -> Query:
    return lambda spark, sf_dir: question(flights_view(spark, sf_dir, year))


def _two_leg_bounded(bounds: TwoLegBounds) -> Query:
    return lambda spark, sf_dir: plans.two_leg_bounded(
        flights_view(spark, sf_dir, days=day_range(bounds)), bounds)


def _set_tables(spark: SparkSession, sf_dir: str) -> TwoLegSets:
    """The sets of ``BOUNDS`` as tables, made from the nations and the days that any line has."""
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    number = F.regexp_extract("n_name", "([0-9]+)$", 1).cast("int")
    roles = nations.select(F.col("n_name").alias("airport"), F.explode(F.filter(F.array(
        F.when(number.between(0, 9), F.lit("x")), F.when(number.between(5, 14), F.lit("y")),
        F.when(number.between(10, 19), F.lit("z"))), lambda role: role.isNotNull())).alias("role"))
    days = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.to_date("l_shipdate").alias("day"))
    return TwoLegSets(roles, days.where(F.col("day").between(BOUNDS.dates[0], BOUNDS.dates[-1])).distinct(), YEAR)


def _two_leg_by_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.two_leg_by_tables(flights_view(spark, sf_dir, YEAR), _set_tables(spark, sf_dir))


def _published(table: str) -> Query:
    """A result table of the batch job's second run under one root."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, flights = new_dir(spark, "published"), flights_view(spark, sf_dir)
        for rows in (flights.where(F.col("CRSDepTime") < 1200), flights):
            run_batch(spark, rows, root, YEAR)
        return read_table(spark, table, root)

    return query


def _from_summary(table: str) -> Query:
    """A result table the way the batch job makes it: from one summary of all flights."""
    return lambda spark, sf_dir: answers_from_summary(flight_summary(flights_view(spark, sf_dir)))[table]


# The questions that share the summary, by the name of their single query.
SUMMARY_TABLES = {
    "airport_popularity_top10": "results11",
    "carrier_ontime_top10": "results12",
    "origin_carrier_packed": "results21",
    "origin_dest_packed": "results22",
    "route_mean_arr_delay": "results24",
}

BATCH: dict[str, Query] = {
    "b_csv_scan_typed": _csv_scan_typed,
    "b_csv_two_layouts": _csv_two_layouts,
    "b_csv_scan_kept": _scanned(rejects=False),
    "b_csv_scan_rejects": _scanned(rejects=True),
    "b_table_roundtrip": _table_roundtrip,
    "b_complete_rows": _on_flights(complete_rows),
    "b_endpoint_counts": _on_flights(endpoint_counts),
    "b_airport_popularity_top10": _on_flights(plans.airport_popularity),
    "b_carrier_ontime_top10": _on_flights(plans.carrier_punctuality),
    "b_origin_carrier_top10": _on_flights(lambda f: plans.origin_top(f, "UniqueCarrier")),
    "b_origin_dest_top10": _on_flights(lambda f: plans.origin_top(f, "Dest")),
    "b_origin_carrier_packed": _on_flights(lambda f: plans.origin_packed(f, "UniqueCarrier")),
    "b_origin_dest_packed": _on_flights(lambda f: plans.origin_packed(f, "Dest")),
    "b_route_mean_arr_delay": _on_flights(plans.route_mean_arr_delay),
    "b_leg1_best": _on_flights(lambda f: plans.first_legs(f, YEAR), YEAR),
    "b_leg2_best": _on_flights(lambda f: plans.second_legs(f, YEAR), YEAR),
    "b_two_leg_all": _on_flights(lambda f: plans.two_leg_all(f, YEAR), YEAR),
    "b_two_leg_bounded": _two_leg_bounded(BOUNDS),
    "b_two_leg_text_days": _two_leg_bounded(TEXT_BOUNDS),
    "b_two_leg_by_tables": _two_leg_by_tables,
    "b_published_routes": _published("results24"),
    **{f"b_summary_{name}": _from_summary(table) for name, table in SUMMARY_TABLES.items()},
}


# --- stream --------------------------------------------------------------

_topics: dict[tuple[str, str], str] = {}


def _replay(flights: DataFrame, path: str) -> None:
    replay_lines(flights, path, maxRecordsPerFile=LINES_PER_FILE)


def shared_topic(spark: SparkSession, sf_dir: str) -> str:
    """The flights as message files; all streaming queries of an application read one replay."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _topics or not path_exists(spark, _topics[key]):
        path = new_dir(spark, "topic")
        _replay(flights_view(spark, sf_dir), path)
        _topics[key] = path
    return _topics[key]


def _stream(spark: SparkSession, path: str) -> DataFrame:
    return decode_flights(read_messages(spark, path, **INTAKE))


def _wait(query) -> None:
    query.awaitTermination()


def _replay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_flights(spark.read.text(shared_topic(spark, sf_dir)))


def _wire_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "decoded")
    _wait(
        _stream(spark, shared_topic(spark, sf_dir)).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**AVAILABLE_NOW).start(f"{root}/flights"))
    return spark.read.parquet(f"{root}/flights")


def _final_state(state: Callable[[DataFrame], DataFrame]) -> Query:
    """The last whole state of a running aggregate with few keys."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = new_dir(spark, "state")
        _wait(start_query(
            state(_stream(spark, shared_topic(spark, sf_dir))), f"{root}/state", f"{root}/checkpoint",
            lambda batch: batch, "complete", AVAILABLE_NOW, partitions=FEW_KEYS))
        return read_latest(spark, f"{root}/state")

    return query


def _argmin_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "state")
    _wait(start_query(
        running_best(_stream(spark, shared_topic(spark, sf_dir))), f"{root}/state", f"{root}/checkpoint",
        lambda batch: batch, "update", AVAILABLE_NOW, rocksdb=True))
    return read_changes(spark, f"{root}/state", LEG_KEYS)


def _stored_state(state: Callable[[DataFrame], DataFrame], values: list[str], finish: Callable[[DataFrame], DataFrame]) -> Query:
    """A running aggregate that is kept in the checkpoint alone, and read from there."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        checkpoint = new_dir(spark, "checkpoint")
        _wait(start_state(state(_stream(spark, shared_topic(spark, sf_dir))), checkpoint, AVAILABLE_NOW))
        return finish(read_state(spark, checkpoint, values))

    return query


_finished: dict[tuple[str, str, str], str] = {}


def _finished_run(spark: SparkSession, sf_dir: str, name: str, run: Callable[[str], None]) -> str:
    """The root of a run that several queries read; an application makes it once."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _finished or not path_exists(spark, _finished[key]):
        root = new_dir(spark, name)
        run(root)
        _finished[key] = root
    return _finished[key]


def _question(name: str, bounds: TwoLegBounds | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = new_dir(spark, name)
        flights = _stream(spark, shared_topic(spark, sf_dir))
        _wait(start_question(name, flights, root, AVAILABLE_NOW, bounds))
        return _answer(spark, name, root)

    return query


def _answer(spark: SparkSession, name: str, root: str) -> DataFrame:
    return conform(read_question(spark, name, root), RESULT_TABLES[STREAM_QUESTIONS[name].table].schema)


def _from_running_summary(name: str) -> Query:
    """A question's answer from the one running summary of all flights."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        topic = shared_topic(spark, sf_dir)
        return _answer(spark, name, _finished_run(spark, sf_dir, "summary", lambda root: _wait(
            start_summary(_stream(spark, topic), root, AVAILABLE_NOW))))

    return query


def _all_questions(name: str) -> Query:
    """A question's answer while all of them run over one input."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = new_dir(spark, f"all-{name}")
        flights = _stream(spark, shared_topic(spark, sf_dir))
        for started in start_all(flights, root, TEXT_BOUNDS, AVAILABLE_NOW):
            _wait(started)
        return _answer(spark, name, root)

    return query


def _log_run(spark: SparkSession, sf_dir: str) -> str:
    """The root of all questions over a log of the lines and of some that are no flights, decoded in two runs."""

    def run(root: str) -> None:
        topic, lines = new_dir(spark, "topic"), spark.read.text(shared_topic(spark, sf_dir))
        early = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
        number = F.split("value", ",")[FLIGHT_SCHEMA.fieldNames().index("FlightNum")]
        bad = lines.where(number.cast("long") % 11 == 0).select(F.concat(F.lit(BAD_LINE), number).alias("value"))
        for part in (lines.where(early), lines.where(~early).unionByName(bad)):
            part.write.mode("append").text(topic)
            for query in start_from_log(read_messages(spark, topic, **INTAKE), root, BOUNDS, AVAILABLE_NOW):
                _wait(query)

    return _finished_run(spark, sf_dir, "log", run)


def _from_log(name: str) -> Query:
    return lambda spark, sf_dir: _answer(spark, name, _log_run(spark, sf_dir))


def _resumed(name: str, parts: Callable[[], list[Column]], bounds: TwoLegBounds | None = None) -> Query:
    """A question over several runs, with a stop after each part of the lines, under one checkpoint."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, topic = new_dir(spark, f"resumed-{name}"), new_dir(spark, "topic")
        flights = decode_flights(spark.read.text(shared_topic(spark, sf_dir)))
        for part in parts():
            _replay(flights.where(F.coalesce(part, F.lit(False))), topic)
            _wait(start_question(name, _stream(spark, topic), root, AVAILABLE_NOW, bounds))
        return _answer(spark, name, root)

    return query


def _halves() -> list[Column]:
    """Morning, then the rest."""
    morning = F.coalesce(F.col("CRSDepTime") < 1200, F.lit(False))
    return [morning, ~morning]


def _thirds() -> list[Column]:
    """By flight number: later parts better some of the legs of earlier ones, on both sides of the noon."""
    third = F.pmod(F.xxhash64("FlightNum"), F.lit(3))
    return [third == i for i in range(3)]


# The questions that share the running summary, by the name of their single query.
SUMMARY_QUESTIONS = {
    "airport_popularity_top10": "airport_popularity",
    "carrier_ontime_top10": "carrier_punctuality",
    "origin_carrier_packed": "origin_carrier",
    "origin_dest_packed": "origin_dest",
    "route_mean_arr_delay": "route_mean",
}

STREAM: dict[str, Query] = {
    "s_replay_lines": _replay_lines,
    "s_wire_decode": _wire_decode,
    "s_state_sum": _final_state(running_visits),
    "s_state_avg": _final_state(lambda f: running_mean(f, ["UniqueCarrier"], "ArrDelay")),
    "s_state_argmin": _argmin_state,
    "s_stored_argmin": _stored_state(
        running_best, ["best"], lambda s: s.select(*LEG_KEYS, "best.*")),
    "s_stored_avg": _stored_state(
        lambda f: running_mean(f, ["UniqueCarrier"], "ArrDelay"), ["parts", "any", "n"],
        lambda s: s.select("UniqueCarrier", unit_of(F.col("parts")).alias("total"), "n", mean_of(F.col("parts"), F.col("n")).alias("mean"))),
    "s_airport_popularity_top10": _question("airport_popularity"),
    "s_carrier_ontime_top10": _question("carrier_punctuality"),
    "s_origin_carrier_packed": _question("origin_carrier"),
    "s_origin_dest_packed": _question("origin_dest"),
    "s_route_mean_arr_delay": _question("route_mean"),
    "s_two_leg_bounded": _question("two_leg", BOUNDS),
    "s_restart_resume": _resumed("airport_popularity", _halves),
    "s_two_leg_resume": _resumed("two_leg", _thirds, BOUNDS),
    "s_route_mean_resume": _resumed("route_mean", _thirds),
    "s_log_flights": lambda spark, sf_dir: read_flight_log(spark, _log_run(spark, sf_dir)),
    "s_log_rejects": lambda spark, sf_dir: read_rejects(spark, _log_run(spark, sf_dir)),
    "s_log_origin_carrier_packed": _from_log("origin_carrier"),
    "s_log_two_leg_bounded": _from_log("two_leg"),
    **{f"s_summary_{name}": _from_running_summary(question) for name, question in SUMMARY_QUESTIONS.items()},
    "s_all_two_leg_bounded": _all_questions("two_leg"),
}


def all_queries() -> dict[str, Query]:
    return {**BATCH, **STREAM}
