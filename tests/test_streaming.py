"""Streaming runs: restart, rejected lines, state stores, all questions at once."""

import datetime
import os
import time

import pytest

from conftest import EDGE_LINES, rows
from skyledger import plans
from skyledger.jobs import batch, replay, stream
from skyledger.operators import TwoLegBounds, best_legs, complete_rows, mean_state
from skyledger.schema import FLIGHT_SCHEMA
from skyledger.session import shared_dir
from skyledger.sinks import Store, read_changes, read_latest, read_table
from skyledger.sources import decode_flights, read_messages, replay_lines
from skyledger.streaming import (
    AVAILABLE_NOW,
    EVERY_TEN_SECONDS,
    Upkeep,
    read_flight_log,
    read_question,
    read_rejects,
    running_best,
    running_mean,
    start_log,
    start_query,
    start_question,
    start_summary,
)
from skyledger.streaming import questions
from test_operators import AIRPORTS, FLIGHTS, START


def flights_of(spark, path, **limit):
    return decode_flights(read_messages(spark, path, **(limit or {"maxFilesPerTrigger": 1})))


@pytest.mark.parametrize("name, expected", [
    ("airport_popularity", plans.airport_popularity),
    ("route_mean", plans.route_mean_arr_delay),
])
def test_restart_goes_on_from_its_checkpoint(spark, edge_flights, folder, line_files, name, expected):
    root, path = folder(), line_files(EDGE_LINES[:9], 2)
    start_question(name, flights_of(spark, path), root, AVAILABLE_NOW).awaitTermination()
    partial = rows(read_question(spark, name, root))
    line_files(EDGE_LINES[9:], 2, path)
    start_question(name, flights_of(spark, path), root, AVAILABLE_NOW).awaitTermination()
    whole = rows(read_question(spark, name, root))
    assert partial != whole
    assert whole == rows(expected(edge_flights))
    again = start_question(name, flights_of(spark, path), root, AVAILABLE_NOW)
    again.awaitTermination()
    assert not again.recentProgress or again.recentProgress[-1].numInputRows == 0
    assert rows(read_question(spark, name, root)) == whole


@pytest.mark.parametrize("rocksdb", [False, True])
def test_argmin_state_equals_batch(spark, edge_flights, folder, line_files, rocksdb):
    root = folder()
    start_query(
        running_best(flights_of(spark, line_files(EDGE_LINES, 3))), f"{root}/t", f"{root}/c",
        lambda batch: batch, "update", AVAILABLE_NOW, rocksdb).awaitTermination()
    got = read_changes(spark, f"{root}/t", ("Origin", "Dest", "FlightDate"))
    assert rows(got) == rows(best_legs(complete_rows(edge_flights, ["ArrDelay"])))


def test_state_store_setting_does_not_stay_in_the_session(spark, folder, line_files):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    root = folder()
    query = start_query(
        running_best(flights_of(spark, line_files(EDGE_LINES))), f"{root}/t", f"{root}/c",
        lambda batch: batch, "update", AVAILABLE_NOW, rocksdb=True)
    assert spark.conf.get(key) == before
    query.awaitTermination()
    assert "rocksdbCommitFlushLatency" in query.recentProgress[0].stateOperators[0].customMetrics


def test_mean_state_equals_batch(spark, edge_flights, folder, line_files):
    root = folder()
    start_query(
        running_mean(flights_of(spark, line_files(EDGE_LINES, 4)), ["Origin", "Dest"], "DepDelay"),
        f"{root}/t", f"{root}/c", lambda batch: batch, "complete", AVAILABLE_NOW).awaitTermination()
    assert rows(read_latest(spark, f"{root}/t")) == rows(mean_state(edge_flights, ["Origin", "Dest"], "DepDelay"))


def test_failure_of_the_finishing_step_ends_the_query(spark, folder, line_files):
    root = folder()
    query = start_question("airport_popularity", flights_of(spark, line_files(EDGE_LINES)), root, AVAILABLE_NOW)
    query.awaitTermination()

    def broken(batch):
        raise ValueError("no result")

    bad = start_query(
        running_best(flights_of(spark, line_files(EDGE_LINES))), f"{root}/t", f"{root}/c", broken,
        "update", AVAILABLE_NOW)
    with pytest.raises(Exception, match="no result"):
        stream.wait_for([query, bad])


def test_bytes_can_limit_the_intake(spark, edge_flights, folder, line_files):
    root = folder()
    flights = flights_of(spark, line_files(EDGE_LINES, 3), maxBytesPerTrigger=1)
    query = start_question("airport_popularity", flights, root, AVAILABLE_NOW)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert rows(read_question(spark, "airport_popularity", root)) == rows(plans.airport_popularity(edge_flights))


def test_all_questions_over_one_input(spark, edge_flights, folder, line_files):
    root = folder()
    messages = read_messages(spark, line_files(EDGE_LINES, 2))
    stream.wait_for(stream.run_stream(messages, root, trigger=AVAILABLE_NOW))
    assert rows(read_question(spark, "airport_popularity", root)) == rows(plans.airport_popularity(edge_flights))
    assert rows(read_question(spark, "route_mean", root)) == rows(plans.route_mean_arr_delay(edge_flights))
    assert rows(read_question(spark, "origin_dest", root)) == rows(
        plans.origin_packed(edge_flights, "Dest", style="tuple"))
    trips = read_question(spark, "two_leg", root).select("airportx", "airporty", "airportz", "totaldelay")
    assert rows(trips) == [("BOS", "ATL", "LAX", -1.0), ("BOS", "JFK", "LAX", -4.0)]
    assert rows(read_rejects(spark, root)) == [("this line is malformed",)]
    assert rows(read_flight_log(spark, root)) == rows(edge_flights)


def test_jobs_from_csv_to_tables(spark, edge_flights, folder):
    csv, lines, streamed, tables = folder(), folder(), folder(), folder()
    edge_flights.write.option("header", True).csv(csv)
    replay.main(["--input", csv, "--output", lines])
    stream.main(["--input", lines, "--output", streamed, "--once", "--show"])
    batch.main(["--input", csv, "--output", tables])
    popularity = rows(plans.airport_popularity(edge_flights))
    assert rows(read_question(spark, "airport_popularity", streamed)) == popularity
    assert rows(read_table(spark, "results11", tables)) == popularity
    assert read_table(spark, "results32", tables).count() == 3


def test_results_also_go_to_a_keyed_store(spark, edge_flights, folder, line_files):
    root, kept = folder(), folder()
    store = Store("parquet", {"path": f"{kept}/{{table}}"})
    flights = flights_of(spark, line_files(EDGE_LINES))
    start_question("route_mean", flights, root, AVAILABLE_NOW, store=store).awaitTermination()
    batch.run_batch(spark, edge_flights, folder(), store=store)
    routes = rows(plans.route_mean_arr_delay(edge_flights))
    assert rows(read_table(spark, "results24", kept)) == sorted(routes + routes, key=repr)
    assert rows(read_table(spark, "results11", kept)) == rows(plans.airport_popularity(edge_flights))


EVERYWHERE = TwoLegBounds(AIRPORTS, AIRPORTS, AIRPORTS, [START + datetime.timedelta(days=i) for i in range(6)], 2008)


def test_stream_equals_batch_on_skewed_rows_with_tidying(spark, folder, monkeypatch):
    monkeypatch.setattr(questions, "TIDY_EVERY", 2)
    monkeypatch.setattr(questions, "KEEP_RESULTS", 1)
    root, lines = folder(), folder()
    named = [r for r in FLIGHTS if r[5] is not None]
    flights = spark.createDataFrame(named, FLIGHT_SCHEMA).repartition(4)
    replay_lines(flights, lines)
    stream.wait_for(stream.run_stream(
        read_messages(spark, lines, maxFilesPerTrigger=1), root, EVERYWHERE, AVAILABLE_NOW, maxFilesPerTrigger="1"))
    expected = {
        "airport_popularity": plans.airport_popularity(flights),
        "carrier_punctuality": plans.carrier_punctuality(flights, round_before_rank=False),
        "origin_carrier": plans.origin_packed(flights, "UniqueCarrier", style="tuple"),
        "origin_dest": plans.origin_packed(flights, "Dest", style="tuple"),
        "route_mean": plans.route_mean_arr_delay(flights),
        "two_leg": plans.two_leg_all(flights, 2008, ["ArrDelay"]),
    }
    for name, batch_answer in expected.items():
        answer = read_question(spark, name, root)
        assert rows(answer) == rows(batch_answer.select(*answer.columns)), name
    assert len(os.listdir(f"{root}/results11")) <= 2
    assert os.listdir(f"{root}/results24/folds") != [] and os.listdir(f"{root}/results32/folds") != []


def test_no_answer_before_the_first_batch_is_no_rows(spark, folder):
    from skyledger.schema import RESULT_TABLES
    from skyledger.streaming import STREAM_QUESTIONS, read_question

    for name, question in STREAM_QUESTIONS.items():
        answer = read_question(spark, name, folder())
        assert answer.count() == 0 and answer.columns == RESULT_TABLES[question.table].schema.fieldNames()


def test_a_backlog_is_taken_in_over_several_batches(spark, edge_flights, folder, line_files, monkeypatch):
    monkeypatch.setattr(stream, "FILE_INTAKE", {"maxBytesPerTrigger": "1"})
    root = folder()
    stream.main(["--input", line_files(EDGE_LINES, 3), "--output", root, "--once"])
    batches = [p for p in os.listdir(f"{root}/_checkpoints/log/commits") if p.isdigit()]
    assert len(batches) == 3
    assert rows(read_question(spark, "airport_popularity", root)) == rows(plans.airport_popularity(edge_flights))


def test_a_given_intake_limit_replaces_the_default():
    assert stream.with_intake("text", {"maxFilesPerTrigger": "2"}) == {"maxFilesPerTrigger": "2"}
    assert "maxBytesPerTrigger" in stream.with_intake("text", {"lineSep": "x"})
    assert "maxOffsetsPerTrigger" in stream.with_intake("kafka", {})


def test_the_batch_job_leaves_no_staged_copies(spark, edge_flights, folder):
    def staged():
        root = shared_dir(spark)
        return {p for p in os.listdir(root) if p.startswith(("flights-", "summary-"))} if os.path.isdir(root) else set()

    csv, tables, before = folder(), folder(), staged()
    edge_flights.write.option("header", True).csv(csv)
    batch.main(["--input", csv, "--output", tables])
    assert staged() == before
    with pytest.raises(Exception, match="no-such-format"):
        batch.main(["--input", csv, "--output", tables, "--output-format", "no-such-format"])
    assert staged() == before
    assert read_table(spark, "results32", tables).count() == 3


def test_the_ten_second_trigger_starts_a_batch_after_each_interval(spark, edge_flights, folder, line_files):
    root = folder()
    flights = flights_of(spark, line_files(EDGE_LINES, 2))
    query = start_question("airport_popularity", flights, root, EVERY_TEN_SECONDS)
    end = time.monotonic() + 90
    try:
        while time.monotonic() < end and sum(p.numInputRows > 0 for p in query.recentProgress) < 2:
            time.sleep(0.5)
        taken = [p for p in query.recentProgress if p.numInputRows]
    finally:
        query.stop()
    assert len(taken) == 2
    first, second = (datetime.datetime.fromisoformat(p.timestamp.rstrip("Z")) for p in taken)
    assert (second - first).total_seconds() >= 1 and second.second % 10 == 0
    assert rows(read_question(spark, "airport_popularity", root)) == rows(plans.airport_popularity(edge_flights))


def state_partitions(root, table):
    return {p for p in os.listdir(f"{root}/_checkpoints/{table}/state/0") if p.isdigit()}


def test_a_given_number_of_state_partitions_wins(spark, folder, line_files):
    root = folder()
    asked = int(spark.conf.get("spark.sql.shuffle.partitions")) + 3
    flights = flights_of(spark, line_files(EDGE_LINES))
    start_question("airport_popularity", flights, root, AVAILABLE_NOW, partitions=asked).awaitTermination()
    start_question("two_leg", flights, root, AVAILABLE_NOW, EVERYWHERE).awaitTermination()
    assert len(state_partitions(root, "results11")) == asked
    assert len(state_partitions(root, "results32")) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_missing_carrier_counts_in_the_running_summary(spark, folder, line_files):
    root = folder()
    lines = [*EDGE_LINES, "2008,4,2008-04-03,,77,BOS,ATL,0900,5,10", "2008,4,2008-04-03,,78,BOS,ATL,0900,7,11"]
    flights = decode_flights(spark.createDataFrame([(line,) for line in lines], "value STRING"))
    start_summary(
        flights_of(spark, line_files(lines, 4)), root, AVAILABLE_NOW, upkeep=Upkeep(every=2, keep=1)).awaitTermination()
    for name, answer in {
        "airport_popularity": plans.airport_popularity(flights),
        "carrier_punctuality": plans.carrier_punctuality(flights, round_before_rank=False),
        "route_mean": plans.route_mean_arr_delay(flights),
    }.items():
        got = read_question(spark, name, root)
        assert rows(got) == rows(answer.select(*got.columns)), name


def test_a_restarted_log_loses_and_doubles_nothing(spark, edge_flights, folder, line_files):
    root, lines = folder(), line_files(EDGE_LINES[:7], 2)
    run = lambda: start_log(read_messages(spark, lines, maxFilesPerTrigger=1), root, AVAILABLE_NOW).awaitTermination()
    assert read_flight_log(spark, root).collect() == [] == read_rejects(spark, root).collect()
    run()
    first = read_flight_log(spark, root).count()
    line_files(EDGE_LINES[7:], 3, lines)
    # Files of a batch that never was committed are not read.
    os.makedirs(f"{root}/log/kind=flights", exist_ok=True)
    edge_flights.selectExpr("*", "cast(null as string) line").write.mode("append").parquet(f"{root}/log/kind=flights")
    run()
    run()
    assert first == 7
    assert rows(read_flight_log(spark, root)) == rows(edge_flights)
    assert rows(read_rejects(spark, root)) == [("this line is malformed",)]


def test_a_line_is_parsed_once_and_followers_parse_nothing(spark, folder, line_files):
    root = folder()
    messages = read_messages(spark, line_files(EDGE_LINES))
    log, *followers = stream.run_stream(messages, root, trigger=AVAILABLE_NOW)
    stream.wait_for(followers)
    plans_of = lambda query: query._jsq.explainInternal(False)
    assert plans_of(log).count("from_csv") == 1
    assert followers and all("from_csv" not in plans_of(q) and "FileScan" in plans_of(q) for q in followers)
