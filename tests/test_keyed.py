"""Keyed tables dealt to buckets, and the delta join of the continuous trips on them."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from skyledger import plans
from skyledger.operators import TwoLegBounds
from skyledger.schema import FLIGHT_SCHEMA
from skyledger.sinks import manifests
from skyledger.sinks.keyed import (
    bucket_of,
    changed_buckets,
    changes_writer,
    fold,
    has_changes,
    open_table,
    read_rows,
    read_versions,
    write_changes,
)
from skyledger.sources import decode_flights, read_messages, replay_lines
from skyledger.streaming import AVAILABLE_NOW, read_question, start_question
from skyledger.streaming.trips import legs_met, legs_table, trips_table
from test_operators import AIRPORTS, FLIGHTS, START

SCHEMA = "k string, part int, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture
def table(spark, folder):
    return open_table(spark, folder(), frame(spark).schema, ["k", "part"], ["part"], buckets=8)


def files_under(path):
    return {
        os.path.join(where, name): os.stat(os.path.join(where, name)).st_mtime_ns
        for where, _, found in os.walk(path) for name in found if name.endswith(".parquet")}


def bucket(spark, table, part):
    return spark.createDataFrame([("x", part, 0)], SCHEMA).select(bucket_of(table)).first()[0]


def test_newest_row_of_each_key(spark, table):
    assert not has_changes(spark, table) and read_rows(spark, table).count() == 0
    write_changes(table, frame(spark, ("a", 1, 1), ("b", 2, 1), (None, None, 1)), 0)
    write_changes(table, frame(spark, ("b", 2, 2), ("c", 3, 0)), 1)
    write_changes(table, frame(spark), 2)
    newest = [("a", 1, 1), ("b", 2, 2), ("c", 3, 0), (None, None, 1)]
    assert rows(read_rows(spark, table)) == sorted(newest, key=repr)
    write_changes(table, frame(spark, ("a", 1, None)), 3)
    newest[0] = ("a", 1, None)
    assert rows(read_rows(spark, table)) == sorted(newest, key=repr)
    fold(spark, table)
    assert rows(read_rows(spark, table)) == sorted(newest, key=repr)
    assert fold(spark, table) == set()


def test_a_fold_rewrites_only_the_buckets_that_changed(spark, table):
    write_changes(table, frame(spark, *[(f"k{i}", i, 0) for i in range(40)]), 0)
    touched = fold(spark, table)
    assert len(touched) > 4
    before = files_under(f"{table.path}/folds")
    write_changes(table, frame(spark, ("k7", 7, 9), ("new", 7, 1)), 1)
    mine = bucket(spark, table, 7)
    assert changed_buckets(spark, table, [1]) == {mine}
    assert fold(spark, table) == {mine}
    after = files_under(f"{table.path}/folds")
    assert all(after[path] == stamp for path, stamp in before.items())
    assert {os.path.dirname(path) for path in after.keys() - before.keys()} == {f"{table.path}/folds/batch_id=1/bucket={mine}"}
    assert set(read_rows(spark, table).where("v <> 0").select("k", "v").collect()) == {("k7", 9), ("new", 1)}
    # The next fold deletes what this one superseded, and the changes that the fold before it covered.
    write_changes(table, frame(spark, ("k7", 7, 10)), 2)
    fold(spark, table)
    write_changes(table, frame(spark, ("k7", 7, 11)), 3)
    fold(spark, table)
    left = files_under(f"{table.path}/folds")
    assert sorted(os.path.relpath(os.path.dirname(p), table.path) for p in left if f"bucket={mine}" in p) == [
        f"folds/batch_id=2/bucket={mine}", f"folds/batch_id=3/bucket={mine}"]
    assert os.listdir(f"{table.path}/changes") == ["batch_id=3"]
    assert len(manifests.versions(spark, f"{table.path}/_manifests")) == 2
    assert read_rows(spark, table).count() == 41
    assert read_rows(spark, table).where("k = 'k7'").first()["v"] == 11


def test_a_replayed_batch_does_no_harm_before_and_after_its_fold(spark, table):
    write = changes_writer(table, lambda df: df, fold_every=2)
    write(frame(spark, ("a", 1, 1)), 0)
    write(frame(spark, ("a", 1, 2), ("b", 2, 2)), 1)
    for _ in range(2):
        write(frame(spark, ("a", 1, 2), ("b", 2, 2)), 1)
        assert rows(read_rows(spark, table)) == [("a", 1, 2), ("b", 2, 2)]
    write(frame(spark, ("b", 2, 3)), 2)
    write(frame(spark, ("b", 2, 3)), 2)
    assert rows(read_rows(spark, table)) == [("a", 1, 2), ("b", 2, 3)]


def test_an_unfinished_batch_is_not_read(spark, table):
    write_changes(table, frame(spark, ("a", 1, 1)), 0)
    write_changes(table, frame(spark, ("a", 1, 2)), 1)
    os.remove(f"{table.path}/changes/batch_id=1/_SUCCESS")
    assert rows(read_rows(spark, table)) == [("a", 1, 1)]


def test_a_fold_that_fails_before_its_manifest_is_made_again(spark, table):
    write_changes(table, frame(spark, ("a", 1, 1)), 0)
    fold(spark, table)
    write_changes(table, frame(spark, ("a", 1, 2)), 1)
    path = f"{table.path}/folds/batch_id=1/bucket={bucket(spark, table, 1)}"
    frame(spark, ("a", 1, 99)).write.parquet(path)
    assert rows(read_rows(spark, table)) == [("a", 1, 2)]
    fold(spark, table)
    assert rows(read_rows(spark, table)) == [("a", 1, 2)]


def test_a_table_keeps_its_number_of_buckets(spark, table):
    assert open_table(spark, table.path, table.schema, table.keys, buckets=3).buckets == 8
    assert open_table(spark, table.path + "-none", table.schema, table.keys, make=False).buckets == 32
    assert not os.path.exists(table.path + "-none")


def test_only_the_buckets_asked_for_are_read(spark, table):
    write_changes(table, frame(spark, *[(f"k{i}", i, 0) for i in range(40)]), 0)
    fold(spark, table)
    write_changes(table, frame(spark, ("k7", 7, 1)), 1)
    mine = bucket(spark, table, 7)
    read = read_versions(spark, table, [mine])
    assert {os.path.basename(os.path.dirname(p)) for p in read.inputFiles()} == {f"bucket={mine}"}


# --- trips ---------------------------------------------------------------

DAYS = [START + datetime.timedelta(days=i) for i in range(6)]
EVERYWHERE = TwoLegBounds(AIRPORTS, AIRPORTS, AIRPORTS, DAYS, 2008)


def stream_of(spark, lines):
    return decode_flights(read_messages(spark, lines, maxFilesPerTrigger=100))


def run_trips(spark, lines, root, **options):
    start_question("two_leg", stream_of(spark, lines), root, AVAILABLE_NOW, EVERYWHERE, **options).awaitTermination()


def flight(day, carrier, number, origin, dest, clock, delay):
    return (2008, 1, day, carrier, number, origin, dest, clock, 0.0, delay)


def test_a_batch_works_on_what_its_changes_meet(spark, folder):
    named = [r for r in FLIGHTS if r[5] is not None]
    root, lines = folder(), folder()
    flights = spark.createDataFrame(named, FLIGHT_SCHEMA)
    replay_lines(flights, lines)
    run_trips(spark, lines, root)
    before = {tuple(r) for r in read_question(spark, "two_leg", root).collect()}

    # One better first leg.
    x, y = AIRPORTS[0], AIRPORTS[1]
    better = spark.createDataFrame([flight(DAYS[1], "ZZ", "1", x, y, 800, -500.0)], FLIGHT_SCHEMA)
    replay_lines(better, lines)
    run_trips(spark, lines, root)
    after = {tuple(r) for r in read_question(spark, "two_leg", root).collect()}
    answer = plans.two_leg_all(flights.unionByName(better), 2008, ["ArrDelay"])
    assert after == {tuple(r) for r in answer.collect()}

    legs, trips = legs_table(spark, root), trips_table(spark, root)
    second = [i for i in os.listdir(f"{legs.path}/changes") if i == "batch_id=1"]
    assert second == ["batch_id=1"]
    changed = spark.read.schema(legs.schema).parquet(f"{legs.path}/changes/batch_id=1")
    assert changed.select("meet_at", "meet_day").collect() == [(y, DAYS[1])]
    met = legs_met(spark, legs, changed, 1)
    assert {tuple(r) for r in met.select("meet_at", "meet_day").distinct().collect()} == {(y, DAYS[1])}
    own = changed_buckets(spark, legs, [1])
    read = {os.path.basename(os.path.dirname(p)) for p in read_versions(spark, legs, own).inputFiles()}
    assert read == {f"bucket={b}" for b in own} and len(own) == 1
    # Only trips over the changed leg are written.
    written = spark.read.schema(trips.schema).parquet(f"{trips.path}/changes/batch_id=1").drop("bucket").collect()
    assert written and {(r.airportx, r.airporty, r.flightdate1) for r in written} == {(x, y, f"{DAYS[1]:%d/%m/%Y}")}
    assert {tuple(r) for r in written} == after - before


@pytest.mark.parametrize("fold_every", [1, 2, 100])
def test_trips_in_any_cut_equal_the_batch_plan(spark, folder, fold_every):
    from skyledger.streaming import Upkeep

    named = [r for r in FLIGHTS if r[5] is not None]
    root, lines = folder(), folder()
    flights = spark.createDataFrame(named, FLIGHT_SCHEMA)
    for part in range(3):
        replay_lines(flights.where(F.pmod(F.xxhash64("FlightNum", "Origin"), F.lit(3)) == part), lines)
        run_trips(spark, lines, root, upkeep=Upkeep(fold_every, 1))
    got = read_question(spark, "two_leg", root)
    answer = plans.two_leg_all(flights, 2008, ["ArrDelay"])
    assert rows(got) == rows(answer.select(*got.columns))


def test_the_delta_join_makes_no_pair_of_unchanged_legs(spark, folder):
    from skyledger.streaming.trips import changed_trips

    root = folder()
    legs = legs_table(spark, root)
    changed = spark.createDataFrame([], legs.schema)
    write_changes(legs, changed, 0)
    assert "changed1" in plan_of(changed_trips(legs_met(spark, legs, changed, 0)))
