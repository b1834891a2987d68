"""The shape of the physical plans."""

import datetime
import glob
import re
from collections import Counter

import pytest

from conftest import plan_of
from skyledger import plans, queries
from skyledger.operators import TwoLegBounds, TwoLegSets, bounded_legs, day_range, pair_legs, popularity
from skyledger.plans.summary import flight_summary
from skyledger.queries import BOUNDS
from skyledger.schema import FLIGHT_SCHEMA
from skyledger.session import session_conf
from skyledger.sources import decode_flights, flights_view, read_flights, write_flights
from test_operators import FLIGHTS

LINES = 60_000
# The settings of a cluster scaled down: nothing fits a broadcast, and a partition
# of a few kilobytes is a large one.
SMALL = dict(
    spark__sql__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__coalescePartitions__enabled="false",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
)


@pytest.fixture(scope="module")
def flights(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "flights")
    return read_flights(spark, write_flights(spark.createDataFrame(FLIGHTS, FLIGHT_SCHEMA), path))


QUESTIONS = {
    "airports": plans.airport_popularity,
    "carriers": plans.carrier_punctuality,
    "origin carriers": lambda f: plans.origin_packed(f, "UniqueCarrier"),
    "routes": plans.route_mean_arr_delay,
    "trips": lambda f: plans.two_leg_all(f, 2008),
    "summary": flight_summary,
}


@pytest.mark.parametrize("name", QUESTIONS)
def test_no_python_and_no_cross_join(flights, name):
    plan = plan_of(QUESTIONS[name](flights))
    assert not re.search("Python|Pandas|ArrowEval|CartesianProduct|NestedLoop", plan)


def test_only_needed_columns_are_read(flights):
    scan = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(plans.carrier_punctuality(flights)))
    assert scan == ["UniqueCarrier:string,ArrDelay:float"]


def test_popularity_reads_the_flights_once(flights):
    assert plan_of(popularity(flights)).count("FileScan") == 1


def test_counts_are_combined_before_the_shuffle(flights):
    plan = plan_of(popularity(flights))
    assert "partial_count" in plan and "partial_sum" in plan


def test_group_limit_on_both_sides_of_the_shuffle(flights):
    plan = plan_of(plans.origin_top(flights, "Dest"))
    assert re.search(r"WindowGroupLimit .* Final", plan) and re.search(r"WindowGroupLimit .* Partial", plan)


def test_global_ranking_sorts_only_the_first_rows(flights):
    assert "TakeOrderedAndProject" in plan_of(plans.airport_popularity(flights))


def test_packing_adds_no_shuffle(flights):
    ranked, packed = plans.origin_top(flights, "Dest"), plans.origin_packed(flights, "Dest")
    assert plan_of(packed).count("Exchange") == plan_of(ranked).count("Exchange")


def test_year_prunes_partitions_and_clock_reaches_the_scan(flights):
    plan = plan_of(plans.first_legs(flights, 2008))
    assert re.search(r"PartitionFilters: \[[^\]]*Year#\d+ = 2008", plan)
    assert "LessThan(CRSDepTime,1200)" in plan


def test_trip_sets_reach_the_scan(spark, flights):
    bounds = TwoLegBounds(["AAA"], ["BBB"], ["CCC"], ["27/02/2008"], 2008)
    with session_conf(spark, spark__sql__maxMetadataStringLength=2000):  # the plan's text is cut by default
        plan = plan_of(plans.two_leg_bounded(flights, bounds))
    pushed = " ".join(re.findall(r"PushedFilters: \[.*", plan))
    assert "EqualTo(Origin,AAA)" in pushed and "EqualTo(FlightDate,2008-02-27)" in pushed


def test_trips_join_on_airport_and_day(flights):
    plan = plan_of(plans.two_leg_all(flights, 2008))
    assert re.search(r"Join \[airporty#\d+, day1#\d+\], \[origin2#\d+, date_sub\(day2#\d+, 2\)\]", plan)


def _scans(df, column):
    """How often the executed plan reads the files with ``column``; a reused shuffle reads none."""
    plan = plan_of(df)
    return len(re.findall(rf"FileScan [^\n]*{column}#", plan))


@pytest.mark.parametrize("question", [
    lambda f: plans.two_leg_all(f, 1998),
    lambda f: plans.two_leg_bounded(f, BOUNDS),
])
def test_trips_read_the_flights_once(spark, folder, question):
    view = flights_view(spark, "/root/testdata/sf0.001", 1998)
    stored = read_flights(spark, write_flights(view, folder()))
    settings = {"spark__sql__autoBroadcastJoinThreshold": -1, "spark__sql__adaptive__enabled": "false"}
    with session_conf(spark, **settings):
        assert _scans(question(view), "l_orderkey") == 1
        assert _scans(question(stored), "CRSDepTime") == 1


def test_days_of_the_bounds_reach_the_scan_of_the_view(spark):
    view = flights_view(spark, "/root/testdata/sf0.001", days=day_range(BOUNDS))
    with session_conf(spark, spark__sql__maxMetadataStringLength=5000):
        plan = plan_of(plans.two_leg_bounded(view, BOUNDS))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan
    assert "LessThan(l_shipdate,1998-04-13T00:00)" in plan


def test_a_message_is_parsed_once(spark):
    lines = spark.createDataFrame([("2008,4,2008-04-03,AA,1,BOS,ATL,0900,5,10",)], "value STRING")
    bounds = TwoLegBounds(["BOS"], ["ATL"], ["LAX"], ["03/04/2008"], 2008)
    plan = bounded_legs(decode_flights(lines), bounds)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1


def test_view_reads_one_year_and_few_columns(spark, tmp_path):
    plan = plan_of(flights_view(spark, "/root/testdata/sf0.001", 1998).select("Origin"))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan
    assert "l_quantity" not in plan


@pytest.fixture
def skewed_tables(spark, tmp_path):
    """Order tables in which one supplier, part and customer have a third of the lines."""
    n = LINES
    hot = "id % 3 = 0"
    tables = {
        "nation": spark.range(25).selectExpr("int(id) AS n_nationkey", "'N' || id AS n_name"),
        "supplier": spark.range(400).selectExpr("id AS s_suppkey", "int(id % 25) AS s_nationkey"),
        "customer": spark.range(400).selectExpr("id AS c_custkey", "int(id % 25) AS c_nationkey"),
        "part": spark.range(400).selectExpr("id AS p_partkey", "'B' || (id % 9) AS p_brand"),
        "orders": spark.range(n).selectExpr(
            "id AS o_orderkey", f"CASE WHEN {hot} THEN 7 ELSE (id * 31) % 400 END AS o_custkey"),
        "lineitem": spark.range(n).selectExpr(
            "id AS l_orderkey", f"CASE WHEN {hot} THEN 11 ELSE (id * 17) % 400 END AS l_partkey",
            f"CASE WHEN {hot} THEN 5 ELSE (id * 13) % 400 END AS l_suppkey", "1 AS l_linenumber",
            "double(id % 50) AS l_quantity",
            "CAST(date_add(DATE '1998-01-01', int(id % 300)) AS TIMESTAMP_NTZ) AS l_shipdate"),
    }
    for name, df in tables.items():
        df.repartition(8).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_hot_keys_are_split_when_nothing_is_broadcast(spark, skewed_tables):
    plain = plans.airport_popularity(flights_view(spark, skewed_tables)).collect()
    with session_conf(spark, **SMALL, spark__sql__shuffle__partitions=16):
        assert plans.airport_popularity(flights_view(spark, skewed_tables)).collect() == plain
        view = flights_view(spark, skewed_tables)
        assert len(view.collect()) == LINES
        final = plan_of(view).split("Initial Plan")[0]
    assert "BroadcastHashJoin" not in final
    assert final.count("SortMergeJoin(skew=true)") == 3


def test_suppliers_do_not_shuffle_the_lines(spark, skewed_tables):
    """Also where nothing is small enough for Spark's own broadcasts."""
    with session_conf(spark, **SMALL, spark__sql__shuffle__partitions=16):
        plain = sorted(map(repr, flights_view(spark, skewed_tables).collect()))
    with session_conf(spark, **SMALL | {"spark__sql__autoBroadcastJoinThreshold": 1}, spark__sql__shuffle__partitions=16):
        view = flights_view(spark, skewed_tables)
        assert sorted(map(repr, view.collect())) == plain
        final = plan_of(view).split("Initial Plan")[0]
    assert "hashpartitioning(l_orderkey" in final and "hashpartitioning(l_partkey" in final
    assert "hashpartitioning(l_suppkey" not in final


def test_bad_lines_are_written_where_the_flights_are(spark, skewed_tables):
    """Files grow in number with the flights; each has its header first, and no task sorts its lines."""
    with session_conf(
            spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__shuffle__partitions=16,
            spark__sql__adaptive__coalescePartitions__enabled="false"):
        path = queries._csv_with_bad_lines(spark, skewed_tables)
        flights = flights_view(spark, skewed_tables)
    files = [open(f).read().splitlines() for f in glob.glob(f"{path}/**/*.txt", recursive=True)]
    assert len(files) > 8
    header = ",".join(flights.columns)
    assert all(lines.count(header) == 1 and lines[0] == header for lines in files)
    bad = flights.where("CAST(FlightNum AS BIGINT) % 11 = 0").count()
    assert sum(line.startswith(queries.BAD_LINE) for lines in files for line in lines) == bad > 0
    assert sum(map(len, files)) == len(files) + LINES + bad


def legs(spark, n, airport, day, hub_side):
    """Legs of which one airport and day has a share that the expressions decide."""
    columns = {
        "Origin": airport if hub_side == "Origin" else "'A' || id",
        "Dest": airport if hub_side == "Dest" else "'Z' || id",
        "FlightDate": day, "UniqueCarrier": "'C'", "FlightNum": "CAST(id AS STRING)",
        "CRSDepTime": "900", "ArrDelay": "CAST(id % 60 AS FLOAT)",
    }
    return spark.range(n).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()]).repartition(8)


def test_a_hub_with_a_third_of_the_legs_is_split(spark):
    first = legs(
        spark, 30_000, "IF(id % 3 = 0, 'HUB', 'Y' || id % 500)",
        "date_add(DATE '2008-01-01', IF(id % 3 = 0, 0, INT(id % 7)))", "Dest")
    second = legs(
        spark, 2_000, "IF(id < 3, 'HUB', 'Y' || id % 500)",
        "date_add(DATE '2008-01-03', IF(id < 3, 0, INT(id % 7)))", "Origin")
    arrivals = Counter((r.Dest, r.FlightDate) for r in first.collect())
    departures = Counter((r.Origin, r.FlightDate - datetime.timedelta(days=2)) for r in second.collect())
    with session_conf(spark, **SMALL, spark__sql__shuffle__partitions=16):
        pairs = pair_legs(first, second)
        assert len(pairs.collect()) == sum(n * departures[key] for key, n in arrivals.items())
        assert "SortMergeJoin(skew=true)" in plan_of(pairs).split("Initial Plan")[0]


def test_sets_as_tables_reach_the_scan(spark, folder):
    """With broadcasts off, members of the sets filter the one scan of the flights by bloom filters, days by their ends."""
    named = [r for r in FLIGHTS if r[5] is not None]
    flights = read_flights(spark, write_flights(spark.createDataFrame(named, FLIGHT_SCHEMA), folder()))
    roles, days = folder(), folder()
    spark.createDataFrame(
        [(a, r) for a in ("AAA", "BBB") for r in "xyz"] + [("CCC", "z")] * 2, "airport string, role string").write.parquet(roles)
    first = sorted({r[2] for r in named})[:3]
    spark.createDataFrame([(d,) for d in first] * 2, "day date").write.parquet(days)
    sets = TwoLegSets(spark.read.parquet(roles), spark.read.parquet(days), 2008)
    with session_conf(
            spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__maxMetadataStringLength=5000,
            spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold=0):
        answer = plans.two_leg_by_tables(flights, sets)
        plan = plan_of(answer)
        got = answer.collect()
    # The filter right over the scan.
    filters = re.findall(r"Filter [^\n]*atleastnnonnulls[^\n]*", plan)
    assert filters and all(f.count("might_contain(") >= 2 for f in filters)
    assert all("FlightDate" in f and ".low" in f and ".high" in f for f in filters)
    with session_conf(
            spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__enabled="false",
            spark__sql__optimizer__runtime__bloomFilter__enabled="false"):
        assert _scans(plans.two_leg_by_tables(flights, sets), "CRSDepTime") == 1
    plain = plans.two_leg_bounded(flights, TwoLegBounds(["AAA", "BBB"], ["AAA", "BBB"], ["AAA", "BBB", "CCC"], first, 2008))
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain.collect())) and got


def test_empty_sets_give_no_trips(spark, folder):
    flights = spark.createDataFrame(FLIGHTS, FLIGHT_SCHEMA)
    for roles, days in (([], [(datetime.date(2008, 2, 27),)]), ([("AAA", "x"), ("BBB", "y"), (None, "z")], [])):
        sets = TwoLegSets(
            spark.createDataFrame(roles, "airport string, role string"), spark.createDataFrame(days, "day date"), 2008)
        assert plans.two_leg_by_tables(flights, sets).collect() == []


def test_exact_sums_stay_in_generated_code(flights):
    plan = plan_of(plans.route_mean_arr_delay(flights))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
