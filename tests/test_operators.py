"""Operators against plain Python on random rows, with a third of them on one key."""

import datetime
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skyledger.functions import as_day
from skyledger.operators import (
    afternoon_flights,
    best_legs,
    complete_rows,
    count_by,
    endpoint_counts,
    in_set,
    mean_by,
    mean_state,
    merge_mean_state,
    morning_flights,
    pack_top,
    pair_legs,
    popularity,
    rank_top,
    rank_top_per_group,
)
from skyledger.schema import FLIGHT_SCHEMA

AIRPORTS = ["AAA", "BBB", "CCC", "DDD", "EEE"]
START = datetime.date(2008, 2, 26)


def random_rows(n=3000, seed=5):
    """Random flights; every third is on the same route, day and carrier."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hot = i % 3 == 0
        origin, dest = ("AAA", "BBB") if hot else rng.sample(AIRPORTS, 2)
        day = START if hot else START + datetime.timedelta(days=rng.randrange(6))
        out.append((
            2008, day.isoweekday(), day, "C0" if hot else f"C{rng.randrange(6)}",
            str(rng.randrange(50)), rng.choice([origin, None]) if i % 50 == 0 else origin, dest,
            rng.choice([700, 1159, 1200, 1201, 1830]),
            rng.choice([None, float(rng.randrange(-10, 40))]),
            rng.choice([None, float(rng.randrange(-10, 40))]),
        ))
    return out


FLIGHTS = random_rows()


@pytest.fixture(scope="module")
def flights(spark):
    return spark.createDataFrame(FLIGHTS, FLIGHT_SCHEMA).repartition(6).cache()


def named(row):
    return dict(zip(FLIGHT_SCHEMA.fieldNames(), row))


def means(keys, value):
    seen = defaultdict(list)
    for row in map(named, FLIGHTS):
        if row[value] is not None:
            seen[tuple(row[k] for k in keys)].append(row[value])
    return {k: (sum(v), len(v), sum(v) / len(v)) for k, v in seen.items()}


def best(keep):
    found = {}
    for row in map(named, FLIGHTS):
        if row["ArrDelay"] is None or not keep(row["CRSDepTime"]):
            continue
        key = (row["Origin"], row["Dest"], row["FlightDate"])
        value = (row["ArrDelay"], row["UniqueCarrier"], row["FlightNum"], row["CRSDepTime"])
        found[key] = min(found.get(key, value), value)
    return found


def test_counts_keep_null_airports(flights):
    departures = Counter(r[5] for r in FLIGHTS)
    arrivals = Counter(r[6] for r in FLIGHTS)
    assert None in departures
    bag = sorted([*departures.items(), *arrivals.items()], key=repr)
    assert rows(endpoint_counts(flights)) == bag
    assert rows(popularity(flights)) == sorted((departures + arrivals).items(), key=repr)
    assert rows(count_by(flights, ["Dest"])) == sorted(arrivals.items(), key=repr)


def test_means(flights):
    expected = means(["Origin", "UniqueCarrier"], "DepDelay")
    got = {tuple(r[:2]): tuple(r[2:]) for r in mean_state(flights, ["Origin", "UniqueCarrier"], "DepDelay").collect()}
    assert got == expected
    plain = mean_by(flights, ["Origin", "UniqueCarrier"], "DepDelay", "m")
    assert {(r[0], r[1]): r[2] for r in plain.collect()} == {k: v[2] for k, v in expected.items()}


def test_merged_means_equal_direct_means(flights):
    parts = mean_state(flights, ["Origin", "Dest", "UniqueCarrier"], "ArrDelay")
    merged = merge_mean_state(parts, ["UniqueCarrier"], "total", "n", "m")
    assert {(r[0],): r[1] for r in merged.collect()} == {
        k: v[2] for k, v in means(["UniqueCarrier"], "ArrDelay").items()}


def test_mean_of_no_values_is_null(spark):
    empty = spark.createDataFrame([("a", 0.0, 0)], "k STRING, total DOUBLE, n BIGINT")
    assert rows(merge_mean_state(empty, ["k"], "total", "n", "m")) == [("a", None)]


def test_double_sums_do_not_lose_single_precision_digits(spark):
    df = spark.range(20_000).select(F.lit("a").alias("k"), F.lit(16777.217).cast("float").alias("v"))
    assert mean_state(df, ["k"], "v").first()["total"] == pytest.approx(335544340.0, abs=10)


def test_complete_rows(flights):
    assert complete_rows(flights).count() == sum(None not in r for r in FLIGHTS)
    assert complete_rows(flights, ["ArrDelay"]).count() == sum(r[9] is not None for r in FLIGHTS)


def test_in_set_takes_literals_and_tables(spark, flights):
    wanted = ["BBB", "EEE"]
    expected = sum(r[6] in wanted for r in FLIGHTS)
    table = spark.createDataFrame([(w,) for w in [*wanted, "BBB"]], "code STRING")
    assert in_set(flights, "Dest", wanted).count() == expected
    assert in_set(flights, "Dest", table).count() == expected
    same_name = table.withColumnRenamed("code", "Dest")
    assert in_set(flights, "Dest", same_name).count() == expected


@pytest.mark.parametrize("k", [1, 3, 100])
def test_rank_top(flights, k):
    counts = count_by(flights, ["UniqueCarrier", "Dest"])
    expected = sorted(((-r["n"], r["UniqueCarrier"], r["Dest"]) for r in counts.collect()))[:k]
    top = rank_top(counts, [F.desc("n"), "UniqueCarrier", "Dest"], k)
    assert [(-r["n"], r["UniqueCarrier"], r["Dest"]) for r in top.orderBy("rank").collect()] == expected
    assert sorted(r["rank"] for r in top.collect()) == list(range(1, len(expected) + 1))


def test_rank_per_group_on_a_group_with_a_third_of_the_rows(spark):
    data = [("hot" if i % 3 == 0 else f"g{i % 40}", (i * 7919) % 10007, i) for i in range(9000)]
    df = spark.createDataFrame(data, "g STRING, v INT, id INT").repartition(5)
    groups = defaultdict(list)
    for g, v, i in data:
        groups[g].append((v, i))
    expected = sorted(
        ((g, v, i, rank) for g, vs in groups.items() for rank, (v, i) in enumerate(sorted(vs)[:4], 1)), key=repr)
    assert rows(rank_top_per_group(df, ["g"], ["v", "id"], 4)) == expected


def test_packing_orders_by_rank_and_not_by_input(spark):
    df = spark.createDataFrame(
        [("A", 11, "k", 5.0), ("A", 2, "x", 1.5), ("A", 1, "y", -0.25)], "g STRING, rank INT, k STRING, v DOUBLE")
    assert rows(pack_top(df, "g", "k", "v", "t", "tuple")) == [("A", "[(y,-0.25), (x,1.5), (k,5.0)]")]
    assert rows(pack_top(df, "g", "k", "v", "t", "flat")) == [("A", "[y, -0.25, x, 1.5, k, 5.0]")]


def test_best_legs(flights):
    got = {tuple(r[:3]): tuple(r[3:]) for r in best_legs(complete_rows(flights, ["ArrDelay"])).collect()}
    assert got == best(lambda clock: True)


def test_pairs_meet_two_days_later_across_a_leap_day(flights):
    delayed = complete_rows(flights, ["ArrDelay"])
    got = rows(pair_legs(best_legs(morning_flights(delayed)), best_legs(afternoon_flights(delayed))).select(
        "airportx", "airporty", "airportz", "flightdate1", "flightnum1", "flightnum2", "totaldelay"))
    first, second = best(lambda c: c < 1200), best(lambda c: c > 1200)
    expected = [
        (x, y, z, d1.strftime("%d/%m/%Y"), p[2], q[2], p[0] + q[0])
        for (x, y, d1), p in first.items() for (y2, z, d2), q in second.items()
        if y == y2 and d2 - d1 == datetime.timedelta(days=2)]
    assert any(trip[3] == "28/02/2008" for trip in expected)
    assert got == sorted(expected, key=repr)


def test_query_dates_are_day_first():
    assert as_day("03/04/2008") == as_day(datetime.date(2008, 4, 3))
    with pytest.raises(ValueError):
        as_day("2008-04-03")
