"""Reading and writing flights."""

import datetime
import os

import pytest

from conftest import EDGE_LINES, plan_of, rows
from skyledger.schema import FLIGHT_SCHEMA
from skyledger.sources import (
    decode_flights,
    file_headers,
    flights_view,
    read_flights,
    read_flights_csv,
    read_messages,
    read_scan,
    rejected_lines,
    replay_lines,
    scan_flights_csv,
    wire_lines,
    write_flights,
    write_scan,
)

HEADER = ",".join(FLIGHT_SCHEMA.fieldNames())
ROW = (2008, 4, datetime.date(2008, 4, 3), "AA", "1", "BOS", "ATL", 900, 5.0, 10.0)


def write_csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def test_csv_is_read_by_name(spark, folder):
    path = folder()
    write_csv(
        f"{path}/a.csv",
        "Dest,Note,Origin,ArrDelay,DepDelay,CRSDepTime,FlightNum,UniqueCarrier,FlightDate,DayOfWeek,Year\n"
        "ATL,\"a, b\",BOS,10,5,0900,1,AA,2008-04-03,4,2008\n")
    flights = read_flights_csv(spark, path)
    assert flights.schema == FLIGHT_SCHEMA
    assert rows(flights) == [ROW]


def test_csv_text_that_does_not_parse_becomes_null(spark, folder):
    path = folder()
    write_csv(
        f"{path}/a.csv",
        f"{HEADER}\nx,4.0,tomorrow,AA,1,BOS,ATL,1200.0,NA,\n2008,4,2008-04-03,AA,1,BOS,ATL,1e30,,7.5\n")
    assert rows(read_flights_csv(spark, path)) == sorted([
        (None, 4, None, "AA", "1", "BOS", "ATL", 1200, None, None),
        (2008, 4, datetime.date(2008, 4, 3), "AA", "1", "BOS", "ATL", None, None, 7.5)], key=repr)


SWAPPED = HEADER.replace("Origin,Dest", "Dest,Origin")
LINE = "2008,4,2008-04-03,AA,1,{},0900,5,10\n"


def test_one_glob_may_hold_several_layouts(spark, folder):
    path = folder()
    write_csv(f"{path}/a.csv", f"{HEADER}\n" + LINE.format("BOS,ATL"))
    write_csv(f"{path}/b.csv", f"{SWAPPED}\n" + LINE.format("ATL,BOS") * 2)
    write_csv(f"{path}/c d+e%20.csv", f"Note,{HEADER}\n\"x, y\"," + LINE.format("BOS,ATL"))
    write_csv(f"{path}/f[1].csv", f"{SWAPPED}\n" + LINE.format("ATL,BOS"))
    write_csv(f"{path}/empty.csv", "")
    write_csv(f"{path}/no-rows.csv", f"{HEADER}\n")
    for given in (path, f"{path}/*.csv", [f"{path}/a.csv", f"{path}/[b-z]*.csv"]):
        assert rows(read_flights_csv(spark, given)) == [ROW] * 5
    found = file_headers(spark, path)
    assert sorted((header, len(files)) for header, files in found.items()) == sorted(
        [(HEADER, 2), (SWAPPED, 2), (f"Note,{HEADER}", 1)])


def test_files_that_agree_are_one_scan_of_the_given_path(spark, folder):
    path = folder()
    for name in "abc":
        write_csv(f"{path}/{name}.csv", f"{HEADER}\n" + LINE.format("BOS,ATL") * 2)
    assert file_headers(spark, path) == {HEADER: [path]}
    assert plan_of(read_flights_csv(spark, path)).count("FileScan csv") == 1


def test_only_the_first_line_of_a_file_is_looked_at(spark, folder):
    path = folder()
    # More than a task's pipes hold.
    write_csv(f"{path}/long.csv", f"{HEADER}\n" + LINE.format("BOS,ATL") * 300_000)
    write_csv(f"{path}/other.csv", f"{SWAPPED}\n" + LINE.format("ATL,BOS"))
    assert {len(files) for files in file_headers(spark, path).values()} == {1}
    assert read_flights_csv(spark, path).count() == 300_001


def test_no_lines_are_no_flights(spark, folder):
    path = folder()
    write_csv(f"{path}/empty.csv", "")
    assert read_flights_csv(spark, path).collect() == [] and scan_flights_csv(spark, path).collect() == []


def test_rejects_come_from_the_scan_of_the_flights(spark, folder):
    path = folder()
    write_csv(f"{path}/a.csv", f"{HEADER}\n" + LINE.format("BOS,ATL") + "this is no flight\n" + "2008,4,2008-04-03,AA,1,BOS,ATL\n"
              + LINE.format(",ATL") + "a,b\n")
    write_csv(f"{path}/b.csv", f"{SWAPPED}\n" + "bad, too\n" + LINE.format("ATL,BOS"))
    stored = write_scan(scan_flights_csv(spark, path), folder())
    flights, rejects = read_scan(spark, stored)
    assert rows(rejects) == [("a,b",), ("bad, too",), ("this is no flight",)]
    plain = read_flights_csv(spark, path).where("Origin IS NOT NULL OR Dest IS NOT NULL")
    assert rows(flights) == rows(plain) and flights.schema == FLIGHT_SCHEMA
    assert flights.where("Origin IS NULL").count() == 1 and flights.where("CRSDepTime IS NULL").count() == 1
    assert os.path.isdir(f"{stored}/kind=flights/Year=2008")
    # One scan per layout feeds both.
    assert plan_of(scan_flights_csv(spark, f"{path}/a.csv")).count("FileScan csv") == 1


def test_a_scan_without_rejects_or_flights(spark, folder):
    good, bad = folder(), folder()
    write_csv(f"{good}/a.csv", f"{HEADER}\n" + LINE.format("BOS,ATL"))
    write_csv(f"{bad}/a.csv", f"{HEADER}\nnothing here\n")
    flights, rejects = read_scan(spark, write_scan(scan_flights_csv(spark, good), folder()))
    assert rows(flights) == [ROW] and rejects.collect() == []
    flights, rejects = read_scan(spark, write_scan(scan_flights_csv(spark, bad), folder()))
    assert flights.collect() == [] and rows(rejects) == [("nothing here",)]


def test_parquet_by_year(spark, edge_flights, folder):
    path = write_flights(edge_flights, folder())
    back = read_flights(spark, path)
    assert back.schema == FLIGHT_SCHEMA
    assert rows(back) == rows(edge_flights)
    assert os.path.isdir(f"{path}/Year=2007")


def test_messages_survive_commas_quotes_and_missing_fields(spark, folder):
    odd = [
        ROW,
        (2008, 4, datetime.date(2008, 4, 3), "A,B", 'say "x"', "BOS", "ATL", 900, None, None),
        (None, None, None, None, None, "BOS", "ATL", None, None, -1.5),
        (2008, 4, datetime.date(2008, 4, 3), "a\\b", " c ", "BOS", "ATL", 900, 0.0, 1.25),
    ]
    flights = spark.createDataFrame(odd, FLIGHT_SCHEMA)
    path = folder()
    replay_lines(flights, path)
    assert rows(decode_flights(spark.read.text(path))) == rows(flights)


def test_wire_form(spark):
    line = wire_lines(spark.createDataFrame([ROW[:8] + (5.0, None)], FLIGHT_SCHEMA)).first()["value"]
    assert line == "2008,4,2008-04-03,AA,1,BOS,ATL,900,5.0,"


def test_lines_are_either_flights_or_rejected(spark):
    bad = ["", "2008,4,2008-04-03,AA,1,,ATL,0900,5,10"]
    lines = spark.createDataFrame([(line,) for line in [*EDGE_LINES, *bad]], "value STRING")
    assert decode_flights(lines).count() == 15
    assert rows(rejected_lines(lines)) == sorted(
        [("",), ("2008,4,2008-04-03,AA,1,,ATL,0900,5,10",), ("this line is malformed",)])


def test_message_stream_is_text(spark, line_files):
    assert read_messages(spark, line_files(EDGE_LINES), maxFilesPerTrigger=1).isStreaming


def test_view_of_one_year_is_that_part_of_the_whole_view(spark):
    sf_dir = "/root/testdata/sf0.001"
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    whole = flights_view(spark, sf_dir)
    assert rows(flights_view(spark, sf_dir, 1998)) == rows(whole.where("Year = 1998"))
    assert whole.schema == FLIGHT_SCHEMA


def test_every_stored_folder_counts(spark, folder, edge_flights):
    early, late = folder(), folder()
    complete = edge_flights.where("Year IS NOT NULL")
    write_flights(complete.where("Year < 2008"), early)
    write_flights(complete.where("Year >= 2008"), late)
    assert rows(read_flights(spark, [early, late])) == rows(complete)


def test_flights_of_a_year_are_few_files(spark, folder, edge_flights):
    path = write_flights(edge_flights.where("Year IS NOT NULL").repartition(8), folder())
    assert len(spark.read.parquet(path).inputFiles()) <= 2 * edge_flights.select("Year").distinct().count()


@pytest.mark.parametrize("carrier", [
    "A\nB", "A\r\nB", "\n", 'say "A"', "a,b", " a ", "100%", "%0A", "%250A", "a\\b", 'a\\"b', None])
def test_any_text_stays_one_message(spark, folder, carrier):
    row, path = ROW[:3] + (carrier,) + ROW[4:], folder()
    replay_lines(spark.createDataFrame([row], FLIGHT_SCHEMA), path)
    lines = spark.read.text(path)
    assert lines.count() == 1
    assert rows(decode_flights(lines)) == [row]
    assert rejected_lines(lines).count() == 0


def test_an_empty_text_is_a_missing_field(spark, folder):
    path = folder()
    replay_lines(spark.createDataFrame([ROW[:3] + ("",) + ROW[4:]], FLIGHT_SCHEMA), path)
    assert rows(decode_flights(spark.read.text(path))) == [ROW[:3] + (None,) + ROW[4:]]
