"""Flights in files: CSV with a header, or parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, StructField, StructType

from skyledger.functions import parse_int
from skyledger.schema import FLIGHT_SCHEMA
from skyledger.session import path_exists
from skyledger.sources.headers import file_headers, united


def _typed(text: Column, data_type: DataType) -> Column:
    if isinstance(data_type, StringType):
        return text
    if isinstance(data_type, IntegerType):
        return parse_int(text)
    return text.try_cast(data_type)


def typed_flights(raw: DataFrame) -> DataFrame:
    """The ten flight columns of an all-text table, by name; text that does not parse becomes null."""
    return raw.select(*typed_columns())


def typed_columns() -> list[Column]:
    """The flight columns from text columns of the same names."""
    return [_typed(F.col(f.name), f.dataType).alias(f.name) for f in FLIGHT_SCHEMA]


_CORRUPT = "_corrupt_record"


def _csv(spark: SparkSession, paths: Sequence[str], keep_bad: bool = False) -> DataFrame:
    reader = spark.read.option("header", True)
    names = reader.csv(paths).columns
    text = StructType([StructField(n, StringType()) for n in names])
    if keep_bad:
        text = text.add(_CORRUPT, StringType())
        reader = reader.option("columnNameOfCorruptRecord", _CORRUPT)
    return reader.schema(text).option("enforceSchema", False).csv(paths)


def _by_header(spark: SparkSession, paths: str | Sequence[str], keep_bad: bool = False) -> list[DataFrame]:
    """The files of ``paths`` as text, one part per distinct header; without any line, none."""
    return [_csv(spark, files, keep_bad) for _, files in sorted(file_headers(spark, paths).items())]


def read_flights_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Typed flights from headed CSV files; each file has its own header.

    Columns are found by name and may be in any order, with others between them. Files are
    grouped by their headers first (see ``file_headers``), so one glob may hold several layouts.
    """
    return united([typed_flights(part) for part in _by_header(spark, paths)] or [spark.createDataFrame([], FLIGHT_SCHEMA)])


def scan_flights_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """What ``read_flights_csv`` gives, and ``line``: null for a flight, else the text of a line that is none.

    A line is none if its fields do not fit its file's header and it does not name both airports.
    A short line that does is a flight whose last fields are null, as in a message.
    """
    parts = []
    for raw in _by_header(spark, paths, keep_bad=True):
        nameless = F.col("Origin").isNull() | F.col("Dest").isNull()
        line = F.when(F.col(_CORRUPT).isNotNull() & nameless, F.col(_CORRUPT)).alias("line")
        parts.append(raw.select(*typed_columns(), line))
    return united(parts or [spark.createDataFrame([], StructType([*FLIGHT_SCHEMA, StructField("line", StringType())]))])


def write_scan(scan: DataFrame, path: str) -> str:
    """Store flights and rejected lines from one scan: flights by year under ``kind=flights``, lines under ``kind=rejects``."""
    kind = F.when(F.col("line").isNull(), F.lit("flights")).otherwise(F.lit("rejects"))
    scan.withColumn("kind", kind).hint("rebalance", "kind", "Year").write.partitionBy("kind", "Year").parquet(path)
    return path


def read_scan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The flights and the rejected lines of a stored scan."""
    flights = spark.createDataFrame([], FLIGHT_SCHEMA)
    if path_exists(spark, f"{path}/kind=flights"):
        flights = read_flights(spark, f"{path}/kind=flights")
    lines = spark.createDataFrame([], "line string")
    if path_exists(spark, f"{path}/kind=rejects"):
        lines = spark.read.schema("line string, Year int").parquet(f"{path}/kind=rejects").select("line")
    return flights, lines


def write_flights(flights: DataFrame, path: str, fmt: str = "parquet", **options) -> str:
    """Store flights by year, so that a question about one year reads one year.

    Rows are brought together by year first (adaptive execution splits large years), or
    every task would write a file for every year.
    """
    flights.hint("rebalance", "Year").write.format(fmt).options(**options).partitionBy("Year").save(path)
    return path


def read_flights(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet", **options) -> DataFrame:
    """Stored flights; each path is a folder by year of its own, and all of them count."""
    parts = [
        spark.read.format(fmt).schema(FLIGHT_SCHEMA).options(**options).load(p).select(*FLIGHT_SCHEMA.fieldNames())
        for p in ([paths] if isinstance(paths, str) else paths)]
    return united(parts)
