"""Column contracts: the flight row and the keyed result tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Names, types and wire order of a flight row.
FLIGHT_SCHEMA = StructType([
    StructField("Year", IntegerType()),
    StructField("DayOfWeek", IntegerType()),
    StructField("FlightDate", DateType()),
    StructField("UniqueCarrier", StringType()),
    StructField("FlightNum", StringType()),
    StructField("Origin", StringType()),
    StructField("Dest", StringType()),
    StructField("CRSDepTime", IntegerType()),
    StructField("DepDelay", FloatType()),
    StructField("ArrDelay", FloatType()),
])


class ResultTable(NamedTuple):
    schema: StructType
    keys: tuple[str, ...]


def _table(keys: tuple[str, ...], **columns) -> ResultTable:
    return ResultTable(StructType([StructField(n, t) for n, t in columns.items()]), keys)


# Names, columns and keys of the result tables. Means are kept as
# double so that batch and stream store the same number.
RESULT_TABLES = {
    "results11": _table(
        ("rank",), rank=IntegerType(), airport=StringType(), popularity=LongType()),
    "results12": _table(
        ("rank",), rank=IntegerType(), airline=StringType(), avgarrdelay=DoubleType()),
    "results21": _table(("airport",), airport=StringType(), topcarrier=StringType()),
    "results22": _table(("airport",), airport=StringType(), topdest=StringType()),
    "results24": _table(
        ("origin", "dest"), origin=StringType(), dest=StringType(), arrdelay=DoubleType()),
    "results32": _table(
        ("flightdate1", "airportx", "airporty", "airportz"),
        airportx=StringType(), airporty=StringType(), airportz=StringType(),
        flightdate1=StringType(), uniquecarrier1=StringType(), flightnum1=StringType(),
        crsdeptime1=IntegerType(), arrdelay1=FloatType(),
        flightdate2=StringType(), uniquecarrier2=StringType(), flightnum2=StringType(),
        crsdeptime2=IntegerType(), arrdelay2=FloatType(), totaldelay=FloatType()),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly the columns of ``schema``, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
