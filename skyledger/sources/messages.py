"""Flights as messages: one comma-separated line each, without a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from skyledger.schema import FLIGHT_SCHEMA
from skyledger.sources.files import typed_columns, typed_flights

# Fixed value: the topic of the flight messages.
TOPIC = "flights"

_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# What stands for a character that would end the line, and for the sign itself.
# A line from elsewhere that holds such a code as plain text is read with the character.
_CODES = (("%", "%25"), ("\n", "%0A"), ("\r", "%0D"))
_TEXT_DDL = ", ".join(f"{name} STRING" for name in FLIGHT_SCHEMA.fieldNames())


def _coded(text: Column) -> Column:
    for char, code in _CODES:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def _decoded(text: Column) -> Column:
    for char, code in reversed(_CODES):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def wire_lines(flights: DataFrame) -> DataFrame:
    """One ``value`` per flight, fields in wire order; a null is an empty field, and an empty text is read as null.

    A line break inside a field is written as a code, so a message stays one line.
    """
    fields = F.struct(*[
        _coded(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in FLIGHT_SCHEMA])
    return flights.select(F.to_csv(fields, _KEEP_SPACES).alias("value"))


def replay_lines(
    flights: DataFrame, path: str | None = None, fmt: str = "text", mode: str = "append", **options
) -> None:
    """Write flights as messages, to text files or, given its connector, to a broker topic."""
    writer = wire_lines(flights).write.format(fmt).options(**options)
    if path is None:
        writer.save()
    else:
        writer.mode(mode).save(path)


def read_messages(
    spark: SparkSession, path: str | None = None, fmt: str = "text", **options
) -> DataFrame:
    """The message stream as ``value`` text, from its beginning.

    ``options`` carries the intake limit: ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` for files, ``maxOffsetsPerTrigger`` for a broker.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", TOPIC).option("startingOffsets", "earliest")
    reader = reader.options(**options)
    stream = reader.load() if path is None else reader.load(path)
    return stream.select(F.col("value").cast("string").alias("value"))


def _fields(messages: DataFrame) -> DataFrame:
    """``value`` and its ten fields as text.

    As a generator the parser runs once per line; as a plain expression it would
    be copied into every later filter on a field.
    """
    return messages.select("value", F.inline(F.array(F.from_csv("value", _TEXT_DDL, _KEEP_SPACES))))


def _is_flight() -> Column:
    return F.col("Origin").isNotNull() & F.col("Dest").isNotNull()


def _texts(fields: DataFrame) -> DataFrame:
    return fields.withColumns({
        f.name: _decoded(F.col(f.name)) for f in FLIGHT_SCHEMA if isinstance(f.dataType, StringType)})


def decode_flights(messages: DataFrame) -> DataFrame:
    """Typed flights of the lines that name both airports; short lines end in nulls."""
    return typed_flights(_texts(_fields(messages).where(_is_flight())))


def decode_lines(messages: DataFrame) -> DataFrame:
    """Every line once: typed as ``decode_flights`` does, with ``kind`` "flights", or as ``line`` with ``kind`` "rejects"."""
    fields = _texts(_fields(messages))
    kind = F.when(_is_flight(), F.lit("flights")).otherwise(F.lit("rejects"))
    line = F.when(~_is_flight(), F.col("value"))
    return fields.select(*typed_columns(), line.alias("line"), kind.alias("kind"))


def rejected_lines(messages: DataFrame) -> DataFrame:
    """The lines that ``decode_flights`` leaves out, unchanged."""
    return _fields(messages).where(~_is_flight()).select("value")
