"""Column expressions shared by batch and streaming plans; all of them stay in the JVM."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

# Fixed value: how dates are written in queries and results.
DAY_FORMAT = "dd/MM/yyyy"


def parse_int(text: Column) -> Column:
    """Text to int; "1200.0" is 1200, anything that is no number is null."""
    return text.try_cast("double").try_cast("int")


def round2(value: Column) -> Column:
    return F.round(value, 2)


# A summed value counts to this part of its unit, and has at most so many digits in these parts.
PARTS = 1_000_000
_WHOLE = "decimal(18,0)"


def in_parts(value: Column) -> Column:
    """A number as a whole number of millionths, which sums add up exactly, in any order and from any cut.

    Null for what is no number, and beyond 10^12.
    """
    return F.rint(value.cast("double") * PARTS).try_cast("bigint").try_cast(_WHOLE)


def unit_of(parts: Column) -> Column:
    """The double that a sum of ``in_parts`` stands for."""
    return parts.cast("double") / PARTS


def mean_of(total: Column, count: Column) -> Column:
    """Mean from a running sum of ``in_parts`` and a count; null for an empty group."""
    return F.try_divide(unit_of(total), count)


def day_text(day: Column) -> Column:
    return F.date_format(day, DAY_FORMAT)


def as_day(value: str | datetime.date) -> datetime.date:
    """A query date, given as ``dd/MM/yyyy`` text or as a date."""
    if isinstance(value, datetime.date):
        return value
    return datetime.datetime.strptime(value, "%d/%m/%Y").date()


def flat_text(name: Column, value: Column) -> Column:
    """``AA, 3.2``"""
    return F.concat_ws(", ", name, value.cast("string"))


def tuple_text(name: Column, value: Column) -> Column:
    """``(AA,3.2)``"""
    return F.concat(F.lit("("), F.concat_ws(",", name, value.cast("string")), F.lit(")"))


def list_text(items: Column) -> Column:
    """``[first, second]``"""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
