"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in ``columns`` (default: in any column)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def with_value(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that carry every one of ``columns``."""
    return complete_rows(df, columns)


def in_set(df: DataFrame, column: str | Column, values: DataFrame | Sequence) -> DataFrame:
    """Rows whose ``column`` is in ``values``.

    A sequence becomes a literal set that is pushed to the scan. A one-column
    DataFrame becomes a semi-join, and Spark picks its strategy from the size.
    """
    key = F.col(column) if isinstance(column, str) else column
    if isinstance(values, DataFrame):
        member = values.columns[0]
        members = values.select(F.col(member).alias("_member"))
        return df.join(members, key == members["_member"], "left_semi")
    return df.where(key.isin(*values))
