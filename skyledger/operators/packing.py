"""Ranked rows of one group rendered as one text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import flat_text, list_text, tuple_text

STYLES = {"flat": flat_text, "tuple": tuple_text}


def pack_top(
    ranked: DataFrame, group: str, key: str, value: str, name: str,
    style: str = "flat", rank: str = "rank",
) -> DataFrame:
    """(group, name) with the group's rows in rank order, e.g. ``[AA, 3.2, DL, 4.5]``.

    ``ranked`` holds at most k rows per group, so the collected list is bounded.
    The order comes from the rank inside the list and not from the input order.
    """
    item = F.struct(F.col(rank).alias("rank"), STYLES[style](F.col(key), F.col(value)).alias("text"))
    items = F.array_sort(F.collect_list(item))
    return ranked.groupBy(group).agg(list_text(F.transform(items, lambda i: i["text"])).alias(name))
