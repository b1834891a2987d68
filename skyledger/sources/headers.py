"""CSV files by their own headers.

One Spark job reads the first line of every file, one small task a file, and no more of it. Files with
one header are then one typed scan, so a glob may mix layouts, and each flight is read by the names that
its own file gives its columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.session import session_conf

# With files this large to open, Spark neither packs files into a task nor splits one.
_WHOLE_FILES = {"spark__sql__files__maxPartitionBytes": str(1 << 40), "spark__sql__files__openCostInBytes": str(1 << 40)}


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _as_path(uri: str) -> str:
    """The path of a file as a reader takes it: not encoded, and without a pattern's signs."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(uri))


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """The files of ``paths`` by their first line; a file without any line has none and is left out.

    Where all files agree, the paths are given back as they came, and no list of files is made.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(given).select("value", F.col("_metadata.file_path").alias("path"))
    # A task ends with the first row of its file; the batches that reach it hold one row each.
    with session_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=1, **_WHOLE_FILES):
        firsts = lines.mapInArrow(_first_row, "value string, path string")
        headers = [row["value"] for row in firsts.select("value").distinct().collect()]
        if len(headers) <= 1:
            return {header: given for header in headers}
        grouped = firsts.groupBy("value").agg(F.sort_array(F.collect_list("path")).alias("paths"))
        return {row["value"]: [_as_path(uri) for uri in row["paths"]] for row in grouped.collect()}


def united(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
