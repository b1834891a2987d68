"""What the operators share: staging, ASCII lower case, and batches of bounded size."""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.session import new_dir

#: Words end at these six characters only, in every operator that counts words.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one vectorised step handles; a longer single text is a step of its own.
STEP_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str, within: str | None = None) -> DataFrame:
    """The rows as a written table in the shared folder: lineage ends here, and lost executors cost nothing.

    ``within`` is a folder that its owner deletes when all that reads the table is written.
    """
    path = f"{within}/{label}-{uuid.uuid4().hex}" if within else new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def decided_rows(docs: DataFrame, keys: dict[str, Column], decided: DataFrame) -> DataFrame:
    """``doc``, all columns of a row, beside the columns of ``decided`` for its key; rows without a decision go.

    ``keys`` say how a row gives the columns it is looked up by; no row numbers are needed, for two scans of
    one table give the same keys. ``decided`` is a written table with one row per key, narrow, so that Spark
    broadcasts a small one and no text is shuffled. Where it has ``times`` above 1, so many rows share
    the key, and one of them stands for all.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *[c.alias(k) for k, c in keys.items()])
    same = reduce(lambda a, b: a & b, [packed[k].eqNullSafe(decided[k]) for k in keys])
    joined = packed.join(decided, same).select("doc", *[decided[c] for c in decided.columns])
    if not decided.where("times > 1").head(1):
        return joined
    return joined.where("times = 1").union(joined.where("times > 1").dropDuplicates(list(keys)))


def lower_ascii(text: Column | str) -> Column:
    """A-Z in lower case and nothing else; null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(column, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def steps(batches: Iterator[pa.RecordBatch], text: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts have at most ``most`` bytes together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield batch.slice(start, stop - start)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings; null is empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, and where each starts (one more entry: the end)."""
    raw = [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
    starts = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in raw], out=starts[1:])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), starts
