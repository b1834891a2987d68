"""A keyed table that a stream changes batch by batch, dealt to buckets by key.

``changes/batch_id=N/bucket=B`` holds the rows that batch N set, ``folds/batch_id=N/bucket=B`` the newest row of
every key of a bucket up to batch N. A manifest names, for each bucket, the fold that counts, and the last
batch that folds cover; readers add the changes of later batches. A fold rewrites only the buckets that
changed since the fold before it. A replayed batch overwrites its own changes; if a fold covers it already,
readers do not look at them. What a fold supersedes is deleted by the next one, so a reader has that long.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from skyledger.session import session_conf
from skyledger.sinks import manifests

#: Buckets of a table made without a number; a table keeps the number it was made with.
BUCKETS = 32


class KeyedTable(NamedTuple):
    """``deal_by`` are columns that the key decides; rows that are read together should agree in them."""

    path: str
    schema: StructType
    keys: tuple[str, ...]
    deal_by: tuple[str, ...]
    buckets: int

    @property
    def _changes(self) -> str:
        return f"{self.path}/changes"

    @property
    def _folds(self) -> str:
        return f"{self.path}/folds"

    @property
    def _manifests(self) -> str:
        return f"{self.path}/_manifests"


def open_table(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
    deal_by: Sequence[str] | None = None, buckets: int = BUCKETS, make: bool = True,
) -> KeyedTable:
    """The table at ``path``, made if it is not there and ``make`` says so; ``buckets`` is for one that is made."""
    known = manifests.newest(spark, f"{path}/_table")
    if known:
        buckets = known[1]["buckets"]
    elif make:
        manifests.put(spark, f"{path}/_table", 0, {"buckets": buckets})
    return KeyedTable(path, schema, tuple(keys), tuple(deal_by or keys), buckets)


def bucket_of(table: KeyedTable) -> Column:
    return F.pmod(F.xxhash64(*table.deal_by), F.lit(table.buckets)).cast("int")


def _write_buckets(rows: DataFrame, path: str) -> None:
    with session_conf(rows.sparkSession, spark__sql__adaptive__enabled="true"):
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_changes(table: KeyedTable, rows: DataFrame, batch_id: int) -> DataFrame:
    """Set ``rows``, one per key, as batch ``batch_id``; return them as stored."""
    path, names = f"{table._changes}/batch_id={batch_id}", table.schema.fieldNames()
    _write_buckets(rows.select(*names).withColumn("bucket", bucket_of(table)), path)
    return rows.sparkSession.read.schema(table.schema).parquet(path).select(*names)


def changes_writer(
    table: KeyedTable, finish: Callable[[DataFrame], DataFrame], fold_every: int, show: int = 0,
    also: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that sets ``finish(batch)`` and folds after every so many batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = write_changes(table, finish(batch), batch_id)
        if show:
            stored.show(show, truncate=False)
        if also:
            also(stored, batch_id)
        if (batch_id + 1) % fold_every == 0:
            fold(batch.sparkSession, table)

    return write


def _complete(spark: SparkSession, table: KeyedTable) -> list[int]:
    """Ids of the batches whose changes Spark has marked complete."""
    glob, files = manifests.file_system(spark, f"{table._changes}/batch_id=*/_SUCCESS")
    found = (f.getPath().getParent().getName() for f in files.globStatus(glob) or [])
    return sorted(int(name.removeprefix("batch_id=")) for name in found)


def _buckets_in(spark: SparkSession, path: str) -> set[int]:
    return {int(name.removeprefix("bucket=")) for name in manifests.names(spark, f"{path}/bucket=*")}


def changed_buckets(spark: SparkSession, table: KeyedTable, batch_ids: Collection[int]) -> set[int]:
    return set().union(*(_buckets_in(spark, f"{table._changes}/batch_id={i}") for i in batch_ids))


def _folded(spark: SparkSession, table: KeyedTable) -> tuple[int, dict[int, int]]:
    """The last batch that folds cover, and for each bucket the fold that counts."""
    known = manifests.newest(spark, table._manifests)
    return (known[0], {int(b): f for b, f in known[1].items()}) if known else (-1, {})


def has_changes(spark: SparkSession, table: KeyedTable) -> bool:
    return _folded(spark, table)[0] >= 0 or bool(_complete(spark, table))


def read_versions(spark: SparkSession, table: KeyedTable, buckets: Collection[int] | None = None) -> DataFrame:
    """Rows with ``bucket`` and the ``batch_id`` that set (or folded) them, among them the newest of each key.

    Only the files of ``buckets``, if given, are read.
    """
    through, folds = _folded(spark, table)
    wanted = (lambda b: True) if buckets is None else set(buckets).__contains__
    fold_paths = [f"{table._folds}/batch_id={f}/bucket={b}" for b, f in sorted(folds.items()) if wanted(b)]
    change_paths = [
        f"{table._changes}/batch_id={i}/bucket={b}" for i in _complete(spark, table) if i > through
        for b in sorted(_buckets_in(spark, f"{table._changes}/batch_id={i}")) if wanted(b)]
    dealt = StructType([*table.schema, StructField("batch_id", IntegerType()), StructField("bucket", IntegerType())])
    parts = [
        spark.read.schema(dealt).option("basePath", base).parquet(*paths)
        for base, paths in ((table._folds, fold_paths), (table._changes, change_paths)) if paths]
    if not parts:
        return spark.createDataFrame([], dealt)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def newest_rows(table: KeyedTable, rows: DataFrame) -> DataFrame:
    """The newest row of each key, with its ``bucket`` and ``batch_id``."""
    rest = [c for c in rows.columns if c not in table.keys]
    return (
        rows.groupBy(*table.keys)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
        .select(*table.keys, "_row.*")
    )


def read_rows(spark: SparkSession, table: KeyedTable, buckets: Collection[int] | None = None) -> DataFrame:
    """The newest row of each key."""
    return newest_rows(table, read_versions(spark, table, buckets)).select(*table.schema.fieldNames())


def fold(spark: SparkSession, table: KeyedTable) -> set[int]:
    """Fold the changes since the last fold, in the buckets they touch, which are returned."""
    through, folds = _folded(spark, table)
    later = [i for i in _complete(spark, table) if i > through]
    if not later:
        return set()
    touched = changed_buckets(spark, table, later)
    if touched:
        rows = newest_rows(table, read_versions(spark, table, touched)).drop("batch_id")
        _write_buckets(rows.select(*table.schema.fieldNames(), "bucket"), f"{table._folds}/batch_id={later[-1]}")
    counting = folds | {b: later[-1] for b in touched}
    manifests.put(spark, table._manifests, later[-1], {str(b): f for b, f in counting.items()})
    _tidy(spark, table, through, folds, counting)
    return touched


def _tidy(spark: SparkSession, table: KeyedTable, through: int, before: dict[int, int], now: dict[int, int]) -> None:
    """Delete the changes that the fold before this one covered, and the fold parts that neither counts."""
    for i in _complete(spark, table):
        if i <= through:
            manifests.delete(spark, f"{table._changes}/batch_id={i}")
    counting = set(before.items()) | set(now.items())
    for name in manifests.names(spark, f"{table._folds}/batch_id=*"):
        batch_id = int(name.removeprefix("batch_id="))
        parts = _buckets_in(spark, f"{table._folds}/{name}")
        for b in parts:
            if (b, batch_id) not in counting:
                manifests.delete(spark, f"{table._folds}/{name}/bucket={b}")
        if all((b, batch_id) not in counting for b in parts):
            manifests.delete(spark, f"{table._folds}/{name}")
    manifests.keep_newest(spark, table._manifests, 2)
