"""Result tables: written once by a batch job, or once per micro-batch by a stream.

A stream's table is a folder with one ``batch_id=N`` directory per micro-batch.
A replayed batch overwrites its own directory and nothing else, so a restart
never stores a batch twice. Readers trust only directories that Spark has
marked complete.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.schema import RESULT_TABLES, conform
from skyledger.session import session_conf
from skyledger.sinks.manifests import delete, file_system
from skyledger.sinks.publish import published_root


class Store(NamedTuple):
    """A place that keeps tables itself and replaces rows by key, reached through its connector.

    ``{table}`` in an option's value stands for the name of the result table.
    """

    fmt: str
    options: dict[str, str]

    def options_for(self, table: str) -> dict[str, str]:
        return {key: value.format(table=table) for key, value in self.options.items()}


def write_table(
    df: DataFrame, table: str, root: str, fmt: str = "parquet", mode: str = "errorifexists", **options
) -> str:
    """Write ``df`` as result table ``table`` under ``root``; existing data is refused by default."""
    path = f"{root}/{table}"
    conform(df, RESULT_TABLES[table].schema).write.format(fmt).mode(mode).options(**options).save(path)
    return path


def write_to_store(df: DataFrame, table: str, store: Store, mode: str = "append") -> None:
    """Write ``df`` as result table ``table`` of ``store``."""
    rows = conform(df, RESULT_TABLES[table].schema)
    rows.write.format(store.fmt).mode(mode).options(**store.options_for(table)).save()


def read_table(spark: SparkSession, table: str, root: str, fmt: str = "parquet", **options) -> DataFrame:
    """A result table under ``root``: that of the newest published run, if any was published there."""
    return (
        spark.read.format(fmt).schema(RESULT_TABLES[table].schema).options(**options)
        .load(f"{published_root(spark, root) or root}/{table}")
    )


def batch_writer(
    path: str,
    finish: Callable[[DataFrame], DataFrame],
    reread: bool = False,
    show: int = 0,
    also: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores ``finish(batch)`` under the batch's own id.

    A streaming query plans without adaptive execution, because its state has a
    fixed number of partitions. ``finish`` holds no state, so it plans with it.
    ``reread`` says that ``finish`` reads its input more than once; the batch is
    then written beside the table first, so that its state is updated only once,
    also when an executor is lost. ``show`` prints that many stored rows, and
    ``also`` is called with all of them and the batch id.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{path}/batch_id={batch_id}"
        if reread:
            batch.write.mode("overwrite").parquet(f"{path}-input")
            batch = spark.read.schema(batch.schema).parquet(f"{path}-input")
        with session_conf(spark, spark__sql__adaptive__enabled="true"):
            result = finish(batch)
            result.write.mode("overwrite").parquet(folder)
        stored = spark.read.schema(result.schema).parquet(folder)
        if show:
            stored.show(show, truncate=False)
        if also:
            also(stored, batch_id)

    return write


def _complete_batches(spark: SparkSession, path: str) -> list[int]:
    pattern, files = file_system(spark, f"{path}/batch_id=*/_SUCCESS")
    names = (f.getPath().getParent().getName() for f in files.globStatus(pattern) or [])
    return sorted(int(name.removeprefix("batch_id=")) for name in names)


def _delete_batches(spark: SparkSession, path: str, batch_ids: list[int]) -> None:
    for batch_id in batch_ids:
        delete(spark, f"{path}/batch_id={batch_id}")


def has_results(spark: SparkSession, path: str) -> bool:
    """Whether any batch of a table is complete."""
    return bool(_complete_batches(spark, path) or _complete_batches(spark, _folded_path(path)))


def _read_batches(spark: SparkSession, path: str, batch_ids: list[int]) -> DataFrame:
    folders = [f"{path}/batch_id={i}" for i in batch_ids]
    return spark.read.option("basePath", path).parquet(*folders)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete batch of a table whose every batch holds the whole result."""
    return _read_batches(spark, path, _complete_batches(spark, path)[-1:]).drop("batch_id")


def prune_results(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` batches of a table whose every batch holds the whole result.

    A reader that has just chosen the newest batch can finish while ``keep`` is above one.
    """
    _delete_batches(spark, path, _complete_batches(spark, path)[:-keep])


def _folded_path(path: str) -> str:
    return f"{path}-folded"


def _changes(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Every row that may be the newest of its key, and the last batch id among them."""
    folds = _complete_batches(spark, _folded_path(path))[-1:]
    later = [i for i in _complete_batches(spark, path) if not folds or i > folds[0]]
    parts = []
    if folds:
        parts.append(_read_batches(spark, _folded_path(path), folds))
    if later:
        parts.append(_read_batches(spark, path, later))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows, max(folds + later)


def _newest_per_key(changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    rest = [c for c in changes.columns if c not in (*keys, "batch_id")]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
        .select(*keys, "_row.*")
    )


def read_changes(spark: SparkSession, path: str, keys: tuple[str, ...]) -> DataFrame:
    """The newest row per key of a table whose batches hold only the changed rows."""
    return _newest_per_key(_changes(spark, path)[0], keys)


def carry_forward(spark: SparkSession, path: str, changed: DataFrame, keys: tuple[str, ...], batch_id: int) -> DataFrame:
    """Store, as batch ``batch_id``, the batch before it with the rows of ``changed`` in place of those with their keys.

    The cost follows one whole result, whatever the number of batches. A replayed batch
    starts from the one before it again; batches before that one are deleted.
    """
    earlier = [i for i in _complete_batches(spark, path) if i < batch_id]
    rows = changed.withColumn("batch_id", F.lit(batch_id))
    if earlier:
        rows = _read_batches(spark, path, earlier[-1:]).unionByName(rows)
    folder = f"{path}/batch_id={batch_id}"
    _newest_per_key(rows, keys).write.mode("overwrite").parquet(folder)
    _delete_batches(spark, path, earlier[:-1])
    return spark.read.schema(changed.schema).parquet(folder)


def compact_changes(spark: SparkSession, path: str, keys: tuple[str, ...]) -> int:
    """Fold the complete batches of a table of changed rows into one, beside it.

    The fold has the id of the last batch in it, which is returned. Batches and
    folds that the fold before this one had already made superfluous are
    deleted, so a reader that started on them has had that long to finish.
    """
    before = _complete_batches(spark, _folded_path(path))
    rows, last = _changes(spark, path)
    if last not in before:
        target = f"{_folded_path(path)}/batch_id={last}"
        _newest_per_key(rows, keys).write.mode("overwrite").parquet(target)
    if before:
        _delete_batches(spark, path, [i for i in _complete_batches(spark, path) if i <= before[-1]])
        _delete_batches(spark, _folded_path(path), before[:-1])
    return last
