"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyledger.session import ROCKSDB_PROVIDER, session_conf
from skyledger.sinks import batch_writer
from skyledger.sources import rejected_lines

# Fixed value: the micro-batch interval of a continuous query.
EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}
# Take in everything that is there, in as many micro-batches as the intake limit asks for, and stop.
AVAILABLE_NOW = {"availableNow": True}


def start_query(
    state: DataFrame,
    path: str,
    checkpoint: str,
    finish: Callable[[DataFrame], DataFrame],
    mode: str = "complete",
    trigger: dict | None = None,
    rocksdb: bool = False,
    partitions: int | None = None,
    reread: bool = False,
    show: int = 0,
    also: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Run ``finish`` on the output of every micro-batch and store it under ``path``.

    ``mode`` "complete" hands over the whole state each time, "update" only the
    groups that changed, which are stored in files of a sensible size instead of
    one per state partition. ``rocksdb`` keeps the state outside the JVM heap, for
    key spaces that grow with the data. ``partitions`` is for those that do not:
    it holds the state in so many partitions, which the checkpoint keeps.
    ``reread`` is for a ``finish`` that uses its input twice; ``show`` prints that
    many rows of every result, and ``also`` is called with every stored result and its batch id.
    """
    store = (lambda batch: finish(batch).hint("rebalance")) if mode == "update" else finish
    return start_batches(
        state, checkpoint, batch_writer(path, store, reread, show, also), mode, trigger, rocksdb, partitions)


def start_batches(
    state: DataFrame,
    checkpoint: str,
    take_in: Callable[[DataFrame, int], None],
    mode: str = "update",
    trigger: dict | None = None,
    rocksdb: bool = False,
    partitions: int | None = None,
) -> StreamingQuery:
    """Call ``take_in`` with the output of every micro-batch and its id; the rest is as in ``start_query``."""
    wanted = {}
    if rocksdb:
        wanted["spark__sql__streaming__stateStore__providerClass"] = ROCKSDB_PROVIDER
    if partitions:
        wanted["spark__sql__shuffle__partitions"] = partitions
    with session_conf(state.sparkSession, **wanted):
        return (
            state.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_TEN_SECONDS))
            .foreachBatch(take_in)
            .start()
        )


def start_rejects(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the lines that are no flights as text under ``path``."""
    return (
        rejected_lines(messages).writeStream.format("text").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start(path)
    )
