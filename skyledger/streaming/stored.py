"""Running states without an output of their own: they are read from the checkpoint.

Spark's state data source gives the keys and values of a query's state as of its last batch, or of an earlier one
that the checkpoint still holds. No files of changes have to be written, kept and folded for such a state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from skyledger.session import ROCKSDB_PROVIDER, session_conf
from skyledger.streaming.runner import EVERY_TEN_SECONDS


def start_state(
    state: DataFrame, checkpoint: str, trigger: dict | None = None, rocksdb: bool = True, partitions: int | None = None
) -> StreamingQuery:
    """Keep ``state`` up to date in ``checkpoint`` and nowhere else."""
    wanted = {"spark__sql__streaming__stateStore__providerClass": ROCKSDB_PROVIDER} if rocksdb else {}
    if partitions:
        wanted["spark__sql__shuffle__partitions"] = partitions
    with session_conf(state.sparkSession, **wanted):
        return (
            state.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_TEN_SECONDS))
            .start()
        )


def read_state(spark: SparkSession, checkpoint: str, values: Sequence[str], batch_id: int | None = None) -> DataFrame:
    """The key columns of a running aggregate, and its partial values, which ``values`` names in their order.

    The partial values of a sum are the sum, of a mean the sum and the count, of a minimum the minimum.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    stored = reader.load(checkpoint)
    held = stored.schema["value"].dataType
    named = StructType([StructField(name, field.dataType) for name, field in zip(values, held, strict=True)])
    return stored.select("key.*", F.col("value").cast(named).alias("_value")).select(
        *stored.schema["key"].dataType.fieldNames(), "_value.*")
