"""One decode for all continuous questions: a log of flights and rejects that they follow.

One query reads and parses the messages and appends them, typed, to a log partitioned by ``kind``. It is a
file sink: a batch's files count once they are in the sink's own commit log, and readers and followers
look at that log alone, so a restart neither loses nor doubles a line. The questions follow the log as a
stream of typed columns; nothing is parsed again, and a question that is added later starts from the beginning.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from skyledger.operators import TwoLegBounds
from skyledger.schema import FLIGHT_SCHEMA
from skyledger.session import path_exists
from skyledger.sinks import Store
from skyledger.sources import decode_lines
from skyledger.streaming.questions import Upkeep, start_all
from skyledger.streaming.runner import AVAILABLE_NOW, EVERY_TEN_SECONDS

LOG_SCHEMA = StructType([*FLIGHT_SCHEMA, StructField("line", StringType()), StructField("kind", StringType())])

#: What a follower takes into a micro-batch at most; everything is taken in, batch by batch.
FOLLOW_INTAKE = {"maxBytesPerTrigger": str(1 << 30)}
POLL_SECONDS = 0.1


def _path(root: str) -> str:
    return f"{root}/log"


def start_log(messages: DataFrame, root: str, trigger: dict | None = None) -> StreamingQuery:
    """Decode ``messages`` and append them to the log under ``root``."""
    return (
        decode_lines(messages).writeStream.format("parquet").outputMode("append").partitionBy("kind")
        .option("checkpointLocation", f"{root}/_checkpoints/log")
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start(_path(root))
    )


def follow_flights(spark: SparkSession, root: str, **intake: str) -> DataFrame:
    """The flights of the log as a stream, from its beginning."""
    log = spark.readStream.schema(LOG_SCHEMA).options(**(intake or FOLLOW_INTAKE)).parquet(_path(root))
    return log.where(F.col("kind") == "flights").select(*FLIGHT_SCHEMA.fieldNames())


def _read(spark: SparkSession, root: str, kind: str, columns: list[str]) -> DataFrame:
    if not path_exists(spark, f"{_path(root)}/_spark_metadata"):
        return spark.createDataFrame([], LOG_SCHEMA).select(*columns)
    return spark.read.schema(LOG_SCHEMA).parquet(_path(root)).where(F.col("kind") == kind).select(*columns)


def read_flight_log(spark: SparkSession, root: str) -> DataFrame:
    """The flights that the log holds now."""
    return _read(spark, root, "flights", FLIGHT_SCHEMA.fieldNames())


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the log that are no flights."""
    return _read(spark, root, "rejects", ["line"])


def start_from_log(
    messages: DataFrame,
    root: str,
    bounds: TwoLegBounds,
    trigger: dict | None = None,
    show: int = 0,
    store: Store | None = None,
    upkeep: Upkeep | None = None,
    **intake: str,
) -> list[StreamingQuery]:
    """All questions over one log, which is started first; ``intake`` limits the followers' batches.

    With a trigger that stops when all is taken in, the followers start after the log has ended.
    """
    spark = messages.sparkSession
    log = start_log(messages, root, trigger)
    if trigger == AVAILABLE_NOW:
        log.awaitTermination()
    # The sink's commit log is there before its first file is.
    while not path_exists(spark, f"{_path(root)}/_spark_metadata"):
        if not log.isActive:
            log.awaitTermination()
            break
        time.sleep(POLL_SECONDS)
    return [log, *start_all(follow_flights(spark, root, **intake), root, bounds, trigger, show, store, upkeep)]
