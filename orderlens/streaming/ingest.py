"""Repeatable incremental load as a stream that stops when it has caught up.

Two guarantees are on offer. ``ingest_available`` counts a file once.
``ingest_distinct`` counts a key once, however often it is sent, within a bounded time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ingest_available(
    spark: SparkSession,
    source: str,
    schema: StructType,
    time_col: str,
    sink: str,
    checkpoint: str,
    pattern: str = "*.parquet",
    max_files: int = 1000,
) -> None:
    """Append every file of the folder ``source`` not seen before, by event day.

    The checkpoint remembers files, not times, so rows that arrive late are read
    like any others, and a rerun without new files adds nothing.
    """
    _append(_arrivals(spark, source, schema, pattern, max_files), time_col, sink, checkpoint)


def ingest_distinct(
    spark: SparkSession,
    source: str,
    schema: StructType,
    time_col: str,
    keys: list[str],
    sink: str,
    checkpoint: str,
    remembered: str = "7 days",
    pattern: str = "*.parquet",
    max_files: int = 1000,
) -> None:
    """The same, and a row whose ``keys`` have arrived before, in the same or another file, is dropped.

    Keys are remembered as state for ``remembered`` after they arrived, which bounds the
    state by the arrivals of that time. The watermark follows the time of arrival, not of the
    event: no row is too late to be taken, however old its event. A key that comes again
    after that time is taken again; ``readers.drop_superseded`` settles such repeats. The
    time of arrival is that of the batch and kept in the checkpoint, so a batch that is
    repeated after a failure gives the same rows.
    """
    arrived = _arrivals(spark, source, schema, pattern, max_files).withColumn("_arrived", F.current_timestamp())
    fresh = arrived.withWatermark("_arrived", remembered).dropDuplicatesWithinWatermark(keys).drop("_arrived")
    _append(fresh, time_col, sink, checkpoint)


def _arrivals(spark: SparkSession, source: str, schema: StructType, pattern: str, max_files: int) -> DataFrame:
    options = {"maxFilesPerTrigger": max_files, "pathGlobFilter": pattern}
    return spark.readStream.schema(schema).options(**options).parquet(source)


def _append(rows: DataFrame, time_col: str, sink: str, checkpoint: str) -> None:
    (
        rows.withColumn("dt", F.to_date(time_col))
        .writeStream.format("parquet")
        .partitionBy("dt")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingested(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """What the stream has committed so far, without the partition column."""
    return spark.read.parquet(sink).select(*schema.fieldNames())
