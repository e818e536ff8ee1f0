"""Parquet sinks that report their row count without a second pass."""

from __future__ import annotations

import math
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderlens.session import PACKED

# Files stay splittable and of readable size; the number of tasks that write
# them is left to Spark.
MAX_RECORDS_PER_FILE = 20_000_000
# A bucket is written, sorted and joined by one task.
BUCKET_ROWS = 1_000_000


class Buckets(NamedTuple):
    """How a table is bucketed: tables of equal buckets join on the keys without a shuffle."""

    count: int
    keys: tuple[str, ...]


def buckets_for(rows: int, least: int = 8) -> int:
    """So many buckets that none holds more than about BUCKET_ROWS of ``rows``, however many there are."""
    return max(least, math.ceil(rows / BUCKET_ROWS))


def write_observed(
    df: DataFrame,
    path: str,
    mode: str,
    metrics: dict[str, Column] | None = None,
    columns: list[Column] | None = None,
    partition_by: tuple[str, ...] = (),
    options: dict[str, str] | None = None,
    buckets: Buckets | None = None,
) -> dict:
    """Write ``df`` and return metrics that were gathered while writing.

    Metrics see all of ``df``; ``columns`` narrows what is written. With ``buckets`` the
    table is bucketed and sorted by their keys, one file per bucket.
    """
    gathered = Observation()
    observed = df.observe(
        gathered,
        F.count(F.lit(1)).alias("rows"),
        *[c.alias(name) for name, c in (metrics or {}).items()],
    )
    if columns:
        observed = observed.select(*columns)
    if buckets:
        dealt = observed.repartition(buckets.count, *buckets.keys)
        writer = dealt.write.mode(mode).bucketBy(buckets.count, *buckets.keys).sortBy(*buckets.keys)
        # Only the files matter; the entry in this session's catalog goes again.
        name = f"bucketed_{uuid.uuid4().hex}"
        writer.option("path", path).saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")
        return gathered.get
    writer = observed.write.mode(mode).options(maxRecordsPerFile=MAX_RECORDS_PER_FILE, **PACKED, **(options or {}))
    writer.parquet(path, partitionBy=list(partition_by) or None)
    return gathered.get


def overwrite_table(df: DataFrame, path: str) -> int:
    """Full rebuild of a processed table or mart; returns the rows written."""
    return write_observed(df, path, "overwrite").get("rows", 0)


def write_raw(df: DataFrame, table_root: str, dt: str, batch: int, metrics: dict[str, Column] | None = None, **more) -> dict:
    """Add one increment under ``dt=<day>/batch=<run number>``.

    No run writes where another has written. What two runs have both read, after a
    crash or through an overlap, is left to ``drop_superseded``.
    """
    return write_observed(df, f"{table_root}/dt={dt}/batch={batch}", "errorifexists", metrics, **more)
