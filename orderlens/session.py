"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Only what the marts rely on; everything else stays the cluster's choice.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app_name: str, cores: str = "8", memory: str = "8g", **conf) -> SparkSession:
    """Single-machine session for tests and the bench. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
    )
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only for a local master, where
    driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderlens-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_root(spark)}/orderlens/{label}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []
# Writer options of tables of lines: a third fewer bytes than with Spark's default codec.
PACKED = {"compression": "zstd"}


def keep(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once as a columnar table and return the table.

    Cuts the lineage, survives lost executors, and lets every later reader
    prune columns and see real sizes. Inside ``scratch`` it goes at the end of the block.
    """
    path = fresh_dir(df.sparkSession, label)
    if _scratch:
        _scratch[-1].append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_counted(df: DataFrame, label: str, **options) -> tuple[DataFrame, int]:
    """``keep`` and the number of rows, counted while they are written."""
    seen = Observation()
    table = keep(df.observe(seen, F.count(F.lit(1)).alias("rows")), label, **options)
    return table, seen.get.get("rows", 0)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables kept inside the block, and no others, are deleted when it ends.

    For jobs whose results are written elsewhere: no frame that reads a kept table may be used afterwards.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


# Files of a finished query's shuffles go at once, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside the block the shuffle files of a query are deleted when it ends, for jobs that run many in a row.

    A query that is run a second time computes its shuffles again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few driver-side rows as a local relation, without Python workers."""
    schema = StructType.fromDDL(ddl)
    records = [dict(zip(schema.fieldNames(), row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schema)), schema)
