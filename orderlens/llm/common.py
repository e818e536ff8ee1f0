"""Helpers shared by the operators: batches in and out of Arrow, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from orderlens.session import fresh_dir, keep, scratch

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MEMO_WORDS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_alone(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``make`` describes, written; tables kept on the way to it are deleted."""
    path = fresh_dir(spark, label)
    with scratch(spark):
        made = make()
        schema = made.schema
        made.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def map_rows(
    df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple]], ddl: str, batch_rows: int = 2_000
) -> DataFrame:
    """``mapInArrow`` for a generator of tuples; results leave in bounded batches."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        for row in make(batches):
            pending.append(row)
            if len(pending) >= batch_rows:
                yield _batch(pending, schema)
                pending = []
        if pending:
            yield _batch(pending, schema)

    return df.mapInArrow(run, ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def rows_in(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple]:
    """The rows of the batches as tuples; only a few rows are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield from zip(*[column.to_pylist() for column in part.columns])


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, remembered; forgets everything when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits (in place)."""
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def odd_constants(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random odd multipliers."""
    start = np.arange(1, count + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed)
    return mix(start) | np.uint64(1)


def windows(values: np.ndarray, offsets: list[int], factors: np.ndarray) -> np.ndarray:
    """Hash of the values at ``offsets`` from every position that holds the whole window."""
    length = len(values) - max(offsets)
    total = np.zeros(max(length, 0), np.uint64)
    for offset, factor in zip(offsets, factors):
        total += values[offset : offset + len(total)] * factor
    return mix(total)


def _marked(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` with ``_likely``: true where ``key`` is in ``wanted``, a table of that column, and for one in nine of the others.

    Eight bits per row of ``wanted`` are broadcast, in words of 64 that the hash of a key points into.
    """
    words = wanted.count() // 8 + 1
    place = F.pmod(F.xxhash64(key), F.lit(64 * words))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    bits = wanted.groupBy(F.shiftright(place, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    placed = rows.withColumn("_place", place).withColumn("_word", F.shiftright("_place", 6))
    found = placed.join(F.broadcast(bits), "_word", "left")
    likely = F.coalesce(F.bit_get("_bits", (F.col("_place") % 64).cast("int")) == 1, F.lit(False))
    return found.select(*rows.columns, likely.alias("_likely"))


def likely_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``, so that the exact join after it moves few rows."""
    return _marked(rows, key, wanted).filter("_likely").drop("_likely")


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` is not in ``gone``, a stored table of that column; few of the rows that stay are moved."""
    marked = _marked(rows, key, gone)
    unsure = marked.filter("_likely").join(gone, key, "left_anti")
    return marked.filter("not _likely").unionByName(unsure).select(*rows.columns)


def spread_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: str, how: str = "inner", hot_rows: int = 5_000, salts: int = 32
) -> DataFrame:
    """Join a stored ``left`` with ``right`` (at most one row per key), splitting hot keys of ``left`` over ``salts`` tasks.

    A key is hot with ``hot_rows`` rows and a thousandth of all rows, so there are at
    most a thousand, which are broadcast; their ``right`` rows are repeated once per salt.
    """
    least = max(hot_rows, left.count() // 1_000)
    hot = left.groupBy(*on).count().filter(F.col("count") >= least).select(*on, F.lit(True).alias("_hot"))
    hot = keep(hot, "hot-keys")
    spread = F.col("_hot")
    for key in on:  # null keys match nothing and must not meet in one task either
        spread = spread | F.col(key).isNull()
    salt = F.when(spread, F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(F.lit(0)).alias("_salt")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = left.join(F.broadcast(hot), on, "left").select(*left.columns, salt.cast("int"))
    copied = right.join(F.broadcast(hot), on, "left").select(*right.columns, F.explode(every).alias("_salt"))
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")
