"""Joins of a large table with a lookup, or with keys that few of its rows have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, IntegralType, StringType, TimestampType

# A side is broadcast only when it was counted and weighed below both limits.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot when it holds more than one in HOT_SHARE of all weighted rows,
# so there are fewer than HOT_SHARE hot keys however large the tables are.
HOT_SHARE = 1000
SPREAD = 1024

# Marks of hashed keys: bits per key while there is room, the words of 64 bits that may be broadcast, and the
# bits per key below which too many other rows would look alike.
MARK_BITS, LEAST_MARK_BITS = 8, 2
MARK_WORDS = MAX_BROADCAST_BYTES // 16
# Words in one broadcast row, which costs far more memory than a word.
ROW_WORDS = 4


def fits_broadcast(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure ``table`` (one pass, three numbers) against the broadcast limits."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) for f in table.schema.fields),
        F.lit(16),
    )
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def few(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if they are measured to be small."""
    return F.broadcast(rows) if fits_broadcast(rows) else rows


def _same_hash(one: DataType, other: DataType) -> bool:
    """Whether equal values of the two types have equal hashes."""
    text = isinstance(one, StringType) and one == StringType()
    return one == other and (text or isinstance(one, IntegralType | DateType | TimestampType | BooleanType))


def marked(rows: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str] | None = None) -> DataFrame | None:
    """``rows`` with ``_likely``: true where the keys are among those of ``wanted``, a stored table, and for few others.

    Bits of hashed keys are broadcast, a few words of 64 to a row. None when ``wanted`` is too large for that, or when its
    keys are of other types. Null keys are among others like any value.
    """
    names = wanted_keys or keys
    if not all(_same_hash(rows.schema[k].dataType, wanted.schema[n].dataType) for k, n in zip(keys, names)):
        return None
    count = wanted.count()
    words = min(count * MARK_BITS // 64 + 1, MARK_WORDS)
    if count * LEAST_MARK_BITS > 64 * words:
        return None

    def place(columns: list[str]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(64 * words))

    group, number = F.floor(F.col("_place") / (64 * ROW_WORDS)).cast("int").alias("_group"), F.shiftright("_place", 6) % ROW_WORDS
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_place") % 64).cast("int"))
    placed = wanted.select(place(names).alias("_place")).withColumn("_number", number)
    bits = placed.groupBy(group).agg(
        *[F.bit_or(F.when(F.col("_number") == n, bit).otherwise(F.lit(0))).alias(f"_bits_{n}") for n in range(ROW_WORDS)]
    )
    found = rows.withColumn("_place", place(keys)).withColumn("_group", group).join(F.broadcast(bits), "_group", "left")
    word = F.lit(0).cast("long")
    for n in range(ROW_WORDS):
        word = F.when(number == n, F.col(f"_bits_{n}")).otherwise(word)
    likely = F.coalesce(F.bit_get(word, (F.col("_place") % 64).cast("int")) == 1, F.lit(False))
    return found.select(*rows.columns, likely.alias("_likely"))


def likely_among(rows: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str] | None = None) -> DataFrame:
    """``rows`` without most of those whose keys are not in ``wanted``, so that the exact join after it moves few."""
    found = marked(rows, keys, wanted, wanted_keys)
    return rows if found is None else found.filter("_likely").drop("_likely")


def among(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """``rows`` whose keys are in ``wanted``, a stored table; few of the others are moved."""
    wanted = wanted.select(*keys)
    if fits_broadcast(wanted):
        return rows.join(F.broadcast(wanted), keys, "left_semi")
    return likely_among(rows, keys, wanted).join(wanted.distinct(), keys, "left_semi")


def without(rows: DataFrame, keys: list[str], gone: DataFrame, condition: Column, gone_keys: list[str], small: bool | None = None) -> DataFrame:
    """``rows`` left anti ``gone``, a stored table, on ``condition``, which equates ``keys``; few of the rows that stay are moved."""
    if fits_broadcast(gone) if small is None else small:
        return rows.join(F.broadcast(gone), condition, "left_anti")
    found = marked(rows, keys, gone, gone_keys)
    if found is None:
        return rows.join(gone, condition, "left_anti")
    unsure = found.filter("_likely").drop("_likely").join(gone, condition, "left_anti")
    return found.filter("not _likely").drop("_likely").unionByName(unsure)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    spread_by: list[str],
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``facts`` left join ``lookup`` on ``key``, safe for any size and any skew.

    ``lookup`` is a stored table, unique on ``key``, whose ``weight`` column says
    how many fact rows carry the key. Small lookups are broadcast. For a large
    one the hot keys, few by construction, are broadcast, and only the remaining
    rows are matched by a shuffle. There, hot and null keys have no partner left,
    so they are spread over the tasks by a hash of ``spread_by``.
    """
    values = [c for c in lookup.columns if c not in (key, weight)]
    if fits_broadcast(lookup, max_rows):
        return facts.join(F.broadcast(lookup.drop(weight)), key, "left").select(*facts.columns, *values)

    total = lookup.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) > total / HOT_SHARE
    hot = lookup.filter(is_hot).select(
        key, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values]
    )
    cold = lookup.filter(~is_hot).select(key, F.lit(0).alias("_spread"), *values)

    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    tagged = facts.join(F.broadcast(hot), key, "left").withColumn(
        "_spread", F.when(settled, 1 + F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int")).otherwise(0)
    )
    return tagged.join(cold, [key, "_spread"], "left").select(
        *[F.col(c) for c in facts.columns],
        *[F.coalesce(F.col(f"_hot_{v}"), F.col(v)).alias(v) for v in values],
    )
