"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from orderlens.operators.lookups import few


def one_row_per_day(dim: DataFrame) -> DataFrame:
    """Holiday facts, one row per day; the flag may be a boolean or 0/1.

    Repeated equal rows count once; a day with two different rows stops the job by name.
    At most one row per calendar day can leave this, whatever the size of the
    dimension, and that is what makes it safe to broadcast.
    """
    facts = F.struct(F.col("is_holiday").cast("boolean").alias("is_holiday"), "holiday_name")
    days = _agreed(dim.filter(F.col("date_key").isNotNull()).groupBy("date_key"), facts)
    return days.select("date_key", "one.is_holiday", "one.holiday_name")


def _agreed(days: GroupedData, facts: Column) -> DataFrame:
    """The grouping columns and ``one``, the facts that all rows of a day agree on."""
    days = days.agg(F.min(facts).alias("one"), F.max(facts).alias("other"))
    conflict = F.raise_error(F.concat(F.lit("the calendar has conflicting rows for "), F.col("date_key").cast("string")))
    one = F.when(F.col("one").eqNullSafe(F.col("other")), F.col("one")).otherwise(conflict.cast(days.schema["one"].dataType))
    return days.withColumn("one", one).drop("other")


def with_day_parts(df: DataFrame, date_col: str) -> DataFrame:
    """Year, month, ISO week, weekday, weekend of the date."""
    day = F.col(date_col)
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "week": F.weekofyear(day),
            "day_of_week": F.date_format(day, "EEEE"),
            "is_weekend": F.weekday(day) >= 5,
        }
    )


def with_calendar(df: DataFrame, date_col: str, dim: DataFrame, holiday_name: bool = False) -> DataFrame:
    """Year, month, ISO week, weekday, weekend from the date; holiday from ``dim``.

    ``is_holiday`` stays null outside the days the dimension covers.
    """
    days = one_row_per_day(dim).withColumnRenamed("date_key", date_col)
    wanted = ["is_holiday", "holiday_name"] if holiday_name else ["is_holiday"]
    return with_day_parts(df, date_col).join(F.broadcast(days.select(date_col, *wanted)), date_col, "left")


def validity_periods(snapshots: DataFrame, taken: str = "dt", run: str = "batch") -> DataFrame:
    """(date_key, is_holiday, holiday_name, valid_from, valid_to): what was known of each day, and when.

    Of several snapshots of one day the last run counts. Equal facts in successive snapshots are
    one period; a day that a snapshot lacks is unknown from then on. ``valid_to`` is the day of the
    next snapshot, null for what still holds.
    """
    newest = snapshots.groupBy(taken).agg(F.max(run).alias(run))
    # One row per snapshot: a handful a day at most.
    following = newest.withColumn("next", F.lead(taken).over(Window.orderBy(taken)))
    rows = snapshots.join(F.broadcast(following), [taken, run]).filter(F.col("date_key").isNotNull())
    facts = F.struct(F.col("is_holiday").cast("boolean").alias("is_holiday"), "holiday_name")
    days = _agreed(rows.groupBy("date_key", F.col(taken).alias("valid_from"), "next"), facts)
    by_day = Window.partitionBy("date_key").orderBy("valid_from")
    same = F.lag("one").over(by_day).eqNullSafe(F.col("one")) & (F.lag("next").over(by_day) == F.col("valid_from"))
    numbered = days.withColumn("_new", F.coalesce((~same).cast("int"), F.lit(1))).withColumn("_period", F.sum("_new").over(by_day))
    return (
        numbered.groupBy("date_key", "_period")
        .agg(F.first("one").alias("one"), F.min("valid_from").alias("valid_from"), F.max_by("next", "valid_from").alias("valid_to"))
        .select("date_key", "one.is_holiday", "one.holiday_name", "valid_from", "valid_to")
    )


def with_calendar_as_of(df: DataFrame, date_col: str, as_of: str, periods: DataFrame) -> DataFrame:
    """Calendar attributes of ``date_col`` as they were known on the day in ``as_of``.

    ``periods`` is a stored table of ``validity_periods``; it is broadcast while it is measured to be small.
    """
    known = few(periods.withColumnRenamed("date_key", "_day"))
    then = F.col(as_of) >= F.col("valid_from")
    then = then & (F.col("valid_to").isNull() | (F.col(as_of) < F.col("valid_to")))
    joined = with_day_parts(df, date_col).join(known, (F.col(date_col) == F.col("_day")) & then, "left")
    return joined.drop("_day", "valid_from", "valid_to")
