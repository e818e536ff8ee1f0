"""Text to timestamp and date, and the count of what would not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text forms found in the source tables.
TIME_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'")
DATE_FORMAT = "dd-MM-yyyy"


def parsed_time(text: str, formats=TIME_FORMATS) -> Column:
    """The first format that fits.

    A failed parse costs far more than a successful one, so a format is tried
    only on text that agrees with it about having a decimal point.
    """
    pointed = F.contains(F.col(text), F.lit("."))
    return F.coalesce(
        *[F.when(pointed == F.lit("." in f), F.try_to_timestamp(F.col(text), F.lit(f))) for f in formats]
    )


def parsed_date(text: str, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(F.col(text), fmt)


def parse_timestamps(df: DataFrame, column: str, formats=TIME_FORMATS) -> DataFrame:
    """Replace text by the first format that fits; null when none does."""
    return df.withColumn(column, parsed_time(column, formats))


def parse_dates(df: DataFrame, column: str, fmt: str = DATE_FORMAT) -> DataFrame:
    return df.withColumn(column, parsed_date(column, fmt))


def failure_counts(text: str, parsed: Column) -> dict[str, Column]:
    """Aggregates that tell unparseable text from text that was never there."""
    return {
        "unparseable": F.count_if(F.col(text).isNotNull() & parsed.isNull()),
        "missing": F.count_if(F.col(text).isNull()),
        "rows": F.count(F.lit(1)),
    }


def parse_failures(df: DataFrame, column: str, parsed: Column) -> DataFrame:
    """One row: rows with bad text, rows without text, all rows."""
    return df.agg(*[count.alias(name) for name, count in failure_counts(column, parsed).items()])
