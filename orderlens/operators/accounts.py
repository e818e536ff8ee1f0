"""Accounts whose volume is beyond that of one person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.lookups import MAX_BROADCAST_ROWS, lookup_join

# Fixed value: more line items than this marks an account as non-individual.
MAX_INDIVIDUAL_LINES = 500
FLAG = "is_likely_non_individual"


def lines_per_customer(slices: DataFrame) -> DataFrame:
    return (
        slices.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.sum("line_count").alias("total_line_items"))
    )


def non_individual_flag(slices: DataFrame, threshold: int = MAX_INDIVIDUAL_LINES) -> DataFrame:
    """Every known customer with its line count and flag. A flag, never a filter."""
    return lines_per_customer(slices).withColumn(FLAG, F.col("total_line_items") > threshold)


def flagged_accounts(slices: DataFrame, threshold: int = MAX_INDIVIDUAL_LINES) -> DataFrame:
    """Only the flagged ids, with the number of slices each holds."""
    return (
        slices.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.sum("line_count").alias("_lines"), F.count(F.lit(1)).alias("slice_count"))
        .filter(F.col("_lines") > threshold)
        .select("user_id", F.lit(True).alias(FLAG), "slice_count")
    )


def with_account_flag(slices: DataFrame, flagged: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Add the flag to slices; guests and unflagged customers get false.

    Only flagged ids are joined, so ordinary customers and the guests' null key
    are not shuffled at all while those ids fit a broadcast.
    """
    return lookup_join(
        slices, flagged, "user_id", "slice_count", ["order_id"], max_broadcast_rows
    ).withColumn(FLAG, F.coalesce(F.col(FLAG), F.lit(False)))
