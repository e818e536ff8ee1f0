"""Mergeable summaries stored per increment and day, for answers over any range without the rows.

A quantile sketch (KLL) stands beside the exact medians, a set sketch (theta) beside the
exact distinct counts. Both merge without loss of their error bound, so a new increment adds
its own sketches and nothing is read again.

Stated errors: a KLL quantile's rank is off by at most ``RANK_ERROR`` of the rows with 99 %
confidence, and is exact up to ``KLL_K`` rows; a theta count has a relative standard error of
``1 / sqrt(2 ** THETA_LG)``, and is exact up to ``2 ** THETA_LG`` values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.columns import TOTAL, money

KLL_K, RANK_ERROR = 200, 0.0133
THETA_LG = 12


def price_sketches(items: DataFrame, day: str = "order_date", k: int = KLL_K) -> DataFrame:
    """(item_name, day, prices, row_count) per named item; rows without a finite price count, but not for the quantile."""
    price = F.col("item_price")
    usable = F.when(~F.isnan(price) & (F.abs(price) != float("inf")), price)
    return (
        items.filter(F.col("item_name").isNotNull())
        .groupBy("item_name", day)
        .agg(F.kll_sketch_agg_double(usable, k).alias("prices"), F.count(F.lit(1)).alias("row_count"))
    )


def sketched_quantiles(sketches: DataFrame, fraction: float = 0.5) -> DataFrame:
    """(item_name, median_item_price, row_count) over all days in ``sketches``; null for an item without a price.

    Stands in for ``prices.item_medians`` where an approximate median will do.
    """
    merged = sketches.groupBy("item_name").agg(
        F.kll_merge_agg_double("prices").alias("prices"), F.sum("row_count").alias("row_count")
    )
    known = F.kll_sketch_get_n_double("prices") > 0
    quantile = F.when(known, F.kll_sketch_get_quantile_double("prices", F.lit(fraction)))
    return merged.select("item_name", quantile.alias("median_item_price"), "row_count")


def rank_interval(items: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with the share of the item's prices below, and up to, its sketched price: what the error is measured by."""
    estimate = F.col("median_item_price")
    ranks = items.join(found, "item_name").filter(F.col("item_price").isNotNull()).groupBy("item_name").agg(
        (F.count_if(F.col("item_price") < estimate) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("item_price") <= estimate) / F.count(F.lit(1))).alias("upto"),
    )
    return found.join(ranks, "item_name", "left")


def total_sketches(slices: DataFrame, keys: list[str], day: str = "order_date", lg: int = THETA_LG) -> DataFrame:
    """Per ``keys`` and day: exact revenue and lines, and theta sketches of orders and known customers."""
    return slices.groupBy(*keys, day).agg(
        F.sum("total_revenue").cast(TOTAL).alias("revenue"), F.sum("line_count").alias("line_count"),
        F.theta_sketch_agg("order_id", lg).alias("orders"), F.theta_sketch_agg("user_id", lg).alias("customers"),
    )


def _estimate(sketch: str) -> Column:
    return F.theta_sketch_estimate(sketch)


def sketched_totals(sketches: DataFrame, keys: list[str], lg: int = THETA_LG) -> DataFrame:
    """total_revenue (exact), order_count and distinct_customers (estimated) per ``keys`` over all days in ``sketches``."""
    return (
        sketches.groupBy(*keys)
        .agg(
            money(F.sum("revenue")).alias("total_revenue"),
            F.theta_union_agg("orders", lg).alias("orders"), F.theta_union_agg("customers", lg).alias("customers"),
        )
        .select(*keys, "total_revenue", _estimate("orders").alias("order_count"), _estimate("customers").alias("distinct_customers"))
    )


def returning_customers(earlier: DataFrame, later: DataFrame, keys: list[str], lg: int = THETA_LG) -> DataFrame:
    """(keys, returning): customers estimated to be in both of two ranges of days."""
    merged = [
        part.groupBy(*keys).agg(F.theta_union_agg("customers", lg).alias(name)) for part, name in ((earlier, "a"), (later, "b"))
    ]
    both = merged[0].alias("x")
    same = F.lit(True)
    other = merged[1].toDF(*[f"_{k}" for k in keys], "b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return both.join(other, same).select(*keys, _estimate(F.theta_intersection("a", "b")).alias("returning"))
