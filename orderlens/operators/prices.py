"""Price anomalies: an item price far above the median of the same item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.lookups import MAX_BROADCAST_ROWS, lookup_join
from orderlens.operators.ranking import lower_medians
from orderlens.session import keep

# Fixed value: a price above this multiple of the item's median is an error.
MAX_PRICE_RATIO = 20


def item_medians(items: DataFrame, **options) -> DataFrame:
    """Exact lower median price and row count of every named item."""
    named = items.filter(F.col("item_name").isNotNull())
    return lower_medians(named, "item_name", "item_price", **options).withColumnRenamed("median", "median_item_price")


def with_price_ratio(items: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS, **options) -> DataFrame:
    """Add median_item_price and price_ratio (null without a positive median)."""
    medians = keep(item_medians(items, **options), "medians")
    joined = lookup_join(items, medians, "item_name", "row_count", ["order_id", "lineitem_id"], max_broadcast_rows)
    median = F.col("median_item_price")
    return joined.withColumn("price_ratio", F.when(median > 0, F.col("item_price") / median))


def price_anomalies(items: DataFrame, limit: float = MAX_PRICE_RATIO, **options) -> DataFrame:
    """The rows the price rule removes, with their ratio."""
    return with_price_ratio(items, **options).filter(F.col("price_ratio") > limit)


def plausible_prices(items: DataFrame, limit: float = MAX_PRICE_RATIO, **options) -> DataFrame:
    """The rows the price rule keeps; an unknown ratio is kept."""
    fine = F.coalesce(F.col("price_ratio") <= limit, F.lit(True))
    return with_price_ratio(items, **options).filter(fine).select(*items.columns)
