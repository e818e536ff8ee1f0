"""Revenue per line item, and the order grain the marts are built from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.columns import TOTAL, amount, price_tier
from orderlens.schemas import LINE_KEY

# One row per order and price tier wherever the other attributes are constant within
# an order; where they are not, totals and distinct counts stay exact all the same.
SLICE_KEYS = ("order_id", "user_id", "restaurant_id", "is_loyalty", "order_date", "price_tier")


def line_revenue(items: DataFrame, options: DataFrame) -> DataFrame:
    """Add item_revenue, options_revenue (0 without options) and total_revenue.

    Options are summed per line before the join, so the line grain is kept.
    """
    extras = options.groupBy(*LINE_KEY).agg(
        F.sum(F.col("option_price") * F.col("option_quantity")).alias("options_revenue")
    )
    joined = items.join(extras, list(LINE_KEY), "left")
    item, extra = F.col("item_price") * F.col("item_quantity"), F.coalesce("options_revenue", F.lit(0.0))
    return joined.select(
        *items.columns,
        item.alias("item_revenue"),
        extra.alias("options_revenue"),
        (item + extra).alias("total_revenue"),
    )


def with_order_date(lines: DataFrame) -> DataFrame:
    return lines.withColumn("order_date", F.to_date("creation_time_utc"))


def order_slices(lines: DataFrame) -> DataFrame:
    """Lines folded to the order grain; the marts aggregate these, not lines.

    ``total_revenue`` is an exact decimal from here until a mart shows it.
    """
    return lines.withColumn("price_tier", price_tier()).groupBy(*SLICE_KEYS).agg(
        F.sum(amount("total_revenue")).cast(TOTAL).alias("total_revenue"),
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col("item_price") == 0).alias("free_line_count"),
    )
