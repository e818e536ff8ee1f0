"""The seven marts and the free-item comparison, built from order slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.calendar import with_calendar
from orderlens.functions.columns import TOTAL, money, ratio
from orderlens.operators.accounts import FLAG, MAX_INDIVIDUAL_LINES, with_account_flag
from orderlens.operators.ranking import distributed_ntile
from orderlens.operators.totals import group_totals
from orderlens.schemas import MARTS
from orderlens.session import keep

# Days of silence that end the Active and At Risk tiers, and how
# many usual gaps a customer may miss before counting as overdue.
ACTIVE_DAYS = 30
AT_RISK_DAYS = 90
OVERDUE_GAPS = 2


def _known(slices: DataFrame) -> DataFrame:
    return slices.filter(F.col("user_id").isNotNull())


def clv_daily(slices: DataFrame, dim: DataFrame, threshold: int = MAX_INDIVIDUAL_LINES) -> DataFrame:
    """Revenue and running lifetime value per customer and order day.

    The window sees one row per customer and day: a customer's partition is
    bounded by the calendar, not by the number of lines.
    """
    days = (
        _known(slices)
        .groupBy("user_id", "order_date")
        .agg(F.sum("total_revenue").alias("daily_revenue"), F.sum("line_count").alias("line_count"))
    )
    customer = Window.partitionBy("user_id")
    so_far = customer.orderBy("order_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = days.select(
        "user_id",
        "order_date",
        money(F.col("daily_revenue")).alias("daily_revenue"),
        money(F.sum("daily_revenue").over(so_far)).alias("cumulative_clv"),
        (F.sum("line_count").over(customer) > threshold).alias(FLAG),
    )
    return with_calendar(running, "order_date", dim).select(*MARTS["clv_daily"])


def reference_date(slices: DataFrame) -> DataFrame:
    """One row: the last order day in the data, guests included."""
    return slices.agg(F.max("order_date").alias("reference_date"))


def customer_base(slices: DataFrame, threshold: int = MAX_INDIVIDUAL_LINES) -> DataFrame:
    """One stored row per customer: what both RFM and churn need."""
    known = _known(slices)
    days = (
        known.groupBy("user_id", "order_date")
        .agg(F.sum("total_revenue").alias("revenue"), F.sum("line_count").alias("line_count"))
        .groupBy("user_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count("order_date").alias("order_days"),
            money(F.sum("revenue")).alias("monetary"),
            (F.sum("line_count") > threshold).alias(FLAG),
        )
    )
    orders = known.select("user_id", "order_id").distinct().groupBy("user_id").agg(F.count("order_id").alias("frequency"))
    base = days.join(orders, "user_id").select(
        "user_id",
        F.date_diff(reference_date(slices).scalar(), F.col("last_order_date")).alias("recency_days"),
        "frequency",
        "monetary",
        "first_order_date",
        "last_order_date",
        "order_days",
        FLAG,
    )
    return keep(base, "customers")


def rfm_scores(customers: DataFrame, **options) -> DataFrame:
    """Quintile scores, 5 is best; equal customers are ordered by user_id."""
    ranked = distributed_ntile(
        customers,
        {"_silence": "recency_days", "frequency_score": "frequency", "monetary_score": "monetary"},
        "user_id",
        **options,
    )
    return ranked.withColumn("recency_score", 6 - F.col("_silence")).drop("_silence")


def rfm_segments(customers: DataFrame, **options) -> DataFrame:
    """Scores and segment label; the first rule that fits names the segment."""
    r, f, m = (F.col(f"{name}_score") for name in ("recency", "frequency", "monetary"))
    # Segment labels and the score bounds that go with them.
    segment = (
        F.when(F.least(r, f, m) >= 4, "VIP")
        .when((r >= 4) & (F.col("frequency") == 1), "New")
        .when((r <= 2) & (F.greatest(f, m) >= 3), "Churn Risk")
        .otherwise("Regular")
    )
    return rfm_scores(customers, **options).withColumn("segment", segment).select(*MARTS["customer_segments_rfm"])


def churn_risk(
    customers: DataFrame,
    active: int = ACTIVE_DAYS,
    at_risk: int = AT_RISK_DAYS,
    gaps: float = OVERDUE_GAPS,
) -> DataFrame:
    """Tier by days of silence, and overdue by the customer's own rhythm.

    The usual gap assumes even spacing over the customer's order days; it is
    null, and overdue is false, after a single order day.
    """
    silence, usual_gap = F.col("recency_days"), F.col("avg_days_between_orders")
    span = F.date_diff("last_order_date", "first_order_date")
    return (
        customers.withColumn(
            "avg_days_between_orders", F.when(F.col("order_days") > 1, span / (F.col("order_days") - 1))
        )
        .withColumns(
            {
                "risk_tier": F.when(silence <= active, "Active").when(silence <= at_risk, "At Risk").otherwise("Churned"),
                "is_overdue": F.coalesce(silence > gaps * usual_gap, F.lit(False)),
            }
        )
        .select(*MARTS["churn_risk"])
    )


def sales_trends(slices: DataFrame, dim: DataFrame) -> DataFrame:
    """Revenue and orders per day, guests included."""
    days = group_totals(slices, ["order_date"], customers=False).withColumn(
        "avg_order_value", ratio("total_revenue", "order_count")
    )
    return with_calendar(days, "order_date", dim).select(*MARTS["sales_trends"])


def loyalty_impact(slices: DataFrame, flagged: DataFrame, **options) -> DataFrame:
    """Totals per order-level loyalty flag and account flag."""
    rows = with_account_flag(slices, flagged, **options)
    return (
        group_totals(rows, ["is_loyalty", FLAG])
        .withColumn("avg_order_value", ratio("total_revenue", "order_count"))
        .select(*MARTS["loyalty_impact"])
    )


def location_performance(slices: DataFrame, flagged: DataFrame, **options) -> DataFrame:
    """Totals per restaurant with the part that flagged accounts hold."""
    rows = with_account_flag(slices, flagged, **options)
    totals = group_totals(
        rows,
        ["restaurant_id"],
        per_order={
            "flagged_revenue": F.sum(F.when(F.col(FLAG), F.col("total_revenue")).otherwise(F.lit(0))),
            "flagged": F.bool_or(FLAG),
        },
        per_group={
            "flagged_account_revenue": money(F.sum("flagged_revenue")),
            "flagged_account_order_count": F.count(F.when(F.col("flagged"), F.col("order_id"))),
        },
    )
    return totals.withColumns(
        {
            "avg_order_value": ratio("total_revenue", "order_count"),
            "flagged_revenue_share": ratio("flagged_account_revenue", "total_revenue"),
        }
    ).select(*MARTS["location_performance"])


def price_tiers(slices: DataFrame) -> DataFrame:
    """Totals per price tier; the data has no discount, so price points stand in."""
    return group_totals(
        slices,
        ["price_tier"],
        per_order={"line_item_count": F.sum("line_count")},
        per_group={"line_item_count": F.sum("line_item_count")},
    ).select(*MARTS["discount_effectiveness"])


def order_totals(slices: DataFrame) -> DataFrame:
    return slices.groupBy("order_id").agg(
        F.sum("total_revenue").alias("order_total"), (F.sum("free_line_count") > 0).alias("has_free_item")
    )


def free_item_orders(lines: DataFrame) -> DataFrame:
    """Orders with at least one item priced exactly 0."""
    return lines.filter(F.col("item_price") == 0).select("order_id").distinct()


def orders_without_free_item(lines: DataFrame, free_orders: DataFrame) -> DataFrame:
    """Totals of all other orders; takes lines or slices."""
    totals = lines.groupBy("order_id").agg(money(F.sum(F.col("total_revenue").cast(TOTAL))).alias("order_total"))
    return totals.join(free_orders, "order_id", "left_anti")


def free_item_effect(slices: DataFrame) -> DataFrame:
    """One row: mean order total with and without a free item, in one pass."""
    free, total = F.col("has_free_item"), F.col("order_total")

    def mean(condition):
        chosen = F.when(condition, total)
        return F.try_divide(money(F.sum(chosen)), F.count(chosen))

    return order_totals(slices).agg(
        F.count_if(free).alias("free_item_orders"),
        mean(free).alias("avg_with_free_item"),
        mean(~free).alias("avg_without_free_item"),
    )
