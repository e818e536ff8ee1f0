"""Column contracts of the source tables and of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Column names of the source tables and of the marts.
ORDER_ITEMS = (
    "order_id", "lineitem_id", "user_id", "restaurant_id", "item_name",
    "item_price", "item_quantity", "is_loyalty", "creation_time_utc",
)
ORDER_ITEM_OPTIONS = ("order_id", "lineitem_id", "option_price", "option_quantity")
DATE_DIM = ("date_key", "is_holiday", "holiday_name")
LINE_KEY = ("order_id", "lineitem_id")

CALENDAR_COLUMNS = ("year", "month", "week", "day_of_week", "is_weekend", "is_holiday")
MARTS = {
    "clv_daily": (
        "user_id", "order_date", "daily_revenue", "cumulative_clv",
        *CALENDAR_COLUMNS, "is_likely_non_individual",
    ),
    "customer_segments_rfm": (
        "user_id", "recency_days", "frequency", "monetary", "recency_score",
        "frequency_score", "monetary_score", "segment", "is_likely_non_individual",
    ),
    "churn_risk": (
        "user_id", "recency_days", "frequency", "monetary", "avg_days_between_orders",
        "risk_tier", "is_overdue", "is_likely_non_individual",
    ),
    "sales_trends": (
        "order_date", "total_revenue", "order_count", "avg_order_value", *CALENDAR_COLUMNS,
    ),
    "loyalty_impact": (
        "is_loyalty", "is_likely_non_individual", "total_revenue", "order_count",
        "distinct_customers", "avg_order_value",
    ),
    "location_performance": (
        "restaurant_id", "total_revenue", "order_count", "distinct_customers",
        "flagged_account_revenue", "flagged_account_order_count", "avg_order_value",
        "flagged_revenue_share",
    ),
    "discount_effectiveness": (
        "price_tier", "total_revenue", "line_item_count", "order_count", "distinct_customers",
    ),
}


def require_columns(df: DataFrame, columns, table: str) -> DataFrame:
    """Fail before any job starts when ``table`` lacks a column the plan needs."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks columns {missing}; it has {df.columns}")
    return df
