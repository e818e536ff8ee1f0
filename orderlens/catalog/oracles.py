"""The same answers as SQL over the driver tables, for DuckDB."""

from __future__ import annotations

from orderlens.catalog.fixtures import THRESHOLD
from orderlens.catalog.queries import EVENT_MARK, ORDER_MARK

LINE_ID = "concat_ws('-', l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT))"
TEXT_TIME = (
    "coalesce(try_strptime(creation_text, '%Y-%m-%dT%H:%M:%S.%gZ'), "
    "try_strptime(creation_text, '%Y-%m-%dT%H:%M:%SZ'))"
)

# One chain of common table expressions; each query uses the tail it needs.
CHAIN = f"""
WITH raw_items AS (
  SELECT l_orderkey AS order_id, {LINE_ID} AS lineitem_id,
    strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE '.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END
      || 'Z' AS creation_text,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS user_id,
    o_orderkey % 40 AS restaurant_id, o_orderstatus = 'P' AS is_loyalty,
    CASE WHEN p_size <> 1 THEN p_name END AS item_name,
    CASE WHEN l_quantity = 50 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice / (l_quantity * 100) END AS item_price,
    l_quantity AS item_quantity, o_orderpriority AS app_name, CAST(o_custkey % 7 AS VARCHAR) AS printed_card_number
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
options AS (
  SELECT l_orderkey AS order_id, {LINE_ID} AS lineitem_id, abs(l_discount) * 10 AS option_price,
    CAST(1 + l_linenumber % 2 AS INTEGER) AS option_quantity FROM lineitem WHERE l_discount <> 0
  UNION ALL
  SELECT l_orderkey, {LINE_ID}, abs(l_tax) * 10, 1 FROM lineitem WHERE l_tax > 0),
days AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE year(o_orderdate) = 1997),
dim AS (
  SELECT day AS date_key, strftime(day, '%d-%m-%Y') AS date_text,
    strftime(day, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday,
    CASE strftime(day, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '07-04' THEN 'Independence Day'
      WHEN '12-25' THEN 'Christmas' END AS holiday_name FROM days),
items AS (
  SELECT *, {TEXT_TIME} AS creation_time, CAST({TEXT_TIME} AS DATE) AS order_date FROM raw_items),
medians AS (
  SELECT item_name, quantile_disc(item_price, 0.5) AS median_item_price, count(*) AS row_count
  FROM items WHERE item_name IS NOT NULL GROUP BY item_name),
ratios AS (
  SELECT items.*, median_item_price,
    CASE WHEN median_item_price > 0 THEN item_price / median_item_price END AS price_ratio
  FROM items LEFT JOIN medians USING (item_name)),
clean AS (SELECT * FROM ratios WHERE price_ratio IS NULL OR price_ratio <= 20),
extras AS (
  SELECT order_id, lineitem_id, sum(option_price * option_quantity) AS options_sum
  FROM options GROUP BY order_id, lineitem_id),
lines AS (
  SELECT clean.*, item_price * item_quantity AS item_revenue, coalesce(options_sum, 0) AS options_revenue,
    item_price * item_quantity + coalesce(options_sum, 0) AS total_revenue,
    CAST(item_price * item_quantity + coalesce(options_sum, 0) AS DECIMAL(24, 6)) AS amount
  FROM clean LEFT JOIN extras USING (order_id, lineitem_id)),
volume AS (
  SELECT user_id, count(*) AS total_line_items, count(*) > {THRESHOLD} AS flag
  FROM lines WHERE user_id IS NOT NULL GROUP BY user_id),
flagged_lines AS (
  SELECT lines.*, coalesce(flag, false) AS flag FROM lines LEFT JOIN volume USING (user_id)),
daily AS (
  SELECT user_id, order_date, sum(amount) AS amount
  FROM lines WHERE user_id IS NOT NULL GROUP BY user_id, order_date),
clv AS (
  SELECT user_id, order_date, CAST(amount AS DOUBLE) AS daily_revenue,
    CAST(sum(amount) OVER (PARTITION BY user_id ORDER BY order_date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_clv FROM daily),
customers AS (
  SELECT user_id, CAST(date_diff('day', max(order_date), (SELECT max(order_date) FROM lines)) AS INTEGER) AS recency_days,
    count(DISTINCT order_id) AS frequency, CAST(sum(amount) AS DOUBLE) AS monetary,
    min(order_date) AS first_day, max(order_date) AS last_day, count(DISTINCT order_date) AS order_days,
    any_value(flag) AS flag
  FROM flagged_lines WHERE user_id IS NOT NULL GROUP BY user_id),
scored AS (
  SELECT *, CAST(6 - ntile(5) OVER (ORDER BY recency_days, user_id) AS INTEGER) AS recency_score,
    CAST(ntile(5) OVER (ORDER BY frequency, user_id) AS INTEGER) AS frequency_score,
    CAST(ntile(5) OVER (ORDER BY monetary, user_id) AS INTEGER) AS monetary_score FROM customers),
rfm AS (
  SELECT *, CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'VIP'
    WHEN frequency = 1 AND recency_score >= 4 THEN 'New'
    WHEN recency_score <= 2 AND (frequency_score >= 3 OR monetary_score >= 3) THEN 'Churn Risk'
    ELSE 'Regular' END AS segment FROM scored),
gaps AS (
  SELECT *, CASE WHEN order_days > 1 THEN date_diff('day', first_day, last_day) / (order_days - 1) END
    AS avg_days_between_orders FROM customers),
churn AS (
  SELECT *, CASE WHEN recency_days <= 30 THEN 'Active' WHEN recency_days <= 90 THEN 'At Risk' ELSE 'Churned' END
    AS risk_tier, coalesce(recency_days > 2 * avg_days_between_orders, false) AS is_overdue FROM gaps),
daily_sales AS (
  SELECT order_date, CAST(sum(amount) AS DOUBLE) AS total_revenue, count(DISTINCT order_id) AS order_count
  FROM lines GROUP BY order_date),
sales AS (
  SELECT daily_sales.*, CASE WHEN order_count <> 0 THEN total_revenue / order_count END AS avg_order_value, is_holiday
  FROM daily_sales LEFT JOIN dim ON order_date = date_key),
loyalty AS (
  SELECT *, CASE WHEN order_count <> 0 THEN total_revenue / order_count END AS avg_order_value FROM (
    SELECT is_loyalty, flag AS is_likely_non_individual, CAST(sum(amount) AS DOUBLE) AS total_revenue,
      count(DISTINCT order_id) AS order_count, count(DISTINCT user_id) AS distinct_customers
    FROM flagged_lines GROUP BY is_loyalty, flag)),
locations AS (
  SELECT *, CASE WHEN order_count <> 0 THEN total_revenue / order_count END AS avg_order_value,
    CASE WHEN total_revenue <> 0 THEN flagged_account_revenue / total_revenue END AS flagged_revenue_share FROM (
    SELECT restaurant_id, CAST(sum(amount) AS DOUBLE) AS total_revenue, count(DISTINCT order_id) AS order_count,
      count(DISTINCT user_id) AS distinct_customers,
      CAST(sum(CASE WHEN flag THEN amount ELSE 0 END) AS DOUBLE) AS flagged_account_revenue,
      count(DISTINCT CASE WHEN flag THEN order_id END) AS flagged_account_order_count
    FROM flagged_lines GROUP BY restaurant_id)),
tiered AS (
  SELECT *, CASE WHEN item_price < 0.01 THEN 'Free' WHEN item_price < 5 THEN '$0.01-$5' WHEN item_price < 10
    THEN '$5-$10' WHEN item_price < 20 THEN '$10-$20' ELSE '$20+' END AS price_tier FROM lines),
tiers AS (
  SELECT price_tier, CAST(sum(amount) AS DOUBLE) AS total_revenue, count(*) AS line_item_count,
    count(DISTINCT order_id) AS order_count, count(DISTINCT user_id) AS distinct_customers
  FROM tiered GROUP BY price_tier),
order_totals AS (
  SELECT order_id, sum(amount) AS order_total, bool_or(item_price = 0) AS has_free
  FROM lines GROUP BY order_id),
item_volume AS (
  SELECT user_id, count(*) AS line_items, count(*) FILTER (WHERE is_loyalty) AS yes,
    count(*) FILTER (WHERE NOT is_loyalty) AS no
  FROM items WHERE user_id IS NOT NULL GROUP BY user_id),
mixed AS (SELECT *, yes / (yes + no) AS pct_loyalty FROM item_volume WHERE yes > 0 AND no > 0)
"""

CALENDAR = """CAST(year({d}) AS INTEGER) AS "year", CAST(month({d}) AS INTEGER) AS "month",
  CAST(week({d}) AS INTEGER) AS "week", dayname({d}) AS day_of_week, isodow({d}) >= 6 AS is_weekend"""

WRONG_AVERAGE = "count(*) FILTER (WHERE abs(avg_order_value - total_revenue / order_count) > 0.01)"
TOTAL_REVENUE = "CAST(sum(CAST(total_revenue AS DECIMAL(34, 6))) AS DOUBLE)"
RECONCILED = [
    ("total_revenue", TOTAL_REVENUE, "abs({v} - (SELECT CAST(sum(CAST(total_revenue AS DECIMAL(34, 6))) AS DOUBLE) FROM sales)) < 1.0"),
    ("total_orders", "sum(order_count)", "{v} = (SELECT sum(order_count) FROM sales)"),
    ("wrong_average", WRONG_AVERAGE, "{v} = 0"),
]
ZERO = "{v} = 0"
NO_NEGATIVES = [
    ("min_revenue", "min(total_revenue)", None),
    ("negative_revenue", "count(*) FILTER (WHERE total_revenue < 0)", ZERO),
    ("min_orders", "min(order_count)", None),
    ("no_orders", "count(*) FILTER (WHERE order_count <= 0)", ZERO),
]


def q(tail: str) -> str:
    return CHAIN + tail


def report(check: str, source: str, metrics: list[tuple[str, str, str | None]]) -> str:
    """The rows of a quality report, without the table chain."""
    return " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{metric}' AS metric, CAST(v AS DOUBLE) AS value, "
        f"{'CAST(NULL AS BOOLEAN)' if rule is None else rule.format(v='v')} AS passed "
        f"FROM (SELECT {expr} AS v FROM {source})"
        for metric, expr, rule in metrics
    )


def day_number(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def rollout(mart: str, source: str) -> str:
    per_user = f"(SELECT user_id, bool_or(flag) AS f, bool_and(flag) AS g, count(*) AS n FROM {source} GROUP BY user_id)"
    return report(
        mart,
        per_user,
        [
            ("rows", "sum(n)", None),
            ("flag_present", "1", "{v} = 1"),
            ("customers", "count(*)", None),
            ("customers_with_two_flags", "count(*) FILTER (WHERE f <> g)", ZERO),
            ("flagged_customers", "count(*) FILTER (WHERE f)", "{v} = (SELECT count(*) FROM volume WHERE flag)"),
            ("known_accounts_not_flagged",
             "count(*) FILTER (WHERE NOT f AND user_id IN (SELECT user_id FROM volume WHERE flag))", ZERO),
        ],
    ).replace("'flag_present' AS metric, CAST(v AS DOUBLE)", "'flag_present' AS metric, CAST(max(v) AS DOUBLE)").replace(
        "v = 1 AS passed", "max(v) = 1 AS passed"
    )


def signs(column: str, source: str) -> str:
    return report(
        column,
        source,
        [
            ("min", f"round(min({column}), 6)", None),
            ("max", f"round(max({column}), 6)", None),
            ("negative", f"count(*) FILTER (WHERE {column} < 0)", ZERO),
            ("zero", f"count(*) FILTER (WHERE {column} = 0)", None),
            ("null", f"count(*) FILTER (WHERE {column} IS NULL)", None),
        ],
    )


SALES = f"""SELECT order_date, total_revenue, order_count, avg_order_value, {CALENDAR.format(d='order_date')},
  is_holiday FROM sales"""
SCORES = "SELECT user_id, recency_score, frequency_score, monetary_score FROM rfm"
LINE_REVENUE = (
    "SELECT order_id, lineitem_id, round(item_revenue, 6) AS item_revenue, "
    "round(options_revenue, 6) AS options_revenue, round(total_revenue, 6) AS total_revenue FROM lines"
)
CLV = (
    f"SELECT user_id, order_date, daily_revenue, cumulative_clv, {CALENDAR.format(d='order_date')}, is_holiday, "
    "flag AS is_likely_non_individual FROM clv LEFT JOIN dim ON order_date = date_key JOIN volume USING (user_id)"
)
EVENTS = "SELECT event_id, user_id, event_type, value FROM events"
PERCENTS = (50, 75, 90, 95, 97, 98, 99, 99.5, 99.9, 99.99, 100)
PERCENTILES = " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS percentile, round(quantile_cont(line_items, {p / 100!r}), 6) AS line_items "
    "FROM item_volume"
    for p in PERCENTS
)
IMPACT = " UNION ALL ".join(
    f"""SELECT CAST({t} AS BIGINT) AS threshold, count(*) FILTER (WHERE line_items > {t}) AS customers_above,
    round(count(*) FILTER (WHERE line_items > {t}) * 100.0::DOUBLE / count(*), 6) AS pct_customers,
    CAST(coalesce(sum(line_items) FILTER (WHERE line_items > {t}), 0) AS BIGINT) AS line_items_above,
    round(coalesce(sum(line_items) FILTER (WHERE line_items > {t}), 0) * 100.0::DOUBLE / sum(line_items), 6)
      AS pct_line_items FROM item_volume"""
    for t in (20, 40, 60, 80)
)
MART_ROWS = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, 'success' AS status, count(*) AS row_count FROM {source}"
    for mart, source in (
        ("clv_daily", "clv"), ("customer_segments_rfm", "rfm"), ("churn_risk", "churn"), ("sales_trends", "sales"),
        ("loyalty_impact", "loyalty"), ("location_performance", "locations"), ("discount_effectiveness", "tiers"),
    )
)


def _mark(text: str) -> str:
    return f"TIMESTAMP '{text[:-1].replace('T', ' ')}'"


ORACLES: dict[str, str] = {
    "scan_source": EVENTS,
    "incremental_orders": f"{EVENTS} WHERE ts > {_mark(EVENT_MARK)}",
    "incremental_order_items": q(
        f'SELECT order_id AS "ORDER_ID", lineitem_id AS "LINEITEM_ID", creation_text AS "CREATION_TIME_UTC" '
        f"FROM items WHERE creation_time > {_mark(ORDER_MARK)}"
    ),
    "incremental_children": q(
        f'SELECT order_id AS "ORDER_ID", lineitem_id AS "LINEITEM_ID", round(option_price, 6) AS "OPTION_PRICE", '
        f'option_quantity AS "OPTION_QUANTITY" FROM options WHERE (order_id, lineitem_id) IN '
        f"(SELECT (order_id, lineitem_id) FROM items WHERE creation_time > {_mark(ORDER_MARK)})"
    ),
    "checkpoint_advance": (
        "SELECT 'events' AS name, '1900-01-01T00:00:00.000000Z' AS mark_before, "
        "strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS mark_after FROM events"
    ),
    "dim_snapshot_latest": q(
        'SELECT date_text AS "DATE_KEY", is_holiday AS "IS_HOLIDAY", holiday_name AS "HOLIDAY_NAME" FROM dim'
    ),
    "raw_partition_roundtrip": (
        "SELECT event_id, user_id, event_type, value, "
        "CASE WHEN event_type = 'error' THEN '2024-01-02' ELSE '2024-01-01' END AS dt FROM events"
    ),
    "raw_partition_shuffled": (
        "SELECT event_id, user_id, event_type, value, "
        "CASE WHEN event_type = 'error' THEN '2024-01-02' ELSE '2024-01-01' END AS dt FROM events"
    ),
    "extract_overlap_backfill": q("SELECT order_id, lineitem_id, item_name FROM items"),
    "quarantine_split": q(
        "SELECT order_id, lineitem_id, CASE WHEN bad IS NULL THEN 'processed' ELSE 'quarantine' END AS place, bad AS reason "
        "FROM (SELECT order_id, lineitem_id, CASE WHEN order_id % 46 = 0 OR order_id % 58 = 0 THEN NULL "
        "WHEN order_id % 23 = 0 THEN 'unparseable' WHEN order_id % 29 = 0 THEN 'missing' "
        "WHEN order_id % 31 = 0 THEN 'unparseable' END AS bad FROM items)"
    ),
    "late_options_in_marts": q(SALES),
    "refresh_by_month": q(
        "SELECT order_id, lineitem_id, item_name, order_date, CAST(date_trunc('month', order_date) AS DATE) AS order_period, coalesce(n, 0) AS n_options FROM items LEFT JOIN "
        "(SELECT order_id, lineitem_id, count(*) AS n FROM options GROUP BY order_id, lineitem_id) USING (order_id, lineitem_id)"
    ),
    "mart_write_roundtrip": q(SALES),
    "row_counts": q(
        "SELECT 'order_items' AS table_name, count(*) AS row_count FROM items UNION ALL "
        "SELECT 'order_item_options', count(*) FROM options UNION ALL SELECT 'date_dim', count(*) FROM dim"
    ),
    "ingest_available_now": EVENTS,
    "ingest_distinct_keys": EVENTS,
    "staged_sales_trends": q(SALES),
    "normalize_columns": q("SELECT order_id, lineitem_id, user_id, restaurant_id, is_loyalty, item_name FROM items"),
    "parse_mixed_timestamps": q(
        "SELECT order_id, lineitem_id, creation_text AS raw_text, "
        "strftime(creation_time, '%Y-%m-%d %H:%M:%S.%g') AS creation_time, order_date FROM items"
    ),
    "parse_dates": q("SELECT date_key, is_holiday, holiday_name FROM dim"),
    "parse_failures": q(
        "SELECT count(*) FILTER (WHERE creation_text IS NOT NULL AND "
        "try_strptime(creation_text, '%Y-%m-%dT%H:%M:%S.%gZ') IS NULL) AS unparseable, "
        "count(*) FILTER (WHERE creation_text IS NULL) AS missing, count(*) AS rows FROM items"
    ),
    "price_tier_labels": q(
        "SELECT order_id, lineitem_id, CASE WHEN item_price < 0.01 THEN 'Free' WHEN item_price < 5 THEN '$0.01-$5' "
        "WHEN item_price < 10 THEN '$5-$10' WHEN item_price < 20 THEN '$10-$20' ELSE '$20+' END AS price_tier FROM items"
    ),
    "calendar_attrs": q(
        f"SELECT d AS order_date, {CALENDAR.format(d='d')}, is_holiday, holiday_name "
        "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) LEFT JOIN dim ON d = date_key"
    ),
    "item_median_price": q("SELECT item_name, median_item_price, row_count FROM medians"),
    "price_anomalies": q(
        "SELECT order_id, lineitem_id, item_name, item_price, median_item_price, price_ratio "
        "FROM ratios WHERE price_ratio > 20"
    ),
    "price_anomalies_shuffled": q(
        "SELECT order_id, lineitem_id, item_name, item_price, median_item_price, price_ratio "
        "FROM ratios WHERE price_ratio > 20"
    ),
    "price_anomaly_kept": q("SELECT order_id, lineitem_id, item_name, item_price FROM clean"),
    "line_revenue": q(LINE_REVENUE),
    "line_revenue_bucketed": q(LINE_REVENUE),
    "line_items_per_customer": q("SELECT user_id, total_line_items FROM volume"),
    "non_individual_flag": q("SELECT user_id, total_line_items, flag AS is_likely_non_individual FROM volume"),
    "clv_daily": q(CLV),
    "clv_daily_incremental": q(CLV),
    "item_median_sketched": q("SELECT item_name, row_count, true AS within_error FROM medians"),
    "location_totals_sketched": q(
        "SELECT restaurant_id, total_revenue, order_count, distinct_customers FROM locations"
    ),
    "calendar_as_of": q(
        "SELECT order_date, as_of, dayname(order_date) AS day_of_week, "
        "CASE WHEN NOT known THEN NULL WHEN may THEN true ELSE is_holiday END AS is_holiday, "
        "CASE WHEN NOT known THEN NULL WHEN may THEN 'May Day' ELSE holiday_name END AS holiday_name FROM ("
        "SELECT order_date, as_of, is_holiday, holiday_name, as_of > DATE '2024-01-05' AND strftime(date_key, '%m-%d') = '05-01' AS may, "
        "as_of > DATE '2024-01-01' AND NOT (as_of > DATE '2024-01-08' AND strftime(date_key, '%m-%d') = '07-04') AS known "
        "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date FROM orders) CROSS JOIN "
        "(VALUES (DATE '2024-01-01'), (DATE '2024-01-05'), (DATE '2024-01-07'), (DATE '2024-01-09')) AS v(as_of) "
        "LEFT JOIN dim ON order_date = date_key)"
    ),
    "reference_date": q("SELECT max(order_date) AS reference_date FROM lines"),
    "rfm_scores": q(SCORES),
    "rfm_scores_distributed": q(SCORES),
    "customer_segments_rfm": q(
        "SELECT user_id, recency_days, frequency, monetary, recency_score, frequency_score, monetary_score, segment, "
        "flag AS is_likely_non_individual FROM rfm"
    ),
    "churn_risk": q(
        "SELECT user_id, recency_days, frequency, monetary, avg_days_between_orders, risk_tier, is_overdue, "
        "flag AS is_likely_non_individual FROM churn"
    ),
    "sales_trends": q(SALES),
    "loyalty_impact": q("SELECT * FROM loyalty"),
    "location_performance": q("SELECT * FROM locations"),
    "price_tier_mart": q("SELECT * FROM tiers"),
    "free_item_orders": q("SELECT order_id FROM order_totals WHERE has_free"),
    "orders_without_free_item": q(
        "SELECT order_id, CAST(order_total AS DOUBLE) AS order_total FROM order_totals WHERE NOT has_free"
    ),
    "free_item_order_value": q(
        "SELECT count(*) FILTER (WHERE has_free) AS free_item_orders, "
        "CAST(sum(order_total) FILTER (WHERE has_free) AS DOUBLE) / count(order_total) FILTER (WHERE has_free) "
        "AS avg_with_free_item, "
        "CAST(sum(order_total) FILTER (WHERE NOT has_free) AS DOUBLE) / count(order_total) FILTER (WHERE NOT has_free) "
        "AS avg_without_free_item FROM order_totals"
    ),
    "mart_run_status": q(MART_ROWS),
    "mart_run_resumed": q(MART_ROWS.replace("'success'", "CASE WHEN mart = 'sales_trends' THEN 'success' ELSE 'kept' END")),
    "dq_sales_trends": q(
        report(
            "sales_trends",
            "sales",
            [
                ("dates", "count(*)", None),
                ("first_date", day_number("min(order_date)"), None),
                ("last_date", day_number("max(order_date)"), None),
                ("dates_without_year", "count(*) FILTER (WHERE year(order_date) IS NULL)", ZERO),
                ("dates_without_holiday_info", "count(*) FILTER (WHERE is_holiday IS NULL)", None),
                *NO_NEGATIVES,
                ("wrong_average", WRONG_AVERAGE, ZERO),
                ("total_revenue", TOTAL_REVENUE, None),
                ("total_orders", "sum(order_count)", None),
            ],
        )
    ),
    "dq_uncovered_dates": q("SELECT order_date FROM sales WHERE is_holiday IS NULL ORDER BY order_date LIMIT 10"),
    "dq_account_profile": q(
        "SELECT user_id, count(DISTINCT restaurant_id) AS locations, count(DISTINCT app_name) AS apps, "
        "count(DISTINCT printed_card_number) AS cards, min(order_date) AS first_order_date, "
        "max(order_date) AS last_order_date, count(DISTINCT order_date) AS order_days "
        "FROM items WHERE user_id IN (SELECT user_id FROM volume WHERE flag) GROUP BY user_id"
    ),
    "dq_rfm": q(
        report(
            "customer_segments_rfm",
            "rfm",
            [
                ("rows", "count(*)", None),
                ("repeated_customers", "count(*) - count(DISTINCT user_id)", ZERO),
                ("min_recency_days", "min(recency_days)", "{v} >= 0"),
                ("max_recency_days", "max(recency_days)", None),
                ("new_with_several_orders", "count(*) FILTER (WHERE segment = 'New' AND frequency <> 1)", ZERO),
                *[
                    metric
                    for s in ("recency_score", "frequency_score", "monetary_score")
                    for metric in (
                        (f"{s}_min", f"min({s})", "{v} = 1"),
                        (f"{s}_max", f"max({s})", "{v} = 5"),
                        (f"{s}_nulls", f"count(*) FILTER (WHERE {s} IS NULL)", ZERO),
                    )
                ],
            ],
        )
    ),
    "dq_segment_counts": q("SELECT segment, count(*) AS customers FROM rfm GROUP BY segment"),
    "dq_clv_monotonic": q(
        report(
            "clv_daily",
            "(SELECT user_id, coalesce(bool_or(fell), false) AS fell FROM (SELECT user_id, cumulative_clv < lag(cumulative_clv) "
            "OVER (PARTITION BY user_id ORDER BY order_date) AS fell FROM clv) GROUP BY user_id)",
            [("customers", "count(*)", None), ("decreasing_customers", "count(*) FILTER (WHERE fell)", ZERO)],
        )
    ),
    "dq_flag_consistency": q(
        report(
            "loyalty_flag",
            "item_volume",
            [
                ("rows_with_customer", "sum(line_items)", None),
                ("customers", "count(*)", None),
                ("consistent_customers", "count(*) FILTER (WHERE (yes > 0) <> (no > 0))", None),
                ("inconsistent_customers", "count(*) FILTER (WHERE yes > 0 AND no > 0)", None),
                ("inconsistent_pct",
                 "round(count(*) FILTER (WHERE yes > 0 AND no > 0) * 100.0::DOUBLE / count(*), 6)", None),
            ],
        )
        + " UNION ALL "
        + report("loyalty_flag", "items", [("rows", "count(*)", None)])
    ),
    "dq_flag_counts": q(
        "SELECT user_id, yes AS loyalty_true_count, no AS loyalty_false_count, pct_loyalty FROM mixed"
    ),
    "dq_flag_share_stats": q(
        report(
            "loyalty_share",
            "mixed",
            [
                ("count", "count(*)", None),
                ("mean", "round(avg(pct_loyalty), 6)", None),
                ("std", "round(stddev_samp(pct_loyalty), 6)", None),
                ("min", "round(min(pct_loyalty), 6)", None),
                ("max", "round(max(pct_loyalty), 6)", None),
                ("25%", "round(quantile_cont(pct_loyalty, 0.25), 6)", None),
                ("50%", "round(quantile_cont(pct_loyalty, 0.5), 6)", None),
                ("75%", "round(quantile_cont(pct_loyalty, 0.75), 6)", None),
            ],
        )
    ),
    "dq_flag_rollout": q(
        " UNION ALL ".join(
            [
                rollout("clv_daily", "(SELECT clv.user_id, flag FROM clv JOIN volume USING (user_id))"),
                rollout("customer_segments_rfm", "rfm"),
                rollout("churn_risk", "churn"),
            ]
        )
    ),
    "dq_top_customers": q("SELECT user_id, line_items FROM item_volume ORDER BY line_items DESC, user_id LIMIT 15"),
    "dq_concentration": q(
        report(
            "volume",
            "item_volume",
            [
                ("customers", "count(*)", None),
                ("mean_line_items", "round(avg(line_items), 6)", None),
                ("median_line_items", "quantile_cont(line_items, 0.5)", None),
                ("top_10_share_pct",
                 "round((SELECT sum(line_items) FROM (SELECT line_items FROM item_volume ORDER BY line_items DESC, "
                 "user_id LIMIT 10)) * 100.0::DOUBLE / sum(line_items), 6)", None),
            ],
        )
    ),
    "dq_percentiles": q(PERCENTILES),
    "dq_percentiles_distributed": q(PERCENTILES),
    "dq_threshold_impact": q(IMPACT),
    "dq_reconcile_loyalty": q(
        report(
            "loyalty_impact",
            "loyalty",
            [
                ("rows", "count(*)", "{v} <= 4"),
                *RECONCILED,
                ("most_flagged_customers", "max(CASE WHEN is_likely_non_individual THEN distinct_customers ELSE 0 END)",
                 "{v} <= (SELECT count(*) FROM volume WHERE flag)"),
            ],
        )
    ),
    "dq_reconcile_location": q(
        report("location_performance", "locations", [("rows", "count(*)", None), *RECONCILED, *NO_NEGATIVES])
    ),
    "dq_top_flagged_locations": q(
        "SELECT restaurant_id, total_revenue, flagged_account_revenue, flagged_revenue_share, "
        "flagged_account_order_count FROM locations ORDER BY flagged_revenue_share DESC NULLS LAST, restaurant_id LIMIT 10"
    ),
    "dq_churn": q(
        report(
            "churn_risk",
            "churn",
            [
                ("rows", "count(*)", "{v} = (SELECT count(*) FROM rfm)"),
                ("repeated_customers", "count(*) - count(DISTINCT user_id)", ZERO),
                *[(f"tier_{t}", f"count(*) FILTER (WHERE risk_tier = '{t}')", None)
                  for t in ("Active", "At Risk", "Churned")],
                ("overdue", "count(*) FILTER (WHERE is_overdue)", None),
                ("not_overdue", "count(*) FILTER (WHERE NOT is_overdue)", None),
                ("one_order_with_gap",
                 "count(*) FILTER (WHERE frequency = 1 AND avg_days_between_orders IS NOT NULL)", ZERO),
                ("several_orders_without_gap",
                 "count(*) FILTER (WHERE frequency > 1 AND avg_days_between_orders IS NULL)", None),
                ("overdue_without_gap",
                 "count(*) FILTER (WHERE avg_days_between_orders IS NULL AND is_overdue)", ZERO),
                ("wrong_overdue",
                 "count(*) FILTER (WHERE is_overdue <> (recency_days > 2 * avg_days_between_orders))", ZERO),
            ],
        )
    ),
    "dq_churn_medians": q(
        "SELECT risk_tier, median_recency_days, customers, median_recency_days > lag(median_recency_days) OVER "
        "(ORDER BY CASE risk_tier WHEN 'Active' THEN 1 WHEN 'At Risk' THEN 2 ELSE 3 END) AS passed FROM ("
        "SELECT risk_tier, quantile_cont(recency_days, 0.5) AS median_recency_days, count(*) AS customers "
        "FROM churn GROUP BY risk_tier)"
    ),
    "dq_timestamp_format": q(
        report(
            "timestamp_format",
            "raw_items",
            [
                ("column_present", "least(count(*), 1)", "{v} = 1"),
                ("is_text", "least(count(*), 1)", "{v} = 1"),
                ("rows", "count(*)", None),
                ("without_fraction", "count(*) FILTER (WHERE NOT contains(creation_text, '.'))", None),
                ("unparseable",
                 f"count(*) FILTER (WHERE creation_text IS NOT NULL AND {TEXT_TIME} IS NULL)", ZERO),
                ("null_or_blank", "count(*) FILTER (WHERE coalesce(trim(creation_text), '') = '')", None),
            ],
        )
    ),
    "dq_timestamp_samples": q(
        "SELECT * FROM (SELECT 'without_fraction' AS kind, creation_text AS sample FROM raw_items "
        "WHERE NOT contains(creation_text, '.') ORDER BY sample LIMIT 10) UNION ALL "
        f"SELECT * FROM (SELECT 'unparseable' AS kind, creation_text AS sample FROM raw_items "
        f"WHERE {TEXT_TIME} IS NULL ORDER BY sample LIMIT 20)"
    ),
    "dq_amounts": q(
        report(
            "total_revenue",
            "lines",
            [
                ("rows", "count(*)", None),
                ("null", "count(*) FILTER (total_revenue IS NULL)", None),
                ("not_finite", "count(*) FILTER (NOT isfinite(total_revenue))", ZERO),
                ("out_of_range", "count(*) FILTER (isfinite(total_revenue) AND abs(total_revenue) >= 1e17)", ZERO),
                ("exact_total_differs",
                 "CAST(abs(CAST(sum(amount) AS DOUBLE) - sum(total_revenue)) > 1e-9 * sum(abs(total_revenue)) "
                 "+ 5e-7 * count(*) AS INTEGER)", ZERO),
            ],
        )
    ),
    "dq_price_signs": q(signs("item_price", "items") + " UNION ALL " + signs("option_price", "options")),
}
