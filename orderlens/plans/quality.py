"""Data-quality reports: rows of (check_name, metric, value, passed).

``passed`` is null where a number is only reported. Every report is one
aggregate over its input, so nothing but the finished numbers leaves the tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.columns import AMOUNT, TOTAL, usable_amount
from orderlens.operators.accounts import FLAG
from orderlens.operators.lookups import fits_broadcast
from orderlens.operators.ranking import exact_percentiles
from orderlens.plans.marts import OVERDUE_GAPS

Rule = Callable[[Column], Column]
AVERAGE_TOLERANCE = 0.01
REVENUE_TOLERANCE = 1.0


def zero(value: Column) -> Column:
    return value == 0


def report(df: DataFrame, check: str, metrics: list[tuple[str, Column, Rule | None]]) -> DataFrame:
    """Aggregate once, then turn the one row into one row per metric."""
    names = [f"m{i}" for i in range(len(metrics))]
    numbers = df.agg(*[agg.alias(n) for n, (_, agg, _) in zip(names, metrics)])
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(n).cast("double").alias("value"),
            (rule(F.col(n)) if rule else F.lit(None)).cast("boolean").alias("passed"),
        )
        for n, (metric, _, rule) in zip(names, metrics)
    ]
    return numbers.select(F.lit(check).alias("check_name"), F.explode(F.array(*rows)).alias("r")).select(
        "check_name", "r.metric", "r.value", "r.passed"
    )


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows() -> Column:
    return F.count(F.lit(1))


def _day_number(day: Column) -> Column:
    """A date as the number yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def _total_revenue() -> Column:
    return F.sum(F.col("total_revenue").cast(TOTAL)).cast("double")


def _wrong_average() -> Column:
    again = F.try_divide(F.col("total_revenue"), F.col("order_count"))
    return F.count_if(F.abs(F.col("avg_order_value") - again) > AVERAGE_TOLERANCE)


def sales_checks(sales: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return report(
        sales,
        "sales_trends",
        [
            ("dates", _rows(), None),
            ("first_date", _day_number(F.min(day)), None),
            ("last_date", _day_number(F.max(day)), None),
            ("dates_without_year", F.count_if(F.col("year").isNull()), zero),
            ("dates_without_holiday_info", F.count_if(F.col("is_holiday").isNull()), None),
            ("min_revenue", F.min("total_revenue"), None),
            ("negative_revenue", F.count_if(F.col("total_revenue") < 0), zero),
            ("min_orders", F.min("order_count"), None),
            ("no_orders", F.count_if(F.col("order_count") <= 0), zero),
            ("wrong_average", _wrong_average(), zero),
            ("total_revenue", _total_revenue(), None),
            ("total_orders", F.sum("order_count"), None),
        ],
    )


def uncovered_dates(sales: DataFrame, k: int = 10) -> DataFrame:
    """The first days for which the calendar dimension has no entry."""
    return sales.filter(F.col("is_holiday").isNull()).select("order_date").orderBy("order_date").limit(k)


def _ids(ids: DataFrame) -> DataFrame:
    """Distinct account ids, broadcast where they were weighed and fit."""
    ids = ids.select("user_id").filter(F.col("user_id").isNotNull()).distinct().withColumn("_known", F.lit(True))
    return F.broadcast(ids) if fits_broadcast(ids) else ids


def account_profile(items: DataFrame, ids: DataFrame) -> DataFrame:
    """Spread of each account in ``ids`` (user_id) over locations, apps, cards and days.

    Every line gives its distinct (account, attribute, value) entries, which are reduced
    before the shuffle and spread by value; the counts see those, not the lines
    of the busiest accounts.
    """
    facts = {
        "locations": F.col("restaurant_id"), "apps": F.col("app_name"), "cards": F.col("printed_card_number"),
        "order_days": F.to_date("creation_time_utc"),
    }
    entries = F.array(
        *[F.struct(F.lit(name).alias("fact"), value.cast("string").alias("value")) for name, value in facts.items()]
    )
    own = items.join(_ids(ids), "user_id", "left_semi").select("user_id", F.explode(entries).alias("e"))
    distinct = own.select("user_id", "e.fact", "e.value").distinct()
    fact, value = F.col("fact"), F.col("value")
    counts = {name: F.count(F.when(fact == name, value)) for name in facts}
    day = F.when(fact == "order_days", value)
    return distinct.groupBy("user_id").agg(
        *[count.alias(name) for name, count in counts.items() if name != "order_days"],
        F.min(day).cast("date").alias("first_order_date"),
        F.max(day).cast("date").alias("last_order_date"),
        counts["order_days"].alias("order_days"),
    )


def rfm_checks(rfm: DataFrame) -> DataFrame:
    scores = ("recency_score", "frequency_score", "monetary_score")
    metrics = [
        ("rows", _rows(), None),
        ("repeated_customers", _rows() - F.countDistinct("user_id"), zero),
        ("min_recency_days", F.min("recency_days"), lambda v: v >= 0),
        ("max_recency_days", F.max("recency_days"), None),
        ("new_with_several_orders", F.count_if((F.col("segment") == "New") & (F.col("frequency") != 1)), zero),
    ]
    for score in scores:
        metrics += [
            (f"{score}_min", F.min(score), lambda v: v == 1),
            (f"{score}_max", F.max(score), lambda v: v == 5),
            (f"{score}_nulls", F.count_if(F.col(score).isNull()), zero),
        ]
    return report(rfm, "customer_segments_rfm", metrics)


def segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(_rows().alias("customers"))


def clv_monotonic(clv: DataFrame) -> DataFrame:
    """Customers whose running total ever falls."""
    history = Window.partitionBy("user_id").orderBy("order_date")
    fell = F.col("cumulative_clv") < F.lag("cumulative_clv").over(history)
    customers = (
        clv.select("user_id", fell.alias("fell")).groupBy("user_id").agg(F.bool_or("fell").alias("fell"))
    )
    return report(
        customers,
        "clv_daily",
        [("customers", _rows(), None), ("decreasing_customers", F.count_if("fell"), zero)],
    )


def flag_counts(items: DataFrame) -> DataFrame:
    """Line items per loyalty value, for every known customer."""
    return (
        items.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("is_loyalty")).alias("loyalty_true_count"),
            F.count_if(~F.col("is_loyalty")).alias("loyalty_false_count"),
            _rows().alias("line_items"),
        )
    )


def inconsistent_customers(items: DataFrame) -> DataFrame:
    """Customers seen with both loyalty values, and their share of true lines."""
    yes, no = F.col("loyalty_true_count"), F.col("loyalty_false_count")
    return (
        flag_counts(items)
        .filter((yes > 0) & (no > 0))
        .select("user_id", "loyalty_true_count", "loyalty_false_count", (yes / (yes + no)).alias("pct_loyalty"))
    )


def flag_consistency(items: DataFrame) -> DataFrame:
    yes, no = F.col("loyalty_true_count") > 0, F.col("loyalty_false_count") > 0
    mixed = F.count_if(yes & no)
    known = report(
        flag_counts(items),
        "loyalty_flag",
        [
            ("rows_with_customer", F.sum("line_items"), None),
            ("customers", _rows(), None),
            ("consistent_customers", F.count_if(yes != no), None),
            ("inconsistent_customers", mixed, None),
            ("inconsistent_pct", F.try_divide(mixed * 100.0, _rows()), None),
        ],
    )
    return known.unionByName(report(items, "loyalty_flag", [("rows", _rows(), None)]))


def flag_share_stats(mixed: DataFrame, **options) -> DataFrame:
    """Distribution of the loyalty share among inconsistent customers."""
    share = F.col("pct_loyalty")
    moments = report(
        mixed,
        "loyalty_share",
        [
            ("count", F.count(share), None),
            ("mean", F.avg(share), None),
            ("std", F.stddev_samp(share), None),
            ("min", F.min(share), None),
            ("max", F.max(share), None),
        ],
    )
    quartiles = exact_percentiles(mixed, "pct_loyalty", [0.25, 0.5, 0.75], **options).select(
        F.lit("loyalty_share").alias("check_name"),
        F.concat((F.col("fraction") * 100).cast("int").cast("string"), F.lit("%")).alias("metric"),
        "value",
        F.lit(None).cast("boolean").alias("passed"),
    )
    return moments.unionByName(quartiles)


def flag_rollout(marts: dict[str, DataFrame], ids: DataFrame) -> DataFrame:
    """Each customer mart carries the flag, once per customer, for the accounts in ``ids`` (user_id)."""
    parts, ids = [], ids.select("user_id").distinct()
    expected = ids.count()
    known_ids = _ids(ids)
    for name, mart in marts.items():
        present = FLAG in mart.columns
        shape = [("rows", _rows(), None), ("flag_present", F.lit(int(present)), lambda v: v == 1)]
        if not present:
            parts.append(report(mart, name, shape))
            continue
        customers = mart.groupBy("user_id").agg(
            F.bool_or(FLAG).alias("mart_flag"), _rows().alias("mart_rows"),
            F.bool_and(FLAG).alias("always"),
        )
        known = customers.join(known_ids, "user_id", "left")
        missed = F.coalesce(F.col("_known"), F.lit(False)) & ~F.col("mart_flag")
        parts.append(
            report(
                known,
                name,
                [
                    ("rows", F.sum("mart_rows"), None),
                    ("flag_present", F.lit(1), lambda v: v == 1),
                    ("customers", _rows(), None),
                    ("customers_with_two_flags", F.count_if(F.col("mart_flag") != F.col("always")), zero),
                    ("flagged_customers", F.count_if("mart_flag"), lambda v: v == expected),
                    ("known_accounts_not_flagged", F.count_if(missed), zero),
                ],
            )
        )
    return _stack(parts)


def top_customers(volume: DataFrame, k: int = 15) -> DataFrame:
    return volume.orderBy(F.desc("line_items"), "user_id").limit(k)


def concentration(volume: DataFrame, k: int = 10, **options) -> DataFrame:
    """Median and mean lines per customer, and the share the busiest hold."""
    total = volume.agg(F.sum("line_items")).scalar()
    top = top_customers(volume, k).agg(F.sum("line_items").alias("top"))
    share = top.select(F.try_divide(F.col("top") * 100.0, total).alias("share"))
    median = exact_percentiles(volume, "line_items", [0.5], **options)
    return _stack(
        [
            report(
                volume,
                "volume",
                [("customers", _rows(), None), ("mean_line_items", F.avg("line_items"), None)],
            ),
            report(median, "volume", [("median_line_items", F.max("value"), None)]),
            report(share, "volume", [(f"top_{k}_share_pct", F.max("share"), None)]),
        ]
    )


# The percentiles and volume thresholds under review.
PERCENTS = (50, 75, 90, 95, 97, 98, 99, 99.5, 99.9, 99.99)
THRESHOLDS = (100, 200, 300, 500)


def volume_percentiles(volume: DataFrame, percents=PERCENTS, **options) -> DataFrame:
    """Lines per customer at each percentile, linearly interpolated; 100 is the maximum."""
    found = exact_percentiles(volume, "line_items", [p / 100 for p in (*percents, 100)], **options)
    return found.select((F.col("fraction") * 100).alias("percentile"), F.col("value").alias("line_items"))


def threshold_impact(volume: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Customers and lines above each candidate threshold, in one pass."""
    lines = F.col("line_items")
    numbers = volume.agg(
        _rows().alias("customers"),
        F.sum(lines).alias("lines"),
        *[F.count_if(lines > t).alias(f"customers_{t}") for t in thresholds],
        *[F.sum(F.when(lines > t, lines).otherwise(0)).alias(f"lines_{t}") for t in thresholds],
    )
    rows = [
        F.struct(
            F.lit(t).cast("bigint").alias("threshold"),
            F.col(f"customers_{t}").alias("customers_above"),
            F.try_divide(F.col(f"customers_{t}") * 100.0, F.col("customers")).alias("pct_customers"),
            F.col(f"lines_{t}").alias("line_items_above"),
            F.try_divide(F.col(f"lines_{t}") * 100.0, F.col("lines")).alias("pct_line_items"),
        )
        for t in thresholds
    ]
    return numbers.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _reconciled(sales: DataFrame) -> list[tuple[str, Column, Rule | None]]:
    """Totals of a mart against the totals of the daily sales mart."""
    both = sales.agg(F.struct(_total_revenue().alias("revenue"), F.sum("order_count").alias("orders"))).scalar()
    revenue, orders = both["revenue"], both["orders"]
    return [
        ("total_revenue", _total_revenue(), lambda v: F.abs(v - revenue) < REVENUE_TOLERANCE),
        ("total_orders", F.sum("order_count"), lambda v: v == orders),
        ("wrong_average", _wrong_average(), zero),
    ]


def loyalty_checks(loyalty: DataFrame, sales: DataFrame, flagged_accounts: int) -> DataFrame:
    in_flagged = F.max(F.when(F.col(FLAG), F.col("distinct_customers")).otherwise(0))
    return report(
        loyalty,
        "loyalty_impact",
        [
            ("rows", _rows(), lambda v: v <= 4),
            *_reconciled(sales),
            # A flagged customer counts once under each loyalty value, so each value is held against the number.
            ("most_flagged_customers", in_flagged, lambda v: v <= flagged_accounts),
        ],
    )


def location_checks(locations: DataFrame, sales: DataFrame) -> DataFrame:
    return report(
        locations,
        "location_performance",
        [
            ("rows", _rows(), None),
            *_reconciled(sales),
            ("min_revenue", F.min("total_revenue"), None),
            ("negative_revenue", F.count_if(F.col("total_revenue") < 0), zero),
            ("min_orders", F.min("order_count"), None),
            ("no_orders", F.count_if(F.col("order_count") <= 0), zero),
        ],
    )


def top_flagged_locations(locations: DataFrame, k: int = 10) -> DataFrame:
    shown = (
        "restaurant_id", "total_revenue", "flagged_account_revenue",
        "flagged_revenue_share", "flagged_account_order_count",
    )
    return locations.select(*shown).orderBy(F.desc("flagged_revenue_share"), "restaurant_id").limit(k)


# Churn tiers from the most to the least recent.
TIERS = ("Active", "At Risk", "Churned")


def churn_checks(churn: DataFrame, rfm: DataFrame) -> DataFrame:
    """Null gaps belong to customers with one order day; overdue follows from the gap."""
    gap, overdue = F.col("avg_days_between_orders"), F.col("is_overdue")
    wrong = gap.isNotNull() & (overdue != (F.col("recency_days") > OVERDUE_GAPS * gap))
    rfm_rows = rfm.agg(_rows()).scalar()
    return report(
        churn,
        "churn_risk",
        [
            ("rows", _rows(), lambda v: v == rfm_rows),
            ("repeated_customers", _rows() - F.countDistinct("user_id"), zero),
            *[(f"tier_{t}", F.count_if(F.col("risk_tier") == t), None) for t in TIERS],
            ("overdue", F.count_if(overdue), None),
            ("not_overdue", F.count_if(~overdue), None),
            ("one_order_with_gap", F.count_if((F.col("frequency") == 1) & gap.isNotNull()), zero),
            # Several orders on a single day leave no gap, so this is only reported.
            ("several_orders_without_gap", F.count_if((F.col("frequency") > 1) & gap.isNull()), None),
            ("overdue_without_gap", F.count_if(gap.isNull() & overdue), zero),
            ("wrong_overdue", F.count_if(wrong), zero),
        ],
    )


def churn_medians(churn: DataFrame) -> DataFrame:
    """Median silence per tier; passed when it exceeds the tier before.

    Days are whole numbers within the calendar, so the histogram is small.
    """
    histogram = churn.groupBy("risk_tier", "recency_days").agg(_rows().alias("weight"))
    medians = histogram.groupBy("risk_tier").agg(
        F.percentile("recency_days", 0.5, F.col("weight")).alias("median_recency_days"), F.sum("weight").alias("customers")
    )
    place = F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("risk_tier"))
    before = F.lag("median_recency_days").over(Window.orderBy("_place"))
    return medians.withColumn("_place", place).withColumn(
        "passed", F.col("median_recency_days") > before
    ).select("risk_tier", "median_recency_days", "customers", "passed")


def _named(raw: DataFrame, column: str) -> str | None:
    return next((c for c in raw.columns if c.lower() == column.lower()), None)


FRACTION = r"\."


def timestamp_format(raw: DataFrame, column: str = "creation_time_utc") -> DataFrame:
    """Forms of a text time column, found in either case."""
    found = _named(raw, column)
    if found is None:
        return report(raw, "timestamp_format", [("column_present", F.lit(0), lambda v: v == 1)])
    text_type = raw.schema[found].dataType.typeName() == "string"
    shape = [
        ("column_present", F.lit(1), lambda v: v == 1),
        ("is_text", F.lit(int(text_type)), lambda v: v == 1),
        ("rows", _rows(), None),
    ]
    if not text_type:
        return report(raw, "timestamp_format", shape)
    text = F.col(found)
    blank = text.isNull() | (F.trim(text) == "")
    return report(
        raw,
        "timestamp_format",
        [
            *shape,
            ("without_fraction", F.count_if(text.isNotNull() & ~text.rlike(FRACTION)), None),
            ("unparseable", F.count_if(text.isNotNull() & F.try_to_timestamp(text).isNull()), zero),
            ("null_or_blank", F.count_if(blank), None),
        ],
    )


def timestamp_samples(raw: DataFrame, column: str = "creation_time_utc", k: int = 10, k_bad: int = 20) -> DataFrame:
    """The first values without a fraction, and the first that do not parse."""
    text = F.col(_named(raw, column)).alias("sample")
    values = raw.select(text).filter(F.col("sample").isNotNull())

    def first(kind: str, condition: Column, limit: int) -> DataFrame:
        chosen = values.filter(condition).orderBy("sample").limit(limit)
        return chosen.select(F.lit(kind).alias("kind"), "sample")

    return first("without_fraction", ~F.col("sample").rlike(FRACTION), k).unionByName(
        first("unparseable", F.try_to_timestamp("sample").isNull(), k_bad)
    )


def price_signs(items: DataFrame, options: DataFrame) -> DataFrame:
    def signs(df: DataFrame, column: str) -> DataFrame:
        price = F.col(column)
        return report(
            df,
            column,
            [
                ("min", F.min(price), None),
                ("max", F.max(price), None),
                ("negative", F.count_if(price < 0), zero),
                ("zero", F.count_if(price == 0), None),
                ("null", F.count_if(price.isNull()), None),
            ],
        )

    return signs(items, "item_price").unionByName(signs(options, "option_price"))


AMOUNT_TOLERANCE = 1e-9


def amounts(lines: DataFrame, column: str = "total_revenue") -> DataFrame:
    """Amounts that no exact total can hold, and the exact total against the plain sum of doubles."""
    value, usable = F.col(column), usable_amount(column)
    exact = F.sum(F.when(usable, value.cast(AMOUNT)).cast(TOTAL)).cast("double")
    plain = F.sum(F.when(usable, value))
    # Rounding each line to a millionth moves the total by half a millionth per line at most.
    allowed = AMOUNT_TOLERANCE * F.sum(F.when(usable, F.abs(value))) + 5e-7 * _rows()
    return report(
        lines,
        column,
        [
            ("rows", _rows(), None),
            ("null", F.count_if(value.isNull()), None),
            ("not_finite", F.count_if(F.isnan(value) | (F.abs(value) == float("inf"))), zero),
            ("out_of_range", F.count_if(~usable & ~F.isnan(value) & (F.abs(value) < float("inf"))), zero),
            ("exact_total_differs", F.coalesce((F.abs(exact - plain) > allowed).cast("int"), F.lit(0)), zero),
        ],
    )
