from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from orderlens.catalog import fixtures as fx
from orderlens.operators.accounts import flagged_accounts
from orderlens.operators.lines import order_slices, with_order_date
from orderlens.plans import base as base_plan
from orderlens.plans import marts
from orderlens.session import keep

DAY = date(2024, 1, 1)
SLICES = (
    "order_id long, user_id string, restaurant_id int, is_loyalty boolean, order_date date, "
    "total_revenue decimal(34,6), line_count long, free_line_count long"
)
DIM = "date_key date, is_holiday boolean, holiday_name string"


def slices(spark, rows):
    """Rows of (order, user, day offset, revenue) with optional restaurant, lines, free lines."""
    full = []
    for order, user, day, revenue, *rest in rows:
        restaurant, line_count, free = (rest + [1, 1, 0][len(rest):])[:3]
        when = None if day is None else DAY + timedelta(days=day)
        amount = None if revenue is None else Decimal(str(revenue))
        full.append((order, user, restaurant, order % 2 == 0, when, amount, line_count, free))
    return spark.createDataFrame(full, SLICES)


def dim(spark):
    return spark.createDataFrame([(DAY, True, "New Year"), (DAY + timedelta(days=1), False, None)], DIM)


def test_churn_bounds(spark):
    # Silence of 30, 31, 90 and 91 days before the last order of the data, by a guest.
    rows = [(1, None, 100, 1.0), (2, "a", 70, 1.0), (3, "b", 69, 1.0), (4, "c", 10, 1.0), (5, "d", 9, 1.0)]
    rows += [(6, "nodate", None, 1.0)]
    # Two orders on one day leave no gap; gaps of 20 with silences of 40 and 41.
    rows += [(7, "same", 95, 1.0), (8, "same", 95, 1.0)]
    rows += [(9, "at", 40, 1.0), (10, "at", 60, 1.0), (11, "over", 39, 1.0), (12, "over", 59, 1.0)]
    found = {r.user_id: r for r in marts.churn_risk(marts.customer_base(slices(spark, rows))).collect()}
    assert {u: found[u].risk_tier for u in "abcd"} == {
        "a": "Active", "b": "At Risk", "c": "At Risk", "d": "Churned"
    }
    assert (found["nodate"].recency_days, found["nodate"].risk_tier) == (None, "Churned")
    assert found["nodate"].is_overdue is False
    assert (found["same"].frequency, found["same"].avg_days_between_orders) == (2, None)
    assert found["same"].is_overdue is False
    assert (found["at"].avg_days_between_orders, found["at"].recency_days, found["at"].is_overdue) == (20, 40, False)
    assert (found["over"].recency_days, found["over"].is_overdue) == (41, True)


def scored_customers(spark, rows):
    schema = (
        "user_id string, recency_days int, frequency long, monetary double, is_likely_non_individual boolean"
    )
    return keep(spark.createDataFrame([(*r, False) for r in rows], schema), "customers")


def test_segments(spark):
    # Five customers: one per quintile in each measure.
    rows = [("vip", 1, 9, 900.0), ("new", 2, 1, 1.0), ("mid", 3, 3, 30.0), ("lost", 8, 5, 50.0), ("gone", 9, 2, 2.0)]
    found = {r.user_id: r for r in marts.rfm_segments(scored_customers(spark, rows)).collect()}
    assert {u: r.segment for u, r in found.items()} == {
        "vip": "VIP", "new": "New", "mid": "Regular", "lost": "Churn Risk", "gone": "Regular"
    }
    assert found["vip"].recency_score == 5 and found["gone"].recency_score == 1


def test_vip_wins_over_new(spark):
    rows = [("a", 1, 1, 900.0)] + [(f"b{i}", 5 + i, 0, 1.0 + i) for i in range(4)]
    found = {r.user_id: r.segment for r in marts.rfm_segments(scored_customers(spark, rows)).collect()}
    assert found["a"] == "VIP"


def test_fewer_customers_than_buckets_and_none(spark):
    two = marts.rfm_scores(scored_customers(spark, [("a", 1, 1, 1.0), ("b", 1, 1, 1.0)])).collect()
    assert sorted((r.user_id, r.frequency_score) for r in two) == [("a", 1), ("b", 2)]
    assert marts.rfm_segments(scored_customers(spark, [])).count() == 0


def test_null_recency_counts_as_most_recent(spark):
    rows = [("x", None, 1, 1.0)] + [(f"c{i}", i, 1, 1.0) for i in range(4)]
    found = {r.user_id: r.recency_score for r in marts.rfm_scores(scored_customers(spark, rows)).collect()}
    assert found["x"] == 5


def test_clv_runs_up_and_skips_guests(spark):
    rows = [(1, "a", 0, 5.0), (2, "a", 0, 2.5), (3, "a", 1, 1.0), (4, None, 0, 99.0), (5, "a", None, 3.0)]
    found = marts.clv_daily(slices(spark, rows), dim(spark), threshold=3).orderBy("order_date").collect()
    assert [(r.order_date, r.daily_revenue, r.cumulative_clv) for r in found] == [
        (None, 3.0, 3.0), (DAY, 7.5, 10.5), (DAY + timedelta(days=1), 1.0, 11.5)
    ]
    assert [r.is_holiday for r in found] == [None, True, False]
    assert all(r.is_likely_non_individual for r in found)


def test_sales_keep_guests_and_undated_rows(spark):
    rows = [(1, "a", 0, 5.0), (1, "a", 0, 1.0), (2, None, 0, 4.0), (3, "b", None, 2.0)]
    found = {r.order_date: r for r in marts.sales_trends(slices(spark, rows), dim(spark)).collect()}
    assert (found[DAY].total_revenue, found[DAY].order_count, found[DAY].avg_order_value) == (10.0, 2, 5.0)
    assert (found[None].total_revenue, found[None].year) == (2.0, None)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_location_and_loyalty(spark, limit):
    rows = [
        (1, "big", 0, 6.0, 10, 600), (2, "big", 1, 2.0, 20, 1), (3, "b", 0, 2.0, 10), (4, None, 0, 4.0, 10),
        (5, None, 0, 0.0, 30), (6, "b", 1, None, 40),
    ]
    base = keep(slices(spark, rows), "slices")
    flagged = keep(flagged_accounts(base), "flagged")
    options = {"max_broadcast_rows": limit}
    places = {r.restaurant_id: r for r in marts.location_performance(base, flagged, **options).collect()}
    ten = places[10]
    assert (ten.total_revenue, ten.order_count, ten.distinct_customers) == (12.0, 3, 2)
    assert (ten.flagged_account_revenue, ten.flagged_account_order_count) == (6.0, 1)
    assert (ten.avg_order_value, ten.flagged_revenue_share) == (4.0, 0.5)
    assert (places[30].flagged_revenue_share, places[30].distinct_customers) == (None, 0)
    assert (places[40].total_revenue, places[40].order_count) == (None, 1)
    groups = {
        (r.is_loyalty, r.is_likely_non_individual): (r.total_revenue, r.order_count, r.distinct_customers)
        for r in marts.loyalty_impact(base, flagged, **options).collect()
    }
    assert groups == {
        (False, True): (6.0, 1, 1), (True, True): (2.0, 1, 1), (False, False): (2.0, 2, 1), (True, False): (4.0, 2, 1)
    }


def test_null_group_keeps_its_customers(spark):
    rows = slices(spark, [(1, "a", 0, 1.0), (2, "b", 0, 1.0)]).withColumn("restaurant_id", F.lit(None).cast("int"))
    base = keep(rows, "slices")
    found = marts.location_performance(base, keep(flagged_accounts(base), "flagged")).collect()
    assert [(r.restaurant_id, r.order_count, r.distinct_customers) for r in found] == [(None, 2, 2)]


def test_free_item_effect(spark):
    rows = [(1, "a", 0, 8.0, 1, 2, 1), (1, "a", 0, 2.0), (2, "b", 0, 4.0), (3, "b", 0, None)]
    row = marts.free_item_effect(slices(spark, rows)).first()
    assert (row.free_item_orders, row.avg_with_free_item, row.avg_without_free_item) == (1, 10.0, 4.0)
    none = marts.free_item_effect(slices(spark, [(2, "b", 0, 4.0)])).first()
    assert (none.free_item_orders, none.avg_with_free_item) == (0, None)


def test_price_tiers(spark):
    rows = [(1, "a", 0.0, 1.0), (1, "a", 0.0, 1.0), (1, "a", 7.0, 7.0), (2, None, None, None)]
    lines = spark.createDataFrame(rows, "order_id long, user_id string, item_price double, total_revenue double")
    lines = lines.select("*", *[F.lit(None).cast("string").alias(c) for c in ("restaurant_id", "is_loyalty", "order_date")])
    found = {r.price_tier: tuple(r)[1:] for r in marts.price_tiers(order_slices(lines)).collect()}
    assert found == {"Free": (2.0, 2, 1, 1), "$5-$10": (7.0, 1, 1, 1), "$20+": (None, 1, 1, 0)}


def test_location_plan(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    plan = plan_of(marts.location_performance(base.slices, base.flagged))
    assert "Expand" not in plan and "SinglePartition" not in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_times_do_not_travel_with_the_lines(spark, sf_dir, monkeypatch):
    """Order days are taken before the lines meet their options, and the slices are those of the other order."""
    met, one = [], base_plan.line_revenue
    monkeypatch.setattr(base_plan, "line_revenue", lambda items, options: (met.append(items), one(items, options))[1])
    base = fx.sales_base(spark, sf_dir)
    found = base.lines
    assert "order_date" in met[0].columns and found.columns == [
        "order_id", "lineitem_id", "user_id", "restaurant_id", "is_loyalty", "order_date", "item_price", "total_revenue"
    ]
    after = with_order_date(one(base.clean_items, base.options)).select(*found.columns)
    assert order_slices(found).exceptAll(order_slices(after)).isEmpty() and found.count() == after.count()
