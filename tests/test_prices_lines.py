import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from orderlens.operators import lines, prices
from orderlens.operators.accounts import flagged_accounts, non_individual_flag, with_account_flag
from orderlens.operators.lookups import fits_broadcast, lookup_join
from orderlens.plans import quality
from orderlens.session import keep

ITEMS = "order_id long, lineitem_id string, item_name string, item_price double"


def priced(spark, rows):
    return spark.createDataFrame([(i, str(i), *r) for i, r in enumerate(rows)], ITEMS)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_price_rule_bounds(spark, limit):
    rows = [("tea", 1.0)] * 5 + [("tea", 20.0), ("tea", 20.01), ("tea", None)]
    rows += [("free", 0.0), ("free", 0.0), ("free", 90.0), (None, 1e6), (None, None)]
    df = priced(spark, rows)
    kept = prices.plausible_prices(df, max_broadcast_rows=limit)
    dropped = prices.price_anomalies(df, max_broadcast_rows=limit)
    assert [(r.item_name, r.item_price) for r in dropped.collect()] == [("tea", 20.01)]
    assert kept.count() == len(rows) - 1
    assert kept.columns == df.columns


@pytest.mark.parametrize("options", [{}, {"slice_rows": 2}])
def test_medians_are_exact_and_lower(spark, options):
    rng = random.Random(5)
    rows = [("tea", p) for p in (4.0, 1.0, 3.0, 2.0, None)] + [(None, 9.0), ("unpriced", None), ("unpriced", None)]
    rows += [("hot", rng.choice([1.0, 2.0, round(rng.random() * 9, 3)])) for _ in range(301)]
    found = {r.item_name: (r.median_item_price, r.row_count) for r in prices.item_medians(priced(spark, rows), **options).collect()}
    hot = sorted(p for name, p in rows if name == "hot")
    assert found == {"tea": (2.0, 5), "unpriced": (None, 2), "hot": (hot[150], 301)}
    assert prices.item_medians(priced(spark, []), **options).count() == 0


def test_large_lookup_keeps_every_row_and_spreads_hot_keys(spark):
    facts = spark.range(3000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("user_id"),
    )
    lookup = keep(
        facts.filter("user_id is not null and user_id % 5 <> 0")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("label", F.concat(F.lit("u"), F.col("user_id"))),
        "lookup",
    )
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, 10)
    small = lookup_join(facts, lookup, "user_id", "n", ["order_id"])
    large = lookup_join(facts, lookup, "user_id", "n", ["order_id"], max_rows=0)
    assert large.columns == small.columns
    assert sorted(large.collect(), key=repr) == sorted(small.collect(), key=repr)
    assert "_spread" in plan_of(large)


def test_line_revenue(spark):
    items = spark.createDataFrame(
        [(1, "a", 2.0, 3.0), (1, "b", 5.0, 1.0), (2, "a", None, 1.0), (2, "b", 1.0, 1.0)],
        "order_id long, lineitem_id string, item_price double, item_quantity double",
    )
    options = spark.createDataFrame(
        [(1, "a", 0.5, 2), (1, "a", 1.0, 1), (2, "b", None, 1), (2, "a", 1.0, 1), (9, "z", 1.0, 1)],
        "order_id long, lineitem_id string, option_price double, option_quantity int",
    )
    found = {
        (r.order_id, r.lineitem_id): (r.item_revenue, r.options_revenue, r.total_revenue)
        for r in lines.line_revenue(items, options).collect()
    }
    assert found == {
        (1, "a"): (6.0, 2.0, 8.0),
        (1, "b"): (5.0, 0.0, 5.0),
        (2, "a"): (None, 1.0, None),
        (2, "b"): (1.0, 0.0, 1.0),
    }


@pytest.mark.parametrize("value", [float("nan"), float("inf"), -1e19])
def test_an_unusable_amount_stops_the_job_by_name_and_is_reported(spark, value):
    rows = [(1, 2.0, 5.0), (1, 3.0, value), (1, 3.0, None)]
    df = spark.createDataFrame(rows, "order_id long, item_price double, total_revenue double").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("user_id", "restaurant_id", "is_loyalty", "order_date")]
    )
    with pytest.raises(Exception, match="total_revenue is not a usable amount"):
        lines.order_slices(df).collect()
    found = {r.metric: (r.value, r.passed) for r in quality.amounts(df).collect()}
    bad = "out_of_range" if value == -1e19 else "not_finite"
    assert found[bad] == (1, False) and found["null"] == (1, None) and found["exact_total_differs"] == (0, True)
    assert lines.order_slices(df.filter("total_revenue = 5")).agg(F.sum("total_revenue")).first()[0] == 5


def slices_of(spark, counts):
    rows = [(i, user, 1, True, datetime(2024, 1, 1).date(), Decimal(1), n, 0) for i, (user, n) in enumerate(counts)]
    schema = (
        "order_id long, user_id long, restaurant_id int, is_loyalty boolean, order_date date, "
        "total_revenue decimal(34,6), line_count long, free_line_count long"
    )
    return spark.createDataFrame(rows, schema)


def test_flag_threshold_is_exclusive(spark):
    slices = slices_of(spark, [(1, 499), (1, 1), (2, 500), (2, 1), (None, 900)])
    flags = {r.user_id: r.is_likely_non_individual for r in non_individual_flag(slices).collect()}
    assert flags == {1: False, 2: True}


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_flag_join_gives_guests_false(spark, limit):
    slices = slices_of(spark, [(1, 10), (2, 600), (None, 900)])
    flagged = keep(flagged_accounts(slices), "flagged")
    joined = with_account_flag(slices, flagged, limit)
    assert {r.user_id: r.is_likely_non_individual for r in joined.collect()} == {1: False, 2: True, None: False}
