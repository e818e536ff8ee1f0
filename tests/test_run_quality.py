import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from orderlens.catalog import fixtures as fx
from orderlens.plans import marts, quality
from orderlens.plans.run import BUILDERS, MartsFailed, run_marts
from orderlens.schemas import MARTS
from orderlens.session import fresh_dir


def boom(_):
    raise ValueError("broken rule")


def test_a_failing_mart_does_not_stop_the_others(spark, sf_dir):
    out = fresh_dir(spark, "marts")
    base = fx.sales_base(spark, sf_dir)
    builders = {**BUILDERS, "sales_trends": boom}
    with pytest.raises(MartsFailed, match="sales_trends") as failure:
        run_marts(spark, base, out, builders)
    status = {r.mart: r for r in failure.value.status.collect()}
    assert status["sales_trends"].status == "failed: broken rule"
    for mart, columns in MARTS.items():
        if mart != "sales_trends":
            stored = spark.read.parquet(f"{out}/{mart}")
            assert status[mart].status == "success"
            assert stored.count() == status[mart].row_count > 0
            assert tuple(stored.columns) == columns
    assert run_marts(spark, base, out, {"x": boom}, raise_on_failure=False).count() == 1


def test_empty_inputs_give_empty_marts(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    for table in ("items", "options", "date_dim"):
        setattr(base, table, getattr(base, table).limit(0))
    status = run_marts(spark, base, fresh_dir(spark, "marts")).collect()
    assert {(r.status, r.row_count) for r in status} == {("success", 0)}
    assert marts.free_item_effect(base.slices).first().avg_with_free_item is None


def metrics(report):
    return {r.metric: (r.value, r.passed) for r in report.collect()}


def test_checks_pass_on_good_marts_and_fail_on_bad_ones(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    sales = marts.sales_trends(base.slices, base.date_dim)
    assert all(p is not False for _, p in metrics(quality.sales_checks(sales)).values())
    bad = sales.withColumn("avg_order_value", F.col("avg_order_value") + 1).withColumn("order_count", F.lit(0))
    found = metrics(quality.sales_checks(bad))
    assert found["no_orders"][1] is False

    clv = marts.clv_daily(base.slices, base.date_dim, base.threshold)
    assert metrics(quality.clv_monotonic(clv))["decreasing_customers"] == (0, True)
    falling = clv.withColumn("cumulative_clv", -F.col("cumulative_clv"))
    assert metrics(quality.clv_monotonic(falling))["decreasing_customers"][1] is False

    rfm = marts.rfm_segments(base.customers)
    assert all(p is not False for _, p in metrics(quality.rfm_checks(rfm)).values())
    assert metrics(quality.rfm_checks(rfm.union(rfm)))["repeated_customers"][1] is False

    churn = marts.churn_risk(base.customers)
    assert all(p is not False for _, p in metrics(quality.churn_checks(churn, rfm)).values())
    flipped = churn.withColumn("is_overdue", ~F.col("is_overdue"))
    assert metrics(quality.churn_checks(flipped, rfm))["wrong_overdue"][1] is False

    places = marts.location_performance(base.slices, base.flagged)
    assert all(p is not False for _, p in metrics(quality.location_checks(places, sales)).values())
    half = places.limit(3)
    assert metrics(quality.location_checks(half, sales))["total_orders"][1] is False

    missing = quality.flag_rollout(
        {"churn_risk": churn.drop("is_likely_non_individual")}, base.flagged
    )
    assert metrics(missing)["flag_present"] == (0, False)

    ids = base.items.select("user_id").filter("user_id is not null").distinct().limit(2)
    profile = quality.account_profile(base.items, ids)
    assert "Expand" not in plan_of(profile) and profile.count() == 2
    asked = quality.flag_rollout({"churn_risk": churn}, ids.union(ids))
    assert metrics(asked)["customers"][0] == churn.count()
