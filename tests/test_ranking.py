import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of
from orderlens.operators.ranking import bucket_ends, distributed_ntile, exact_percentiles
from orderlens.session import keep


def customers(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, 1, 1, 1, 2, 3]), round(rng.random() * 5, 1)) for i in range(n)]
    rng.shuffle(rows)
    return keep(spark.createDataFrame(rows, "user_id long, recency int, money double"), "t")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 6, 7, 101, 1000])
def test_distributed_equals_builtin(spark, n):
    df = customers(spark, n)
    scores = {"a": "recency", "b": "money"}
    large = distributed_ntile(df, scores, "user_id", slice_rows=max(1, n // 5))
    small = df.withColumns(
        {out: F.ntile(5).over(Window.orderBy(F.col(m).asc_nulls_first(), "user_id")) for out, m in scores.items()}
    )
    assert sorted(large.collect(), key=repr) == sorted(small.collect(), key=repr)
    one_task = distributed_ntile(df, scores, "user_id")
    assert sorted(one_task.collect(), key=repr) == sorted(small.collect(), key=repr)


def test_text_ids(spark):
    df = keep(spark.range(57).select(F.md5(F.col("id").cast("string")).alias("u"), (F.col("id") % 2).alias("v")), "t")
    large = distributed_ntile(df, {"a": "v"}, "u", slice_rows=10)
    expected = df.withColumn("a", F.ntile(5).over(Window.orderBy("v", "u")))
    assert sorted(large.collect()) == sorted(expected.collect())


def test_distributed_plan_moves_no_customer_rows(spark):
    plan = plan_of(distributed_ntile(customers(spark, 100), {"a": "money"}, "user_id"))
    assert "Exchange" not in plan and "Window" not in plan


def test_bucket_ends():
    assert bucket_ends(11, 5) == [3, 5, 7, 9]
    assert bucket_ends(3, 5) == [1, 2, 3, 3]


@pytest.mark.parametrize("slice_rows", [2_000_000, 40, 1])
def test_percentiles(spark, slice_rows):
    rng = random.Random(3)
    values = [rng.choice([1, 1, 1, rng.randint(1, 500)]) for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    points = [0.0, 0.25, 0.5, 0.9, 0.995, 1.0]
    found = {r.fraction: r.value for r in exact_percentiles(df, "v", points, slice_rows).collect()}
    assert found == pytest.approx({p: np.percentile(values, p * 100) for p in points})


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert [tuple(r) for r in exact_percentiles(df, "v", [0.5]).collect()] == [(0.5, None)]
