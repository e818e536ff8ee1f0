"""Daily lifetime value brought forward from one increment to the next.

A running total over all days would read all days again for every new one. Here
the last total of each customer is carried as state, so new days start from it. Rows
of a customer that arrive for a day before its last one shift all later totals of
that customer: for such customers alone, the daily amounts from that day on are read
again and their rows replaced. The result equals the mart built from all slices.

Everything a run reads was noted as complete by an earlier run, so a run that
failed is simply repeated.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.functions.calendar import with_calendar
from orderlens.functions.columns import TOTAL, money
from orderlens.operators.accounts import FLAG, MAX_INDIVIDUAL_LINES
from orderlens.operators.lookups import few, lookup_join
from orderlens.plans.refresh import PERIOD, period_of, replace_rows
from orderlens.schemas import MARTS
from orderlens.session import keep, scratch, small_table

RUNS = "run long"
# Stands for an unknown order day in stored tables; it sorts first, as null does.
NO_DAY = "0001-01-01"
DAILY = f"user_id long, order_date date, revenue {TOTAL}, {PERIOD} date, run long"


def last_run(spark: SparkSession, root: str) -> int:
    """The newest complete run; 0 before the first."""
    try:
        return spark.read.schema(RUNS).parquet(f"{root}/runs").agg(F.max("run")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def state(spark: SparkSession, root: str) -> DataFrame:
    """(user_id, last_day, total, line_count): what is carried to the next increment."""
    return spark.read.parquet(f"{root}/state/run={last_run(spark, root)}")


def late_history(daily: DataFrame, late: DataFrame) -> DataFrame:
    """Daily amounts of the ``late`` customers (user_id, first_day) from their first new day on, by pruned periods."""
    least = late.agg(F.min("first_period")).scalar()
    rows = daily.filter(F.col(PERIOD) >= least).join(few(late), "user_id")
    return rows.filter(F.col("order_date") >= F.col("first_day")).select("user_id", "order_date", "revenue")


def advance_clv(spark: SparkSession, slices: DataFrame, root: str, grain: str = "month") -> int:
    """Add the order slices of one increment below ``root``; returns the rows of the mart that were written."""
    done = last_run(spark, root)
    run = done + 1
    with scratch(spark):
        day = F.coalesce("order_date", F.lit(NO_DAY).cast("date"))
        days = slices.filter(F.col("user_id").isNotNull()).groupBy("user_id", day.alias("order_date")).agg(
            F.sum("total_revenue").cast(TOTAL).alias("revenue"), F.sum("line_count").alias("lines")
        )
        days = keep(days.withColumn(PERIOD, period_of("order_date", grain)), "new-days")
        news = keep(
            days.groupBy("user_id").agg(
                F.min("order_date").alias("first_day"), F.max("order_date").alias("new_last"), F.min(PERIOD).alias("first_period"),
                F.sum("revenue").cast(TOTAL).alias("added"), F.sum("lines").alias("lines"),
            ),
            "new-customers",
        )
        rows = days.select("user_id", "order_date", "revenue")
        zero = F.lit(0).cast(TOTAL)
        if done:
            before = state(spark, root)
            daily = spark.read.schema(days.drop("lines").withColumn("run", F.lit(0).cast("long")).schema).parquet(f"{root}/daily")
            late = keep(news.join(before, "user_id").filter("first_day <= last_day").select(*news.columns), "late-customers")
            history = keep(late_history(daily.filter(F.col("run") <= done), late), "late-history")
            redone = history.groupBy("user_id").agg(F.sum("revenue").cast(TOTAL).alias("redone"))
            base = news.join(before, "user_id", "left").join(redone, "user_id", "left").select(
                "user_id", (F.coalesce("total", zero) - F.coalesce("redone", zero)).alias("base")
            )
            rows = rows.unionByName(history)
            carried = before.join(news, "user_id", "full").select(
                "user_id", F.greatest("last_day", "new_last").alias("last_day"),
                (F.coalesce("total", zero) + F.coalesce("added", zero)).cast(TOTAL).alias("total"),
                (F.coalesce("line_count", F.lit(0)) + F.coalesce("lines", F.lit(0))).alias("line_count"),
            )
        else:
            base = news.select("user_id", zero.alias("base"))
            carried = news.select(
                "user_id", F.col("new_last").alias("last_day"), F.col("added").alias("total"), F.col("lines").alias("line_count")
            )
        so_far = Window.partitionBy("user_id").orderBy("order_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = rows.groupBy("user_id", "order_date").agg(F.sum("revenue").cast(TOTAL).alias("daily_revenue"))
        running = summed.join(base, "user_id").select(
            "user_id", "order_date", "daily_revenue",
            (F.sum("daily_revenue").over(so_far) + F.col("base")).cast(TOTAL).alias("cumulative_clv"),
            period_of("order_date", grain).alias(PERIOD),
        )
        running = keep(running, "running")
        # A row's period follows from its key, so older versions lie in the same periods.
        written = replace_rows(running, f"{root}/rows", ["user_id", "order_date"], not done, fixed=True)[0]
        days.drop("lines").write.mode("overwrite").partitionBy(PERIOD).parquet(f"{root}/daily/run={run}")
        carried.write.mode("overwrite").parquet(f"{root}/state/run={run}")
    small_table(spark, [(run,)], RUNS).coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return written


def clv_daily(spark: SparkSession, root: str, dim: DataFrame, threshold: int = MAX_INDIVIDUAL_LINES) -> DataFrame:
    """The mart as ``marts.clv_daily`` gives it; the flag follows the customer's lines so far."""
    unknown = F.col("order_date") == F.lit(NO_DAY).cast("date")
    rows = spark.read.parquet(f"{root}/rows").select(
        "user_id", F.when(~unknown, F.col("order_date")).alias("order_date"),
        money(F.col("daily_revenue")).alias("daily_revenue"), money(F.col("cumulative_clv")).alias("cumulative_clv"),
    )
    flagged = state(spark, root).filter(F.col("line_count") > threshold)
    flagged = flagged.select("user_id", F.lit(True).alias(FLAG), F.lit(1).alias("weight"))
    marked = lookup_join(rows, keep(flagged, "flagged"), "user_id", "weight", ["order_date"])
    marked = marked.withColumn(FLAG, F.coalesce(FLAG, F.lit(False)))
    return with_calendar(marked, "order_date", dim).select(*MARTS["clv_daily"])
