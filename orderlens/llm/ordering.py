"""Places and running sums in a total order, without a hot group in one task.

Rows are dealt out by range and sorted once; the stored table keeps ``slice``
and ``place``, whose order is the asked one. A group that crosses slices gets its
sums from those of its earlier slices, and a slice border cuts one group at
most, so these offsets are fewer than the slices and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import keep


def in_order(df: DataFrame, order: list, columns: list, label: str, slices: int | None = None) -> DataFrame:
    """``columns`` of ``df`` with slice and place; the bounds are sampled, so the table is stored."""
    dealt = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    placed = dealt.sortWithinPartitions(*order).select(
        *columns, F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("place")
    )
    return keep(placed, label)


def running(placed: DataFrame, group: list[str], sums: dict[str, Column]) -> DataFrame:
    """``placed`` with, per name, the sum over the group's rows up to and including this one."""
    rows = placed.withColumns({f"_{name}": value for name, value in sums.items()})
    ends = rows.groupBy(*group, "slice").agg(*[F.sum(f"_{name}").alias(f"_{name}") for name in sums])
    earlier = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(
        *[F.col(g).alias(f"_group_{g}") for g in group], F.col("slice").alias("_in"),
        F.lag(F.lit(True)).over(Window.partitionBy(*group).orderBy("slice")).alias("_cut"),
        *[F.sum(f"_{name}").over(earlier).alias(f"_base_{name}") for name in sums],
    ).filter("_cut").drop("_cut")
    same = F.col("slice") == F.col("_in")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_group_{g}"))
    so_far = Window.partitionBy(*group, "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = [
        (F.sum(f"_{name}").over(so_far) + F.coalesce(F.col(f"_base_{name}"), F.lit(0))).alias(name) for name in sums
    ]
    return rows.join(F.broadcast(offsets), same, "left").select(*placed.columns, *totals)
