"""Exact order statistics without sorting everything, or a hot group, on one task.

``Window.orderBy`` without a partition key moves every row to a single task, and
with one it moves a whole group there. The operators here need only a few rows
at known positions. So the entries are range-partitioned into slices of bounded
size, the slices are counted, and only within the slices that hold a wanted
position are rows numbered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import PACKED, keep, keep_counted, small_table

SLICE_ROWS = 2_000_000


def sliced(entries: DataFrame, keys: list[Column], entry_count: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``entries`` with the number of their slice, ranges of ``keys`` of bounded size.

    Stored, because range bounds are sampled and must not be drawn twice; when the sample
    was so poor that a slice has more than twice its rows, all are cut finer.
    """
    slices = max(1, math.ceil(entry_count / slice_rows))
    while True:
        placed = keep(entries.repartitionByRange(slices, *keys).withColumn("slice", F.spark_partition_id()), "placed", **PACKED)
        # One slice holds no more than all entries, so there is nothing to count.
        if slices == 1 or slices >= entry_count:
            return placed
        fullest = placed.groupBy("slice").count().agg(F.max("count")).first()[0] or 0
        if fullest <= 2 * slice_rows:
            return placed
        slices = min(2 * slices, entry_count)


def _inside(position: str = "position") -> Column:
    """Whether a span that ends at ``upto`` and covers ``n`` positions holds ``position``."""
    return (F.col(position) <= F.col("upto")) & (F.col(position) > F.col("upto") - F.col("n"))


FROM_START = (Window.unboundedPreceding, Window.currentRow)


def at_positions(
    entries: DataFrame,
    group: str,
    order: list[Column],
    wanted: DataFrame,
    entry_count: int,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The entry at each wanted 1-based position of its group.

    An entry covers ``weight`` consecutive positions and ``(group, *order)`` is
    unique. ``wanted`` has (group, position). The slices are counted, and only those that hold a
    wanted position are numbered.
    """
    placed = sliced(entries, [F.col(group), *order], entry_count, slice_rows)
    by_slice = Window.partitionBy(group).orderBy("slice").rowsBetween(*FROM_START)
    spans = (
        placed.groupBy(group, "slice")
        .agg(F.sum("weight").alias("n"))
        .withColumn("upto", F.sum("n").over(by_slice))
    )
    target = spans.join(wanted, group).filter(_inside()).select(
        group, "slice", "position", (F.col("position") - F.col("upto") + F.col("n")).alias("offset")
    )
    within = Window.partitionBy(group, "slice").orderBy(*order).rowsBetween(*FROM_START)
    numbered = placed.join(target.select(group, "slice").distinct(), [group, "slice"], "left_semi").withColumn(
        "last", F.sum("weight").over(within)
    )
    return (
        numbered.join(target, [group, "slice"])
        .filter((F.col("offset") <= F.col("last")) & (F.col("offset") > F.col("last") - F.col("weight")))
        .select("position", *entries.columns)
    )


def _sortable(measure: str) -> Column:
    """Nulls sort first, as in an ascending window order."""
    return F.coalesce(F.col(measure).cast("double"), F.lit(float("-inf")))


def bucket_ends(rows: int, buckets: int) -> list[int]:
    """Last 1-based position of every bucket but the last; early buckets take the remainder."""
    size, extra = divmod(rows, buckets)
    return [size * b + min(b, extra) for b in range(1, buckets)]


def distributed_ntile(
    df: DataFrame,
    scores: dict[str, str],
    tie: str,
    buckets: int = 5,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``ntile(buckets)`` over all rows for each ``{output: measure}``.

    ``df`` is a stored table and ``tie`` is unique and never null in it, which
    makes every order total. Rows are scored by comparing each with the last row of
    each bucket: no shuffle of whole rows, and only those few rows reach the driver.
    """
    rows = df.count()
    measures = list(dict.fromkeys(scores.values()))
    pairs = [F.struct(F.lit(m).alias("measure"), _sortable(m).alias("value")) for m in measures]
    entries = df.select(F.explode(F.array(*pairs)).alias("e"), F.col(tie).alias("tie")).select(
        "e.measure", "e.value", "tie", F.lit(1).cast("long").alias("weight")
    )
    ends = bucket_ends(rows, buckets)
    wanted = small_table(
        df.sparkSession,
        [(m, end) for m in measures for end in sorted(set(ends)) if end],
        "measure string, position long",
    )
    order = [F.col("value"), F.col("tie")]
    found = at_positions(entries, "measure", order, wanted, rows * len(measures), slice_rows).collect()
    edges = {(r["measure"], r["position"]): r for r in found}

    def score(measure: str) -> Column:
        value, bucket = _sortable(measure), F.lit(buckets)
        for number, end in reversed(list(enumerate(ends, start=1))):
            edge = edges.get((measure, end))
            if edge is not None:
                inside = (value < edge["value"]) | ((value == edge["value"]) & (F.col(tie) <= F.lit(edge["tie"])))
                bucket = F.when(inside, number).otherwise(bucket)
        return bucket

    return df.withColumns({out: score(m) for out, m in scores.items()})


def lower_medians(df: DataFrame, group: str, value: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(group, median, row_count): exact lower median of ``value`` per group.

    Each group is first folded to its distinct values, so a hot group with a few
    hundred prices is as cheap as any other; the folded values are sliced, so one with
    very many is not sorted on one task either. Null values
    are counted in row_count but do not take part in the median.
    """
    histogram, entries = keep_counted(df.groupBy(group, value).agg(F.count(F.lit(1)).alias("weight")), "histogram", **PACKED)
    order = [F.col(value).asc_nulls_last()]
    placed = sliced(histogram, [F.col(group), *order], entries, slice_rows)
    whole, by_slice = Window.partitionBy(group), Window.partitionBy(group).orderBy("slice").rowsBetween(*FROM_START)
    known = F.sum(F.when(F.col(value).isNotNull(), F.col("weight")).otherwise(0))
    # A group of nulls only has its null entry as the first position.
    middle = F.greatest(F.floor((F.sum("known").over(whole) + 1) / 2), F.lit(1)).cast("long")
    spans = placed.groupBy(group, "slice").agg(F.sum("weight").alias("n"), known.alias("known")).select(
        group, "slice", "n", F.sum("n").over(by_slice).alias("upto"), F.sum("n").over(whole).alias("row_count"), middle.alias("position")
    )
    # One slice per group is left, so the rows to be numbered are not multiplied.
    target = spans.filter(_inside()).select(group, "slice", "row_count", (F.col("position") - F.col("upto") + F.col("n")).alias("offset"))
    within = Window.partitionBy(group, "slice").orderBy(*order).rowsBetween(*FROM_START)
    numbered = placed.join(target, [group, "slice"]).withColumn("last", F.sum("weight").over(within))
    found = numbered.filter((F.col("offset") <= F.col("last")) & (F.col("offset") > F.col("last") - F.col("weight")))
    return found.select(group, F.col(value).alias("median"), "row_count")


def exact_percentiles(df: DataFrame, value: str, fractions: list[float], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rows (fraction, value): exact percentiles with linear interpolation.

    The rows are first reduced to a histogram, so a repeated value costs one
    entry, and the histogram is searched by position.
    """
    histogram = keep(
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("weight")),
        "histogram",
    )
    distinct, rows = histogram.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    if not rows:
        return small_table(df.sparkSession, [(float(f), None) for f in fractions], "fraction double, value double")
    ranks = {f: f * (rows - 1) for f in fractions}
    positions = sorted({int(p) + 1 for r in ranks.values() for p in (math.floor(r), math.ceil(r))})
    wanted = small_table(df.sparkSession, [("all", p) for p in positions], "measure string, position long")
    entries = histogram.select(F.lit("all").alias("measure"), "value", "weight")
    found = at_positions(entries, "measure", [F.col("value")], wanted, distinct, slice_rows).collect()
    at = {r["position"]: r["value"] for r in found}
    answer = []
    for fraction, rank in ranks.items():
        low, high = at[math.floor(rank) + 1], at[math.ceil(rank) + 1]
        answer.append((float(fraction), low + (high - low) * (rank - math.floor(rank))))
    return small_table(df.sparkSession, answer, "fraction double, value double")
