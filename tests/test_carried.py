"""What is carried from run to run: streamed keys, buckets, running totals, sketches, snapshots, mart status."""

import random
import threading
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from orderlens.catalog import fixtures as fx
from orderlens.catalog.queries import QUERIES
from orderlens.functions.calendar import validity_periods, with_calendar_as_of
from orderlens.operators import lines, prices, sketches
from orderlens.operators.ranking import lower_medians
from orderlens.plans import clv_state, marts
from orderlens.plans import run as run_plan
from orderlens.plans.pipeline import load, processed, run_pipeline
from orderlens.plans.run import BUILDERS, MartsFailed, run_marts
from orderlens.plans.transform import line_buckets
from orderlens.session import fresh_dir, keep
from orderlens.sources import incremental as inc
from orderlens.sources import readers, sinks
from orderlens.streaming.ingest import ingest_distinct, ingested

EVENT = "id long, ts timestamp, note string"


class Stream:
    def __init__(self, spark, **options):
        self.spark, self.root, self.options = spark, fresh_dir(spark, "distinct"), options

    def send(self, *rows):
        df = self.spark.createDataFrame([(i, datetime(2024, 1, d), n) for i, d, n in rows], EVENT)
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        return self.run()

    def run(self):
        schema = self.spark.createDataFrame([], EVENT).schema
        ingest_distinct(
            self.spark, f"{self.root}/in", schema, "ts", ["id"], f"{self.root}/out", f"{self.root}/ckpt", **self.options
        )
        found = ingested(self.spark, f"{self.root}/out", schema)
        return sorted((r.id, r.ts.day) for r in found.collect())


def test_repeated_keys_and_files_count_once_and_late_rows_arrive(spark):
    stream = Stream(spark)
    assert stream.send((1, 20, "a"), (2, 21, "a"), (1, 20, "a")) == [(1, 20), (2, 21)]
    # The same file again under another name, and a key again with other content.
    assert stream.send((1, 20, "a"), (2, 21, "a"), (1, 20, "a"), (2, 22, "b")) == [(1, 20), (2, 21)]
    assert stream.send((3, 1, "late"), (4, 30, "a")) == [(1, 20), (2, 21), (3, 1), (4, 30)]
    assert stream.send((5, 1, "later still")) == [(1, 20), (2, 21), (3, 1), (4, 30), (5, 1)]
    assert len(stream.run()) == 5


def test_a_batch_lost_after_its_write_is_not_written_twice(spark):
    """The commit log's last entry is lost: the batch runs again from the checkpoint with the same result."""
    stream = Stream(spark, max_files=1)
    before = stream.send((1, 20, "a"), (2, 21, "a"))
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{stream.root}/ckpt/commits")
    files = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max((s.getPath() for s in files.listStatus(commits) if s.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
    files.delete(last, False)
    assert stream.run() == before
    assert stream.send((2, 21, "a"), (3, 22, "a")) == [*before, (3, 22)]


def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir):
    root, by_line = fresh_dir(spark, "bucketed"), line_buckets(4)
    sinks.write_observed(fx.order_items(spark, sf_dir), f"{root}/items", "overwrite", buckets=by_line)
    sinks.write_observed(fx.order_item_options(spark, sf_dir), f"{root}/options", "overwrite", buckets=by_line)
    items, options = (readers.read_bucketed(spark, f"{root}/{t}", by_line) for t in ("items", "options"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        revenue = plan_of(lines.line_revenue(items, options))
        assert "SortMergeJoin" in revenue and "Exchange" not in revenue
        with_rule = plan_of(lines.line_revenue(prices.plausible_prices(items), options))
        assert "Exchange hashpartitioning" not in with_rule
        children = plan_of(inc.incremental_children(options, items))
        assert "LeftSemi" in children and "Exchange" not in children
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert items.count() == fx.order_items(spark, sf_dir).count()


def test_larger_tables_get_more_buckets(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKET_ROWS", 500)
    counts, write = [], sinks.write_observed
    monkeypatch.setattr(sinks, "write_observed", lambda *a, **k: (counts.append(k["buckets"].count), write(*a, **k))[1])
    rows = fx.table(spark, sf_dir, "lineitem").count()
    assert QUERIES["line_revenue_bucketed"](spark, sf_dir).count() > 0
    assert len(counts) == 2 and set(counts) == {-(-rows // 500)} and counts[0] > 8


def test_the_pipeline_over_buckets(spark, sf_dir):
    root = fresh_dir(spark, "stages")
    tables = fx.raw_order_items(spark, sf_dir), fx.raw_order_item_options(spark, sf_dir), fx.raw_date_dim(spark, sf_dir)
    only = {"sales_trends": BUILDERS["sales_trends"]}
    for day in ("2024-01-01", "2024-01-02"):
        status = run_pipeline(spark, *tables, root, day, extraction={"buckets": 4}, builders=only, threshold=fx.THRESHOLD)
    base = fx.sales_base(spark, sf_dir)
    assert status.first().row_count == marts.sales_trends(base.slices, base.date_dim).count()
    assert "Bucketed: true" in plan_of(processed(spark, root, 4)[0].groupBy("order_id", "lineitem_id").count())
    with pytest.raises(ValueError, match="not both"):
        load(spark, *tables, root, "2024-01-03", by="day", buckets=4)


SLICE = "user_id long, order_id long, order_date date, total_revenue decimal(34,6), line_count long"
DIM = "date_key date, is_holiday boolean, holiday_name string"


def slices_of(spark, rows):
    return spark.createDataFrame([(*r[:3], Decimal(r[3]), r[4]) for r in rows], SLICE)


def clv_of(df):
    columns = ("user_id", "order_date", "daily_revenue", "cumulative_clv", "is_likely_non_individual")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_carried_totals_equal_the_whole_mart_after_every_increment(spark):
    draw = random.Random(5)
    day = lambda: draw.choice([None, date(2024, draw.randint(1, 4), draw.randint(1, 28))])
    rows = [(draw.choice([None, 1, 2, 3, 4, 5]), n, day(), draw.randint(-5, 99), draw.randint(1, 4)) for n in range(120)]
    dim = spark.createDataFrame([(date(2024, 1, 1), True, "x")], DIM)
    root, seen = fresh_dir(spark, "clv"), []
    for part in (rows[:50], rows[50:52], [], rows[52:]):
        seen += part
        clv_state.advance_clv(spark, slices_of(spark, part), root)
        whole = marts.clv_daily(slices_of(spark, seen), dim, 20)
        assert clv_of(clv_state.clv_daily(spark, root, dim, 20)) == clv_of(whole)
    assert clv_state.last_run(spark, root) == 4


def test_new_days_write_their_rows_alone_and_a_failed_run_is_repeated(spark, monkeypatch):
    root = fresh_dir(spark, "clv")
    part = lambda *rows: slices_of(spark, rows)
    clv_state.advance_clv(spark, part((1, 1, date(2024, 1, 1), 5, 1), (2, 2, date(2024, 1, 2), 7, 1)), root, "day")
    later = part((1, 3, date(2024, 1, 3), 1, 1), (2, 4, date(2024, 1, 1), 2, 1))
    with monkeypatch.context() as patch:
        patch.setattr(clv_state, "small_table", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            clv_state.advance_clv(spark, later, root, "day")
    # New: the third day of customer 1; the first and, moved by it, the second day of customer 2.
    assert clv_state.advance_clv(spark, later, root, "day") == 4  # with customer 1's first day, which shares its period
    found = clv_of(clv_state.clv_daily(spark, root, spark.createDataFrame([], DIM), 1))
    assert [(r[0], r[1].day, r[3]) for r in found] == [(1, 1, 5.0), (1, 3, 6.0), (2, 1, 2.0), (2, 2, 9.0)]
    assert clv_state.advance_clv(spark, part((1, 9, date(2024, 1, 9), 1, 1)), root, "day") == 1


def test_history_is_read_by_pruned_periods(spark):
    path = fresh_dir(spark, "daily")
    rows = spark.range(40).selectExpr("id % 2 AS user_id", "date_add(date'2024-01-01', int(id)) AS order_date", "cast(1 AS decimal(34,6)) AS revenue")
    rows.withColumn("order_period", F.col("order_date")).write.partitionBy("order_period").parquet(path)
    late = keep(spark.createDataFrame([(1, date(2024, 2, 1), date(2024, 2, 1))], "user_id long, first_day date, first_period date"), "late")
    history = clv_state.late_history(spark.read.parquet(path), late)
    assert sorted(r.order_date.day for r in history.collect()) == [1, 3, 5, 7, 9]
    assert "PartitionFilters: [isnotnull(order_period" in plan_of(history)


def test_sketched_medians_keep_their_stated_error(spark):
    rows = spark.range(200_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('item', id % 40)) AS item_name", "cast(hash(id) % 10000 AS double) / 7 AS item_price",
        "date_add(date'2024-01-01', int(id % 30)) AS order_date",
    )
    daily = keep(sketches.price_sketches(rows), "daily")
    ranked = sketches.rank_interval(rows, keep(sketches.sketched_quantiles(daily), "found")).collect()
    assert len(ranked) == 41
    for row in ranked:
        assert row.below - 2 * sketches.RANK_ERROR <= 0.5 <= row.upto + 2 * sketches.RANK_ERROR, row
    # A range of days is the merge of its days; a few rows are exact.
    few = rows.filter("order_date < date'2024-01-02' and item_name != 'hot'")
    exact = {r.item_name: (r.median, r.row_count) for r in lower_medians(few, "item_name", "item_price").collect()}
    some = sketches.sketched_quantiles(daily.filter("order_date < date'2024-01-02' and item_name != 'hot'")).collect()
    assert {r.item_name: (r.median_item_price, r.row_count) for r in some} == exact


def test_sketches_of_odd_prices(spark):
    rows = [("a", None), ("a", float("nan")), ("b", 3.0), ("b", float("inf")), (None, 1.0), ("c", 1.0), ("c", 2.0)]
    df = spark.createDataFrame([(*r, date(2024, 1, 1)) for r in rows], "item_name string, item_price double, order_date date")
    found = {r.item_name: (r.median_item_price, r.row_count) for r in sketches.sketched_quantiles(sketches.price_sketches(df)).collect()}
    assert found == {"a": (None, 2), "b": (3.0, 2), "c": (1.0, 2)}
    assert sketches.sketched_quantiles(sketches.price_sketches(df.limit(0))).collect() == []


def test_sketched_totals_and_returning_customers(spark):
    df = spark.range(60_000).selectExpr(
        "id AS order_id", "if(id % 5 = 0, null, id % 20000) AS user_id", "id % 2 AS restaurant_id", "1L AS line_count",
        "cast(1.5 AS decimal(34,6)) AS total_revenue", "date_add(date'2024-01-01', int(id / 6000)) AS order_date",
    )
    daily = keep(sketches.total_sketches(df, ["restaurant_id"]), "daily")
    for row in sketches.sketched_totals(daily, ["restaurant_id"]).collect():
        assert row.total_revenue == 45_000.0
        assert abs(row.order_count / 30_000 - 1) < 0.05 and abs(row.distinct_customers / 8_000 - 1) < 0.05
    early, late = daily.filter("order_date < date'2024-01-02'"), daily.filter("order_date >= date'2024-01-05'")
    returning = sketches.returning_customers(early, late, ["restaurant_id"]).collect()
    assert len(returning) == 2 and all(abs(r.returning / 2_400 - 1) < 0.05 for r in returning)


def snapshots(spark, rows):
    schema = "date_key date, is_holiday boolean, holiday_name string, dt date, batch long"
    return spark.createDataFrame([(date(2024, 5, d), h, n, date(2024, 1, t), b) for d, h, n, t, b in rows], schema)


def test_a_changed_holiday_is_seen_as_it_was_on_the_run_day(spark):
    taken = snapshots(spark, [
        (1, False, None, 1, 1), (2, False, None, 1, 1), (1, False, None, 3, 2), (2, False, None, 3, 2),
        (1, True, "wrong", 5, 3), (1, True, "May Day", 5, 4), (2, False, None, 5, 4), (1, False, None, 7, 5),
    ])
    periods = keep(validity_periods(taken), "validity")
    found = sorted((r.date_key.day, r.valid_from.day, r.valid_to and r.valid_to.day, r.holiday_name) for r in periods.collect())
    assert found == [(1, 1, 5, None), (1, 5, 7, "May Day"), (1, 7, None, None), (2, 1, 7, None)]
    asked = spark.createDataFrame(
        [(date(2024, 5, d), date(2024, 1, a)) for d in (1, 2, 3) for a in (1, 4, 5, 6, 7, 9)] + [(None, date(2024, 1, 1)), (date(2024, 5, 1), date(2023, 12, 31))],
        "order_date date, as_of date",
    )
    seen = {(r.order_date and r.order_date.day, r.as_of.day): r.is_holiday for r in with_calendar_as_of(asked, "order_date", "as_of", periods).collect()}
    assert [seen[1, a] for a in (1, 4, 5, 6, 7, 9)] == [False, False, True, True, False, False]
    assert [seen[2, a] for a in (1, 6, 7)] == [False, False, None] and seen[3, 4] is None and seen[None, 1] is None
    assert seen[1, 31] is None


def test_conflicting_facts_of_one_snapshot_stop_by_name(spark):
    taken = snapshots(spark, [(1, False, None, 1, 1), (1, True, "x", 1, 1)])
    with pytest.raises(Exception, match="conflicting rows for 2024-05-01"):
        validity_periods(taken).collect()


def test_a_failed_mart_alone_is_rebuilt(spark, sf_dir, monkeypatch):
    root, base, built, at_once = fresh_dir(spark, "resumed"), fx.sales_base(spark, sf_dir), [], []
    first, both = ("sales_trends", "loyalty_impact", "customer_segments_rfm", "churn_risk"), threading.Barrier(2, timeout=60)
    down = {"churn_risk"}

    def counted(name):
        def build(b):
            built.append(name)
            if name in ("sales_trends", "loyalty_impact") and not at_once:
                both.wait()  # passes only if two marts are built at a time
            if name in down:
                raise ValueError("broken rule")
            at_once.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
            return BUILDERS[name](b)

        return build

    builders = {name: counted(name) for name in first}
    noted = {"workers": 2, "status_path": f"{root}/status", "run_key": "monday"}
    made = []
    monkeypatch.setattr("orderlens.plans.base.customer_base", lambda *a: made.append(1) or marts.customer_base(*a))
    with pytest.raises(MartsFailed, match="churn_risk"):
        run_marts(spark, base, f"{root}/marts", builders, **noted)
    assert sorted(built) == sorted(first) and len(made) == 1 and set(at_once) == {*first} - down
    down.clear()
    built.clear()
    status = {r.mart: r for r in run_marts(spark, base, f"{root}/marts", builders, **noted).collect()}
    assert built == ["churn_risk"]
    assert {n: s.status for n, s in status.items()} == {**dict.fromkeys(first, "kept"), "churn_risk": "success"}
    assert all(s.row_count == spark.read.parquet(f"{root}/marts/{n}").count() for n, s in status.items())
    built.clear()
    run_marts(spark, base, f"{root}/marts", builders, **{**noted, "run_key": "tuesday"})
    assert sorted(built) == sorted(first)
    with pytest.raises(ValueError, match="run_key"):
        run_marts(spark, base, f"{root}/marts", builders, status_path=f"{root}/status")
    assert run_plan.finished_marts(spark, f"{root}/none", "monday") == {}


def test_a_second_attempt_starts_from_the_stored_slices(spark, sf_dir, monkeypatch):
    root, base, down, folded = fresh_dir(spark, "resumed"), fx.sales_base(spark, sf_dir), [1], []
    monkeypatch.setattr("orderlens.plans.base.order_slices", lambda df: (folded.append(1), lines.order_slices(df))[1])

    def late(b):
        if down:
            raise ValueError("not today")
        return BUILDERS["sales_trends"](b)

    builders = {"sales_trends": late, "discount_effectiveness": BUILDERS["discount_effectiveness"]}
    noted = {"status_path": f"{root}/status", "run_key": "monday", "raise_on_failure": False}
    run_marts(spark, base, f"{root}/marts", builders, **noted)
    stored = run_plan._shared_paths(spark, f"{root}/status-shared", "monday")
    down.clear()
    status = {r.mart: r.status for r in run_marts(spark, base, f"{root}/marts", builders, **noted).collect()}
    assert status == {"sales_trends": "success", "discount_effectiveness": "kept"} and len(folded) == 1
    expected = marts.sales_trends(base.slices, base.date_dim)
    found = spark.read.parquet(f"{root}/marts/sales_trends")
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(stored[0].slices)
    # The tables are gone: one more mart under the same key builds them again.
    more = {**builders, "clv_daily": BUILDERS["clv_daily"]}
    folded.clear()
    assert [r.status for r in run_marts(spark, base, f"{root}/marts", more, **noted).collect()] == ["kept", "kept", "success"]
    assert len(folded) == 1


def test_notes_made_at_a_time_are_all_kept(spark):
    path, names = f"{fresh_dir(spark, 'notes')}/status", [f"mart{i}" for i in range(24)]
    threads = [threading.Thread(target=run_plan._note, args=(spark, path, "monday", (n, "success", 1))) for n in names]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join(120)
    assert sorted(run_plan.finished_marts(spark, path, "monday")) == sorted(names)
