"""Every operator and mart as a query over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.catalog import fixtures as fx
from orderlens.functions import times
from orderlens.functions.calendar import validity_periods, with_calendar, with_calendar_as_of
from orderlens.functions.columns import MONEY_SCALE, price_tier, snake_lower
from orderlens.operators import accounts, lines, prices, sketches
from orderlens.operators.ranking import SLICE_ROWS
from orderlens.plans import clv_state, marts, quality
from orderlens.plans.base import SalesBase
from orderlens.plans.pipeline import load, run_pipeline
from orderlens.plans.refresh import PERIOD
from orderlens.plans.run import BUILDERS, run_marts
from orderlens.plans.transform import line_buckets, process_dates
from orderlens.session import fresh_dir, keep, small_table
from orderlens.sources import incremental as inc
from orderlens.sources import marks, readers, sinks
from orderlens.streaming.ingest import ingest_available, ingest_distinct, ingested

Query = Callable[[SparkSession, str], DataFrame]
# Marks that split the driver's events and orders into an old and a new part.
EVENT_MARK = "2024-01-16T00:00:00.000000Z"
ORDER_MARK = "1998-06-30T12:00:00.000000Z"
LAST_DAY = "1998-06-30T00:00:00"
# Lines from this day to the mark arrive with a wrong day first; the second run's overlap reaches back to it.
MOVED_FROM, OVERLAP_DAYS, SECOND_MARK = "1998-06-10T00:00:00", 30, "1999-12-31T00:00:00"
CLV_DAYS = ("1996-12-31", "1998-12-31")


def _time_text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")


# --- sources, sinks, increments -------------------------------------------


def scan_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = readers.read_source(spark, "parquet", f"{sf_dir}/events.parquet")
    return events.select("event_id", "user_id", "event_type", "value")


def incremental_orders(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return inc.incremental(events, "ts", EVENT_MARK).select("event_id", "user_id", "event_type", "value")


def incremental_order_items(spark, sf_dir):
    """The increment by text time in mixed forms."""
    items = inc.incremental_text(fx.raw_order_items(spark, sf_dir), "CREATION_TIME_UTC", ORDER_MARK)
    return items.select("ORDER_ID", "LINEITEM_ID", "CREATION_TIME_UTC")


def incremental_children(spark, sf_dir):
    parents = inc.incremental_text(fx.raw_order_items(spark, sf_dir), "CREATION_TIME_UTC", ORDER_MARK)
    children = inc.incremental_children(fx.raw_order_item_options(spark, sf_dir), parents, ["ORDER_ID", "LINEITEM_ID"])
    return children.withColumn("OPTION_PRICE", F.round("OPTION_PRICE", 6))


def checkpoint_advance(spark, sf_dir):
    """The mark before and after one run over the events."""
    path = fresh_dir(spark, "marks")
    before = marks.read_mark(spark, path, "events")
    seen = inc.incremental(fx.table(spark, sf_dir, "events"), "ts", before)
    marks.advance_mark(spark, path, "events", marks.increment_mark(seen, "ts").first()[0])
    after = marks.read_mark(spark, path, "events")
    return small_table(spark, [("events", before, after)], "name string, mark_before string, mark_after string")


def dim_snapshot_latest(spark, sf_dir):
    """Two snapshots of the calendar are stored; only the later one is read."""
    root = fresh_dir(spark, "raw-date-dim")
    dim = fx.raw_date_dim(spark, sf_dir)
    sinks.write_raw(dim, root, "2024-01-01", 0)
    sinks.write_raw(dim, root, "2024-01-02", 0)
    return readers.latest_snapshot(readers.read_raw(spark, root)).select("DATE_KEY", "IS_HOLIDAY", "HOLIDAY_NAME")


def _repeated_keys(spark, sf_dir, **options):
    root = fresh_dir(spark, "raw-events")
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    sinks.write_raw(events, root, "2024-01-01", 0)
    sinks.write_raw(events.filter(F.col("event_type") == "error"), root, "2024-01-02", 1)
    kept = readers.drop_superseded(readers.read_raw(spark, root), ["event_id"], **options)
    return kept.select("event_id", "user_id", "event_type", "value", F.col("dt").cast("string").alias("dt"))


def raw_partition_roundtrip(spark, sf_dir):
    """Events stored as two increments; keys extracted twice count once."""
    return _repeated_keys(spark, sf_dir)


def raw_partition_shuffled(spark, sf_dir):
    """The same by the plan of repeated keys that are too many to broadcast."""
    return _repeated_keys(spark, sf_dir, max_broadcast_rows=0)


def mart_write_roundtrip(spark, sf_dir):
    path = f"{fresh_dir(spark, 'marts')}/sales_trends"
    base = fx.sales_base(spark, sf_dir)
    for _ in range(2):
        sinks.overwrite_table(marts.sales_trends(base.slices, base.date_dim), path)
    return spark.read.parquet(path)


def row_counts(spark, sf_dir):
    """Rows per processed table, observed while it is written."""
    out = fresh_dir(spark, "processed")
    tables = {
        "order_items": fx.order_items(spark, sf_dir),
        "order_item_options": fx.order_item_options(spark, sf_dir),
        "date_dim": fx.date_dim(spark, sf_dir),
    }
    counts = [(name, sinks.overwrite_table(df, f"{out}/{name}")) for name, df in tables.items()]
    return small_table(spark, counts, "table_name string, row_count long")


def ingest_available_now(spark, sf_dir):
    """The stream runs twice; the second run finds nothing new."""
    root = fresh_dir(spark, "ingest")
    schema = fx.table(spark, sf_dir, "events").schema
    for _ in range(2):
        ingest_available(spark, sf_dir, schema, "ts", f"{root}/sink", f"{root}/checkpoint", "events.parquet")
    return ingested(spark, f"{root}/sink", schema).select("event_id", "user_id", "event_type", "value")


def ingest_distinct_keys(spark, sf_dir):
    """A stream that gets part of the events, then all of them twice; every event counts once, late ones too."""
    root = fresh_dir(spark, "distinct")
    events = fx.table(spark, sf_dir, "events")
    for part in (events.filter(F.col("ts") > EVENT_MARK[:-1]), events, events):
        part.write.mode("append").parquet(f"{root}/in")
        ingest_distinct(spark, f"{root}/in", events.schema, "ts", ["event_id"], f"{root}/sink", f"{root}/checkpoint")
    return ingested(spark, f"{root}/sink", events.schema).select("event_id", "user_id", "event_type", "value")


def staged_sales_trends(spark, sf_dir):
    """Extract in two runs, transform, then build a mart from the stored tables."""
    root = fresh_dir(spark, "stages")
    items, options = fx.stored_raw_items(spark, sf_dir), fx.raw_order_item_options(spark, sf_dir)
    dim = fx.raw_date_dim(spark, sf_dir)
    early = items.filter(F.col("CREATION_TIME_UTC") <= ORDER_MARK)
    only = {"sales_trends": BUILDERS["sales_trends"]}
    for dt, available in (("2024-01-01", early), ("2024-01-02", items)):
        run_pipeline(spark, available, options, dim, root, dt, threshold=fx.THRESHOLD, builders=only)
    return spark.read.parquet(f"{root}/marts/sales_trends")


def extract_overlap_backfill(spark, sf_dir):
    """A base run, then on one day an overlap that finds late rows and an ordinary run; nothing is lost.

    Late are the orders of odd number of the last day before the mark.
    """
    root = fresh_dir(spark, "backfill")
    items, options = fx.stored_raw_items(spark, sf_dir), fx.raw_order_item_options(spark, sf_dir)
    dim = fx.raw_date_dim(spark, sf_dir)
    until_mark, last_day = F.col("CREATION_TIME_UTC") <= ORDER_MARK, F.col("CREATION_TIME_UTC") >= LAST_DAY
    late = until_mark & last_day & (F.col("ORDER_ID") % 2 == 1)
    runs = (
        ("2024-01-01", items.filter(until_mark & ~late), 0),
        ("2024-01-02", items.filter(until_mark), 2 * 86_400),
        ("2024-01-02", items, 0),
    )
    for dt, available, overlap in runs:
        load(spark, available, options, dim, root, dt, overlap_seconds=overlap)
    return spark.read.parquet(f"{root}/processed/order_items").select("order_id", "lineitem_id", "item_name")


def _damaged(items: DataFrame, *sound: int) -> DataFrame:
    """Some orders get times that cannot be read; those divisible by a number of ``sound`` keep theirs."""
    text, order = F.col("CREATION_TIME_UTC"), F.col("ORDER_ID")
    kept = F.lit(False)
    for number in sound:
        kept = kept | (order % number == 0)
    spoilt = (
        F.when(kept, text).when(order % 23 == 0, "not a time").when(order % 29 == 0, F.lit(None))
        .when(order % 31 == 0, F.concat(F.substring(text, 9, 2), F.lit("/"), F.substring(text, 6, 2), F.lit("/"), F.substring(text, 1, 4)))
        .otherwise(text)
    )
    return items.withColumn("CREATION_TIME_UTC", spoilt)


def quarantine_split(spark, sf_dir):
    """Two runs over items with damaged times, some of them mended before the second run."""
    root = fresh_dir(spark, "quarantine")
    items, options = fx.stored_raw_items(spark, sf_dir), fx.raw_order_item_options(spark, sf_dir)
    dim = fx.raw_date_dim(spark, sf_dir)
    early = _damaged(items.filter(F.col("CREATION_TIME_UTC") <= ORDER_MARK))
    load(spark, early, options, dim, root, "2024-01-01")
    load(spark, _damaged(items, 46, 58), options, dim, root, "2024-01-02", recheck=True)
    sound = spark.read.parquet(f"{root}/processed/order_items")
    held = spark.read.parquet(f"{root}/processed/order_items_quarantine")
    places = [
        sound.select("order_id", "lineitem_id", F.lit("processed").alias("place"), F.lit(None).cast("string").alias("reason")),
        held.select("order_id", "lineitem_id", F.lit("quarantine").alias("place"), "reason"),
    ]
    return places[0].unionByName(places[1])


def late_options_in_marts(spark, sf_dir):
    """A third of the options comes after its items were extracted, and reaches the mart all the same."""
    root = fresh_dir(spark, "late-options")
    items, options = fx.stored_raw_items(spark, sf_dir), fx.raw_order_item_options(spark, sf_dir)
    dim = fx.raw_date_dim(spark, sf_dir)
    only = {"sales_trends": BUILDERS["sales_trends"]}
    for dt, available in (("2024-01-01", options.filter(F.col("ORDER_ID") % 3 != 0)), ("2024-01-02", options)):
        run_pipeline(
            spark, items, available, dim, root, dt, extraction={"late_options": True}, threshold=fx.THRESHOLD, builders=only
        )
    return spark.read.parquet(f"{root}/marts/sales_trends")


def refresh_by_month(spark, sf_dir):
    """Processed tables by month after three increments; the second one moves lines to other months."""
    root = fresh_dir(spark, "by-month")
    items, options = fx.stored_raw_items(spark, sf_dir), fx.raw_order_item_options(spark, sf_dir)
    dim = fx.raw_date_dim(spark, sf_dir)
    text = F.col("CREATION_TIME_UTC")
    moved = (F.col("ORDER_ID") % 5 == 0) & (text <= ORDER_MARK) & (text >= MOVED_FROM)
    before = F.concat(F.date_sub(F.to_date(F.substring(text, 1, 10)), 40).cast("string"), F.substring(text, 11, 30))
    wrong = items.withColumn("CREATION_TIME_UTC", F.when(moved, before).otherwise(text))
    runs = (
        ("2024-01-01", wrong.filter(text <= ORDER_MARK), {}),
        ("2024-01-02", items.filter(text <= SECOND_MARK), {"overlap_seconds": OVERLAP_DAYS * 86_400}),
        ("2024-01-03", items, {}),
    )
    for dt, available, extraction in runs:
        load(spark, available, options, dim, root, dt, by="month", **extraction)
    lines = spark.read.parquet(f"{root}/processed/order_items")
    extras = spark.read.parquet(f"{root}/processed/order_item_options")
    keys = ["order_id", "lineitem_id", PERIOD]
    extras = extras.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    lines = lines.select(*keys, "item_name", F.to_date("creation_time_utc").alias("order_date"))
    return lines.join(extras, keys, "left").select(
        "order_id", "lineitem_id", "item_name", "order_date", PERIOD, F.coalesce("n", F.lit(0)).alias("n_options")
    )


# --- projections and parsing ------------------------------------------------


def normalize_columns(spark, sf_dir):
    lowered = snake_lower(fx.raw_order_items(spark, sf_dir))
    return lowered.select("order_id", "lineitem_id", "user_id", "restaurant_id", "is_loyalty", "item_name")


def parse_mixed_timestamps(spark, sf_dir):
    raw = snake_lower(fx.raw_order_items(spark, sf_dir)).withColumn("raw_text", F.col("creation_time_utc"))
    parsed = times.parse_timestamps(raw, "creation_time_utc")
    return parsed.select(
        "order_id", "lineitem_id", "raw_text", _time_text("creation_time_utc").alias("creation_time"),
        F.to_date("creation_time_utc").alias("order_date"),
    )


def parse_dates(spark, sf_dir):
    return times.parse_dates(snake_lower(fx.raw_date_dim(spark, sf_dir)), "date_key")


def parse_failures(spark, sf_dir):
    """Item times against the first format alone: whole seconds fail it."""
    raw = snake_lower(fx.raw_order_items(spark, sf_dir))
    strict = times.parsed_time("creation_time_utc", times.TIME_FORMATS[:1])
    return times.parse_failures(raw, "creation_time_utc", strict)


def price_tier_labels(spark, sf_dir):
    items = fx.order_items(spark, sf_dir)
    return items.select("order_id", "lineitem_id", price_tier().alias("price_tier"))


def calendar_attrs(spark, sf_dir):
    days = fx.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("order_date")).distinct()
    return with_calendar(days, "order_date", fx.date_dim(spark, sf_dir), holiday_name=True)


# --- prices, lines, accounts -------------------------------------------------


def item_median_price(spark, sf_dir):
    return prices.item_medians(fx.order_items(spark, sf_dir))


def price_anomalies(spark, sf_dir):
    found = prices.price_anomalies(fx.order_items(spark, sf_dir))
    return found.select("order_id", "lineitem_id", "item_name", "item_price", "median_item_price", "price_ratio")


def price_anomalies_shuffled(spark, sf_dir):
    """The same by the plan of medians that are too many to broadcast."""
    found = prices.price_anomalies(fx.order_items(spark, sf_dir), max_broadcast_rows=0)
    return found.select("order_id", "lineitem_id", "item_name", "item_price", "median_item_price", "price_ratio")


def price_anomaly_kept(spark, sf_dir):
    kept = prices.plausible_prices(fx.order_items(spark, sf_dir))
    return kept.select("order_id", "lineitem_id", "item_name", "item_price")


def line_revenue(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    found = lines.line_revenue(base.clean_items, base.options)
    revenue = ("item_revenue", "options_revenue", "total_revenue")
    return found.select("order_id", "lineitem_id", *[F.round(c, MONEY_SCALE).alias(c) for c in revenue])


def line_revenue_bucketed(spark, sf_dir):
    """The same from tables stored in buckets of the line key, joined without a shuffle; large tables get more buckets."""
    count = sinks.buckets_for(fx.table(spark, sf_dir, "lineitem").count())
    root, by_line = fresh_dir(spark, "bucketed"), line_buckets(count)
    tables = {"items": fx.order_items(spark, sf_dir), "options": fx.order_item_options(spark, sf_dir)}
    for name, df in tables.items():
        sinks.write_observed(df, f"{root}/{name}", "overwrite", buckets=by_line)
    items, options = (readers.read_bucketed(spark, f"{root}/{name}", by_line) for name in tables)
    found = lines.line_revenue(prices.plausible_prices(items), options)
    revenue = ("item_revenue", "options_revenue", "total_revenue")
    return found.select("order_id", "lineitem_id", *[F.round(c, MONEY_SCALE).alias(c) for c in revenue])


def line_items_per_customer(spark, sf_dir):
    return accounts.lines_per_customer(fx.sales_base(spark, sf_dir).slices)


def non_individual_flag(spark, sf_dir):
    return accounts.non_individual_flag(fx.sales_base(spark, sf_dir).slices, fx.THRESHOLD)


# --- marts --------------------------------------------------------------------


def clv_daily(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    return marts.clv_daily(base.slices, base.date_dim, base.threshold)


def reference_date(spark, sf_dir):
    return marts.reference_date(fx.sales_base(spark, sf_dir).slices)


def rfm_scores(spark, sf_dir):
    scored = marts.rfm_scores(fx.sales_base(spark, sf_dir).customers)
    return scored.select("user_id", "recency_score", "frequency_score", "monetary_score")


def rfm_scores_distributed(spark, sf_dir):
    """The same scores over many slices, as large customer tables have."""
    customers = fx.sales_base(spark, sf_dir).customers
    scored = marts.rfm_scores(customers, slice_rows=min(SLICE_ROWS, customers.count() // 4 + 1))
    return scored.select("user_id", "recency_score", "frequency_score", "monetary_score")


def customer_segments_rfm(spark, sf_dir):
    return marts.rfm_segments(fx.sales_base(spark, sf_dir).customers)


def churn_risk(spark, sf_dir):
    return marts.churn_risk(fx.sales_base(spark, sf_dir).customers)


def sales_trends(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    return marts.sales_trends(lines.order_slices(base.lines), base.date_dim)


def loyalty_impact(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    return marts.loyalty_impact(base.slices, base.flagged)


def location_performance(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    return marts.location_performance(base.slices, base.flagged)


def price_tier_mart(spark, sf_dir):
    return marts.price_tiers(fx.sales_base(spark, sf_dir).slices)


def free_item_orders(spark, sf_dir):
    return marts.free_item_orders(fx.sales_base(spark, sf_dir).clean_items)


def orders_without_free_item(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    free = base.slices.filter("free_line_count > 0").select("order_id").distinct()
    return marts.orders_without_free_item(base.slices, free)


def free_item_order_value(spark, sf_dir):
    return marts.free_item_effect(lines.order_slices(fx.sales_base(spark, sf_dir).lines))


def mart_run_status(spark, sf_dir):
    """All marts built and stored in one run over shared tables."""
    return run_marts(spark, fx.sales_base(spark, sf_dir), fresh_dir(spark, "marts"))


def mart_run_resumed(spark, sf_dir):
    """Four marts at a time; one fails, and a second attempt builds it alone."""
    root, base = fresh_dir(spark, "resumed"), fx.sales_base(spark, sf_dir)

    def broken(_):
        raise ValueError("not today")

    again = {"workers": 4, "status_path": f"{root}/status", "run_key": "2024-01-01", "raise_on_failure": False}
    run_marts(spark, base, f"{root}/marts", {**BUILDERS, "sales_trends": broken}, **again)
    return run_marts(spark, base, f"{root}/marts", **again)


def clv_daily_incremental(spark, sf_dir):
    """Lifetime values brought forward over three increments, the last with late days of old customers."""
    root, base = fresh_dir(spark, "clv"), fx.sales_base(spark, sf_dir)
    day, late = F.col("order_date"), F.col("order_id") % 7 == 0
    first, second = day <= CLV_DAYS[0], (day > CLV_DAYS[0]) & (day <= CLV_DAYS[1])
    for part in (first & ~late, second & ~late, (day > CLV_DAYS[1]) | late):
        clv_state.advance_clv(spark, base.slices.filter(part), root)
    return clv_state.clv_daily(spark, root, base.date_dim, base.threshold)


def item_median_sketched(spark, sf_dir):
    """Medians from stored daily sketches: rows per item, and whether the price's rank is within the stated error."""
    root = fresh_dir(spark, "sketches")
    items = lines.with_order_date(fx.order_items(spark, sf_dir)).select("item_name", "item_price", "order_date")
    sinks.overwrite_table(sketches.price_sketches(items), f"{root}/prices")
    found = keep(sketches.sketched_quantiles(spark.read.parquet(f"{root}/prices")), "sketched-medians")
    ranked = sketches.rank_interval(items, found)
    error = 2 * sketches.RANK_ERROR  # five standard errors
    within = (F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)
    return ranked.select("item_name", "row_count", F.coalesce(within, F.col("median_item_price").isNull()).alias("within_error"))


def location_totals_sketched(spark, sf_dir):
    """Totals per restaurant from stored daily sketches; up to 4,096 orders and customers their counts are exact."""
    root = fresh_dir(spark, "sketches")
    sinks.overwrite_table(
        sketches.total_sketches(fx.sales_base(spark, sf_dir).slices, ["restaurant_id"]), f"{root}/totals"
    )
    return sketches.sketched_totals(spark.read.parquet(f"{root}/totals"), ["restaurant_id"])


def calendar_as_of(spark, sf_dir):
    """Order days with the holidays known before, at and after two changes of the calendar."""
    root = fresh_dir(spark, "raw-date-dim")
    dim = fx.raw_date_dim(spark, sf_dir)
    changed = dim.withColumns({
        "IS_HOLIDAY": F.col("IS_HOLIDAY") | F.startswith("DATE_KEY", F.lit("01-05-")),
        "HOLIDAY_NAME": F.when(F.startswith("DATE_KEY", F.lit("01-05-")), "May Day").otherwise(F.col("HOLIDAY_NAME")),
    })
    shorter = changed.filter(~F.startswith("DATE_KEY", F.lit("04-07-")))
    for number, (dt, known) in enumerate((("2024-01-02", dim), ("2024-01-04", dim), ("2024-01-06", changed), ("2024-01-08", shorter))):
        sinks.write_raw(known, root, dt, number)
    snapshots = process_dates(readers.read_raw(spark, root))
    periods = keep(validity_periods(snapshots), "validity")
    days = fx.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("order_date")).distinct()
    runs = F.array(*[F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-05", "2024-01-07", "2024-01-09")])
    asked = days.withColumn("as_of", F.explode(runs))
    found = with_calendar_as_of(asked, "order_date", "as_of", periods)
    return found.select("order_date", "as_of", "day_of_week", "is_holiday", "holiday_name")


# --- data quality --------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers rounded for the comparison with SQL; the library gives them as they are."""
    return df.withColumns({c: F.round(c, MONEY_SCALE) for c in columns or ("value",)})


def _sales(base: SalesBase) -> DataFrame:
    return marts.sales_trends(base.slices, base.date_dim)


def dq_sales_trends(spark, sf_dir):
    return quality.sales_checks(_sales(fx.sales_base(spark, sf_dir)))


def dq_uncovered_dates(spark, sf_dir):
    return quality.uncovered_dates(_sales(fx.sales_base(spark, sf_dir)))


def dq_account_profile(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    return quality.account_profile(base.items, base.flagged)


def dq_rfm(spark, sf_dir):
    return quality.rfm_checks(customer_segments_rfm(spark, sf_dir))


def dq_segment_counts(spark, sf_dir):
    return quality.segment_counts(customer_segments_rfm(spark, sf_dir))


def dq_clv_monotonic(spark, sf_dir):
    return quality.clv_monotonic(clv_daily(spark, sf_dir))


def dq_flag_consistency(spark, sf_dir):
    return _rounded(quality.flag_consistency(fx.order_items(spark, sf_dir)))


def dq_flag_counts(spark, sf_dir):
    return quality.inconsistent_customers(fx.order_items(spark, sf_dir))


def dq_flag_share_stats(spark, sf_dir):
    return _rounded(quality.flag_share_stats(quality.inconsistent_customers(fx.order_items(spark, sf_dir))))


def dq_flag_rollout(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    customer_marts = {
        "clv_daily": marts.clv_daily(base.slices, base.date_dim, base.threshold),
        "customer_segments_rfm": marts.rfm_segments(base.customers),
        "churn_risk": marts.churn_risk(base.customers),
    }
    return quality.flag_rollout(customer_marts, base.flagged)


def dq_top_customers(spark, sf_dir):
    return quality.top_customers(fx.sales_base(spark, sf_dir).customer_lines)


def dq_concentration(spark, sf_dir):
    return _rounded(quality.concentration(fx.sales_base(spark, sf_dir).customer_lines))


def dq_percentiles(spark, sf_dir):
    return _rounded(quality.volume_percentiles(fx.sales_base(spark, sf_dir).customer_lines), "percentile", "line_items")


def dq_percentiles_distributed(spark, sf_dir):
    """The same percentiles over many slices, as wide histograms have."""
    volume = fx.sales_base(spark, sf_dir).customer_lines
    slice_rows = min(SLICE_ROWS, volume.count() // 100 + 1)
    return _rounded(quality.volume_percentiles(volume, slice_rows=slice_rows), "percentile", "line_items")


def dq_threshold_impact(spark, sf_dir):
    volume = fx.sales_base(spark, sf_dir).customer_lines
    return _rounded(quality.threshold_impact(volume, (20, 40, 60, 80)), "pct_customers", "pct_line_items")


def dq_reconcile_loyalty(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    loyalty = marts.loyalty_impact(base.slices, base.flagged)
    return quality.loyalty_checks(loyalty, _sales(base), base.flagged.count())


def dq_reconcile_location(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    return quality.location_checks(marts.location_performance(base.slices, base.flagged), _sales(base))


def dq_top_flagged_locations(spark, sf_dir):
    return quality.top_flagged_locations(location_performance(spark, sf_dir))


def dq_churn(spark, sf_dir):
    base = fx.sales_base(spark, sf_dir)
    return quality.churn_checks(marts.churn_risk(base.customers), marts.rfm_segments(base.customers))


def dq_churn_medians(spark, sf_dir):
    return quality.churn_medians(churn_risk(spark, sf_dir))


def dq_timestamp_format(spark, sf_dir):
    return quality.timestamp_format(fx.raw_order_items(spark, sf_dir))


def dq_timestamp_samples(spark, sf_dir):
    return quality.timestamp_samples(fx.raw_order_items(spark, sf_dir))


def dq_price_signs(spark, sf_dir):
    return _rounded(quality.price_signs(fx.order_items(spark, sf_dir), fx.order_item_options(spark, sf_dir)))


def dq_amounts(spark, sf_dir):
    return quality.amounts(fx.sales_base(spark, sf_dir).lines)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_source, incremental_orders, incremental_order_items, incremental_children, checkpoint_advance,
        dim_snapshot_latest, raw_partition_roundtrip, mart_write_roundtrip, row_counts, ingest_available_now,
        staged_sales_trends, normalize_columns, parse_mixed_timestamps, parse_dates, parse_failures,
        price_tier_labels, calendar_attrs, item_median_price, price_anomalies, price_anomaly_kept, line_revenue,
        line_items_per_customer, non_individual_flag, clv_daily, reference_date, rfm_scores,
        rfm_scores_distributed, customer_segments_rfm, churn_risk, sales_trends, loyalty_impact,
        location_performance, price_tier_mart, free_item_orders, orders_without_free_item, free_item_order_value,
        mart_run_status, dq_sales_trends, dq_uncovered_dates, dq_account_profile, dq_rfm, dq_segment_counts,
        dq_clv_monotonic, dq_flag_consistency, dq_flag_counts, dq_flag_share_stats, dq_flag_rollout,
        dq_top_customers, dq_concentration, dq_percentiles, dq_percentiles_distributed, dq_threshold_impact,
        dq_reconcile_loyalty, dq_reconcile_location, dq_top_flagged_locations, dq_churn, dq_churn_medians,
        dq_timestamp_format, dq_timestamp_samples, dq_price_signs, dq_amounts, extract_overlap_backfill,
        raw_partition_shuffled, price_anomalies_shuffled, quarantine_split, late_options_in_marts, refresh_by_month,
        ingest_distinct_keys, line_revenue_bucketed, mart_run_resumed, clv_daily_incremental, item_median_sketched,
        location_totals_sketched, calendar_as_of,
    )
}
