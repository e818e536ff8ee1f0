"""Raw increments to processed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.columns import snake_lower
from orderlens.functions.times import failure_counts, parse_dates, parse_timestamps, parsed_date, parsed_time
from orderlens.schemas import LINE_KEY
from orderlens.session import small_table
from orderlens.sources.quarantine import SOUND, STATE, UNREADABLE, failure_reason, still_unreadable
from orderlens.sources.readers import VERSION, drop_superseded, latest_snapshot, read_raw
from orderlens.sources.sinks import Buckets, write_observed

CHECKS = "table string, rows long, unparseable long, missing long"
OPTION_VALUES = "option_price double, option_quantity int, dt date, batch long"


def process_items(raw: DataFrame) -> DataFrame:
    return parse_timestamps(snake_lower(raw), "creation_time_utc")


def process_options(raw: DataFrame) -> DataFrame:
    return snake_lower(raw)


def process_dates(raw: DataFrame) -> DataFrame:
    return parse_dates(snake_lower(raw), "date_key")


def _store_parsed(df: DataFrame, path: str, text: str, parsed: Column, **more) -> dict:
    """Write with ``text`` replaced by ``parsed``, counting failures on the way."""
    both = df.withColumn("_parsed", parsed)
    metrics = {name: count for name, count in failure_counts(text, F.col("_parsed")).items() if name != "rows"}
    keep = [F.col("_parsed").alias(c) if c == text else F.col(c) for c in df.columns]
    return write_observed(both, path, "overwrite", metrics, keep, **more)


def raw_table(spark: SparkSession, raw_root: str, table: str, empty: str | None = None) -> DataFrame:
    """All increments of a raw table with lower-case names."""
    return snake_lower(read_raw(spark, f"{raw_root}/{table}", empty))


def raw_options(spark: SparkSession, raw_root: str, items: DataFrame) -> DataFrame:
    """The raw options; before there are any, an empty table whose keys have the types of ``items``."""
    keys = ", ".join(f"{k} {items.schema[k].dataType.simpleString()}" for k in LINE_KEY)
    return raw_table(spark, raw_root, "order_item_options", f"{keys}, {OPTION_VALUES}")


def quarantine(raw_items: DataFrame, text: str = "creation_time_utc") -> DataFrame:
    """Rows whose time cannot be read, the newest per line, with the reason; lines that were mended since are left out."""
    waiting = raw_items.filter(F.col(STATE) == UNREADABLE)
    newest = drop_superseded(waiting, list(LINE_KEY))
    still = still_unreadable(newest, raw_items.filter(F.col(STATE) == SOUND), list(LINE_KEY), "batch")
    return still.drop(STATE).withColumn("reason", failure_reason(text))


def line_buckets(count: int | None) -> Buckets | None:
    return Buckets(count, LINE_KEY) if count else None


def transform(
    spark: SparkSession, raw_root: str, processed_root: str, readmit: bool = False, buckets: int | None = None
) -> DataFrame:
    """Rebuild all processed tables; returns rows and parse failures per table.

    Items and options stay apart, so the item grain is not multiplied. Bad text
    is reported and does not stop the run: items without a readable time go to
    ``order_items_quarantine`` with their reason. ``readmit`` puts them among the
    items as well, with a null time. ``buckets`` stores items and options in so many
    buckets of the line key, so that every later join of the two goes without a shuffle.
    """
    run, by_line = list(VERSION), line_buckets(buckets)
    raw_items = raw_table(spark, raw_root, "order_items")
    items = drop_superseded(raw_items.filter(F.col(STATE) == SOUND), list(LINE_KEY)).drop(*run, STATE)
    options = drop_superseded(raw_options(spark, raw_root, raw_items), list(LINE_KEY)).drop(*run)
    dates = latest_snapshot(raw_table(spark, raw_root, "date_dim")).drop(*run)

    text = "creation_time_utc"
    missing = F.col("reason") == "missing"
    held = write_observed(
        quarantine(raw_items, text), f"{processed_root}/order_items_quarantine", "overwrite",
        {"missing": F.count_if(missing), "unparseable": F.count_if(~missing)},
    )
    if readmit:
        back = spark.read.parquet(f"{processed_root}/order_items_quarantine").select(*items.columns)
        items = items.unionByName(back)
    stored_items = _store_parsed(items, f"{processed_root}/order_items", text, parsed_time(text), buckets=by_line)
    for failure in ("unparseable", "missing"):
        stored_items[failure] = held.get(failure, 0)
    seen = {
        "order_items": stored_items,
        "order_item_options": write_observed(
            options, f"{processed_root}/order_item_options", "overwrite", buckets=by_line
        ),
        "date_dim": _store_parsed(dates, f"{processed_root}/date_dim", "date_key", parsed_date("date_key")),
    }
    return small_table(
        spark,
        [(t, m.get("rows", 0), m.get("unparseable", 0), m.get("missing", 0)) for t, m in seen.items()],
        CHECKS,
    )
