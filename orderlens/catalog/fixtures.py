"""Driver tables read as the order model, without a shuffle of its own making.

The mapping is described in FIXTURES.md. The raw tables have upper-case names
and text times, like the source system.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens.functions.columns import snake_lower
from orderlens.functions.times import parse_timestamps
from orderlens.plans.base import SalesBase
from orderlens.plans.transform import process_dates, process_options
from orderlens.session import PACKED, keep, shuffles_released

# Line items per account above which the driver data counts an account as
# non-individual; its busiest customers have about 80 lines, not 500.
THRESHOLD = 60


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file footer once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def parallel(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows by a hash of ``keys``, so that a file of one split feeds all cores.

    A round-robin would sort the rows first.
    """
    return df.repartition(*keys)


def _line_id(parts: tuple[str, ...] = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")) -> Column:
    """Together with the order key this names a driver line item uniquely."""
    return F.concat_ws("-", *[F.col(p).cast("bigint").cast("string") for p in parts])


def _creation_text() -> Column:
    key = F.col("o_orderkey")
    moment = F.timestamp_add("SECOND", (key % 86400).cast("int"), F.col("o_orderdate"))
    millis = F.concat(F.lit("."), F.lpad((key % 1000).cast("string"), 3, "0"))
    return F.concat(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.when(key % 10 == 0, "").otherwise(millis), F.lit("Z")
    )


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the items take over from their order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ORDER_ID"),
        _creation_text().alias("CREATION_TIME_UTC"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias("USER_ID"),
        (F.col("o_orderkey") % 40).alias("RESTAURANT_ID"),
        (F.col("o_orderstatus") == "P").alias("IS_LOYALTY"),
        F.col("o_orderpriority").alias("APP_NAME"),
        (F.col("o_custkey") % 7).cast("string").alias("PRINTED_CARD_NUMBER"),
    )


def _items_of(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """The lines with the columns of ``orders``.

    Names are joined while the lines are narrow. The lines are then dealt out by order once, for the
    cores and for the join with the orders; numbers travel, the line's text key is made at the end.
    """
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("PART"), F.when(F.col("p_size") != 1, F.col("p_name")).alias("ITEM_NAME")
    )
    quantity = F.col("l_quantity")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ORDER_ID"),
        F.col("l_partkey").alias("PART"),
        F.col("l_suppkey").alias("SUPPLIER"),
        F.col("l_linenumber").alias("LINE"),
        F.when(quantity == 50, 0.0).otherwise(F.col("l_extendedprice") / (quantity * 100)).alias("ITEM_PRICE"),
        quantity.alias("ITEM_QUANTITY"),
    )
    named = parallel(lines.join(parts, "PART"), "ORDER_ID")
    line_id = _line_id(("LINE", "PART", "SUPPLIER", "ITEM_QUANTITY")).alias("LINEITEM_ID")
    own = ["ITEM_PRICE", "ITEM_QUANTITY", *[c for c in orders.columns if c != "ORDER_ID"], "ITEM_NAME"]
    return named.join(orders, "ORDER_ID").select("ORDER_ID", line_id, *own)


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items_of(spark, sf_dir, _raw_orders(spark, sf_dir))


def stored_raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, for several runs that extract from it."""
    with shuffles_released(spark):
        return keep(raw_order_items(spark, sf_dir), "source-items", **PACKED)


def raw_order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two options per line at most, one from its discount and one from its tax; a zero gives none."""
    tax = F.abs("l_tax")
    first = F.struct(
        (F.abs("l_discount") * 10).alias("OPTION_PRICE"),
        (1 + F.col("l_linenumber") % 2).alias("OPTION_QUANTITY"),
    )
    second = F.struct((tax * 10).alias("OPTION_PRICE"), F.lit(1).alias("OPTION_QUANTITY"))
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_orderkey").alias("ORDER_ID"),
            _line_id().alias("LINEITEM_ID"),
            F.explode(F.array(F.when(F.col("l_discount") != 0, first), F.when(F.col("l_tax") > 0, second))).alias("o"),
        )
        .filter(F.col("o").isNotNull())
        .select("ORDER_ID", "LINEITEM_ID", "o.OPTION_PRICE", "o.OPTION_QUANTITY")
    )


def raw_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order days of one year, with that year's fixed holidays."""
    day = F.to_date("o_orderdate")
    holiday = (
        F.when(F.col("month_day") == "01-01", "New Year")
        .when(F.col("month_day") == "07-04", "Independence Day")
        .when(F.col("month_day") == "12-25", "Christmas")
    )
    return (
        table(spark, sf_dir, "orders")
        .filter(F.year("o_orderdate") == 1997)
        .select(day.alias("day"))
        .distinct()
        .withColumn("month_day", F.date_format("day", "MM-dd"))
        .select(
            F.date_format("day", "dd-MM-yyyy").alias("DATE_KEY"),
            holiday.isNotNull().alias("IS_HOLIDAY"),
            holiday.alias("HOLIDAY_NAME"),
        )
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed items; a time is parsed once per order, not once per line."""
    return snake_lower(_items_of(spark, sf_dir, parse_timestamps(_raw_orders(spark, sf_dir), "CREATION_TIME_UTC")))


def order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_options(raw_order_item_options(spark, sf_dir))


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_dates(raw_date_dim(spark, sf_dir))


def sales_base(spark: SparkSession, sf_dir: str) -> SalesBase:
    """The items are stored, as processed items are; several steps read them."""
    return SalesBase(
        keep(order_items(spark, sf_dir), "order-items", **PACKED),
        order_item_options(spark, sf_dir),
        date_dim(spark, sf_dir),
        threshold=THRESHOLD,
    )
