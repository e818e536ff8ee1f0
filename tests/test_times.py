from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderlens.functions import times
from orderlens.functions.calendar import with_calendar
from orderlens.functions.columns import price_tier, snake_lower
from orderlens.plans import quality

TEXTS = [
    ("2019-12-31T23:59:58.007Z", datetime(2019, 12, 31, 23, 59, 58, 7000)),
    ("2020-02-29T00:00:00Z", datetime(2020, 2, 29)),
    ("2020-02-29T06:07:08.4Z", datetime(2020, 2, 29, 6, 7, 8, 400000)),
    ("2020-02-29T06:07:08.400001Z", None),
    ("2020-02-29 06:07:08", None),
    ("bad", None),
    ("b.ad", None),
    (None, None),
]


def test_mixed_time_forms(spark):
    df = spark.createDataFrame(TEXTS, "text string, expected timestamp_ntz")
    parsed = df.select(times.parsed_time("text").cast("timestamp_ntz").alias("t"), "expected").collect()
    assert [r.t for r in parsed] == [r.expected for r in parsed]


def test_dates(spark):
    df = spark.createDataFrame([("07-04-2018",), ("2018-04-07",), (None,)], "d string")
    assert [r.d for r in times.parse_dates(df, "d").collect()] == [date(2018, 4, 7), None, None]


def test_failures_tell_bad_from_missing(spark):
    df = spark.createDataFrame(TEXTS, "text string, expected timestamp_ntz")
    row = times.parse_failures(df, "text", times.parsed_time("text")).first()
    assert (row.unparseable, row.missing, row.rows) == (4, 1, 8)


def test_timestamp_format_report(spark):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS] + [("  ",)], "CREATION_TIME_UTC string")
    found = {r.metric: (r.value, r.passed) for r in quality.timestamp_format(df).collect()}
    assert found["column_present"] == (1, True)
    assert found["is_text"] == (1, True)
    assert found["null_or_blank"] == (2, None)
    assert found["unparseable"] == (3, False)
    typed = df.select(F.lit(1).alias("creation_time_utc"))
    assert {r.metric: r.passed for r in quality.timestamp_format(typed).collect()}["is_text"] is False
    absent = df.select(F.lit(1).alias("other"))
    assert [r.passed for r in quality.timestamp_format(absent).collect()] == [False]


@pytest.mark.parametrize(
    "price, label",
    [
        (None, "$20+"), (-3.5, "Free"), (0.0099, "Free"), (0.01, "$0.01-$5"), (2.75, "$0.01-$5"),
        (5.0, "$5-$10"), (7.1, "$5-$10"), (10.0, "$10-$20"), (13.3, "$10-$20"), (20.0, "$20+"), (812.0, "$20+"),
    ],
)
def test_price_tier_bounds(spark, price, label):
    df = spark.createDataFrame([(price,)], "item_price double")
    assert df.select(price_tier()).first()[0] == label


def test_lower_case_columns(spark):
    df = spark.createDataFrame([(1, 2)], "ORDER_ID int, Creation_Time int")
    assert snake_lower(df).columns == ["order_id", "creation_time"]


def test_calendar_is_not_multiplied_by_repeated_days(spark):
    dim = spark.createDataFrame(
        [(date(2021, 1, 1), True, "New Year"), (date(2021, 1, 1), True, "New Year"), (None, False, None)],
        "date_key date, is_holiday boolean, holiday_name string",
    )
    days = spark.createDataFrame([(date(2021, 1, 1),), (date(2021, 1, 3),), (None,)], "d date")
    rows = {r.d: r for r in with_calendar(days, "d", dim, holiday_name=True).collect()}
    assert len(rows) == 3
    friday, sunday = rows[date(2021, 1, 1)], rows[date(2021, 1, 3)]
    assert (friday.week, friday.year, friday.day_of_week, friday.is_weekend) == (53, 2021, "Friday", False)
    assert (friday.is_holiday, friday.holiday_name) == (True, "New Year")
    assert (sunday.is_weekend, sunday.is_holiday) == (True, None)
    assert rows[None].year is None


def test_calendar_flags_may_be_numbers(spark):
    dim = spark.createDataFrame([(date(2021, 1, 1), 1, "x"), (date(2021, 1, 2), 0, None)], "date_key date, is_holiday int, holiday_name string")
    days = spark.createDataFrame([(date(2021, 1, 1),), (date(2021, 1, 2),)], "d date")
    assert {r.d.day: r.is_holiday for r in with_calendar(days, "d", dim).collect()} == {1: True, 2: False}


def test_conflicting_calendar_days_fail_by_name(spark):
    dim = spark.createDataFrame(
        [(date(2021, 1, 1), True, "A"), (date(2021, 1, 1), False, "B")], "date_key date, is_holiday boolean, holiday_name string"
    )
    days = spark.createDataFrame([(date(2021, 1, 1),)], "d date")
    with pytest.raises(Exception, match="conflicting rows for 2021-01-01"):
        with_calendar(days, "d", dim).collect()
