"""Column-level building blocks shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money is summed as decimals, to a millionth. A sum of doubles depends on the
# order of its additions, so reruns, retries and marts would not agree to the
# cent on large totals; a decimal sum is the same however the rows are split.
AMOUNT = "decimal(24,6)"
TOTAL = "decimal(34,6)"
MONEY_SCALE = 6


def snake_lower(df: DataFrame) -> DataFrame:
    """Lower-case every column name in one projection."""
    return df.toDF(*[name.lower() for name in df.columns])


# Beyond this an amount does not fit the decimal.
LARGEST_AMOUNT = 1e17


def usable_amount(value: str) -> Column:
    """False for an amount that is not a number, infinite or beyond all reason; null for null."""
    return ~F.isnan(value) & (F.abs(value) < LARGEST_AMOUNT)


def amount(value: str) -> Column:
    """A double amount of money as an exact decimal.

    An amount that has none stops the job by name, so it cannot vanish from a total;
    the report ``quality.amounts`` counts such lines. Null stays null.
    """
    bad = F.concat(F.lit(f"{value} is not a usable amount: "), F.col(value).cast("string"))
    return F.when(usable_amount(value) | F.col(value).isNull(), F.col(value).cast(AMOUNT)).otherwise(
        F.raise_error(bad).cast(AMOUNT)
    )


def money(total: Column) -> Column:
    """An exact total as the double the marts show."""
    return total.cast("double")


def ratio(numerator, denominator) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(F.col(numerator), F.col(denominator))


# Tier labels with their exclusive upper price bounds.
PRICE_TIERS = (
    ("Free", 0.01),
    ("$0.01-$5", 5.0),
    ("$5-$10", 10.0),
    ("$10-$20", 20.0),
)
TOP_PRICE_TIER = "$20+"


def price_tier(price: str = "item_price") -> Column:
    """Tier label of a price; an unknown price counts as the top tier."""
    label = F.lit(TOP_PRICE_TIER)
    for name, upper in reversed(PRICE_TIERS):
        label = F.when(F.col(price) < upper, name).otherwise(label)
    return label
