"""Shared preparation: everything the marts have in common, computed once."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.accounts import MAX_INDIVIDUAL_LINES, flagged_accounts
from orderlens.operators.lines import line_revenue, order_slices, with_order_date
from orderlens.operators.prices import MAX_PRICE_RATIO, plausible_prices
from orderlens.plans.marts import customer_base
from orderlens.schemas import DATE_DIM, ORDER_ITEM_OPTIONS, ORDER_ITEMS, require_columns
from orderlens.session import PACKED, keep


@dataclass
class SalesBase:
    """Processed tables in, stored intermediate tables out, each built on first use."""

    items: DataFrame
    options: DataFrame
    date_dim: DataFrame
    price_ratio: float = MAX_PRICE_RATIO
    threshold: int = MAX_INDIVIDUAL_LINES
    _building: threading.Lock = field(default_factory=threading.Lock, init=False, repr=False, compare=False)

    def __post_init__(self):
        require_columns(self.items, ORDER_ITEMS, "order_items")
        require_columns(self.options, ORDER_ITEM_OPTIONS, "order_item_options")
        require_columns(self.date_dim, DATE_DIM, "date_dim")

    @cached_property
    def clean_items(self) -> DataFrame:
        return plausible_prices(self.items, self.price_ratio)

    @cached_property
    def lines(self) -> DataFrame:
        """Clean lines with revenue; the marts read their fold, ``slices``, which alone is stored."""
        wanted = [
            "order_id", "lineitem_id", "user_id", "restaurant_id", "is_loyalty",
            "order_date", "item_price", "total_revenue",
        ]
        return line_revenue(with_order_date(self.clean_items), self.options).select(*wanted)

    def plan_of_shared(self, name: str) -> DataFrame:
        """What ``slices`` or ``flagged`` store."""
        return order_slices(self.lines) if name == "slices" else flagged_accounts(self.slices, self.threshold)

    @cached_property
    def slices(self) -> DataFrame:
        return keep(self.plan_of_shared("slices"), "slices", **PACKED)

    @cached_property
    def flagged(self) -> DataFrame:
        return keep(self.plan_of_shared("flagged"), "flagged")

    @property
    def customers(self) -> DataFrame:
        """Built once, also where several marts are built at a time."""
        with self._building:
            if "_customers" not in self.__dict__:
                self.__dict__["_customers"] = customer_base(self.slices, self.threshold)
        return self.__dict__["_customers"]

    @cached_property
    def customer_lines(self) -> DataFrame:
        """Line count per known customer, for the volume checks on unfiltered items."""
        return keep(
            self.items.filter(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("line_items")),
            "volume",
        )
