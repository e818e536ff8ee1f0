"""Merging items that share buckets into components, without listing all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.components import connected
from orderlens.session import keep

WORTHWHILE = 50


def shared_buckets(keys: DataFrame) -> DataFrame:
    """The rows (key, rep) of keys that more than one item has."""
    several = keys.groupBy("key").count().filter("count > 1").select("key")
    return keys.join(several, "key").select("key", "rep")


def leading_pairs(buckets: DataFrame, roots: DataFrame, number: int) -> DataFrame:
    """(a, b): per item the one of another component that leads most of its buckets.

    A bucket's leader is the item of smallest hash, another one each round.
    """
    lead = F.min(F.struct(F.xxhash64("rep", F.lit(number)).alias("h"), "rep", "root")).alias("lead")
    placed = buckets.join(roots, "rep")
    leaders = placed.groupBy("key").agg(lead, F.min("root").alias("low"), F.max("root").alias("high"))
    leaders = leaders.filter("low != high").select("key", "lead")
    votes = placed.join(leaders, "key").filter("root != lead.root").groupBy("rep", F.col("lead.rep").alias("b")).count()
    best = votes.groupBy(F.col("rep").alias("a")).agg(F.max(F.struct("count", "b")).alias("best"))
    return best.select("a", "best.b")


def open_rows(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, rep, root) of the buckets that reach over several components."""
    placed = buckets.join(roots, "rep")
    spans = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    return placed.join(spans.select("key"), "key").select("key", "rep", "root")


def merge(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, root) after the links (a, b) between items."""
    ends = links.join(roots.select(F.col("rep").alias("a"), F.col("root").alias("u")), "a")
    ends = ends.join(roots.select(F.col("rep").alias("b"), F.col("root").alias("v")), "b").filter("u != v")
    moved = connected(ends.select("u", "v").distinct(), "u", "v")
    joined = roots.join(moved, roots["root"] == moved["node"], "left")
    return keep(joined.select("rep", F.coalesce(moved["root"], roots["root"]).alias("root")), "roots")


def merged(
    buckets: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    rest: Callable[[DataFrame], DataFrame],
    sure: bool = False,
) -> DataFrame:
    """(rep, root) of all items in ``buckets``, a stored table.

    ``confirm`` keeps the linked ones of pairs (a, b). Rounds of leading pairs merge the large groups
    and go on while at least one in ``WORTHWHILE`` of their pairs is a link; then ``rest`` names all
    pairs, of the rows of buckets that are still open, which have to be confirmed. With ``sure`` it
    confirms them itself and names links.
    """
    members = buckets.select("rep").distinct()
    roots = keep(members.select("rep", F.col("rep").alias("root")), "roots")
    tried, number = None, 0
    while True:
        pairs = leading_pairs(buckets, roots, number)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = keep(pairs, "leading-pairs")
        links = keep(confirm(pairs), "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found, number = links.count(), number + 1
        if found:
            roots = merge(roots, links)
        if found * WORTHWHILE <= pairs.count():
            break
    if sure:
        links = keep(rest(open_rows(buckets, roots)), "links")
        return roots if links.isEmpty() else merge(roots, links)
    ordered = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = keep(rest(open_rows(buckets, roots)).join(ordered, ["a", "b"], "left_anti"), "remaining-pairs")
    links = keep(confirm(left), "links")
    return roots if links.isEmpty() else merge(roots, links)
