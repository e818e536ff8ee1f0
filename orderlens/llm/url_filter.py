"""URL filter: rules decide what they fit, gradient-boosted trees on lexical features the rest.

Only DataFrame functions and ``pyspark.ml`` are used. A rule is a host and a
path: it fits that host and its subdomains where the URL's path starts with the
rule's path; the longest rule that fits decides. Trees are fitted on labelled URLs,
by default the distinct ones that the rules decide, of which at most
``MAX_PER_CLASS`` of each class are used, those of smallest hash. One half of them
gives the suffix statistics (how often the last label, and the last two labels, of
the host are blocked), the other half fits the trees, so that no tree sees a statistic
that its own label went into. The statistics are as many rows as that half has URLs
at most, which bounds their broadcast.

Defined cases: host and path of a null URL, or of one without ``://``, are empty and no
rule fits; such URLs have features all the same and the trees judge them; of rules of
equal length the earlier one decides; repeated rows are judged alike, each in its row;
without labelled URLs of both classes there is nothing to learn, and what no rule fits
is allowed; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.session import keep

# Rules with their verdicts.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
BLOCK, ALLOW = "block", "allow"

MAX_PER_CLASS = 10_000
TREES, DEPTH, SEED = 20, 4, 13
FITTING_TASKS = 4
# Text counts as this many labelled URLs of the average kind in a suffix's statistic.
PRIOR_WEIGHT = 2.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "0123456789/.:-_?=&%#+~@"
LEXICAL = (
    "url_length", "host_length", "path_length", "host_labels", "path_depth", "digit_ratio", "entropy", "parameters",
    "query_length", "hyphens", "escapes", "secure", "fragment",
)
SUFFIXES = ("suffix1", "suffix2")
STATISTICS = tuple(f"{s}_{kind}" for s in SUFFIXES for kind in ("rate", "seen"))


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path of ``url``."""
    start = F.instr("url", "://")
    rest = F.when(start > 0, F.substring(F.col("url"), start + 3, F.length("url"))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def fitting_rule(rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits ``host`` and ``path``, null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in reversed(sorted(rules, key=lambda r: -len(r[0]))):
        host, slash, path = rule.partition("/")
        below = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
        fits = below & F.startswith(F.col("path"), F.lit(slash + path))
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _occurrences(text: Column, character: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per character over the characters of a URL, all others taken as one; linear in the text."""
    length = F.length(text).cast("double")
    counts = F.transform(
        F.array(*map(F.lit, ALPHABET)), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double")
    )
    plain = lambda n: n * F.log2(F.greatest(n, F.lit(1.0)))
    sums = F.aggregate(
        counts, F.struct(F.lit(0.0).alias("weighted"), F.lit(0.0).alias("n")),
        lambda acc, n: F.struct((acc["weighted"] + plain(n)).alias("weighted"), (acc["n"] + n).alias("n")),
    )
    total = sums["weighted"] + plain(F.greatest(length - sums["n"], F.lit(0.0)))
    return F.when(length > 0, F.log2(length) - total / length).otherwise(F.lit(0.0))


def with_features(rows: DataFrame) -> DataFrame:
    """``rows`` (url, host, path, ...) with the lexical features and the hashes of the host's last one and two labels."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    length = F.length(url).cast("double")
    digits = F.length(F.regexp_replace(url, r"[^0-9]", "")).cast("double")
    pairs = F.when(F.length(query) > 0, _occurrences(query, "&") + 1).otherwise(0.0)
    segments = _occurrences(path, "/")
    values = {
        "url_length": length, "host_length": F.length(host).cast("double"), "path_length": F.length(path).cast("double"),
        "host_labels": F.when(host != "", _occurrences(host, ".") + 1).otherwise(0.0), "path_depth": segments,
        "digit_ratio": F.when(length > 0, digits / length).otherwise(0.0), "entropy": _entropy(F.lower(url)),
        "parameters": pairs, "query_length": F.length(query).cast("double"), "hyphens": _occurrences(host, "-"),
        "escapes": _occurrences(url, "%"), "secure": F.startswith(url, F.lit("https://")).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "suffix1": F.xxhash64(F.substring_index(host, ".", -1)), "suffix2": F.xxhash64(F.substring_index(host, ".", -2)),
    }
    return rows.withColumns(values)


class UrlModel:
    """Trees and suffix statistics, fitted on labelled URLs (url, blocked)."""

    def __init__(self, labelled: DataFrame, max_per_class: int = MAX_PER_CLASS):
        rows = with_features(with_parts(labelled.filter("url is not null and blocked is not null").select("url", "blocked")))
        # Urls are carried as hashes and numbers from here, whatever their length.
        rows = rows.select(F.xxhash64("url").alias("h"), "blocked", *LEXICAL, *SUFFIXES).dropDuplicates(["h"])
        classes = [rows.filter(F.col("blocked") == b).orderBy("h").limit(max_per_class) for b in (True, False)]
        sample = keep(classes[0].unionByName(classes[1]).withColumn("half", F.pmod(F.xxhash64("h"), F.lit(2))), "url-labelled")
        counts = {(r["half"], r["blocked"]): r["count"] for r in sample.groupBy("half", "blocked").count().collect()}
        self.trees = self.statistics = None
        if len(counts) < 4:  # a class is missing from a half
            return
        first = sample.filter("half = 0")
        known, blocked = counts[0, True] + counts[0, False], counts[0, True]
        self.prior = blocked / known
        self.statistics = {
            s: keep(
                first.groupBy(s).agg(F.count(F.lit(1)).alias("_n"), F.count_if("blocked").alias("_blocked")), f"url-{s}"
            )
            for s in SUFFIXES
        }
        train = self._assembled(sample.filter("half = 1").coalesce(FITTING_TASKS)).select(
            "features", F.col("blocked").cast("double").alias("label")
        )
        self.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(train)

    def _assembled(self, rows: DataFrame) -> DataFrame:
        for s in SUFFIXES:
            rows = rows.join(F.broadcast(self.statistics[s]), s, "left")
            seen, blocked = (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("_n", "_blocked"))
            rate = (blocked + self.prior * PRIOR_WEIGHT) / (seen + PRIOR_WEIGHT)
            rows = rows.withColumns({f"{s}_rate": rate, f"{s}_seen": F.log1p(seen)}).drop("_n", "_blocked")
        return VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features").transform(rows)

    def judge(self, rows: DataFrame) -> DataFrame:
        """``rows`` (url, host, path, ...) with ``p_block``, null where there was nothing to learn."""
        if self.trees is None:
            return rows.withColumn("p_block", F.lit(None).cast("double"))
        scored = self.trees.transform(self._assembled(with_features(rows)))
        return scored.select(*rows.columns, vector_to_array("probability")[1].alias("p_block"))


def judged(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, p_block) of every page; ``labelled`` (url, blocked) replaces the URLs the rules decide."""
    rule, says = fitting_rule(rules)
    rows = with_parts(pages.select("page_id", "url")).withColumns({"rule": rule, "verdict": says})
    decided = rows.filter("rule is not null")
    model = UrlModel(decided.select("url", (F.col("verdict") == BLOCK).alias("blocked")) if labelled is None else labelled)
    open_rows = model.judge(rows.filter("rule is null"))
    open_rows = open_rows.withColumn("verdict", F.when(F.col("p_block") >= 0.5, BLOCK).otherwise(ALLOW))
    columns = ["page_id", "host", "path", "rule", "verdict", "p_block"]
    found = [decided.withColumn("p_block", F.lit(None).cast("double")), open_rows]
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in found])
