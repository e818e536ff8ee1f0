"""Quality classifier by importance resampling.

Two generative models over hashed unigrams and bigrams: the target model is
estimated from documents labelled good, the raw model from all documents. The
log weight of a document is the mean of log(target / raw) over its n-grams, counted as
``EFFECTIVE`` n-grams so that long and short documents compare; ``NEUTRAL`` n-grams of
ratio 1 are added, which keeps very short documents near 0. Keys are log weight
plus Gumbel noise, and the documents with the k largest keys are kept: that draws
k of them without replacement by importance.

How many to keep is a share of all documents, or else follows the labels: k is the
number of documents whose log weight reaches the cut that best separates labelled good
from labelled bad, where losing good counts ``GOOD_COST`` times. The target model
learns from one half of the labelled sample, the cut from the other.

Only the labelled sample is bounded (``MAX_LABELLED`` ids with the smallest hash);
raw counts, weights and the selection cover every row.

Defined cases: null text is empty; a document without n-grams has log weight 0;
labels with a null id or null quality are not used, and a document labelled both ways
counts as bad; without good labels both models agree and every log weight is 0, and
all documents are kept; without bad labels the smallest good weight is the cut;
documents with equal keys stand or fall together; repeated rows share a key; a null id
draws the noise of its own hash; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import GOLDEN, WordHashes, map_rows, mix, rows_in
from orderlens.session import keep

BUCKETS = 8_192
MAX_LABELLED = 20_000
PRIOR = 10.0  # n-grams per bucket by which the target model leans on the raw one
EFFECTIVE, NEUTRAL = 1_000, 10
GOOD_COST = 4.0
SEED = 17
TOKEN = re.compile(r"\w+|[^\w\s]+")


def buckets_of(text: str, hashes: WordHashes, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every unigram and bigram; two equal words in a row are one bigram, whatever the word."""
    words = hashes.of([w.encode() for w in TOKEN.findall(text.lower())])
    pairs = mix(words[:-1] * np.uint64(3) + words[1:] * GOLDEN)
    pairs[words[:-1] == words[1:]] = GOLDEN
    return (np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64)


def labelled_sample(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, good, held_out): at most ``limit`` labelled ids, those of the smallest hash."""
    known = labels.filter("doc_id is not null and quality is not null")
    one = known.groupBy("doc_id").agg((F.min("quality") >= 1).alias("good"))
    half = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(2)) == 1).alias("held_out")
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select("doc_id", "good", half)


def fit(docs: DataFrame, sample: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log(target / raw) per bucket, from the n-gram counts of all rows."""
    learnt = sample.filter("good and not held_out")
    marked = docs.select("doc_id", "text").join(F.broadcast(learnt), "doc_id", "left")

    def gather(batches: Iterator[pa.RecordBatch]):
        hashes = WordHashes()
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for text, good in rows_in(batches):
            found = np.bincount(buckets_of(text or "", hashes, buckets), minlength=buckets)
            raw += found
            if good:
                target += found
        for bucket in np.flatnonzero(raw):
            yield int(bucket), int(raw[bucket]), int(target[bucket])

    parts = map_rows(marked.select("text", "good"), gather, "bucket int, raw long, target long")
    totals = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.ones(buckets), np.zeros(buckets)
    for row in totals.collect():  # one row per bucket
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    raw /= raw.sum()
    weight = PRIOR * buckets
    return np.log((target + weight * raw) / (target.sum() + weight)) - np.log(raw) if target.any() else np.zeros(buckets)


def gumbel(doc_id, seed: int = SEED) -> float:
    """Standard Gumbel noise that depends on the document's id alone."""
    bits = xxhash.xxh3_64_intdigest(repr(doc_id).encode(), seed)
    return -math.log(-math.log(((bits >> 11) + 0.5) / 2**53))


def names_of(columns: list[str]) -> tuple[str, str]:
    """log_weight and gumbel_key, with underscores before them where ``columns`` has these names."""
    found = []
    for name in ("log_weight", "gumbel_key"):
        while name in columns:
            name = f"_{name}"
        found.append(name)
    return found[0], found[1]


def score(docs: DataFrame, ratio: np.ndarray, columns: list[str]) -> DataFrame:
    """The columns of ``docs`` with its log weight and Gumbel key, named by ``names_of``."""
    weight_name, key_name = names_of(columns)
    weights = docs.sparkSession.sparkContext.broadcast(ratio)
    own = "text" in columns
    doc_at, text_at = columns.index("doc_id"), columns.index("text") if own else len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table = WordHashes(), weights.value
        for batch in batches:
            found, keys = [], []
            for doc, text in rows_in([batch.select([doc_at, text_at])]):
                places = buckets_of(text or "", hashes, len(table))
                value = EFFECTIVE * float(table[places].sum()) / (len(places) + NEUTRAL)
                found.append(value)
                keys.append(value + gumbel(doc))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(found, pa.float64()), pa.array(keys, pa.float64())],
                names=[*columns, weight_name, key_name],
            )

    schema = docs.select(*columns).schema.add(weight_name, "double").add(key_name, "double")
    return docs.select(*columns, *([] if own else ["text"])).mapInArrow(run, schema)


def best_cut(scored: DataFrame, sample: DataFrame, weight: str = "log_weight") -> float:
    """The log weight that best separates held-out good from bad."""
    held = F.broadcast(sample.filter("held_out"))
    # At most MAX_LABELLED numbers, the documented bound of the sample.
    rows = scored.select("doc_id", weight).join(held, "doc_id").groupBy("doc_id", "good").agg(F.min(weight).alias("w")).collect()
    good = np.sort([r["w"] for r in rows if r["good"]])
    bad = np.sort([r["w"] for r in rows if not r["good"]])
    if not len(good):
        return -math.inf
    if not len(bad):
        return float(good[0])
    edges = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[edges[0]], (edges[1:] + edges[:-1]) / 2])
    lost = np.searchsorted(good, cuts) / len(good)
    refused = np.searchsorted(bad, cuts) / len(bad)
    return float(cuts[np.argmax(refused - GOOD_COST * lost)])


def kth_largest(scored: DataFrame, key: str, k: int) -> float:
    """The k-th largest value of a stored column, by counting in ever narrower ranges.

    Each pass counts the rows per range (a few thousand counts reach the driver) and
    goes on inside the one that holds the k-th; no sort, whatever k is.
    """
    low, high, rows = scored.agg(F.min(key), F.max(key), F.count(key)).first()
    if k >= rows:
        return low
    left, ranges = k, 4096
    while low < high:
        width = (high - low) / ranges
        if not width or low + width == low:
            return _largest_within(scored, key, low, high, left)
        inside = scored.filter(F.col(key).between(low, high))
        place = F.least(F.floor((F.col(key) - low) / F.lit(width)), F.lit(ranges - 1)).alias("place")
        groups = inside.groupBy(place).agg(F.count(key).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        for row in sorted(groups.collect(), key=lambda r: -r["place"]):
            if left <= row["n"]:
                low, high = row["low"], row["high"]
                break
            left -= row["n"]
    return low


def _largest_within(scored: DataFrame, key: str, low: float, high: float, k: int) -> float:
    """The same among neighbouring doubles, of which there are few."""
    inside = scored.filter(F.col(key).between(low, high)).groupBy(key).count()
    for row in sorted(inside.collect(), key=lambda r: -r[key]):
        if k <= row["count"]:
            return row[key]
        k -= row["count"]
    return low


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, columns: list[str] | None = None) -> DataFrame:
    """The kept documents: ``columns`` (doc_id among them, and alone by default) with log weight and Gumbel key."""
    columns = columns or ["doc_id"]
    weight, key = names_of(columns)
    sample = keep(labelled_sample(labels), "labelled")
    scored = keep(score(docs, fit(docs, sample), columns), "scored")
    if share is None:
        k = scored.filter(F.col(weight) >= best_cut(scored, sample, weight)).count()
    else:
        k = round(share * scored.count())
    return scored.filter(F.col(key) >= kth_largest(scored, key, k)) if k > 0 else scored.limit(0)
