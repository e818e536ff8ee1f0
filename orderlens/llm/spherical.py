"""Near copies of embeddings: spherical-cap filters from random product codes.

A vector is turned by a fixed random rotation and cut into ``BLOCKS`` blocks. A filter is
a direction made of one random code word per block, and a vector belongs to every
filter whose direction it meets above its own level, which is set so that ``LIST``
directions exceed it (a level shared by all vectors would leave some of them without a filter,
because sums of bounded scores vary far more between vectors than a normal tail). The
list is decoded from the sorted sums of two halves: the k-th best sum of one half
can only go with the LIST / k best of the other, so the many other directions are
never visited. The number of directions follows the number of vectors, so a filter
holds a few vectors at any size, unless the vectors have so few dimensions that many lie near each other; several
independent codes are used. A pair of cosine 0.95 shares a filter with probability ``RECALL`` or more, which a trial on
random pairs of as many dimensions confirms before the codes are used; from 16 dimensions on, up to a million vectors, it is above 0.999.

Vectors that share a filter are merged into components with the pairs' cosines
verified in double precision. All links lie inside a component, so links are counted
there, by blocks of rows, and pairs are never written. A wide component or filter is
split into pairs of blocks, which go to different tasks.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components have no links; vectors of different length never link; equal vectors
are one class and link with each other; rows without an id are left out; of
repeated ids the row with the smallest vector counts; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows, rows_in, spread_join
from orderlens.llm.merging import merged, shared_buckets
from orderlens.session import keep

COSINE = 0.95
CODES, BLOCKS, LIST = 2, 4, 64
PER_FILTER = 1.5  # vectors that a filter meets, on average
MIN_WORDS, MAX_WORDS = 6, 400
RECALL = 0.997  # of pairs at the threshold, by trial; more similar pairs are found more often
WIDE = 2_000


def block_count(dims: int) -> int:
    """Blocks of at least two components, as far as there are so many."""
    return max(1, min(BLOCKS, dims // 2))


@lru_cache(maxsize=64)
def words_per_block(vectors: int, dims: int) -> int:
    """Code words per block, so that a filter meets PER_FILTER vectors, or more where pairs would be lost.

    In few dimensions the best directions of many lie closer together than linked vectors do, so the number of words
    is lowered until pairs at the threshold share a filter.
    """
    words = math.ceil((max(vectors, 1) * LIST / PER_FILTER) ** (1 / block_count(dims)))
    words = max(MIN_WORDS, min(MAX_WORDS, words))
    while words > MIN_WORDS and sharing(dims, words) < RECALL:
        words = max(MIN_WORDS, words * 3 // 4)
    return words


def sharing(dims: int, words: int, pairs: int = 1_000) -> float:
    """The share of random pairs at the threshold that meet in a filter of any of the codes, by trial."""
    if dims < 2:
        return 1.0
    rng = np.random.default_rng([dims, words])
    x, z = rng.standard_normal((2, pairs, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = COSINE * x + math.sqrt(1 - COSINE**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    met = np.zeros(pairs, bool)
    for number in range(CODES):
        code = ProductCode(dims, words, number)
        met |= [not set(a).isdisjoint(b) for a, b in zip(map(np.ndarray.tolist, code.decode(x)), map(np.ndarray.tolist, code.decode(y)))]
    return float(met.mean())


class ProductCode:
    """One rotation with its code words; ``decode`` lists the filters a unit vector exceeds."""

    def __init__(self, dims: int, words: int, seed: int):
        rng = np.random.default_rng([dims, words, seed])
        self.rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        self.cuts = np.array_split(np.arange(dims), block_count(dims))
        self.words = []
        for cut in self.cuts:
            code = rng.standard_normal((words, len(cut)))
            self.words.append(code / np.linalg.norm(code, axis=1, keepdims=True) * math.sqrt(len(cut) / dims))
        self.size = words

    def decode(self, units: np.ndarray) -> Iterator[np.ndarray]:
        """Filter numbers per row of unit vectors."""
        turned = units @ self.rotation
        scores = [turned[:, cut] @ code.T for cut, code in zip(self.cuts, self.words)]
        half = (len(scores) + 1) // 2
        for row in range(len(units)):
            left, right = _sums([s[row] for s in scores[:half]]), _sums([s[row] for s in scores[half:]])
            one, other = _best(left), _best(right)
            partners = np.minimum(len(other), LIST // np.arange(1, len(one) + 1))
            first = np.repeat(np.arange(len(one)), partners)
            second = np.arange(len(first)) - np.repeat(np.cumsum(partners) - partners, partners)
            first, second = one[first], other[second]
            exceeding = _best(left[first] + right[second])
            yield first[exceeding] * len(right) + second[exceeding]


def _best(values: np.ndarray) -> np.ndarray:
    """Places of the LIST largest values, largest first."""
    if len(values) > LIST:
        found = np.argpartition(-values, LIST - 1)[:LIST]
        return found[np.argsort(-values[found], kind="stable")]
    return np.argsort(-values, kind="stable")


def _sums(parts: list[np.ndarray]) -> np.ndarray:
    """Sums over one word of each block, in the order of the words' numbers."""
    total = np.zeros(1)
    for part in parts:
        total = (total[:, None] + part[None, :]).ravel()
    return total


@lru_cache(maxsize=8)
def product_code(dims: int, words: int, seed: int) -> ProductCode:
    return ProductCode(dims, words, seed)


def unit(vector) -> np.ndarray | None:
    """The vector as a double unit vector, or None where it has no direction."""
    if not vector or any(x is None for x in vector):
        return None
    values = np.array(vector, np.float64)
    if not np.isfinite(values).all() or not values.any():
        return None
    values /= np.abs(values).max()
    return values / np.linalg.norm(values)


def directed(vectors: DataFrame) -> DataFrame:
    """(vec_id, dims, unit) per id; unit is null (and dims 0) where the vector has no direction."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for vec, values in rows_in(batches):
            found = unit(values)
            yield vec, 0 if found is None else len(found), None if found is None else found.tobytes()

    one = vectors.filter("vec_id is not null").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return map_rows(one, run, f"vec_id {kind}, dims int, unit binary")


def filters(classes: DataFrame, words: dict[int, int]) -> DataFrame:
    """(key, rep): every filter that every class exceeds; keys tell lengths and codes apart."""
    kind = classes.schema["rep"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                dims = np.array(part.column(1))
                for size in np.unique(dims):
                    place = np.flatnonzero(dims == size)
                    rows = part.take(pa.array(place))
                    units = np.frombuffer(b"".join(rows.column(2).to_pylist())).reshape(len(place), size)
                    for number in range(CODES):
                        lists = list(product_code(int(size), words[int(size)], number).decode(units))
                        reps = rows.column(0).take(pa.array(np.repeat(np.arange(len(place)), [len(x) for x in lists])))
                        keys = (np.concatenate(lists) * CODES + number) * 65_536 + size
                        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), reps], names=["key", "rep"])

    return classes.select("rep", "dims", "unit").mapInArrow(run, f"key long, rep {kind}")


def confirmed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The stored pairs (a, b) of a cosine of at least COSINE."""
    kind = classes.schema["rep"].dataType.simpleString()
    half = spread_join(pairs, classes.select(F.col("rep").alias("b"), F.col("unit").alias("_b")), ["b"], "a")
    both = half.join(classes.select(F.col("rep").alias("a"), F.col("unit").alias("_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]):
        for a, b, x, y in rows_in(batches):
            if np.frombuffer(x) @ np.frombuffer(y) >= COSINE:
                yield a, b

    return map_rows(both.select("a", "b", "_a", "_b"), run, f"a {kind}, b {kind}")


def blocked(rows: DataFrame, wide: int = WIDE) -> DataFrame:
    """``rows`` (key, rep, ...) dealt out by pairs of blocks of their key: (..., own, low, high).

    A key of up to ``wide`` rows is one block; otherwise each row goes to as many block pairs as there are blocks.
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / wide).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = rows.join(sizes, "key").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("blocks", "other")
    return dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "rep")


def _block_pairs(batches: Iterator[pa.RecordBatch], names: list[str]):
    """Per pair of blocks of a key: (rows of the first, rows of the second, whether they are the same)."""
    at = [names.index(n) for n in ("key", "low", "high")]
    for (_, low, high), group in groupby(rows_in(batches), key=lambda r: tuple(r[i] for i in at)):
        rows = list(group)
        own = names.index("own")
        first = [r for r in rows if r[own] == low]
        yield first, first if low == high else [r for r in rows if r[own] == high], low == high


def _units(rows: list[tuple], place: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[place] for r in rows)).reshape(len(rows), -1)


def packed(classes: DataFrame) -> DataFrame:
    """(rep, packed, scale, error): unit vectors in a byte per component, with the length of what that leaves out."""
    kind = classes.schema["rep"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for rep, vector in rows_in(batches):
            values = np.frombuffer(vector)
            scale = float(np.abs(values).max()) / 127
            small = np.rint(values / scale).astype(np.int8)
            yield rep, small.tobytes(), scale, float(np.linalg.norm(values - small * scale))

    return map_rows(classes.select("rep", "unit"), run, f"rep {kind}, packed binary, scale double, error double")


def near_pairs(rows: DataFrame) -> DataFrame:
    """(a, b), a < b, of different components whose cosine may suffice, from rows (key, rep, root, packed, scale, error).

    What packing leaves out bounds the error of a cosine, so no pair of sufficient cosine is missed.
    """
    kind = rows.schema["rep"].dataType.simpleString()
    dealt = blocked(rows)
    names = dealt.columns
    rep, root, vector = names.index("rep"), names.index("root"), names.index("packed")
    scale, error = names.index("scale"), names.index("error")

    def unpacked(part: list[tuple]):
        small = np.frombuffer(b"".join(r[vector] for r in part), np.int8).reshape(len(part), -1)
        return small * np.array([r[scale] for r in part])[:, None], np.array([r[error] for r in part])

    def run(batches: Iterator[pa.RecordBatch]):
        for first, second, same in _block_pairs(batches, names):
            if not first or not second or same and len(first) < 2:
                continue
            one, one_error = unpacked(first)
            other, other_error = (one, one_error) if same else unpacked(second)
            slack = one_error[:, None] + (1 + one_error[:, None]) * other_error[None, :] + 1e-9
            for x, y in zip(*np.nonzero(one @ other.T >= COSINE - slack)):
                a, b = first[x], second[y]
                if a[root] != b[root] and (not same or x < y):
                    yield min(a[rep], b[rep]), max(a[rep], b[rep])

    return map_rows(dealt, run, f"a {kind}, b {kind}").distinct()


def link_counts(rows: DataFrame) -> DataFrame:
    """(rep, links): linked other vectors per class, from rows (key, rep, n, unit) whose key is the component."""
    kind = rows.schema["rep"].dataType.simpleString()
    dealt = blocked(rows)
    names = dealt.columns
    rep, size, vector = names.index("rep"), names.index("n"), names.index("unit")

    def run(batches: Iterator[pa.RecordBatch]):
        for first, second, same in _block_pairs(batches, names):
            if not first or not second:
                continue
            near = _units(first, vector) @ _units(second, vector).T >= COSINE
            if same:
                np.fill_diagonal(near, False)
            for row, links in zip(first, near @ np.array([r[size] for r in second])):
                yield row[rep], int(links)
            if not same:
                for row, links in zip(second, np.array([r[size] for r in first]) @ near):
                    yield row[rep], int(links)

    return map_rows(dealt, run, f"rep {kind}, links long").groupBy("rep").agg(F.sum("links").alias("links"))


def near_copies(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per vector."""
    rows = keep(directed(vectors), "directed")
    classes = rows.filter("unit is not null").groupBy("unit").agg(
        F.min("vec_id").alias("rep"), F.first("dims").alias("dims"), F.count(F.lit(1)).alias("n")
    )
    classes = keep(classes, "classes")
    # One row per vector length in the table.
    sizes = {r["dims"]: words_per_block(r["count"], r["dims"]) for r in classes.groupBy("dims").count().collect()}
    buckets = keep(shared_buckets(keep(filters(classes, sizes), "filters")), "buckets")
    units = classes.select("rep", "unit")
    light = keep(packed(classes), "packed")
    roots = merged(
        buckets, lambda pairs: confirmed(pairs, units), lambda left: near_pairs(left.join(light, "rep"))
    )
    placed = classes.join(roots, "rep", "left").withColumn("key", F.coalesce("root", "rep"))
    several = roots.groupBy(F.col("root").alias("key")).count().filter("count > 1").select("key")
    counts = link_counts(placed.join(several, "key", "left_semi").select("key", "rep", "n", "unit"))
    moved = keep(
        placed.join(counts, "rep", "left")
        .filter("n > 1 or links > 0")
        .select("unit", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"), F.col("key").alias("_root")),
        "linked",
    )
    joined = spread_join(rows.select("vec_id", "unit"), moved, ["unit"], "vec_id", "left")
    component = F.coalesce("_root", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
