"""Near copies of documents: MinHash signatures, a multi-index Hamming join, exact confirmation.

A document is the set of its distinct five-word shingles. Its signature has
``SYMBOLS`` minimum hashes of 32 bits, and the distance of two signatures is the number of
differing symbols. Signatures are cut into chunks of four symbols. By the pigeonhole principle
two signatures within ``MAX_DISTANCE`` agree on some chunk up to the number of
errors allowed to it, where allowances plus one sum to more than MAX_DISTANCE. So every
choice of positions left after the allowed errors is a key, and such pairs
share a key without exception. MAX_DISTANCE lies 4.8 standard deviations above
the mean distance of two documents of similarity 0.75.

Equal sets are one class before anything is compared. Components need no list of
all pairs: in rounds, every class is compared with the one class that leads most of
its buckets, links are merged, and buckets that lie in one component are done. When most pairs of
a round are no links, the signatures of the remaining buckets are compared in two passes. The
first keeps the rows that have a partner of another component within the distance and of a size
that allows a link; no pair is written. The second gives these rows their full sets, compares
them bucket by bucket, and writes a link only where it joins two components that the bucket
has not joined yet, so what is written grows with the rows, also where many similar texts
are no links. A bucket that is too wide is split by the keys of another chunking of
the signature, which every pair within the distance shares as well, and what stays wide is dealt
out by pairs of blocks, so no pair is lost. All links are confirmed on full sets:
100 * intersection >= 75 * union.

Defined cases: null text is empty; an empty set is linked with nothing; fewer than five words
are one shingle; of repeated ids, rows with equal sets are one document and the row with
the smallest set hash counts where they differ (``documents_of``); rows without an id are left out of
the result and stay in ``drop_copies``; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import (
    WordHashes, keep_alone, likely_among, map_rows, mix, odd_constants, rows_in, spread_join, windows, without,
)
from orderlens.llm.merging import merged, shared_buckets
from orderlens.session import keep

SHINGLE = 5
PERCENT = 75
SYMBOLS, CHUNK, MAX_DISTANCE = 48, 4, 26
WIDE_BUCKET = 5_000
MAX_SPLITS = 4
BLOCK_ROWS, BLOCK_SHINGLES = 1_000, 2_000_000
SLICE_SHINGLES = 200_000


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes; bytes.split and bytes.lower know ASCII alone, as wanted."""
    words = hashes.of((text or "").encode().lower().split())
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    return np.unique(windows(words, list(range(size)), odd_constants(SHINGLE, seed=11)) + np.uint64(size))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SYMBOLS 32-bit symbols per (non-empty) set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[:-1]])]).astype(np.int64)
    shifts, factors = odd_constants(SYMBOLS, seed=21), odd_constants(SYMBOLS, seed=22)
    result = np.empty((len(sets), SYMBOLS), np.int32)
    for i in range(SYMBOLS):
        least = np.minimum.reduceat((flat ^ shifts[i]) * factors[i], starts)
        result[:, i] = mix(least).astype(np.uint32).view(np.int32)
    return result


def cover(level: int) -> list[list[int]]:
    """Symbol positions of every key: a chunking of the signature, another one per level."""
    order = np.argsort(odd_constants(SYMBOLS, seed=31 + level)).tolist()
    chunks = [order[i : i + CHUNK] for i in range(0, SYMBOLS, CHUNK)]
    # Allowances plus one must sum to MAX_DISTANCE + 1 over all chunks.
    size, extra = divmod(MAX_DISTANCE + 1, len(chunks))
    keys = []
    for number, chunk in enumerate(chunks):
        errors = size + (number < extra) - 1
        keys += [sorted(kept) for kept in combinations(chunk, CHUNK - errors)]
    return keys


def keys_of(signature: np.ndarray, level: int) -> np.ndarray:
    """Keys (documents x keys) of signature rows."""
    columns = signature.view(np.uint32).astype(np.uint64)
    positions_of, factors, found = cover(level), odd_constants(CHUNK, seed=41), []
    starts = odd_constants(len(positions_of), seed=42)
    for number, positions in enumerate(positions_of):
        total = np.full(len(columns), starts[number])
        for position, factor in zip(positions, factors):
            total += (columns[:, position] + np.uint64(1)) * factor
        found.append(mix(total))
    return np.stack(found, axis=1).view(np.int64)


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, signature) of every row; digest and signature are null for empty sets."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        hashes, ids, sets, size = WordHashes(), [], [], 0

        def flush():
            filled = [s for s in sets if len(s)]
            rows = iter(signatures(filled)) if filled else iter(())
            for doc, found in zip(ids, sets):
                if len(found):
                    yield doc, len(found), xxhash.xxh3_128_digest(found.tobytes()), next(rows).tobytes()
                else:
                    yield doc, 0, None, None

        for doc, text in rows_in(batches):
            found = shingles(text, hashes)
            ids.append(doc)
            sets.append(found)
            size += len(found)
            if size >= SLICE_SHINGLES or len(ids) >= 5_000:
                yield from flush()
                ids, sets, size = [], [], 0
        yield from flush()

    ddl = f"doc_id {kind}, n_shingles long, digest binary, signature binary"
    return map_rows(docs.filter("doc_id is not null").select("doc_id", "text"), run, ddl)


def documents_of(rows: DataFrame) -> DataFrame:
    """One row per id, with its number of rows; of rows that share an id and differ, the one with the smallest digest."""
    least = F.min(F.struct("digest", "n_shingles", "signature")).alias("d")
    return rows.groupBy("doc_id").agg(least, F.count(F.lit(1)).alias("copies")).select("doc_id", "copies", "d.*")


def _keys(classes: DataFrame) -> DataFrame:
    """(key, rep) of all classes."""
    kind = classes.schema["rep"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1_000):
                part = batch.slice(start, 1_000)
                rows = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int32).reshape(-1, SYMBOLS)
                keys = keys_of(rows, 0)
                reps = part.column(0).take(pa.array(np.repeat(np.arange(len(rows)), keys.shape[1])))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), reps], names=["key", "rep"])

    return classes.select("rep", "signature").mapInArrow(run, f"key long, rep {kind}")


def _sets(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, shingles) of the classes that share a bucket; shingles are sorted 64-bit hashes in a row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Most texts share no bucket, so they are not shuffled to find that out.
    texts = likely_among(docs.select(F.col("doc_id").alias("rep"), "text"), "rep", reps.select("rep"))

    def run(batches: Iterator[pa.RecordBatch]):
        hashes = WordHashes()
        for rep, text, digest in rows_in(batches):
            found = shingles(text, hashes)
            if xxhash.xxh3_128_digest(found.tobytes()) == digest:
                yield rep, found.tobytes()

    def of(some: DataFrame) -> DataFrame:
        wanted = texts.join(some, "rep").select("rep", "text", "digest")
        return map_rows(wanted, run, f"rep {kind}, shingles binary", batch_rows=200)

    # Only ids of several rows can come twice; the sets of the others need not be shuffled to find that out.
    return of(reps.filter("copies = 1")).unionByName(of(reps.filter("copies > 1")).dropDuplicates(["rep"]))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The stored pairs (a, b) whose full sets are similar enough."""
    kind = sets.schema["rep"].dataType.simpleString()

    def of(end: str) -> DataFrame:
        """Sets of one end of the pairs, so that few others are shuffled."""
        some = likely_among(sets, "rep", pairs.select(F.col(end).alias("rep")))
        return some.select(F.col("rep").alias(end), F.col("shingles").alias("_" + end))

    both = spread_join(pairs, of("b"), ["b"], "a").join(of("a"), "a")

    def run(batches: Iterator[pa.RecordBatch]):
        for a, b, x, y in rows_in(batches):
            one, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if not _sizes_allow(len(one), len(other)):
                continue
            shared = len(np.intersect1d(one, other, assume_unique=True))
            if 100 * shared >= PERCENT * (len(one) + len(other) - shared):
                yield a, b

    return map_rows(both.select("a", "b", "_a", "_b"), run, f"a {kind}, b {kind}")


def _sizes_allow(one, other):
    """Whether sets of these sizes can be similar enough; sizes may be arrays."""
    return 100 * np.minimum(one, other) >= PERCENT * np.maximum(one, other)


def near_links(left: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links that join the components, from rows (key, rep, root, n, signature) of buckets.

    Every pair of different components within the distance is compared on full sets; of the links, each
    bucket names as many as join its components.
    """
    found, level = [], 0
    rows = keep(left.select("key", "rep", "root", "n", "signature"), "open-buckets")
    while True:
        wide = keep(rows.groupBy("key").count().filter(F.col("count") > WIDE_BUCKET).select("key"), "wide-buckets")
        last = level == MAX_SPLITS or wide.isEmpty()
        found.append(_with_partners(rows if last else rows.join(wide, "key", "left_anti")))
        if last:
            break
        level += 1
        split = _split(rows.join(wide, "key", "left_semi"), level)
        sizes = split.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
        rows = keep(split.join(sizes.select("key"), "key").select(rows.columns), "open-buckets")
    partners = found[0]
    for more in found[1:]:
        partners = partners.unionByName(more)
    partners = keep(partners, "rows-with-partners")
    kind = sets.schema["rep"].dataType.simpleString()
    wanted = likely_among(sets, "rep", partners.select("rep").distinct())
    filled = partners.join(wanted, "rep").select("key", "low", "high", "own", "rep", "root", "shingles")
    filled = filled.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return map_rows(filled, _linked, f"a {kind}, b {kind}").distinct()


def _with_partners(rows: DataFrame) -> DataFrame:
    """(key, low, high, own, rep, root): rows with a partner within the distance, by pairs of blocks of their bucket.

    Blocks hold about BLOCK_ROWS rows and BLOCK_SHINGLES shingles.
    """
    weight = F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)
    sizes = rows.groupBy("key").agg(F.ceil(weight).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = rows.join(sizes, "key").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    dealt = dealt.select("key", "low", "high", "own", "rep", "root", "n", "signature")
    dealt = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return map_rows(dealt, _near, f"key long, low int, high int, own int, rep {kinds['rep']}, root {kinds['root']}")


def _split(rows: DataFrame, level: int) -> DataFrame:
    """Rows of wide buckets under finer keys, one per key of another chunking."""
    finer_by = np.uint64(3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1_000):
                part = batch.slice(start, 1_000)
                signs = np.frombuffer(b"".join(part.column(4).to_pylist()), np.int32).reshape(-1, SYMBOLS)
                coarse = np.array(part.column(0)).view(np.uint64)[:, None]
                finer = mix(keys_of(signs, level).view(np.uint64) * finer_by + coarse)
                copies = part.take(pa.array(np.repeat(np.arange(len(signs)), finer.shape[1])))
                yield pa.RecordBatch.from_arrays([pa.array(finer.view(np.int64).ravel()), *copies.columns[1:]], names=names)

    names = ["key", "rep", "root", "n", "signature"]
    ids = rows.schema["rep"].dataType.simpleString()
    return rows.select(names).mapInArrow(run, f"key long, rep {ids}, root {ids}, n long, signature binary")


def _block_groups(batches: Iterator[pa.RecordBatch]):
    """Per pair of blocks of a bucket: (key, rows, component numbers, places of the first and of the second block)."""
    for (key, low, high), group in groupby(rows_in(batches), key=lambda r: r[:3]):
        rows = list(group)
        numbers: dict = {}
        codes = np.array([numbers.setdefault(r[5], len(numbers)) for r in rows])
        if len(numbers) < 2:
            continue
        own = np.array([r[3] for r in rows])
        yield key, rows, codes, np.flatnonzero(own == low), np.flatnonzero(own == high), low == high


def _tiles(first: np.ndarray, second: np.ndarray, same: bool, size: int):
    """Slices of the two blocks that cover every pair once; inside a slice of one block all pairs appear twice."""
    for i in range(0, len(first), size):
        for j in range(i if same else 0, len(second), size):
            yield first[i : i + size], second[j : j + size]


def _distances(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    if len(one) * len(other) <= 1_024:
        return (one[:, None, :] != other[None, :, :]).sum(2)
    apart = np.zeros((len(one), len(other)), np.uint8)
    for symbol in range(SYMBOLS):
        apart += one[:, symbol, None] != other[None, :, symbol]
    return apart


def _near(batches: Iterator[pa.RecordBatch]):
    """Rows of buckets that have a partner of another component, within the distance and of a suitable size.

    A pair that shares several buckets counts in the one of the smallest key alone, which its
    signatures tell; the keys of split buckets are others, and there it may count again.
    """
    for key, rows, codes, first, second, same in _block_groups(batches):
        sizes = np.array([r[6] for r in rows])
        signs = np.frombuffer(b"".join(r[7] for r in rows), np.int32).reshape(len(rows), -1)
        partnered, keys, split = np.zeros(len(rows), bool), None, False
        for one, other in _tiles(first, second, same, 256):
            near = (codes[one, None] != codes[None, other]) & _sizes_allow(sizes[one, None], sizes[None, other])
            near &= ~(partnered[one, None] & partnered[None, other])
            if not near.any():
                continue
            x, y = np.nonzero(near & (_distances(signs[one], signs[other]) <= MAX_DISTANCE))
            if not len(x):
                continue
            x, y = one[x], other[y]
            if keys is None:
                keys = keys_of(signs, 0)
                split = not (keys == key).any()
            if not split:
                named = np.zeros(len(x), bool)
                for start in range(0, len(x), 4_096):
                    part = slice(start, start + 4_096)
                    here, there = keys[x[part]], keys[y[part]]
                    named[part] = np.where(here == there, here, np.iinfo(np.int64).max).min(1) == key
                x, y = x[named], y[named]
            partnered[x] = partnered[y] = True
        for place in np.flatnonzero(partnered):
            yield rows[place][:6]


def overlaps(one: list[np.ndarray], other: list[np.ndarray], width: int = 4_096) -> np.ndarray:
    """Sizes of the intersections of every set of ``one`` with every set of ``other``."""
    sets = one if one is other else one + other
    values, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1 if one is not other else np.ones(len(values), bool)
    column = np.cumsum(shared) - 1
    chosen = shared[places]
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[chosen]
    columns = column[places[chosen]]
    order = np.argsort(columns, kind="stable")
    owners, columns = owners[order], columns[order]
    total = np.zeros((len(one), len(other)), np.int64)
    ends = int(shared.sum())
    for start in range(0, ends, width):
        low, high = np.searchsorted(columns, [start, start + width])
        marks = np.zeros((len(sets), min(width, ends - start)), np.float32)
        marks[owners[low:high], columns[low:high] - start] = 1
        total += (marks[: len(one)] @ marks[len(sets) - len(other) :].T).astype(np.int64)
    return total


def _linked(batches: Iterator[pa.RecordBatch]):
    """Per pair of blocks, links on full sets that join components not yet joined there: fewer than its rows."""
    for _, rows, codes, first, second, same in _block_groups(batches):
        sets = [np.frombuffer(r[6], np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets])
        for one, other in _tiles(first, second, same, 128):
            if not (codes[one, None] != codes[None, other]).any():
                continue
            left = [sets[x] for x in one]
            shared = overlaps(left, left if one[0] == other[0] else [sets[y] for y in other])
            links = 100 * shared >= PERCENT * (sizes[one, None] + sizes[None, other] - shared)
            for x, row in zip(one, links):
                while len(open_ends := other[row & (codes[other] != codes[x])]):
                    y = open_ends[0]
                    yield tuple(sorted((rows[x][4], rows[y][4])))
                    codes[codes == codes[y]] = codes[x]


def _moved(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(digest, _root) of the classes of several documents or of a component with others."""
    buckets = keep(shared_buckets(_keys(classes)), "buckets")
    members = buckets.select("rep").distinct()
    columns = classes.select("rep", "digest", "copies", F.col("size").alias("n"), "signature")
    members = keep(members.join(columns, "rep"), "members")
    sets = keep(_sets(docs, members.select("rep", "digest", "copies")), "sets")
    signed = members.select("rep", "n", "signature")
    roots = merged(
        buckets, lambda pairs: confirmed(pairs, sets), lambda left: near_links(left.join(signed, "rep"), sets), sure=True
    )
    moved = classes.join(roots, "rep", "left").select("digest", "n", F.coalesce("root", "rep").alias("root"), "rep")
    return moved.filter("n > 1 or root != rep").select("digest", F.col("root").alias("_root"))


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    rows = keep(documents_of(described(docs)), "described")
    filled = rows.filter("digest is not null")
    classes = filled.groupBy("digest").agg(
        F.min(F.struct("doc_id", "copies")).alias("_rep"), F.first("signature").alias("signature"), F.count(F.lit(1)).alias("n"),
        F.first("n_shingles").alias("size"),
    )
    classes = keep(classes.select("digest", F.col("_rep.doc_id").alias("rep"), "_rep.copies", "signature", "n", "size"), "classes")
    moved = keep_alone(docs.sparkSession, "moved", lambda: _moved(docs, classes))
    joined = spread_join(rows, moved, ["digest"], "doc_id", "left")
    component = F.coalesce("_root", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component; rows without an id stay."""
    gone = keep(components(docs).filter("not kept").select("doc_id"), "gone")
    return without(docs, "doc_id", gone)
