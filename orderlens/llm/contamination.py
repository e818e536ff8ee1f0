"""Benchmark decontamination by spaced-seed hashing.

A seed is a window of 12 tokens, cut into four blocks of three; a mask ignores two
of the blocks. The six masks together survive any two substituted tokens in a window.
Every masked window of the benchmark is hashed, every masked window of the
documents is looked up, and around each hit the two texts are compared token by
token along the same diagonal. An overlap is any stretch of it between equal tokens that
has ``MIN_TOKENS`` tokens (or as many as the item) of which ``MIN_EQUAL`` are equal, or the
whole item with that share, its first and last tokens substituted or not. Items shorter
than a window are matched whole and exactly.

Benchmark hashes travel in blocks of bounded size, built once and broadcast, one pass over
the documents each; documents are never shuffled.

Tokens are runs of letters and digits, lower-cased. Defined cases: null texts are
empty; items without tokens match nothing, items of one word every document with that
word; a null item or document id stays null in the result; repeated rows repeat; an
empty table on either side gives none. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import MEMO_WORDS, WordHashes, map_rows, mix, odd_constants, rows_in, windows

TOKEN = re.compile(r"[^\W_]+")
WINDOW = 12
# Kept positions of each mask: two of the four blocks of three.
MASKS = [
    [p for p in range(WINDOW) if p // 3 in pair] for pair in ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))
]
MIN_TOKENS = 13
MIN_EQUAL = 4, 5  # so many of so many tokens
ITEMS_PER_BLOCK_TOKENS = 400_000


class TokenHashes(WordHashes):
    """The same for words as text, which are encoded only when they are new."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return value


def token_hashes(text: str, hashes: TokenHashes) -> np.ndarray:
    return hashes.of(TOKEN.findall(text.lower()))


def seed_hashes(tokens: np.ndarray) -> list[np.ndarray]:
    """Per mask, the hash at every window start: the sum of the two kept blocks' hashes, each worked out once."""
    reach = len(tokens) - WINDOW + 1
    if reach <= 0:
        return [np.zeros(0, np.uint64)] * len(MASKS)
    factors = odd_constants(WINDOW, seed=5)
    sums = []
    for first in range(0, WINDOW, 3):
        total = tokens[first : first + reach] * factors[first]
        for at in (first + 1, first + 2):
            total += tokens[at : at + reach] * factors[at]
        sums.append(total)
    return [mix(sums[mask[0] // 3] + sums[mask[-1] // 3]) for mask in MASKS]


def whole_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` tokens from every start."""
    return windows(tokens, list(range(length)), odd_constants(length, seed=6))


class SeedIndex:
    """Masked windows of a block of benchmark items, and whole items shorter than a window."""

    def __init__(self, items: list[tuple[object, str]]):
        hashes = TokenHashes()
        self.ids = [i for i, _ in items]
        self.tokens = [token_hashes(t or "", hashes) for _, t in items]
        found = [[] for _ in MASKS]
        short: dict[int, list] = {}
        for number, tokens in enumerate(self.tokens):
            if 0 < len(tokens) < WINDOW:
                short.setdefault(len(tokens), []).append((whole_hashes(tokens, len(tokens))[0], number))
            for mask, values in enumerate(seed_hashes(tokens)):
                place = np.full(len(values), number, np.int64), np.arange(len(values), dtype=np.int64)
                found[mask].append((values, *place))
        self.masks = []
        for parts in found:
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.uint64)] * 3
            order = np.argsort(columns[0], kind="stable")
            self.masks.append([c[order] for c in columns])
        self.short = {}
        for length, pairs in short.items():
            values, numbers = (np.array(c, kind) for c, kind in zip(zip(*sorted(pairs)), (np.uint64, np.int64)))
            self.short[length] = values, numbers
        total = sum(len(m[0]) for m in self.masks)
        self.bits = np.uint64(max(16, int(total * 16).bit_length()))
        self.filter = np.zeros(1 << int(self.bits), bool)
        for values, *_ in self.masks:
            self.filter[values >> (np.uint64(64) - self.bits)] = True

    def diagonals(self, tokens: np.ndarray) -> set[tuple[int, int]]:
        """(item number, document position minus item position) of every hit."""
        found = set()
        for (values, numbers, starts), seeds in zip(self.masks, seed_hashes(tokens)):
            near = np.flatnonzero(self.filter[seeds >> (np.uint64(64) - self.bits)])
            low = np.searchsorted(values, seeds[near], "left")
            high = np.searchsorted(values, seeds[near], "right")
            for at, a, b in zip(near[low < high], low[low < high], high[low < high]):
                found.update(zip(numbers[a:b].tolist(), (at - starts[a:b]).tolist()))
        return found

    def exact(self, tokens: np.ndarray) -> dict[int, int]:
        """Number of each short item that occurs whole -> its first document position."""
        found: dict[int, int] = {}
        for length, (values, numbers) in self.short.items():
            seen, first = np.unique(whole_hashes(tokens, length), return_index=True)
            low, high = np.searchsorted(seen, values, "left"), np.searchsorted(seen, values, "right")
            for number, at in zip(numbers[low < high].tolist(), first[low[low < high]].tolist()):
                if (tokens[at : at + length] == self.tokens[number]).all():
                    found[number] = at
        return found

    def overlaps(self, tokens: np.ndarray) -> Iterator[tuple[object, int, int, int, int]]:
        """(item id, document start, item start, length, equal tokens): the best overlap per item."""
        best: dict[int, tuple] = {}
        for number, diagonal in self.diagonals(tokens):
            item = self.tokens[number]
            low, high = max(0, diagonal), min(len(tokens), diagonal + len(item))
            equal = tokens[low:high] == item[low - diagonal : high - diagonal]
            segment = best_segment(equal, min(MIN_TOKENS, len(item)))
            if segment is None and len(equal) == len(item) and has_share(int(equal.sum()), len(item)):
                segment = 0, len(item), int(equal.sum())
            if segment is not None:
                start, end, same = segment
                found = (same, end - start, low + start, low + start - diagonal)
                best[number] = max(best.get(number, found), found)
        for number, start in self.exact(tokens).items():
            length = len(self.tokens[number])
            best[number] = length, length, start, 0
        for number, (same, length, start, item_start) in best.items():
            yield self.ids[number], start, item_start, length, same


def has_share(same: int, length: int) -> bool:
    part, whole = MIN_EQUAL
    return same * whole >= length * part


def best_segment(equal: np.ndarray, least: int) -> tuple[int, int, int] | None:
    """(start, end, equal tokens) of the segment with the most equal tokens among those that have ``least`` tokens, a
    share of ``MIN_EQUAL`` and an equal token at either end."""
    part, whole = MIN_EQUAL
    # A segment has the share if its sum of these is not negative.
    total = np.concatenate([[0], np.cumsum(np.where(equal, whole - part, -part))])
    count = np.concatenate([[0], np.cumsum(equal)])
    places = np.flatnonzero(equal)
    ends = places + 1
    # Per end, the first start from which the share is reached, and from there the first equal token.
    starts = np.searchsorted(-np.minimum.accumulate(total), -total[ends], "left")
    starts = places[np.searchsorted(places, starts)]
    long = ends - starts >= least
    if not long.any():
        return None
    starts, ends = starts[long], ends[long]
    best = int(np.argmax(count[ends] - count[starts]))
    start, end = int(starts[best]), int(ends[best])
    return start, end, int(count[end] - count[start])


def blocks(benchmark: DataFrame, limit: int = ITEMS_PER_BLOCK_TOKENS) -> Iterator[list[tuple]]:
    """The benchmark in blocks of about ``limit`` tokens, each of which one task can hold."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(TOKEN.findall((row["text"] or "").lower()))
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


OVERLAP_DDL = "doc_start long, item_start long, n_tokens long, n_equal long"


def contaminated(docs: DataFrame, benchmark: DataFrame, limit: int = ITEMS_PER_BLOCK_TOKENS) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_tokens, n_equal): a document's longest overlap with each item."""
    spark, narrow = docs.sparkSession, docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, item_id {item_kind}, {OVERLAP_DDL}"

    def search(block):
        built = spark.sparkContext.broadcast(SeedIndex(block))

        def run(batches: Iterator[pa.RecordBatch]):
            index, hashes = built.value, TokenHashes()
            for doc, text in rows_in(batches):
                for item, *found in index.overlaps(token_hashes(text or "", hashes)):
                    yield doc, item, *found

        return map_rows(narrow, run, ddl)

    found = [search(block) for block in blocks(benchmark, limit)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], ddl)


def clean(docs: DataFrame, benchmark: DataFrame, limit: int = ITEMS_PER_BLOCK_TOKENS) -> DataFrame:
    """``docs`` without the rows that overlap a benchmark item; columns stay as they are."""
    spark, text_at = docs.sparkSession, docs.columns.index("text")
    for block in blocks(benchmark, limit):
        built = spark.sparkContext.broadcast(SeedIndex(block))

        def run(batches: Iterator[pa.RecordBatch], built=built) -> Iterator[pa.RecordBatch]:
            index, hashes = built.value, TokenHashes()
            for batch in batches:
                kept = [
                    next(index.overlaps(token_hashes(text or "", hashes)), None) is None
                    for (text,) in rows_in([batch.select([text_at])])
                ]
                yield batch.filter(pa.array(kept, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
