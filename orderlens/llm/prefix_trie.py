"""The trie of conversation prefixes, from the common prefixes of sorted neighbours.

Conversations are sorted as sequences of turns, so the members of every prefix
are neighbours, and an edge between two neighbours is as deep as their common
prefix. Union-find over these edges in descending depth builds the trie: a merge
at depth d makes the branching node of that depth. Each range of the sorted
conversations merges for itself. A component that may go on beyond the border of
its range, because the border's edge is deeper, stays open: what is left of a
range is a few open components between edges that fall towards its middle. These
contracted forests of neighbouring ranges are merged in the next round, until
one range is left. Nodes between two branchings have the members of the lower
one and are written out along its edge.

Nothing holds a conversation whole: turns are carried as 128-bit codes, places
and byte sums are distributed prefix sums, and sort keys are blocks of codes;
where a conversation has more than ``BLOCK`` turns, blocks are replaced by their
ranks, which sort alike, until one block is left.

Defined cases: rows without conv_id belong to no conversation; null role or text
is empty; turns are ordered by turn (null first), then role and text, and
repeated rows are repeated turns; equal conversations are members of the same
nodes; other columns are ignored; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows, rows_in, spread_join
from orderlens.llm.ordering import in_order, running
from orderlens.session import keep

BLOCK = 256
SLICE_SEQUENCES = 50_000
FAN_IN = 64
CODE, RANK = 32, 16  # hex digits of a turn's code and of a block's rank
ROOT = "0:0"
NO_END = hashlib.sha256(b"").hexdigest()
IDS_PER_CHUNK = 4_096


def coded(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, code, size): every turn by its place from 1, the code of (role, text) and the text's bytes."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"), role.alias("_role"), text.alias("_text"),
        F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, CODE).alias("code"),
        F.octet_length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("_tie"),  # splits repeated rows over ranges
    )
    placed = in_order(rows, ["conv_id", "_turn", "_role", "_text", "_tie"], ["conv_id", "code", "size"], "turns")
    return running(placed, ["conv_id"], {"pos": F.lit(1).cast("long")}).select("conv_id", "pos", "code", "size")


def rebuilt(sequences: DataFrame, group: int = 5, shared: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of c - c % ``group``; h is crc32(c) % ``shared``."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared))
    members = sequences.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("_base"), h.alias("_h"))
    heads = sequences.filter((F.col("conv_id") % group == 0) & (F.col("pos") < shared))
    heads = heads.withColumnRenamed("conv_id", "_base")
    # Fewer than 2 x group conversations share a base, and each takes fewer than `shared` turns of it.
    taken = members.join(heads, "_base").filter(F.col("pos") <= F.col("_h")).select("conv_id", "pos", "code", "size")
    return taken.unionByName(sequences.filter(F.col("pos") > h))


def _paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, pos, code, size, bytes, prefix): with the bytes up to each turn and the identity of the prefix it ends.

    ``pos`` is counted anew, from 1 without gaps.
    """
    placed = in_order(sequences, ["conv_id", "pos"], ["conv_id", "code", "size"], "sequences")
    numbered = running(placed, ["conv_id"], {"pos": F.lit(1).cast("long")})
    lane = lambda n: F.xxhash64("code", "pos", F.lit(n)).cast("decimal(20,0)")
    summed = running(numbered, ["conv_id"], {"bytes": F.col("size"), "_a": lane(1), "_b": lane(2)})
    prefix = F.concat(F.col("_a").cast("string"), F.lit(":"), F.col("_b").cast("string"))
    return keep(summed.select("conv_id", "pos", "code", "size", "bytes", prefix.alias("prefix")), "paths")


def _keys(paths: DataFrame, block: int) -> tuple[DataFrame, list[DataFrame]]:
    """(conv_id, key) whose order is that of the sequences; the ranked blocks (key, rank) of each lower level."""
    codes, levels = paths.select("conv_id", "pos", "code"), []
    while True:
        in_block = F.array_sort(F.collect_list(F.struct("pos", "code")))
        blocks = codes.groupBy("conv_id", F.floor((F.col("pos") - 1) / block).alias("block")).agg(
            F.array_join(F.transform(in_block, lambda x: x["code"]), "").alias("key")
        )
        blocks = keep(blocks, "blocks")
        if not blocks.agg(F.max("block")).first()[0]:
            return blocks.select("conv_id", "key"), levels
        placed = in_order(blocks.select("key").distinct(), ["key"], ["key"], "block-order")
        ranked = running(placed.withColumn("_all", F.lit(0)), ["_all"], {"number": F.lit(1).cast("long")})
        ranked = keep(ranked.select("key", F.lpad(F.hex("number"), RANK, "0").alias("code")), "block-ranks")
        levels.append(ranked)
        codes = spread_join(blocks, ranked, ["key"], "conv_id").select("conv_id", (F.col("block") + 1).alias("pos"), "code")


def _shared(key: str, other: str | None, width: int) -> tuple[int, str | None, str | None]:
    """The symbols that two keys share from the start, and the first in which they differ."""
    if other is None:
        return 0, None, None
    count, least = 0, min(len(key), len(other))
    while count < least and key[count : count + width] == other[count : count + width]:
        count += width
    return count // width, key[count : count + width] or None, other[count : count + width] or None


def _compared(rows: DataFrame, width: int, block: int) -> DataFrame:
    """Adds the shared symbols of key and next_key to ``lcp``, counted in blocks so far."""
    carried = [c for c in rows.columns if c not in ("key", "next_key", "lcp")]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*carried).schema)

    def compare(batches: Iterator[pa.RecordBatch]):
        for key, other, lcp, *rest in rows_in(batches):
            count, mine, theirs = _shared(key or "", other, width)
            yield (*rest, lcp * block + count, mine, theirs)

    chosen = rows.select("key", "next_key", "lcp", *carried)
    return map_rows(chosen, compare, f"{ddl}, lcp long, code string, next_code string")


def _neighbours(members: DataFrame, paths: DataFrame, levels: list[DataFrame], block: int, slice_rows: int) -> DataFrame:
    """The distinct sequences in their order: the items of the first round, each with its edge to the next one."""
    found = keep(
        members.groupBy("key", "prefix", "bytes", "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")),
        "sequences",
    )
    columns = ["key", "prefix", "bytes", "depth", "conv_id", "n"]
    placed = in_order(found, ["key"], columns, "sorted", max(1, math.ceil(found.count() / slice_rows)))
    inside = Window.partitionBy("slice").orderBy("place")
    first = placed.groupBy("slice").agg(F.min_by(F.struct("key", "depth"), "place").alias("first"))
    after = Window.orderBy("slice")  # one row per slice
    heads = keep(first.select("slice", F.lead("first").over(after).alias("head")), "slice-heads")
    following = F.coalesce(F.lead(F.struct("key", "depth")).over(inside), F.col("head"))
    rows = placed.join(F.broadcast(heads), "slice").withColumn("following", following).select(
        *placed.columns, F.lit(0).cast("long").alias("lcp"),
        F.col("following.key").alias("next_key"), F.col("following.depth").alias("next_depth"),
    )
    rows = _compared(rows, RANK if levels else CODE, block)
    for number, ranked in reversed(list(enumerate(levels))):
        mine = ranked.select("code", "key")
        theirs = ranked.select(F.col("code").alias("next_code"), F.col("key").alias("next_key"))
        # Both are unique per code; rows without a code have come to the end of a sequence.
        rows = keep(rows, "differing")
        rows = spread_join(rows, mine, ["code"], "conv_id", "left")
        rows = spread_join(keep(rows, "differing"), theirs, ["next_code"], "conv_id", "left").drop("code", "next_code")
        rows = _compared(rows, RANK if number else CODE, block)
    lcp = F.when(F.col("next_depth").isNotNull(), F.least("lcp", "depth", "next_depth"))
    rows = rows.withColumn("lcp", lcp).drop("code", "next_code", "next_depth")
    at = paths.select("conv_id", F.col("pos").alias("lcp"), F.col("prefix").alias("edge_prefix"), F.col("bytes").alias("edge_bytes"))
    zero = F.lit(0).cast("long")
    return rows.join(at, ["conv_id", "lcp"], "left").select(
        "slice", "place", "conv_id", "n", "depth", "bytes", "prefix", zero.alias("children"), zero.alias("leaves"), zero.alias("below"),
        F.coalesce("lcp", F.lit(-1)).alias("lcp"), F.coalesce("edge_prefix", F.lit(ROOT)).alias("edge_prefix"),
        F.coalesce("edge_bytes", zero).alias("edge_bytes"),
    )


ITEM = (
    "slice int, place long, conv_id long, n long, depth long, bytes long, prefix string, children long, leaves long, "
    "below long, lcp long, edge_prefix string, edge_bytes long"
)
# A finished component spans the depths from ``top`` to ``depth``; ``parent`` is the prefix above.
FOREST = f"{ITEM}, top long, parent string"


class _Component:
    """Neighbouring items that share a prefix of ``depth`` turns: a node and what is known below it."""

    __slots__ = ("conv", "n", "depth", "bytes", "prefix", "children", "leaves", "below")

    def __init__(self, conv, n, depth, size, prefix, children=0, leaves=0, below=0):
        self.conv, self.n, self.depth, self.bytes, self.prefix = conv, n, depth, size, prefix
        self.children, self.leaves, self.below = children, leaves, below

    def end_leaves(self) -> int:
        return self.leaves if self.children else 1

    def take(self, child: _Component) -> None:
        """A finished component becomes a child; what its edge saves lies below this node."""
        self.conv, self.n = min(self.conv, child.conv), self.n + child.n
        self.children += 1
        self.leaves += child.end_leaves()
        self.below += child.below + (child.n - 1) * (child.bytes - self.bytes)

    def absorb(self, same: _Component) -> None:
        """Another part of this very node."""
        self.conv, self.n = min(self.conv, same.conv), self.n + same.n
        self.children += same.children
        self.leaves += same.leaves
        self.below += same.below


def merge_range(items: pd.DataFrame) -> pd.DataFrame:
    """One round over one range of neighbours: finished components, and what stays open, in its order.

    ``left`` is the depth of the edge before the range, -1 at the ends of the order.
    """
    items = items.sort_values("place")
    slice_no, left = int(items["slice"].iloc[0]), int(items["left"].iloc[0])
    places, edges = items["place"].tolist(), items["lcp"].tolist()
    edge_prefix, edge_bytes = items["edge_prefix"].tolist(), items["edge_bytes"].tolist()
    fields = ("conv_id", "n", "depth", "bytes", "prefix", "children", "leaves", "below")
    parts = [_Component(*row) for row in zip(*[items[c].tolist() for c in fields])]
    count, right = len(parts), edges[-1]
    up, low, high = list(range(count)), list(range(count)), list(range(count))
    closed: list[tuple] = []

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def close(part: _Component, top: int, parent: str | None) -> None:
        closed.append(
            (slice_no, None, part.conv, part.n, part.depth, part.bytes, part.prefix, part.children, part.end_leaves(), part.below,
             None, None, None, top, parent)
        )

    for edge in sorted(range(count - 1), key=lambda i: -edges[i]):
        depth, a, b = edges[edge], find(edge), find(edge + 1)
        before = edges[low[a] - 1] if low[a] else left
        after = edges[high[b]] if high[b] < count - 1 else right
        if max(before, after) > depth:  # open beyond a border
            continue
        merged = None
        for part in (parts[a], parts[b]):
            if part.depth == depth:
                if merged is None:
                    merged = part
                else:
                    merged.absorb(part)
        for part in (parts[a], parts[b]):
            if part.depth > depth:
                close(part, depth + 1, edge_prefix[edge])
                if merged is None:
                    merged = _Component(part.conv, 0, depth, edge_bytes[edge], edge_prefix[edge])
                merged.take(part)
        up[b], high[a], parts[a] = a, high[b], merged
    roots = [i for i in range(count) if up[i] == i]
    if left < 0 and right < 0:  # the whole order: one component is left
        last = parts[roots[0]]
        if last.depth:
            close(last, 1, ROOT)
            root = _Component(last.conv, 0, 0, 0, ROOT)
            root.take(last)
            last = root
        close(last, 0, None)
        roots = []
    still = [
        (slice_no, places[low[i]], p.conv, p.n, p.depth, p.bytes, p.prefix, p.children, p.leaves, p.below,
         edges[high[i]], edge_prefix[high[i]], edge_bytes[high[i]], None, None)
        for i in roots for p in [parts[i]]
    ]
    return pd.DataFrame(still + closed, columns=[c.split()[0] for c in FOREST.split(", ")]).astype(
        {c.split()[0]: "Int64" for c in FOREST.split(", ") if c.endswith("long")}
    )


def _forest(items: DataFrame, fan_in: int) -> DataFrame:
    """The finished components (conv_id, n, top, depth, bytes, prefix, children, leaves, below, parent)."""
    finished, items = [], keep(items, "items")
    last = items.agg(F.max("slice")).first()[0]
    while last is not None:
        borders = items.groupBy("slice").agg(F.max_by("lcp", "place").alias("lcp"))
        borders = borders.select("slice", F.coalesce(F.lag("lcp").over(Window.orderBy("slice")), F.lit(-1)).alias("left"))
        merged = items.join(F.broadcast(keep(borders, "borders")), "slice").groupBy("slice").applyInPandas(merge_range, FOREST)
        merged = keep(merged, "forest")
        finished.append(merged.filter("top is not null"))
        items = merged.filter("top is null").drop("top", "parent")
        if not last:
            break
        items, last = items.withColumn("slice", F.floor(F.col("slice") / fan_in).cast("int")), last // fan_in
    if not finished:
        return items.select(*items.columns, F.lit(0).cast("long").alias("top"), F.lit("").alias("parent"))
    every = finished[0]
    for more in finished[1:]:
        every = every.unionByName(more)
    return every


def _ends(members: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of every sequence: the digest of its members' ids, ascending, comma-joined.

    A digest is sequential, so one task reads a sequence's ids; they come as chunks
    that were joined before, and pass as a stream.
    """
    placed = in_order(members.select("prefix", "conv_id"), ["prefix", "conv_id"], ["prefix", "conv_id"], "ends")
    ordered = running(placed, ["prefix"], {"number": F.lit(1).cast("long")})
    chunk = F.floor((F.col("number") - 1) / IDS_PER_CHUNK).alias("chunk")
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ordered.groupBy("prefix", chunk).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]):
        current, state = None, None
        for prefix, number, text in rows_in(batches):
            if prefix != current:
                if state is not None:
                    yield current, state.hexdigest()
                current, state = prefix, hashlib.sha256()
            state.update(f",{text}".encode() if number else text.encode())
        if state is not None:
            yield current, state.hexdigest()

    return map_rows(chunks.repartition("prefix").sortWithinPartitions("prefix", "chunk"), digest, "prefix string, ends_sha256 string")


def prefix_trie(
    sequences: DataFrame, members: DataFrame, block: int = BLOCK, slice_rows: int = SLICE_SEQUENCES, fan_in: int = FAN_IN
) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv_id, pos, code, size), as ``coded`` makes them.

    ``members`` (conv_id, unique) adds conversations without turns. Columns: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves (childless
    nodes of the subtree), saved_tokens (over the subtree, bytes of the last text times
    members but one), ends_sha256 (ids of the members that end here).
    """
    paths = _paths(sequences)
    keys, levels = _keys(paths, block)
    ends = paths.groupBy("conv_id").agg(F.max(F.struct("pos", "prefix", "bytes")).alias("end"))
    zero = F.lit(0).cast("long")
    every = members.join(keys, "conv_id", "left").join(ends, "conv_id", "left").select(
        "conv_id", F.coalesce("key", F.lit("")).alias("key"), F.coalesce("end.prefix", F.lit(ROOT)).alias("prefix"),
        F.coalesce("end.bytes", zero).alias("bytes"), F.coalesce("end.pos", zero).alias("depth"),
    )
    every = keep(every, "members")
    nodes = _forest(_neighbours(every, paths, levels, block, slice_rows), fan_in)
    columns = ["conv_id", "n", "top", "depth", "bytes", "prefix", "children", "leaves", "below", "parent"]
    nodes = keep(nodes.select(*columns), "components")
    above = nodes.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = spread_join(nodes, above, ["parent"], "prefix", "left").join(_ends(every), "prefix", "left")
    # Long edges are written out in runs of bounded length.
    runs = nodes.withColumn("_from", F.explode(F.sequence("top", "depth", F.lit(1_024).cast("long"))))
    along = F.sequence("_from", F.least(F.col("_from") + 1_023, "depth"))
    spread = runs.withColumn("pos", F.explode(along)).join(
        paths.select("conv_id", "pos", "size", F.col("bytes").alias("_upto")), ["conv_id", "pos"], "left"
    )
    at_end = F.col("pos") == F.col("depth")
    along_edge = F.col("bytes") - F.coalesce("_upto", zero) + F.coalesce("size", zero)
    return spread.select(
        "conv_id", F.col("pos").alias("depth"),
        F.when(F.col("pos") == F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(at_end, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("below") + (F.col("n") - 1) * along_edge).alias("saved_tokens"),
        F.coalesce(F.when(at_end, F.col("ends_sha256")), F.lit(NO_END)).alias("ends_sha256"),
    )


def shared_prefixes(turns: DataFrame, **options) -> DataFrame:
    """The trie of ``turns`` (conv_id, turn, role, text) as they are."""
    sequences = keep(coded(turns), "coded")
    return prefix_trie(sequences, sequences.select("conv_id").distinct(), **options)


def shared_rebuilt_prefixes(turns: DataFrame, **options) -> DataFrame:
    """The trie after ``rebuilt``; a conversation may lose all turns by it and is then a member of the root alone."""
    sequences = keep(coded(turns), "coded")
    return prefix_trie(rebuilt(sequences), sequences.select("conv_id").distinct(), **options)
