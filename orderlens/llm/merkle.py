"""A Merkle manifest of a dataset, and versions of it by path copying.

Rows are leaves; the leaves of a source, by document id, and then the subroots of
all sources, by source, are folded three by three into one root. Work is cut into
aligned blocks of ``FAN_IN ** LEVELS`` neighbouring nodes, so a source with a third
of all rows is spread over many tasks, and a block's root is one row for the next
levels. Upwards, only block roots travel. Downwards, every block is given the
siblings on its way to the root, one row per block, and finishes its own leaves.

A tampered leaf makes a version of the tree. The nodes of a block are kept once as
immutable levels that all versions share; a version copies only the ancestors of
its leaf within the block and goes on with the copied block root in the levels
above, whose untouched siblings it takes from the block's way. So a version costs
one node per level, and a leaf verifies if the version's root equals the root.

Defined cases: null fields have a hash of their own; rows without a source form the
first source; a null doc_id comes first in its source and is never tampered with;
rows of equal doc_id are ordered by their leaf; repeated rows are leaves of their own;
a text without a line break stays as it is; other columns are ignored; an empty
table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from orderlens.llm.ordering import in_order, running
from orderlens.session import keep

FAN_IN = 3
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def node_hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(text: Column) -> Column:
    """Digest of all fields, with ``text`` in the place of the text."""

    def part(name: str) -> Column:
        value = text if name == "text" else F.col(name).cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, digest, altered): ``altered`` is the tampered leaf, null where nothing changes."""
    text = F.col("text")
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    altered = F.when(chosen & F.contains(text, F.lit("\n")), leaf_hash(F.replace(text, F.lit("\n"), F.lit(""))))
    # Groups are compared as plain text: a null source becomes the empty group, the first of all.
    group = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), F.col("source")))
    return docs.select(
        group.alias("grp"), F.col("doc_id"), leaf_hash(text).alias("digest"), altered.alias("altered"),
        F.monotonically_increasing_id().alias("_tie"),
    )


def numbered(nodes: DataFrame, group: str, order: list[str], columns: list[str], label: str) -> DataFrame:
    """Stored: ``columns`` with the 0-based ``number`` of each node in its group."""
    placed = in_order(nodes, order, columns, label)
    counted = running(placed, [group], {"number": F.lit(1).cast("long")})
    return keep(counted.select(*columns, (F.col("number") - 1).alias("number")), label)


def height(count: int) -> int:
    """Levels above ``count`` nodes."""
    levels = 0
    while count > 1:
        count, levels = -(-count // FAN_IN), levels + 1
    return levels


def block_levels(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of one aligned block, level by level, each list shared by all versions."""
    grown = [digests]
    for _ in range(levels):
        below = grown[-1]
        grown.append([node_hash(below[i : i + FAN_IN]) for i in range(0, len(below), FAN_IN)])
    return grown


def siblings(grown: list[list[str]], number: int) -> list[tuple[str, str]]:
    """Per level of the block, the digests before and after the node on the way up from ``number``."""
    way = []
    for nodes in grown[:-1]:
        start = number - number % FAN_IN
        way.append(("".join(nodes[start:number]), "".join(nodes[number + 1 : start + FAN_IN])))
        number //= FAN_IN
    return way


def copied_path(digest: str, way: list[tuple[str, str]]) -> list[str]:
    """The changed node and the ancestors that its version copies, lowest first; everything else is shared."""
    path = [digest]
    for before, after in way:
        digest = node_hash([before, digest, after])
        path.append(digest)
    return path


def _per_block(nodes: DataFrame, upper: DataFrame, levels: int, work: Callable[..., dict], ddl: str) -> DataFrame:
    """``work(rows, way, grown)`` on every aligned block of ``nodes``, whose rows come as dicts in their order.

    ``upper`` has one row per block (grp, number, ...), which ``work`` gets as ``way``.
    """
    size = FAN_IN**levels
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    counts = nodes.groupBy("grp").agg((F.max("number") + 1).alias("count"))
    given = upper.join(counts, "grp").withColumnRenamed("number", "block")
    given = given.toDF(*given.columns)  # columns of its own, as it may come from the same table
    placed = nodes.withColumn("block", F.floor(F.col("number") / size))

    def on_block(rows: pa.Table, way: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda row: row["number"])
        above = way.to_pylist()[0]
        grown = block_levels([row["digest"] for row in rows], min(levels, height(above["count"])))
        return pa.Table.from_pydict(work(rows, above, grown), schema)

    return placed.groupBy("grp", "block").cogroup(given.groupBy("grp", "block")).applyInArrow(on_block, ddl)


def grown_rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes (grp, number, digest) of every round, stored; at the end one per group, its root."""

    def fold(rows, above, grown):
        return {"grp": [above["grp"]], "number": [above["block"]], "digest": [grown[-1][0]]}

    rounds = [nodes]
    while True:
        below = rounds[-1].select("grp", "number", "digest")
        blocks = below.select("grp", F.floor(F.col("number") / FAN_IN**levels).alias("number")).distinct()
        rounds.append(keep(_per_block(below, blocks, levels, fold, "grp string, number long, digest string"), "merkle-round"))
        if not rounds[-1].agg(F.max("number")).first()[0]:
            return rounds


def ways_down(rounds: list[DataFrame], ends: DataFrame, levels: int) -> DataFrame:
    """The ways of the nodes of the first of ``rounds``, given those of the last: ``ends`` (grp, number, before, after, root, subroot).

    A way lists, level by level, the sibling digests before and after the node.
    """
    ddl = "grp string, number long, before array<string>, after array<string>, root string, subroot string"

    def walk(rows, above, grown):
        own = [siblings(grown, i) for i in range(len(rows))]
        return {
            "grp": [r["grp"] for r in rows], "number": [r["number"] for r in rows],
            "before": [[b for b, _ in way] + above["before"] for way in own],
            "after": [[a for _, a in way] + above["after"] for way in own],
            "root": [above["root"]] * len(rows), "subroot": [above["subroot"]] * len(rows),
        }

    for nodes in reversed(rounds[:-1]):
        ends = keep(_per_block(nodes.select("grp", "number", "digest"), ends, levels, walk, ddl), "merkle-ways")
    return ends


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of ``docs``.

    ``levels`` is the height of an aligned block.
    """
    rows = leaves(docs)
    nodes = numbered(rows, "grp", ["grp", "doc_id", "digest", "_tie"], ["grp", "doc_id", "digest", "altered"], "merkle-leaves")
    rounds = grown_rounds(nodes, levels)
    subroots = rounds[-1].select("grp", "digest", F.lit("").alias("top"))
    tops = numbered(subroots, "top", ["grp"], ["top", "grp", "digest"], "merkle-subroots")
    upper = grown_rounds(tops.select(F.col("top").alias("grp"), "number", "digest"), levels)
    none = F.array().cast("array<string>")
    start = upper[-1].select(
        "grp", "number", none.alias("before"), none.alias("after"), F.col("digest").alias("root"), F.lit("").alias("subroot")
    )
    ways = ways_down(upper, start, levels)
    sources = tops.select("grp", "number", F.col("digest").alias("subroot")).join(ways.drop("grp", "subroot"), "number")
    sources = sources.withColumn("number", F.lit(0).cast("long"))
    above = ways_down(rounds[1:], sources, levels)

    def finish(rows, above, grown):
        outer = list(zip(above["before"], above["after"]))
        ways = [siblings(grown, i) + outer for i in range(len(rows))]
        versions = [copied_path(row["altered"] or row["digest"], way) for row, way in zip(rows, ways)]
        count = len(rows)
        return {
            "doc_id": [r["doc_id"] for r in rows], "leaf": [r["digest"] for r in rows],
            "subroot": [above["subroot"]] * count, "root": [above["root"]] * count,
            "proof_sha256": [node_hash([digest for level in way for digest in level]) for way in ways],
            "folded_root": [version[-1] for version in versions],
            "verified": [version[-1] == above["root"] for version in versions],
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _per_block(
        nodes, above, levels, finish,
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
