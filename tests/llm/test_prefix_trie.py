"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from orderlens.llm import prefix_trie as trie
from orderlens.session import keep

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversations(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


def after_rebuild(own):
    changed = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        changed[c] = own.get(base, [])[:h] + turns[h:]
    return changed


def brute_force(found):
    members = defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = lambda node: [n for n in members if n[: len(node)] == node]
    rows = set()
    for node, convs in members.items():
        tree = below(node)
        saved = sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in tree)
        leaves = sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in tree) for n in tree)
        children = sum(len(n) == len(node) + 1 for n in tree)
        ends = ",".join(str(c) for c in sorted(convs) if len(found[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.add((min(convs), len(node), parent, len(convs), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def rows_of(df):
    collected = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(collected) == len(set(collected))
    return set(collected)


def random_turns(seed, convs, longest, texts):
    draw = random.Random(seed)
    return [
        (c, t, draw.choice(["user", "user", "assistant", None]), draw.choice(texts))
        for c in range(-3, convs) for t in range(draw.randint(0, longest))
    ]


@pytest.mark.parametrize("options", [{}, {"block": 2, "slice_rows": 5, "fan_in": 2}, {"block": 3, "slice_rows": 1, "fan_in": 3}])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, options, seed):
    rows = random_turns(seed, 40, 9, ["a", "b", None])
    df = spark.createDataFrame(rows, TURNS)
    assert rows_of(trie.shared_prefixes(df, **options)) == brute_force(conversations(rows))


def test_rebuilt_equals_brute_force(spark):
    rows = random_turns(3, 60, 12, ["x", "yy", "üz"])
    df = spark.createDataFrame(rows, TURNS)
    found = after_rebuild(conversations(rows))
    assert any(not turns for turns in found.values())
    assert rows_of(trie.shared_rebuilt_prefixes(df, slice_rows=7, fan_in=2)) == brute_force(found)


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [
        (1, None, "user", "b"), (1, 0, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"),
        (None, 0, "user", "lost"), (2, None, "user", "b"), (9, 5, "", ""), (9, 7, None, None),
    ]
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], TURNS + ", slice string, pos int")
    assert rows_of(trie.shared_prefixes(df)) == brute_force(conversations(rows))


def test_long_conversations_over_many_blocks(spark):
    """One conversation with a third of all turns, a copy of it, and one that leaves it near its end."""
    long = [(0, t, "user", str(t % 7)) for t in range(600)]
    copy = [(1, *r[1:]) for r in long]
    leaves = [(2, *r[1:]) for r in long[:590]] + [(2, 600, "user", "other")]
    rows = long + copy + leaves
    df = spark.createDataFrame(rows, TURNS)
    found = rows_of(trie.shared_prefixes(df, block=4, slice_rows=2))
    assert len(found) == 602
    by_depth = {(r[0], r[1]): r for r in found}
    assert by_depth[(0, 590)][3:6] == (3, 2, 2) and by_depth[(0, 591)][3:6] == (2, 1, 1)
    assert by_depth[(2, 591)][2:6] == (0, 1, 0, 1)
    assert by_depth[(0, 0)][6] == 2 * 590 + 10


def test_copies_of_one_conversation(spark):
    df = spark.range(9_000).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'same' AS text")
    found = rows_of(trie.shared_prefixes(df, slice_rows=10))
    ids = ",".join(map(str, range(9_000)))
    assert found == {
        (0, 0, None, 9_000, 1, 1, 4 * 8_999, trie.NO_END),
        (0, 1, 0, 9_000, 0, 1, 4 * 8_999, hashlib.sha256(ids.encode()).hexdigest()),
    }


def test_very_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(4, 0, "user", "é" * 1_000_000), (6, 0, "user", "é" * 1_000_000)], TURNS)
    assert {r[6] for r in rows_of(trie.shared_prefixes(df))} == {2_000_000}
    empty = spark.createDataFrame([], TURNS)
    assert rows_of(trie.shared_prefixes(empty)) == set() and rows_of(trie.shared_rebuilt_prefixes(empty)) == set()


def test_only_turnless_members(spark):
    sequences = keep(trie.coded(spark.createDataFrame([(1, 0, "user", "a")], TURNS)), "coded")
    found = trie.prefix_trie(sequences.filter("false"), sequences.select("conv_id"))
    assert rows_of(found) == {(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())}
