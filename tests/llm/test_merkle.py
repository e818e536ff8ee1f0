"""The manifest against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest

from orderlens.llm import merkle

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = (doc_id, source, lang, n_chars, text)
    return digest("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def tree(nodes):
    """Levels of one tree, three by three."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return levels


def climb(levels, place, value):
    """(root after replacing one leaf by ``value``, the siblings on the way)."""
    proof = []
    for nodes in levels[:-1]:
        run = list(nodes[place // 3 * 3 : place // 3 * 3 + 3])
        run[place % 3] = value
        proof += run[: place % 3] + run[place % 3 + 1 :]
        place, value = place // 3, digest("".join(run))
    return value, proof


def brute_force(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    by_source = {}
    for source in sources:
        own = [(r, leaf(*r)) for r in rows if r[3] == source]
        by_source[source] = sorted(own, key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {s: tree([h for _, h in own]) for s, own in by_source.items()}
    top = tree([trees[s][-1][0] for s in sources])
    found = []
    for number, source in enumerate(sources):
        for place, (row, own) in enumerate(by_source[source]):
            tampered = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                tampered = leaf(row[0], row[1].replace("\n", ""), *row[2:])
            subroot, low = climb(trees[source], place, tampered)
            root, high = climb(top, number, subroot)
            found.append(
                (row[0], own, trees[source][-1][0], top[-1][0], digest("".join(low + high)), root, root == top[-1][0])
            )
    return found


def rows_of(df):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return [tuple(r[c] for c in columns) for r in df.collect()]


def same(rows, df, **options):
    order = lambda found: sorted(found, key=repr)
    assert order(rows_of(merkle.manifest(df, **options))) == order(brute_force(rows))


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_equals_brute_force(spark, levels):
    draw = random.Random(levels)
    texts = ["one\ntwo", "plain", "", None, "ü\n\n", "\n"]
    sources = ["a", "a", "a", "b", "é", "", None, *[f"s{i}" for i in range(12)]]
    rows = [(i, draw.choice(texts), draw.choice(["de", None]), draw.choice(sources), draw.choice([3, None])) for i in range(-2, 120)]
    same(rows, spark.createDataFrame(rows, DOCUMENTS).repartition(5), levels=levels)


def test_repeated_rows_and_missing_ids(spark):
    rows = [(5, "x\ny", None, "a", 1)] * 4 + [(5, "z", None, "a", 1), (None, "x\ny", None, "a", 1), (None, "q", None, None, 1)]
    same(rows, spark.createDataFrame(rows, DOCUMENTS), levels=1)


def test_one_leaf_is_its_own_root(spark):
    rows = [(7, "only\n", "en", "a", 5)]
    same(rows, spark.createDataFrame(rows, DOCUMENTS))


def test_versions_share_untouched_nodes():
    grown = merkle.block_levels([digest(str(i)) for i in range(20)], 3)
    before = [list(level) for level in grown]
    path = merkle.copied_path(digest("other"), merkle.siblings(grown, 7))
    assert grown == before and len(path) == 4
    assert path[-1] == tree([*before[0][:7], digest("other"), *before[0][8:]])[-1][0]
    assert merkle.copied_path(before[0][7], merkle.siblings(grown, 7))[1:] == [grown[1][2], grown[2][0], grown[3][0]]


def test_long_texts_other_columns_and_empty_tables(spark):
    rows = [(i, "long line\n" * 100_000, "en", "a", 1) for i in range(2)]
    wide = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOCUMENTS + ", grp string, number long, digest long")
    same(rows, wide)
    assert rows_of(merkle.manifest(spark.createDataFrame([], DOCUMENTS))) == []
