import random

from conftest import plan_of

from orderlens.llm import common, near_copies
from orderlens.llm.components import connected


def brute_force(rows):
    """{doc_id: (size, component)} by comparing every pair of full sets."""
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        sets[doc] = grams
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: (len(s), find(d)) for d, s in sets.items()}


def found(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies.components(docs).collect()}


def corpus(seed, groups=12, words=60):
    """Groups of edited copies around the threshold, some of them chained, and texts on their own."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(3_000)]
    for _ in range(groups):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(5, words))]
        for _ in range(rng.randint(1, 8)):
            rows.append(" ".join(text))
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force(documents):
    for seed in (1, 2):
        rows = corpus(seed)
        assert found(documents(rows)) == brute_force(rows)


def test_wide_buckets_are_split_without_loss(documents, monkeypatch):
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(30)]
    # Every text shares a long passage with all others but is no near copy, except for a few pairs.
    rows = []
    for i in range(60):
        own = [f"d{i}x{rng.randrange(10**6)}" for _ in range(25)]
        rows.append(" ".join(shared + own))
        if i % 12 == 0:
            rows.append(" ".join(shared + own[:-1]))
    rows = list(enumerate(rows))
    monkeypatch.setattr(near_copies, "WIDE_BUCKET", 4)
    assert found(documents(rows)) == brute_force(rows)


def test_a_large_group_around_the_threshold_in_blocks(documents, monkeypatch):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for _ in range(150):
        text = list(base)
        for _ in range(rng.randint(1, 4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(text))
    rows = list(enumerate(rows))
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", 20)
    expected = brute_force(rows)
    assert 1 < len({component for _, component in expected.values()}) < len(rows)
    assert found(documents(rows)) == expected


def test_overlaps_and_joining_links():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    plain = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert near_copies.overlaps(sets, sets, width=64).tolist() == plain
    assert near_copies.overlaps(sets[:7], sets[7:], width=64).tolist() == [row[7:] for row in plain[:7]]
    # Sixty equal sets in two blocks and one of its own: 59 links join them, whatever their number of pairs.
    same, own = np.arange(20, dtype=np.uint64).tobytes(), np.arange(50, 70, dtype=np.uint64).tobytes()
    for low, high in ((0, 0), (0, 1)):
        rows = [(5, low, high, low if i < 30 else high, i, i, same) for i in range(60)] + [(5, low, high, high, 99, 99, own)]
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=list("abcdefg"))
        links = list(near_copies._linked(iter([batch])))
        assert len(links) == 59 and {end for link in links for end in link} == set(range(60))


def test_keys_guarantee_the_distance():
    import numpy as np

    rng = np.random.default_rng(3)
    one = rng.integers(-(2**31), 2**31, (200, near_copies.SYMBOLS)).astype(np.int32)
    other = one.copy()
    for row in other:
        row[rng.permutation(near_copies.SYMBOLS)[: near_copies.MAX_DISTANCE]] += 1
    for level in range(3):
        same = near_copies.keys_of(one, level) == near_copies.keys_of(other, level)
        assert same.any(axis=1).all()


def test_defined_cases(documents):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one"), (7, long), (8, long + " end"),
        (9, "ÉTÉ a b c d"), (10, "été a b c d"), (None, "one two"),
    ]
    docs = documents(rows + [(6, "one")], rep="string", root="int", key="double", digest="string")
    result = {r.doc_id: r for r in near_copies.components(docs).collect()}
    assert near_copies.components(docs).count() == 10
    assert [result[i].component_id for i in range(1, 11)] == [1, 2, 3, 4, 4, 6, 7, 7, 9, 10]
    assert [result[i].n_shingles for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 1]
    assert all(r.kept == (r.doc_id == r.component_id) for r in result.values())
    left = near_copies.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [1, 10, 2, 3, 4, 6, 6, 7, 9, None]
    assert near_copies.components(docs.limit(0)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200, 260)] + [(7, 300), (300, 7), (5, 5)], "a long, b long")
    roots = {r.node: r.root for r in connected(edges, "a", "b").collect()}
    assert roots == {i: 200 for i in range(201, 261)} | {300: 7}


def test_rows_outside_a_wanted_table_are_not_moved(spark, documents):
    rows = documents([(i, f"text {i}") for i in range(4_000)] + [(7, "again"), (None, "no id")])
    wanted = spark.createDataFrame([(i,) for i in range(0, 4_000, 40)] + [(None,), (-1,), (40,)], "doc_id long")
    likely = {r.doc_id for r in common.likely_among(rows, "doc_id", wanted).collect()}
    assert likely >= {i for i in range(0, 4_000, 40)} and len(likely) < 1_000
    left = common.without(rows, "doc_id", wanted.filter("doc_id is not null"))
    plain = rows.join(wanted.filter("doc_id is not null"), "doc_id", "left_anti").select(rows.columns)
    assert sorted(left.collect(), key=repr) == sorted(plain.collect(), key=repr)
    assert common.without(rows, "doc_id", wanted.limit(0)).count() == 4_002
    assert common.likely_among(rows, "doc_id", wanted.limit(0)).count() == 0


def test_texts_without_a_shared_bucket_are_filtered_before_the_join(documents):
    docs = documents(corpus(3))
    reps = docs.filter("doc_id < 3").selectExpr("doc_id as rep", "cast('' as binary) as digest", "1L as copies")
    assert "bit_get" in plan_of(near_copies._sets(docs, reps))
