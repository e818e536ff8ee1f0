import numpy as np
import pytest

from orderlens.llm import spherical


def brute_force(rows):
    units = {v: spherical.unit(x) for v, x in rows}
    links = {v: set() for v in units}
    for a, x in units.items():
        for b, y in units.items():
            if a != b and x is not None and y is not None and len(x) == len(y) and x @ y >= 0.95:
                links[a].add(b)
    result = {}
    for v in units:
        seen, todo = {v}, [v]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        result[v] = (len(links[v]), min(seen))
    return result


def found(table):
    return {r.vec_id: (r.n_links, r.component_id) for r in spherical.near_copies(table).collect()}


def test_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for dims, count in ((64, 60), (16, 25), (3, 25), (1, 4)):
        for _ in range(count):
            base = rng.standard_normal(dims)
            rows.append(base)
            for scale in (0.05, 0.2, 0.33)[: rng.integers(0, 4)]:
                rows.append(base * rng.uniform(0.5, 2) + scale * rng.standard_normal(dims) * np.linalg.norm(base) / dims**0.5)
    rows = [(i, [float(np.float32(x)) for x in r]) for i, r in enumerate(rows)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(table) == brute_force(rows)


def test_few_dimensions_hold_many_vectors(spark):
    rng = np.random.default_rng(12)
    rows = [(i, np.float32(rng.standard_normal(dims)).tolist()) for i, dims in enumerate([3] * 150 + [8] * 700 + [2] * 40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected = brute_force(rows)
    assert sum(links > 0 for links, _ in expected.values()) > 150
    assert found(table) == expected


def test_blocks_of_a_wide_component(spark, monkeypatch):
    monkeypatch.setattr(spherical.blocked, "__defaults__", (7,))
    rng = np.random.default_rng(6)
    rows = [(i, (np.ones(32) + 0.1 * rng.standard_normal(32)).tolist()) for i in range(40)] + [(99, [1.0] * 32), (98, [1.0] * 32)]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<float>")) == {
        v: (n, c) for v, (n, c) in brute_force([(v, np.float32(x).tolist()) for v, x in rows]).items()
    }


@pytest.mark.parametrize("vectors", [10_000, 1_000_000])
@pytest.mark.parametrize("dims", [2, 3, 4, 5, 6, 8, 12, 16, 32, 64, 384])
def test_recall_at_the_threshold(dims, vectors):
    rng = np.random.default_rng(8)
    count = 600
    x = rng.standard_normal((count, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((count, dims))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.95 * x + (1 - 0.95**2) ** 0.5 * z
    met = np.zeros(count, bool)
    for seed in range(spherical.CODES):
        code = spherical.product_code(dims, spherical.words_per_block(vectors, dims), seed)
        met |= [bool(np.intersect1d(a, b).size) for a, b in zip(code.decode(x), code.decode(y))]
    assert met.mean() >= 0.99


def test_decoding_lists_the_best_directions():
    code, rng = spherical.ProductCode(12, 5, 1), np.random.default_rng(2)
    x = rng.standard_normal((3, 12))
    turned = x @ code.rotation
    scores = [turned[:, cut] @ words.T for cut, words in zip(code.cuts, code.words)]
    for row, listed in enumerate(code.decode(x)):
        every = spherical._sums([s[row] for s in scores])
        assert set(listed) == set(np.argsort(-every)[: spherical.LIST])


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, unit string")
    assert found(table) == {i: (0, i) for i in (1, 2, 3, 4, 5, 6, 10)} | {7: (2, 7), 8: (2, 7), 9: (2, 7)}
    assert spherical.near_copies(table).count() == 10
    assert found(table.limit(0)) == {}
