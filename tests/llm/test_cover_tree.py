from __future__ import annotations

import numpy as np
import pytest

from supplyprep.llm import cover_tree


def points(n, seed, dim=16):
    """Loose points, tight groups, and groups inside groups."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 3, dim))
    near = base[rng.integers(0, len(base) // 4, n // 3)] + rng.normal(scale=0.05, size=(n // 3, dim))
    tight = base[0] + rng.normal(scale=0.01, size=(n - 2 * (n // 3), dim))
    x = rng.permutation(np.concatenate([base, near, tight]))
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_levels_nest_and_cover():
    x = points(600, 1)
    tree = cover_tree.grow(x.astype(np.float32))
    assert sorted(tree.order.tolist()) == list(range(600))
    for k, (first, last, radius) in enumerate(zip(tree.first, tree.last, tree.radius, strict=True)):
        assert first[0] == 0 and last[-1] == 600 and (first[1:] == last[:-1]).all()
        if k:
            assert set(tree.first[k - 1]) <= set(first)
        for a, b, r in zip(first, last, radius, strict=True):
            far = np.linalg.norm(tree.points[a:b] - tree.points[a], axis=1).max()
            assert far <= r + 1e-6 or b - a == 1
            if 1 <= k < len(tree.first) - 1:
                assert far <= cover_tree.TOP_RADIUS / 2**k + 1e-3


@pytest.mark.parametrize("least", [0.95, 0.8, 0.999])
def test_traversal_equals_brute_force(least):
    x, w = points(500, 2), np.random.default_rng(0).integers(1, 4, 500)
    a, b = cover_tree.grow(x[:200].astype(np.float32)), cover_tree.grow(x[200:].astype(np.float32))
    ea, eb, wa, wb = x[:200][a.order], x[200:][b.order], w[:200][a.order], w[200:][b.order]
    links = x @ x.T >= least
    np.fill_diagonal(links, False)
    count = np.zeros(500, dtype=int)
    own_a, _, xa, ya = cover_tree.traverse(a, a, ea, ea, wa, wa, least, True)
    own_b, _, xb, yb = cover_tree.traverse(b, b, eb, eb, wb, wb, least, True)
    cross_a, cross_b, xc, yc = cover_tree.traverse(a, b, ea, eb, wa, wb, least, False)
    count[a.order] += own_a + cross_a
    count[200 + b.order] += own_b + cross_b
    assert (count == links @ w).all()
    both = np.concatenate([a.order, 200 + b.order])
    forest = [(a.order[xa], a.order[ya]), (200 + b.order[xb], 200 + b.order[yb]), (both[xc], both[yc])]
    assert all(links[u, v].all() for u, v in forest)

    def roots(pairs):
        label = np.arange(500)
        while True:
            new = label.copy()
            for u, v in pairs:
                np.minimum.at(new, u, label[v])
                np.minimum.at(new, v, label[u])
            if (new == label).all():
                return label
            label = new

    assert (roots(forest) == roots([np.nonzero(links)])).all()


def test_tables(spark):
    x = points(240, 4)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None]), (904, []), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (907, rows[0][1]), (907, rows[0][1]), (None, [5.0, 10.0]), (908, [1e-200, 2e-200]), (909, [float("inf")] * 2)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS mark", "'x' AS unit", "2 AS label")
    found = cover_tree.near_duplicate_vectors(table, 0.95, sample=60, block=40).collect()
    assert len(found) == len(rows) + len(odd)
    links = x @ x.T >= 0.95
    np.fill_diagonal(links, False)
    expected = links.sum(axis=1)
    same = links[0].copy()
    same[0] = True
    expected[same] += 2
    got = {r["vec_id"]: r for r in found}
    assert [got[i]["n_links"] for i in range(240)] == expected.tolist()
    assert all(got[k]["n_links"] == 0 and got[k]["component_id"] == k and got[k]["kept"] for k in (900, 901, 902, 903, 904, 909))
    assert got[907]["n_links"] == expected[0] and got[907]["component_id"] == got[0]["component_id"]
    assert [got[k]["n_links"] for k in (905, 906, 908, None)] == [3, 3, 3, 3]
    assert [got[k]["component_id"] for k in (905, 906, 908, None)] == [905] * 4
    label = np.arange(240)
    while True:
        new = np.array([min(label[i], label[links[i]].min(initial=240)) for i in range(240)])
        if (new == label).all():
            break
        label = new
    assert [got[i]["component_id"] for i in range(240)] == label.tolist()
    assert cover_tree.near_duplicate_vectors(table.limit(0)).count() == 0


def counted_pairs(spark, x, **options):
    rows = [(i, x.shape[1], r.tobytes(), 1) for i, r in enumerate(x)]
    met = cover_tree.vector_meetings(spark.createDataFrame(rows, "rep long, dim int, unit binary, copies long"), 0.95, **options)
    return met.select("a", "part_a", "b", "part_b").distinct().count(), met.count()


def test_tight_groups_meet_in_few_pairs(spark):
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(300, 32)), 20, axis=0) + rng.normal(scale=0.002, size=(6000, 32))
    x = rng.permutation(x / np.linalg.norm(x, axis=1)[:, None])
    pairs, sent = counted_pairs(spark, x, block=100)
    assert pairs < 183 and sent < 2 * len(x)  # of 1,830 pairs of 60 blocks


def test_far_vectors_are_sent_where_they_reach(spark):
    x = np.random.default_rng(6).normal(size=(6000, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    pairs, sent = counted_pairs(spark, x, block=300)
    assert sent < len(x) * 20 * 0.7  # each vector to all 20 blocks would be 20


@pytest.mark.parametrize("dim", [3, 8])
def test_every_link_meets(spark, dim):
    x = np.random.default_rng(dim).normal(size=(900, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[::7] = x[0] + 1e-3 * x[::7]  # a group larger than a block
    x /= np.linalg.norm(x, axis=1)[:, None]
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    links = x @ x.T >= 0.95
    np.fill_diagonal(links, False)
    got = {r["vec_id"]: r["n_links"] for r in cover_tree.near_duplicate_vectors(table, 0.95, sample=100, block=50).collect()}
    assert [got[i] for i in range(900)] == links.sum(axis=1).tolist()
