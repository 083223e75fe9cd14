from __future__ import annotations

import numpy as np
import xxhash

from supplyprep.llm import simhash
from supplyprep.llm.components import connected_components


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1030)] + [(5, 5)]
    found = connected_components(spark.createDataFrame([*pairs, (None, 3), (4, None)], "a long, b long")).collect()
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in found} == components([p for p in pairs if p[0] != p[1]], nodes)
    assert len(found) == len(nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text, shingle):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).translate({i: " " for i in range(9, 14)}).split(" ") if w]
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_by_definition():
    for text in ["", "  ", "One", "ÀB c d e\x0bf g\x1ch i", "a b c d", "a b c d e a b c d e", "x " * 50]:
        assert simhash.fingerprint(text.encode(), 4) % (1 << 64) == fingerprint(text, 4)


def test_masks_meet_every_close_pair():
    rng = np.random.default_rng(2)
    for distance, n in ((4, 100), (4, 10**6), (3, 10**9), (1, 2)):
        masks = simhash.block_masks(distance, n)
        for _ in range(200):
            flip = sum(1 << int(b) for b in rng.choice(64, distance, replace=False))
            assert any(flip & m == 0 for m in masks)


def brute(values, distance):
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if bin((a ^ b) % (1 << 64)).count("1") <= distance]
    return components(pairs, values)


def clustered(n, seed):
    """Fingerprints around a few centres, many of them close to each other."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(-(2**63), 2**63, 4, dtype=np.int64)
    out = set()
    for k in range(n):
        x = int(centres[k % 4]) if k % 3 else int(rng.integers(-(2**63), 2**63, dtype=np.int64))
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            x ^= -(1 << 63) if b == 63 else 1 << int(b)
        out.add(x)
    return sorted(out)


def test_links_keep_all_components_with_and_without_hot_blocks(spark):
    values = clustered(400, 3)
    table = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    for distance, most in ((4, 20_000), (4, 8), (3, 8)):
        links = [(r["a"], r["b"]) for r in simhash.fingerprint_links(table, len(values), distance, most).collect()]
        assert all(bin((a ^ b) % (1 << 64)).count("1") <= distance for a, b in links)
        assert components(links, values) == brute(values, distance)


def test_tables(spark, edge, none):
    rows = simhash.simhash_components(edge).collect()
    assert len(rows) == edge.count()
    by_text = {}
    for r in edge.collect():
        by_text.setdefault(fingerprint(r["text"] or "", 4), []).append(r["doc_id"])
    assert all(r["component_id"] == 2 for r in rows if r["fingerprint"] == 0)  # null, empty and blank texts
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 6)} == {1}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert simhash.simhash_components(none).count() == 0


def test_repeated_rows_become_one(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "b"), (1, text, "a"), (1, text, "a"), (2, text, "c"), (3, "quite other words stand in this text here", "d"), (None, None, "e"), (None, None, "f")]
    kept = simhash.keep_one_per_component(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted((r["doc_id"] or 0, r["source"]) for r in kept.collect()) == [(0, "e"), (1, "a"), (3, "d")]


def test_repeated_rows_with_maps_become_one(spark):
    table = spark.createDataFrame([(1, "a b c d e f", {"k": 2}), (1, "a b c d e f", {"k": 1}), (2, "quite other words in here", None)], "doc_id long, text string, extra map<string,int>")
    kept = simhash.keep_one_per_component(table)
    assert sorted((r["doc_id"], r["extra"]) for r in kept.collect()) == [(1, {"k": 1}), (2, None)]


def test_one_row_of_each_component_stays(edge, none):
    kept = simhash.keep_one_per_component(edge)
    assert kept.columns == edge.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == [-1, 1, 2, 5, 7, 7, 8, 9]
    assert simhash.keep_one_per_component(none).count() == 0
