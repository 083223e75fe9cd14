from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from supplyprep.operators import graph

EDGE = "g string, f string, s string"


def closing_edges(edges, is_root):
    """Edges that close a cycle on a simple path, by plain enumeration."""
    below = {}
    for g, f, s in edges:
        below.setdefault((g, f), set()).add(s)
    found = set()

    def walk(g, path, node):
        for son in below.get((g, node), ()):
            if son in path:
                found.add((g, node, son))
            else:
                walk(g, path | {son}, son)

    for g, f, s in edges:
        if is_root(f):
            if s == f:
                found.add((g, f, s))
            else:
                walk(g, {f, s}, s)
    return found


def random_edges(seed, nodes=9, count=14):
    rng = random.Random(seed)
    return [
        (g, f"n{rng.randrange(nodes)}", f"n{rng.randrange(nodes)}") for g in "ab" for _ in range(count)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_cycle_edges_match_enumeration(spark, seed):
    edges = random_edges(seed)
    df = spark.createDataFrame(edges, EDGE)
    roots = {"n0", "n1"}
    got = graph.find_cycle_edges(df, F.col("f").isin(*roots), "f", "s", ["g"])
    assert {tuple(r)[:3] for r in got.collect()} == closing_edges(edges, lambda f: f in roots)


def test_no_cycle_is_left_and_levels_are_shortest(spark):
    edges = [("a", "r", "x"), ("a", "x", "y"), ("a", "y", "x"), ("a", "y", "z"), ("a", "p", "q"), ("a", "q", "p")]
    df = spark.createDataFrame(edges, EDGE)
    root = F.col("f") == "r"
    found = graph.find_cycle_edges(df, root, "f", "s", ["g"])
    assert rows(found) == [("a", "y", "x", 3, True)]
    kept = graph.delete_cycle_edges(df, found, ["g", "f", "s"])
    assert ("a", "q", "p") in rows(kept)  # a cycle that no root reaches stays
    assert graph.find_cycle_edges(kept, root, "f", "s", ["g"]).count() == 0


def test_graph_without_cycles(spark):
    df = spark.createDataFrame([("a", "r", "x"), ("a", "x", "y")], EDGE)
    assert graph.find_cycle_edges(df, F.col("f") == "r", "f", "s", ["g"]).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_flagged_ancestor_matches_search(spark, seed):
    edges = random_edges(seed, nodes=12, count=18)
    flagged = {"n1", "n4", "n7"}
    above = {}
    for g, f, s in edges:
        above.setdefault((g, s), set()).add(f)
    expected = set()
    for g in "ab":
        for n in {s for gg, _, s in edges if gg == g}:
            level, seen, depth = above.get((g, n), set()), set(), 1
            while level:
                hits = level & flagged
                if hits:
                    expected.add((g, n, min(hits), depth))
                    break
                seen |= level
                level = {p for m in level for p in above.get((g, m), ())} - seen
                depth += 1
    df = spark.createDataFrame(edges, EDGE)
    label = F.when(F.col("f").isin(*flagged), F.col("f"))
    assert {tuple(r) for r in graph.flagged_ancestor(df, "f", "s", ["g"], label).collect()} == expected
    direct = graph.flagged_ancestor(df, "f", "s", ["g"], label, max_depth=1)
    assert {tuple(r) for r in direct.collect()} == {e for e in expected if e[3] == 1}
    asked = spark.createDataFrame([("n2",), ("n3",), ("n4",), ("none",)], "code string")
    some = graph.flagged_ancestor(df, "f", "s", ["g"], label, wanted=asked)
    assert {tuple(r) for r in some.collect()} == {e for e in expected if e[1] in ("n2", "n3", "n4")}


def test_self_loops(spark):
    df = spark.createDataFrame(
        [("u", "a", "a"), ("u", "a", "b"), ("u", "c", "c"), (None, "d", "d"), (None, "d", "e"), ("u", None, "f")],
        "bu string, f string, s string",
    )
    out = graph.drop_self_loops(df, ["bu"], "f", "s")
    assert rows(out) == sorted(
        [("u", "a", "b"), ("u", "c", None), (None, "d", None), (None, "d", "e"), ("u", None, "f")],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


SHORT = graph.Shape(site="o", father="f", father_site="fs", son="s", son_site="ss")
COLUMNS = "o string, f string, fs string, s string, ss string"


def test_bypass_adds_only_unknown_edges(spark):
    source = spark.createDataFrame(
        [("l", "A", "a", "SBB1", "m"), ("l", "SBB1", "m", "S", "s"), ("l", "SBB1", "m", None, "t"), ("k", "SBB1", "m", "Z", "z")],
        COLUMNS,
    )
    edges = source.union(spark.createDataFrame([("l", "A", "a", None, "t")], COLUMNS))
    out = graph.bypass_level(edges, source, F.col("s").startswith("SBB"), remove=F.col("s").startswith("SBB"), shape=SHORT)
    new = set(rows(out)) - set(rows(edges))
    assert new == {("l", "A", "a", "S", "s")}
    assert ("l", "A", "a", "SBB1", "m") not in rows(out)
    assert out.count() == edges.count() - 1 + 1


def test_variants_need_an_unmarked_father(spark):
    df = spark.createDataFrame(
        [("o", "A", "a$01"), ("o", "A", "a"), ("o", "B", "b$01"), ("p", "A", "a$02"), ("o", None, "c$1")], "o string, f string, fs string"
    )
    out = graph.drop_variant_fathers(df, "o", "f", "fs")
    assert rows(out, "fs") == [("a",), ("a$02",), ("b$01",), ("c$1",)]


def test_redundant_suffix(spark):
    edges = spark.createDataFrame(
        [
            ("w", "P", "ABCDEFGHIJ01"),  # short form has edges: goes
            ("w", "ABCDEFGHIJ", "X"),
            ("w", "P", "KLMNOPQRST01"),  # short form is nested into itself: stays
            ("w", "KLMNOPQRST", "KLMNOPQRST99"),
            ("v", "P", "ABCDEFGHIJ01"),  # other site without edges of the short form: stays
            ("w", "P", "UVWXYZABCD01"),  # unknown component: stays
            ("w", "UVWXYZABCD", "Y"),
        ],
        "o string, f string, s string",
    )
    dim = spark.createDataFrame([("ABCDEFGHIJ",), ("KLMNOPQRST",)], "code string")
    out = graph.drop_redundant_suffix_edges(edges, dim, "code", None, "o", "f", "s")
    gone = set(rows(edges)) - set(rows(out))
    assert gone == {("w", "P", "ABCDEFGHIJ01")}


def test_forbidden_edges_with_exceptions(spark):
    df = spark.createDataFrame([("P1", None), ("P2", "x"), (None, "P1"), ("E", "y")], "f string, fs string")
    allowed = spark.createDataFrame([("P1",)], "code string")
    extra = spark.createDataFrame([("E",)], "code string")
    out = graph.drop_forbidden_edges(
        df, F.lit(True), [(allowed, "code")], F.coalesce("f", "fs"), (extra, "code", F.col("f"))
    )
    assert rows(out) == [("E", "y"), ("P1", None), (None, "P1")]


@pytest.mark.parametrize("entries", [1, 2])
def test_cycles_of_a_complete_graph_are_settled_early(spark, entries):
    nodes = range(14)
    edges = [("g", f"n{a}", f"n{b}", False) for a in nodes for b in nodes if a != b]
    edges += [("g", "root", f"n{k}", True) for k in range(entries)]
    table = spark.createDataFrame(edges, "grp string, father string, son string, is_root boolean")
    found = {(r["father"], r["son"]): r["level"] for r in graph.find_cycle_edges(table, F.col("is_root"), "father", "son", ["grp"]).collect()}
    # With one entry no walk gets anywhere without it, so the edges out of it close nothing.
    inner = {(f"n{a}", f"n{b}") for a in nodes for b in nodes if a != b and not (entries == 1 and a == 0)}
    assert set(found) == inner
    assert found["n3", "n0"] == 3 and found["n3", "n4"] == 4


def chain(n, prefix="n"):
    return [("g", f"{prefix}{k}", f"{prefix}{k + 1}", False) for k in range(n)]


def test_cycle_of_a_thousand_edges_takes_few_jobs(spark, monkeypatch):
    jobs = []
    write = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, label, counted=None: jobs.append(label) or write(df, label, counted))
    # One long cycle, and a chain as long that ends in a short one.
    edges = [("g", "root", "n0", True), *chain(999), ("g", "n999", "n0", False)]
    edges += [("g", "root", "m0", True), *chain(1000, "m"), ("g", "m1000", "m998", False)]
    table = spark.createDataFrame(edges, "grp string, father string, son string, is_root boolean")
    found = graph.find_cycle_edges(table, F.col("is_root"), "father", "son", ["grp"])
    assert rows(found) == [("g", "m1000", "m998", 1002, True), ("g", "n999", "n0", 1001, True)]
    assert len(jobs) < 40


def test_ancestor_over_a_thousand_edges_takes_few_jobs(spark, monkeypatch):
    jobs = []
    write = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, label, counted=None: jobs.append(label) or write(df, label, counted))
    edges = [("g", "top", "n0", True), *chain(1000), ("g", "n500", "x", False), ("g", "n3", "x", False)]
    table = spark.createDataFrame(edges, "grp string, father string, son string, flagged boolean")
    found = graph.flagged_ancestor(table, "father", "son", ["grp"], F.when(F.col("flagged"), F.col("father")))
    distance = {r["son"]: r["distance"] for r in found.collect()}
    assert len(distance) == 1002 and distance["n1000"] == 1001 and distance["x"] == 5
    assert len(jobs) < 15


@pytest.mark.parametrize("seed", range(4, 7))
def test_cycle_levels_match_a_breadth_first_search(spark, seed):
    """Level of an edge: the least number of edges of a simple path from a root edge that it closes."""
    edges = random_edges(seed, nodes=12, count=17)
    roots = {"n0", "n1", "n2"}
    below = {}
    for g, f, s in edges:
        below.setdefault((g, f), set()).add(s)
    best = {}

    def walk(g, path):
        for son in below.get((g, path[-1]), ()):
            if son in path:
                best[g, path[-1], son] = min(best.get((g, path[-1], son), 99), len(path))
            else:
                walk(g, [*path, son])

    for g, f, s in edges:
        if f in roots:
            if s == f:
                best[g, f, s] = 1
            else:
                walk(g, [f, s])
    df = spark.createDataFrame(edges, EDGE)
    got = {(r["g"], r["f"], r["s"]): r["level"] for r in graph.find_cycle_edges(df, F.col("f").isin(*roots), "f", "s", ["g"]).collect()}
    assert got == best
