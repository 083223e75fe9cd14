from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from supplyprep.operators import groups, joins
from supplyprep.operators import rows as changes
from supplyprep.operators.rows import Correction, Lookup


def test_upsert_is_idempotent_and_keeps_repeated_targets(spark):
    old = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "c", 12)], "k int, t string, q int")
    new = spark.createDataFrame([(1, "x", 99), (3, "y", 5)], "k int, t string, q int")
    once = changes.upsert(old, new, ["k"], update=["q"])
    assert rows(once) == [(1, "a", 99), (1, "b", 99), (2, "c", 12), (3, "y", 5)]
    assert rows(changes.upsert(once, new, ["k"], update=["q"])) == rows(once)


def test_upsert_fails_on_repeated_source_key(spark):
    old = spark.createDataFrame([(1, 10)], "k int, q int")
    new = spark.createDataFrame([(1, 5), (1, 6)], "k int, q int")
    with pytest.raises(PySparkException):
        changes.upsert(old, new, ["k"], update=["q"]).collect()


def test_update_from_respects_condition_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    ref = spark.createDataFrame([(1, None), (2, "B"), (None, "N")], "k int, w string")
    out = changes.update_from(df, ref, ["k"], {"v": "w"})
    assert rows(out) == [(1, None), (2, "B"), (None, "c")]
    out = changes.update_from(df, ref, ["k"], {"v": "w"}, F.col("v") == "b")
    assert rows(out) == [(1, "a"), (2, "B"), (None, "c")]


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    assert rows(changes.delete_where(df, F.col("k") == 1)) == [(3,), (None,)]


def test_blank_singletons_ignores_rows_with_missing_keys(spark):
    df = spark.createDataFrame(
        [("u", 1, "g"), ("u", 2, "h"), ("u", 2, "h"), (None, 3, "k")], "bu string, f int, g string"
    )
    out = changes.blank_singletons(df, ["bu", "f", "g"], "g")
    assert rows(out, "f", "g") == [(1, None), (2, "h"), (2, "h"), (3, "k")]


def test_cascade_treats_null_and_sentinel_alike(spark):
    df = spark.createDataFrame([("a", None), ("b", "X"), ("c", "kept"), ("d", None)], "i string, s string")
    first = spark.createDataFrame([("a", "X"), ("b", "s1"), ("c", "s1")], "i string, v string")
    second = spark.createDataFrame([("a", "s2"), ("b", "s2")], "i string, v string")
    out = changes.fill_cascade(df, [Lookup(first, ["i"]), Lookup(second, ["i"])], {"s": "v"})
    assert rows(out) == [("a", "s2"), ("b", "s1"), ("c", "kept"), ("d", None)]


def test_corrections_apply_in_order(spark):
    df = spark.createDataFrame([("a", "p"), ("b", "p")], "x string, y string")
    out = changes.apply_corrections(
        df, [Correction({"x": ("a",)}, {"x": "b"}), Correction({"x": ("b",), "y": ("q",)})]
    )
    assert rows(out) == [("b", "p"), ("b", "p")]


def test_keep_latest_does_not_depend_on_row_order(spark):
    values = [(k, t, v) for k in range(5) for t in (1, 2, None) for v in range(3)]
    expected = None
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame(values, "k int, t int, v int").repartition(seed + 1)
        got = rows(groups.keep_latest(df, ["k"], ["t"]))
        assert expected in (None, got)
        expected = got
    assert expected == [(k, None, 2) for k in range(5)]
    first = groups.keep_first(spark.createDataFrame(values, "k int, t int, v int"), ["k"], ["t"])
    assert rows(first) == [(k, 1, 0) for k in range(5)]


def test_dense_rank_matches_window(spark):
    rng = random.Random(7)
    values = [(rng.choice("ab"), rng.choice("xyz") * rng.randint(1, 4), rng.choice([None, "p", "q"])) for _ in range(300)]
    df = spark.createDataFrame(values, "g string, a string, b string")
    got = {tuple(r)[:3]: r["rank"] for r in groups.dense_rank_within(df, ["g"], ["a", "b"]).collect()}
    for group in "ab":
        keys = sorted({v for v in values if v[0] == group}, key=lambda v: (v[1], v[2] is None, v[2] or ""))
        assert [got[k] for k in keys] == list(range(1, len(keys) + 1))


def test_multi_map_counts_missing_code(spark):
    df = spark.createDataFrame(
        [("s", "i1", "c1"), ("s", "i1", None), ("s", "i2", "c1"), ("s", "i2", "c1"), ("s", None, "c9"), ("s", None, "c8")],
        "site string, item string, code string",
    )
    assert rows(groups.multi_mapped(df, "site", "item", "code")) == [("s", "i1", "c1")]


def test_one_or_default(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, None), (3, None), (4, "a"), (4, "b")], "k int, v string")
    assert rows(groups.one_or_default(df, ["k"], "v", "D", "o")) == [(1, "a"), (2, "D"), (3, None), (4, "D")]


@pytest.mark.parametrize("codes, expected", [(["b"], ["a"]), (["b", None], []), ([], ["a", "b", None])])
def test_not_in_follows_sql(spark, codes, expected):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    ref = spark.createDataFrame([(c,) for c in codes], "r string")
    assert [r[0] for r in rows(joins.not_in(df, "c", ref, "r"))] == expected
    flagged = joins.flag_not_in(df, "c", ref, "r", "ok").filter("ok")
    assert [r[0] for r in rows(flagged, "c")] == expected


def test_with_other_child(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None), (3, "c")], "g int, c string")
    assert rows(joins.with_other_child(df, ["g"], "c")) == [(2, "a"), (2, "b")]


def test_contained_best_finds_every_alias(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None]
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ref = spark.createDataFrame([(w,) for w in words], "w string")
    for text, best in rows(joins.contained_best(df, "t", ref, "w", "w", "best")):
        hits = [w for w in words if text is not None and w in text]
        assert best == (max(hits) if hits else None)


def test_contained_best_searches_many_lengths_by_few_widths(spark):
    rng = random.Random(5)
    words = sorted({"HUB-" + "".join(rng.choice("0123") for _ in range(n)) for n in range(1, 30) for _ in range(3)})
    texts = ["x" * rng.randint(0, 3) + rng.choice(words) + rng.choice(["", "0", " HUB-"]) for _ in range(150)] + ["", None, "HUB-", words[-1]]
    df = spark.createDataFrame([(t, n) for n, t in enumerate(texts)], "t string, n int")
    ref = spark.createDataFrame([(w, w[::-1]) for w in [*words, ""]] + [(words[0], "zz"), (None, "zzz")], "w string, v string")
    worth = {w: w[::-1] for w in words} | {words[0]: "zz"}
    found = {r["n"]: r["best"] for r in joins.contained_best(df, "t", ref, "w", "v", "best").collect()}
    assert found == {n: max((v for w, v in worth.items() if t is not None and w in t), default=None) for n, t in enumerate(texts)}
    signed = joins.alias_signatures(ref.select(F.col("w").alias("__alias")).filter("length(w) > 0").distinct()).collect()
    assert sorted(r["__alias"] for r in signed) == words
    assert {r["__width"] for r in signed} == {4, 8, 16, 32}
    assert all(len(r["__gram"]) == r["__width"] and r["__gram"] in r["__alias"] for r in signed)


def test_contained_best_without_aliases_or_texts(spark):
    df, ref = spark.createDataFrame([("a",), (None,)], "t string"), spark.createDataFrame([("a",)], "w string")
    assert rows(joins.contained_best(df, "t", ref.limit(0), "w", "w", "best")) == [("a", None), (None, None)]
    assert rows(joins.contained_best(df.limit(0), "t", ref, "w", "w", "best")) == []


def test_canonical_prefix_prefers_the_shortest_and_changes_once(spark):
    dim = spark.createDataFrame([("ABCDEFG",), ("ABCDEFGHIJ",), ("KNOWN",)], "code string")
    df = spark.createDataFrame(
        [("ABCDEFGHIJK", None), ("ABCDEFGHIJ", "ABCDEFGHIJ"), ("ZZZ", "q"), ("ABCDEFGxx", "KNOWN")],
        "s string, t string",
    )
    out = joins.canonical_prefix(df, "t", "s", dim, "code", (7, 10))
    assert rows(out) == [
        ("ABCDEFGHIJ", "ABCDEFGHIJ"),
        ("ABCDEFGHIJK", "ABCDEFG"),
        ("ABCDEFGxx", "KNOWN"),
        ("ZZZ", "q"),
    ]


def test_dedup_subset_leaves_other_rows(spark):
    df = spark.createDataFrame([("w", 1, "a"), ("w", 1, "b"), ("x", 1, "a"), (None, 1, "a"), (None, 1, "a")], "s string, k int, v string")
    out = groups.dedup_subset(df, F.col("s") == "w", ["s", "k"], ["v"])
    assert rows(out) == [("w", 1, "a"), ("x", 1, "a"), (None, 1, "a"), (None, 1, "a")]


def test_flag_one_of_looks_each_row_up_once(spark):
    df = spark.createDataFrame(
        [(1, "a", "x", "1"), (2, "a", "y", None), (3, "b", "x", "1"), (4, None, "x", "1"), (5, "b", None, "1"), (6, "a", "x", None)],
        "id int, kind string, item string, site string",
    )
    wide = spark.createDataFrame([("x", "1"), ("x", "1"), ("x", None), ("y", "")], "i string, s string")
    narrow = spark.createDataFrame([("x",), (None,), ("z",)], "i string")
    lookups = [("w", wide, [("item", "i"), ("site", "s")], "kind = 'a'"), ("n", narrow, [("item", "i")], "kind IN ('b', 'c')")]
    found = joins.flag_one_of(df, lookups)
    assert found.columns == [*df.columns, "w", "n"]
    assert rows(found, "id", "w", "n") == [
        (1, True, False), (2, False, False), (3, False, True), (4, False, False), (5, False, False), (6, False, False)
    ]
