"""Search by limited accumulators against scoring every document by every term."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from supplyprep.llm import lexical_search

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    bags = [(key, Counter(terms(text))) for key, text in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, total = sum(s > 0 for s in sizes), max(1, sum(sizes))
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for (key, bag), n in zip(bags, sizes, strict=True):
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in set(terms(text)) if t in bag
            )
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, k=10, **more):
    rows = lexical_search.search(docs, items, k, **more).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=str)


@pytest.mark.parametrize(("postings", "item_bytes"), [(2_000_000, 8 << 20), (40, 300)])
def test_equals_brute_force(spark, monkeypatch, postings, item_bytes):
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", postings)
    chosen = random.Random(postings)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "naïve", "文字", "x-y", "A_b"]
    prose = lambda n: " ".join(words[min(int(chosen.expovariate(0.08)), 64)] for _ in range(n))
    docs = [(i, prose(chosen.randint(0, 60))) for i in range(300)]
    docs += [(1000 + i, docs[i % 3][1]) for i in range(40)] + [(5, None), (None, prose(20)), (6, ""), (7, ".,;"), (8, prose(9)), (8, prose(9))]
    items = [(i, prose(chosen.randint(1, 12))) for i in range(25)] + [(30, None), (31, "!"), (32, "unknown words"), (0, prose(5)), (None, "w1 w2 w1")]
    items += items[:2]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS score", "'x' AS key", "2 AS item", "3 AS rank")
    queries = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS item", "9 AS doc_id")
    assert found(df, queries, item_bytes=item_bytes) == brute(docs, items, 10)


def test_odd_tables(spark, edge, none):
    items = spark.createDataFrame([(1, "alpha kappa tie"), (2, "w1x1 w5x5 key text")], "item_id long, text string")
    pairs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert found(edge, items) == brute(pairs, [tuple(r) for r in items.collect()], 10)
    assert found(none, items) == found(edge, items.limit(0)) == []
    assert found(none.selectExpr("cast(doc_id as string) AS doc_id", "text"), items) == []


def test_accumulators_are_limited(monkeypatch):
    """A common term makes no accumulator once rare terms have filled the first places, and scores stay exact."""
    n = 400
    terms = np.array([0] * 12 + [1] * n)
    documents = np.array([*range(12), *range(n)])
    order = np.argsort(documents, kind="stable")
    sizes = np.bincount(documents, minlength=n)
    block = lexical_search.Block(terms[order], np.ones(n + 12, dtype=np.int64), sizes, np.full(n, 100), np.arange(n), 2)
    touched = []
    split = np.partition
    monkeypatch.setattr(lexical_search.np, "partition", lambda a, k: touched.append(len(a)) or split(a, k))
    at, scores = block.best([(0, 5000), (1, 3)], 10)
    assert at.tolist() == list(range(10)) and len(set(scores.tolist())) == 1
    assert max(touched) == 12
    share = 1_000_000_000 // 1800
    assert scores[0] == 5003 * share
