from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from supplyprep.llm import suffix_dedup


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(d, dtype=np.uint8)[~gone]) if len(d) else b""
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, length):
    """Copies, near copies with edits everywhere, shared passages around the length, periodic texts."""
    chosen = random.Random(seed)
    word = lambda: "".join(chosen.choice("abcdeé") for _ in range(chosen.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = [prose(chosen.randint(5, 120)) for _ in range(12)]
    texts = list(base) + base[:4]
    for _ in range(25):
        t = list(chosen.choice(base))
        for _ in range(chosen.randint(1, 3)):
            t[chosen.randrange(len(t))] = chosen.choice("xyz")
        texts.append("".join(t))
    passage = prose(60)
    for n in (length - 1, length, length + 1, length + 7, 2 * length):
        texts += [prose(10) + passage[:n] + prose(9) for _ in range(2)]
    texts += ["For " * 150, "For " * 150 + "x", "aaaa" * 100, "ab" * 300 + "c" + "ab" * 300, None, "", "short"]
    return texts


@pytest.mark.parametrize("length", [60, 110])
def test_equals_brute_force(spark, length, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "WIDTHS", (11, 3, 1))
    texts = corpus(length, length)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(suffix_dedup.remove_repeats(docs, length).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == brute(texts, length)


@pytest.mark.parametrize("segment", [300, 331])
def test_cuts_of_long_texts_repeat_nothing(spark, segment):
    chosen = random.Random(segment)
    prose = lambda n: " ".join("".join(chosen.choice("abcdefgh") for _ in range(chosen.randint(1, 7))) for _ in range(n))
    texts = [prose(4000), prose(2000), *corpus(segment, 110)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(suffix_dedup.remove_repeats(docs, 110, segment=segment).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == brute(texts, 110)
    assert rows[0]["n_removed"] == rows[1]["n_removed"] == 0


def test_all_windows_have_one_anchor_and_segments_agree(monkeypatch):
    data = np.frombuffer(("abc " * 100 + " ".join(str(i * 7919 % 1009) for i in range(900))).encode(), dtype=np.uint8)
    whole = suffix_dedup.anchors(data, 100)
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 333)
    cut = suffix_dedup.anchors(data, 100)
    for place, first, last, _ in (whole, cut):
        windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
        assert windows.tolist() == list(range(len(data) - 99))
        assert (place >= last).all() and (place + suffix_dedup.GRAM <= first + 100).all()
    expand = lambda x: np.repeat(x[0], x[2] - x[1] + 1).tolist()
    assert expand(whole) == expand(cut)


def test_tables(edge, none):
    rows = suffix_dedup.remove_repeats(edge, 50).collect()
    expected = sorted(zip([r["doc_id"] or 0 for r in edge.collect()], brute([r["text"] for r in edge.collect()], 50), strict=True))
    assert sorted((r["doc_id"] or 0, (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in rows) == expected
    assert suffix_dedup.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(none, 20)
