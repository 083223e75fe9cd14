"""Packing: every id in exactly one piece, whole windows, and neighbours that are like their seed."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from supplyprep.llm import packing
from supplyprep.llm.tokens import WordBpe

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_coder_equals_the_library(library):
    chosen = random.Random(3)
    low = "".join(map(chr, range(0x250)))
    texts = ["".join(chosen.choice(low) for _ in range(30)) for _ in range(3000)]
    texts += ["", "it's IT'S 'S ''s don't", "a<|endoftext|>b", "İstanbul", "naïve café 文字 😀 \u0000 end", "x\u0085y\x1cz", "Á é"]
    coder = WordBpe(open(VOCABULARY, "rb").read(), most_words=500)
    assert [np.frombuffer(coder.encode(t), "<u4").tolist() for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def holds(pieces, docs, library, window):
    """All the laws of a packing; returns the tokens of padding."""
    ids = [library.encode(t or "", add_special_tokens=False).ids + [2] for _, t in docs]
    sequences, by_document = defaultdict(list), defaultdict(list)
    for p in pieces:
        data = np.frombuffer(p["ids"], "<u4")
        assert len(data) == p["length"] > 0
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        by_document[p["doc_id"]].append((p["start"], p["doc_tokens"], data.tolist()))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    expected = defaultdict(list)
    for (key, _), own in zip(docs, ids, strict=True):
        expected[key].append(own)
    for key, own in expected.items():
        if len(own) == 1:
            parts = sorted(by_document.pop(key))
            assert [x for _, _, part in parts for x in part] == own[0]
            assert [s for s, _, _ in parts] == np.cumsum([0, *[len(p) for _, _, p in parts[:-1]]]).tolist()
            assert {n for _, n, _ in parts} == {len(own[0])}
        else:  # rows that share a key
            assert sorted(x for _, _, part in by_document.pop(key) for x in part) == sorted(x for o in own for x in o)
    assert not by_document
    return padding


@pytest.mark.parametrize(("window", "shard"), [(64, 500), (4096, 1 << 20)])
def test_given_documents(spark, data, library, window, shard):
    df = spark.read.parquet(f"{data}/documents.parquet")
    pieces = packing.pack(df, VOCABULARY, window=window, shard_tokens=shard).collect()
    assert holds(pieces, [(r["doc_id"], r["text"]) for r in df.collect()], library, window) == 0


def test_odd_tables(edge, none, library):
    pieces = packing.pack(edge, VOCABULARY).collect()
    assert holds(pieces, [(r["doc_id"], r["text"]) for r in edge.collect()], library, 4096) == 0
    assert packing.pack(none, VOCABULARY).count() == 0


def test_windows_hold_like_documents():
    """Documents of five vocabularies, mixed: the index brings each vocabulary together."""
    chosen = random.Random(1)
    topic = [chosen.randrange(5) for _ in range(200)]
    documents = [np.array([1000 * t + chosen.randrange(60) for _ in range(50)] + [2]) for t in topic]
    packer = packing.Packer(512, 0)
    packer.pack(documents, list(range(200)))
    packer.finish()
    windows = defaultdict(list)
    for document, _, length, sequence, _ in packer.done:
        windows[sequence].append((topic[document], length))
    full = [w for w in windows.values() if sum(n for _, n in w) == 512]
    share = [max(sum(n for t, n in w if t == s) for s in range(5)) / 512 for w in full]
    assert len(full) >= 18 and np.mean(share) > 0.85


def test_scores_are_bm25():
    chosen = random.Random(2)
    documents = [np.array([chosen.randrange(30) for _ in range(chosen.randint(3, 40))]) for _ in range(25)]
    shard = packing.Shard(documents)
    mean = np.mean([len(d) for d in documents])

    def score(seed, other):
        total = 0.0
        for t in set(documents[seed].tolist()):
            df, tf = sum(t in d for d in documents), int((documents[other] == t).sum())
            norm = packing.K1 * (1 - packing.B + packing.B * len(documents[other]) / mean)
            total += np.log1p((25 - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + norm)
        return total

    used = np.zeros(25, dtype=bool)
    used[[3, 4]] = True
    scores = [score(3, other) for other in shard.neighbours(3, used)]
    assert len(scores) == 23 and all(a >= b - 1e-9 for a, b in zip(scores, scores[1:], strict=False))


def test_many_texts_are_encoded_as_one_by_one_with_each_distinct_word_looked_up_once():
    coder = WordBpe(open(VOCABULARY, "rb").read())
    texts = ["The cat's 12 hats, the cat", "", " \x85a\xa0b\tthe ", "a\x1cb the", "İX Dž <|endoftext|>", "".join(map(chr, range(0x180))), " ".join(map(chr, range(0x180))), "the cat &&& ÉÀ"]
    alone = [np.frombuffer(coder.encode(t), dtype="<u4").tolist() for t in texts]
    assert [ids.tolist() for ids in coder.encode_all(texts)] == alone
    assert [ids.tolist() for ids in coder.encode_all([])] == []
    fresh, asked = WordBpe(coder.whole.to_str().encode(), most_words=0), []
    make = fresh._cache.make
    fresh._cache.make = lambda word: asked.append(word) or make(word)
    fresh.encode_all(["the cat the cat"] * 3)
    assert sorted(asked) == ["cat", "the"]


def test_words_that_differ_by_marks_share_their_pieces(library):
    """Each distinct piece of many texts is encoded once, whatever marks stand around it in its words."""
    coder, asked = WordBpe(open(VOCABULARY, "rb").read(), most_words=0), []
    make = coder._cache.make
    coder._cache.make = lambda piece: asked.append(piece) or make(piece)
    texts = ["cat, cat. (Cat) cat's", "", "'cat' cat7cat,cat", "文 cat", "!'st ''s", "it's"]
    chosen = random.Random(5)
    low = "".join(map(chr, range(0x180))) + "''''  stmdlrve0123.,!?"
    texts += ["".join(chosen.choice(low) for _ in range(40)) for _ in range(500)]
    assert [ids.tolist() for ids in coder.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    asked.clear()
    coder.encode_all(texts[:3])
    assert sorted(filter(None, asked)) == sorted(["cat", ",", ".", "(", ")", "'s", "'", "7"])
    assert [ids.tolist() for ids in coder.encode_all(["文", "<|endoftext|>"])] == [library.encode(t, add_special_tokens=False).ids for t in ("文", "<|endoftext|>")]
