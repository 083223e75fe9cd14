from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from supplyprep.llm import byte_bpe, re_pair
from supplyprep.llm.tokens import GPT2_PATTERN, ByteLevelBpe, splitter

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WHOLE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "B", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "'", "'ll", "1", "²", "½", "中", "😀", "　", "!", "#", "_", "́", "ß", "\x00", "<|endoftext|>", "Ⅷ", "ɐ"]


@pytest.fixture(scope="module")
def coder():
    return ByteLevelBpe(open(RANKS, "rb").read())


@pytest.fixture(scope="module")
def peer():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n=1500):
    chosen = random.Random(5)
    return ["".join(chosen.choice(PIECES) for _ in range(chosen.randint(0, 14))) for _ in range(n)]


def test_pattern_is_the_public_one():
    assert public_tokenizers.PATTERN == GPT2_PATTERN
    assert splitter(r"\S+")("a b") == ["a", "b"]


def test_ids_and_offsets_agree_with_both_libraries(coder, peer):
    whole, own = Tokenizer.from_file(WHOLE), ByteLevelBpe(open(WHOLE, "rb").read())
    whole.encode_special_tokens = True
    for text in texts():
        ids = np.frombuffer(coder.encode(text), dtype="<u4")
        assert ids.tolist() == peer.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
        found = whole.encode(text, add_special_tokens=False)
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == found.ids
        assert coder.offsets(text, ids).tolist() == [a for a, _ in found.offsets]


def test_added_tokens_are_the_librarys(spark):
    whole, own = Tokenizer.from_file(WHOLE), ByteLevelBpe(open(WHOLE, "rb").read(), added=True)
    for text in ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n\n x", *texts()]:
        ids = np.frombuffer(own.encode(text), dtype="<u4")
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == text.encode()
    assert len(own.token_bytes) == whole.get_vocab_size()
    docs = spark.createDataFrame([(1, "a <|endoftext|> b " * 40), (2, "c d")], "doc_id long, text string")
    rows = sorted(re_pair.token_rows(spark, re_pair.write_token_files(docs, WHOLE)).collect(), key=lambda r: r["doc_id"])
    for row, text in zip(rows, [r["text"] for r in docs.collect()], strict=True):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
        assert (row["n_tokens"], row["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))


def test_split_characters_are_shown_as_replacements(coder):
    ids = np.frombuffer(coder.encode("😀"), dtype="<u4")
    assert len(ids) > 1
    assert byte_bpe.as_text(coder.decode(ids)) == "😀"
    assert "�" in byte_bpe.as_text(coder.decode(ids[:1]))


def test_tables(edge, none, peer):
    coded = byte_bpe.decode(byte_bpe.encode(edge, RANKS, offsets="starts"), RANKS)
    rows = coded.collect()
    assert len(rows) == edge.count()
    for row in rows:
        text = row["text"] or ""
        assert list(row["token_ids"]) == peer.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
        assert len(row["starts"]) == len(row["token_ids"])
        assert row["score"] == "own score"
    assert byte_bpe.code_round_trip(none, RANKS).count() == 0


# --- token files ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, 1 + 3 * seed, rng.integers(0, 400)) for _ in range(30)] + [np.zeros(500), np.zeros(0)]
    ids = np.concatenate(docs).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    shard = re_pair.Shard(re_pair.pack(ids, starts, [*range(31), None], 70, 6))
    assert np.array_equal(shard.all_ids(), ids)
    assert shard.sizes().tolist() == [len(d) for d in docs]
    assert shard.keys[-2:] == [30, None]
    assert all(np.array_equal(shard.document(k), d) for k, d in enumerate(docs))
    assert len(shard.rules) > 0 and len(shard.symbols) < len(ids)
    assert np.array_equal(shard.lengths, re_pair.rule_lengths(shard.rules, 70))


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(1)
    copy = rng.integers(0, 50, 700)
    docs = [copy] * 20 + [rng.integers(0, 50, 900) for _ in range(30)] + [np.zeros(1000)]
    ids = np.concatenate(docs).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    symbols, where, rules = re_pair.compress(ids, starts, 50)
    assert np.array_equal(re_pair.expand(symbols, rules, 50), ids)
    assert re_pair.rule_lengths(rules, 50).max() == 700
    seen = {}
    for a, b in zip(where[:-1], where[1:], strict=True):
        last = None
        for k in range(a, b - 1):
            pair = (int(symbols[k]), int(symbols[k + 1]))
            if (k - 1, pair) == last:  # overlaps the one before
                last = None
                continue
            last = (k, pair)
            seen[pair] = seen.get(pair, 0) + 1
    assert max(seen.values()) < 8


def test_wide_symbols_and_empty_shard():
    ids = np.array([200_000, 5, 200_000, 5] * 20, dtype=np.uint32)
    shard = re_pair.Shard(re_pair.pack(ids, np.array([0, 80]), [1], 200_001, 3))
    assert np.array_equal(shard.all_ids(), ids)
    assert re_pair.Shard(re_pair.pack(ids[:0], np.array([0]), [], 9, 3)).sizes().tolist() == []
    with pytest.raises(ValueError):
        re_pair.Shard(b"none" + bytes(60))


def test_token_files(spark, edge, none):
    path = re_pair.write_token_files(edge, WHOLE, shard_tokens=1000)
    rows = sorted(re_pair.token_rows(spark, path).collect(), key=lambda r: r["start"])
    whole = Tokenizer.from_file(WHOLE)
    whole.encode_special_tokens = True
    expected = sorted((-1 if r["doc_id"] is None else r["doc_id"], len(whole.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in edge.collect())
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in rows) == expected
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert keys == sorted(keys)
    assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:k]) for k in range(len(rows))]
    assert re_pair.token_rows(spark, re_pair.write_token_files(none, WHOLE)).count() == 0


def test_re_pair_sorts_only_pairs_that_may_be_frequent(monkeypatch):
    """A pair too rare in one round is not looked at again; what is left has no frequent pair."""
    rng = np.random.default_rng(3)
    rare, phrase = rng.integers(0, 50_000, 40_000), rng.integers(0, 50_000, 64)
    ids = np.concatenate([rare, np.tile(phrase, 200), np.zeros(1000, dtype=int)]).astype(np.uint32)
    starts, sorted_pairs, sort = np.array([0, 7, 7, len(ids)]), [], np.sort
    monkeypatch.setattr(np, "sort", lambda values, *a, **k: sorted_pairs.append(len(values)) or sort(values, *a, **k))
    symbols, where, rules = re_pair.compress(ids, starts, 50_000)
    monkeypatch.undo()
    assert len(sorted_pairs) > 5 and sum(sorted_pairs) < 2 * len(ids)
    assert np.array_equal(re_pair.expand(symbols, rules, 50_000), ids)
    assert len(re_pair.expand(symbols[: where[1]], rules, 50_000)) == 7
    pairs = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
    apart = pairs[symbols[:-1] != symbols[1:]]
    assert np.unique(apart, return_counts=True)[1].max() < 8


def test_hash_look_up_of_pairs_finds_what_a_search_finds():
    rng = np.random.default_rng(4)
    known = np.unique(rng.integers(0, 1 << 40, 60_000).astype(np.uint64))
    pair = np.concatenate([rng.choice(known, 30_000), rng.integers(0, 1 << 40, 30_000).astype(np.uint64)])
    place = re_pair._places(known, pair)
    there = np.isin(pair, known)
    assert ((place >= 0) == there).all() and (known[place[there]] == pair[there]).all()
    assert (re_pair._places(known, pair[:100]) == place[:100]).all()
