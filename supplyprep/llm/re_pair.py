"""Token-id files compressed by Re-Pair grammars.

Documents are dealt out by ranges of their key and sorted within; a task encodes the texts that
come to it one after the other and closes a shard whenever ``shard_tokens`` ids are reached. Each
shard is one row of a Parquet table in the shared folder: a few numbers, and the bytes of
:func:`pack`. A shard holds its own grammar, so it can be decoded alone.

The grammar of a shard is made by replacing frequent pairs of neighbouring symbols by a new
symbol, round after round, until no pair is frequent. A round counts the pairs of the whole shard
exactly and replaces the frequent ones together; where two overlap the more frequent one wins. A rule is a pair of
earlier symbols, and the length of its expansion is stored with it, so the position of any token
is found without expanding what lies before. Pairs never cross a document's end.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyprep.llm.common import bounded_slices, map_arrow, new_path, text_or_empty
from supplyprep.llm.tokens import ByteLevelBpe

MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sIIII")
#: Hash cells by which pairs are looked up.
_MIXER, _CELL_BITS = np.uint64(0x9E3779B97F4A7C15), 18
#: Above every pair of two symbols.
_NO_PAIR = np.uint64(2**64 - 1)


@lru_cache(maxsize=2)
def _coder(content: bytes) -> ByteLevelBpe:
    return ByteLevelBpe(content, most_pieces=500_000, added=True)


# --- grammar -------------------------------------------------------------------------------------


def _places(known: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Index of each pair in the sorted ``known``, -1 if it is not there.

    A hash leads to the index; pairs whose cell another known pair took are searched for.
    """
    def cells(pairs: np.ndarray) -> np.ndarray:
        return ((pairs * _MIXER) >> np.uint64(64 - _CELL_BITS)).astype(np.int64)

    if len(pair) < 1 << 14:
        place = np.minimum(np.searchsorted(known, pair), len(known) - 1)
        return np.where(known[place] == pair, place, -1)
    slot, own = np.full(1 << _CELL_BITS, -1, dtype=np.int32), cells(known)
    slot[own] = np.arange(len(known), dtype=np.int32)
    cell = cells(pair)
    place = slot[cell].astype(np.int64)
    place[known[place] != pair] = -1
    hidden = np.flatnonzero(slot[own] != np.arange(len(known)))
    if len(hidden):
        shared = np.zeros(1 << _CELL_BITS, dtype=bool)
        shared[own[hidden]] = True
        look = np.flatnonzero(shared[cell] & (place < 0))
        found = np.minimum(np.searchsorted(known, pair[look]), len(known) - 1)
        place[look] = np.where(known[found] == pair[look], found, -1)
    return place


def compress(ids: np.ndarray, starts: np.ndarray, first_rule: int, rounds: int | None = None, least: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over one shard, until no pair is seen ``least`` times; ``rounds`` may end it earlier.

    ``starts``: where each document begins in ``ids``, and the total at the end. ``first_rule``:
    the number of the first rule, above all ids. Returns the symbols left, where each document
    begins among them, and the rules as rows of two symbols. Pairs are counted without overlaps; a
    shard shorter than two ids has no rules.
    """
    symbols = ids.astype(np.uint32)
    opens = np.zeros(len(symbols) + 1, dtype=bool)  # a document starts at this symbol
    opens[starts] = True
    rules = [np.zeros((0, 2), dtype=np.uint32)]
    n_rules, step = 0, 0
    # Where pairs begin that may be frequent. Pairs of earlier symbols only get fewer, so what was too
    # rare once stays so; beside them only pairs with a new symbol are counted in the next round.
    maybe = np.flatnonzero(~opens[1:-1])
    while len(maybe) and (rounds is None or step < rounds):
        step += 1
        left, right = symbols[maybe], symbols[maybe + 1]
        pair = (left.astype(np.uint64) << np.uint64(32)) | right
        counted = len(pair)
        # In a run of one symbol every second pair counts.
        twins = np.flatnonzero(left == right)
        if len(twins):
            fresh = np.concatenate([[True], np.diff(maybe[twins]) > 1])
            run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            second = twins[(np.arange(len(twins)) - run) % 2 == 1]
            pair[second] = _NO_PAIR
            twins, counted = maybe[second], counted - len(second)
        ordered = np.sort(pair)[:counted]
        edges = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])
        counts = np.diff(edges)
        frequent = counts >= least
        if not frequent.any():
            break
        known, counts = ordered[edges[:-1][frequent]], counts[frequent]
        place = _places(known, pair)
        same = np.flatnonzero(place >= 0)
        at, place = maybe[same], place[same]
        # Where pairs overlap, the more frequent one is replaced. The most frequent one of all keeps
        # every place; one that is left with too few is counted again in the next round.
        order = np.empty(len(known), dtype=np.int64)
        order[np.argsort(counts, kind="stable")] = np.arange(len(known))
        own, apart = order[place], np.diff(at) > 1
        wins = np.ones(len(at), dtype=bool)
        wins[1:] &= apart | (own[1:] > own[:-1])
        wins[:-1] &= apart | (own[:-1] > own[1:])
        wins = np.flatnonzero(wins)
        met, at, place = at, at[wins], place[wins]
        enough = np.bincount(place, minlength=len(known)) >= least
        number = (first_rule + n_rules + np.cumsum(enough) - 1).astype(np.uint32)
        taken = np.flatnonzero(enough[place])
        at, place = at[taken], place[taken]
        symbols[at] = number[place]
        alive = np.zeros(len(symbols), dtype=bool)
        for begin in (met, twins, at, at[at > 0] - 1):
            alive[begin] = True
        # The symbol behind a new one goes; the pair that began there begins at the new one.
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        kept = np.flatnonzero(keep)
        symbols, opens, alive = symbols[kept], np.append(opens[kept], True), alive[kept]
        maybe = np.flatnonzero(alive[:-1] & ~opens[1:-1])
        pairs = known[enough]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        n_rules += len(pairs)
    rules = np.vstack(rules)
    # Empty documents share a start, so starts are counted from the lengths before and after.
    kept_before = np.concatenate([[0], np.cumsum(_lengths(symbols, rules, first_rule))])
    return symbols, np.searchsorted(kept_before, starts), rules


def rule_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Expanded length of each rule."""
    lengths = np.ones(len(rules), dtype=np.int64)
    # Rules refer to earlier rounds only, so a few passes settle all of them.
    while True:
        known = np.ones_like(lengths)
        for side in (0, 1):
            inner = rules[:, side] >= first_rule
            part = np.ones_like(lengths)
            part[inner] = lengths[rules[inner, side] - first_rule]
            known = part if side == 0 else known + part
        if np.array_equal(known, lengths) or not len(rules):
            return lengths
        lengths = known


def _lengths(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    out = np.ones(len(symbols), dtype=np.int64)
    inner = symbols >= first_rule
    out[inner] = rule_lengths(rules, first_rule)[symbols[inner] - first_rule]
    return out


def _written_out(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Expansion by replacing rules level after level."""
    out = symbols.astype(np.uint32)
    while len(inner := np.flatnonzero(out >= first_rule)):
        sizes = np.ones(len(out), dtype=np.int64)
        sizes[inner] = 2
        place = np.concatenate([[0], np.cumsum(sizes)])
        wide = np.empty(place[-1], dtype=np.uint32)
        wide[place[:-1]] = out
        pairs = rules[out[inner] - first_rule]
        wide[place[inner]], wide[place[inner] + 1] = pairs[:, 0], pairs[:, 1]
        out = wide
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols stand for: all rules are written out once, then each symbol is looked up."""
    if not len(rules):
        return symbols.astype(np.uint32)
    lengths = rule_lengths(rules, first_rule) if lengths is None else lengths
    table = np.concatenate([np.arange(first_rule, dtype=np.uint32), _written_out(rules.ravel(), rules, first_rule)])
    size_of = np.concatenate([np.ones(first_rule, dtype=np.int64), lengths])
    start_of = np.concatenate([np.arange(first_rule), first_rule + np.cumsum(lengths) - lengths])
    sizes = size_of[symbols]
    place = np.cumsum(sizes)
    total = int(place[-1]) if len(place) else 0
    place -= sizes
    source = np.repeat(start_of[symbols] - place, sizes)
    source += np.arange(total)
    return table[source]


# --- shard bytes -------------------------------------------------------------------------------------


def pack(ids: np.ndarray, starts: np.ndarray, keys: list[int | None], first_rule: int, rounds: int | None = None) -> bytes:
    """One shard: header, document keys (a flag and a value each), document starts, rules, rule lengths, symbols.

    All numbers are little-endian; symbols take 16 bits where all fit, else 32.
    """
    symbols, where, rules = compress(ids, starts, first_rule, rounds)
    wide = len(symbols) > 0 and int(symbols.max()) > 0xFFFF
    return b"".join(
        [
            _HEAD.pack(MAGIC, len(keys), len(rules), len(symbols), first_rule | (int(wide) << 31)),
            np.array([k is not None for k in keys], dtype=np.uint8).tobytes(),
            np.array([0 if k is None else k for k in keys], dtype="<i8").tobytes(),
            where.astype("<u4").tobytes(),
            rules.astype("<u4").tobytes(),
            rule_lengths(rules, first_rule).astype("<u4").tobytes(),
            symbols.astype("<u4" if wide else "<u2").tobytes(),
        ]
    )


class Shard:
    """A packed shard; documents are decoded one by one."""

    def __init__(self, data: bytes) -> None:
        magic, n, n_rules, n_symbols, last = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        wide, self.first_rule = last >> 31, last & 0x7FFFFFFF
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += found.nbytes
            return found

        valid, values = take("u1", n), take("<i8", n)
        self.keys = [int(v) if ok else None for ok, v in zip(valid, values, strict=True)]
        self.starts = take("<u4", n + 1).astype(np.int64)
        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = take("<u4", n_rules).astype(np.int64)
        self.symbols = take("<u4" if wide else "<u2", n_symbols).astype(np.uint32)

    def sizes(self) -> np.ndarray:
        """Ids of each document, from the stored lengths of the rules alone."""
        each = np.ones(len(self.symbols), dtype=np.int64)
        inner = self.symbols >= self.first_rule
        each[inner] = self.lengths[self.symbols[inner] - self.first_rule]
        total = np.concatenate([[0], np.cumsum(each)])
        return np.diff(total[self.starts])

    def document(self, k: int) -> np.ndarray:
        """Ids of one document; no other is expanded."""
        return _written_out(self.symbols[self.starts[k] : self.starts[k + 1]], self.rules, self.first_rule)

    def all_ids(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.first_rule, self.lengths)


# --- tables -------------------------------------------------------------------------------------


def write_token_files(docs: DataFrame, vocabulary: str, path: str | None = None, key: str = "doc_id", text: str = "text", end_id: int = 0, shard_tokens: int = 1 << 20, rounds: int | None = None) -> str:
    """Write the ids of all texts in ascending ``key`` order; returns the table's path.

    ``vocabulary`` is the path of a vocabulary file that the driver can read; its content is
    broadcast. ``end_id`` is appended to each document. A null text is empty and has the end id
    alone; a null key comes first; rows with equal keys follow the hash of their text, and rows
    that are equal in both are alike in the file. Other columns are left out. No documents: a
    table without rows. A document longer than a shard is a shard of its own.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "token-files")
    content = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())
    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # Ranges over key and text hash: one hot key is cut, too.
    rows = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = _coder(content.value), TaskContext.get().partitionId()
        first_rule = len(coder.token_bytes)
        end = np.array([end_id], dtype="<u4").tobytes()
        coded: list[bytes] = []
        keys: list[int | None] = []
        held = shard = before = 0

        def closed() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])])
            data = pack(np.frombuffer(b"".join(coded), dtype="<u4"), starts, keys, first_rule, rounds)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "before": pa.array([before], pa.int64()), "n_docs": pa.array([len(keys)], pa.int64()), "n_tokens": pa.array([int(starts[-1])], pa.int64()), "data": pa.array([data], pa.binary())}
            )

        for batch in bounded_slices(batches):
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = coder.encode(t) + end
                if keys and held + len(ids) > 4 * shard_tokens:
                    yield closed()
                    before += held // 4
                    coded, keys, held, shard = [], [], 0, shard + 1
                coded.append(ids)
                keys.append(k)
                held += len(ids)
        if keys:
            yield closed()

    map_arrow(rows, run, "part int, shard int, before long, n_docs long, n_tokens long, data binary").write.parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Shards with ``start``, the number of ids in all shards before.

    A shard stores the ids before it in its part; the driver sums the parts, as many numbers as
    the writing job had partitions.
    """
    shards = spark.read.parquet(path)
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    before, at = [], 0
    for part in range(max(totals, default=0) + 1):
        before.append(at)
        at += totals.get(part, 0)
    offsets = F.array(*[F.lit(n).cast("long") for n in before])
    return shards.withColumn("start", F.element_at(offsets, F.col("part") + 1) + F.col("before"))


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens and the CRC-32 of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch.column(1)[row].as_buffer())
                sizes = shard.sizes()
                ends = np.cumsum(sizes)
                ids = memoryview(shard.all_ids().astype("<u4", copy=False)).cast("B")
                sums = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                start = batch.column(0)[row].as_py()
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(shard.keys, pa.int64()), "start": pa.array(start + ends - sizes), "n_tokens": pa.array(sizes), "ids_crc32": pa.array(sums, pa.int64())})

    return map_arrow(read_token_files(spark, path).select("start", "data"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
