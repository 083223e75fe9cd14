"""Packing of documents into training sequences by lexical retrieval.

1. Every text is tokenized once; its ids are written with two min-hashes of them.
2. The documents are sorted over the cluster by min-hash, so that documents with much the same
   words come to lie near each other, and cut into shards of bounded tokens.
3. A shard is a BM25 inverted index in the memory of a task. A seed document opens a window; the
   index returns its unused neighbours, best first, and they fill the window greedily. The document
   that does not fit any more is cut, and its rest is the seed of the next window.

No window but the last of a task is left open, and that one is dealt into sequences whose lengths
are powers of two, so nothing is padded. Hot groups of copies are cut by the sort's last key, the
row number; memory goes by the shard, whatever the size of a partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from supplyprep.llm.common import ARROW_BYTES, bounded_slices, map_arrow, staged, text_or_empty
from supplyprep.llm.tokens import WordBpe

WINDOW = 4096
#: Tokens of a shard, the index that a task holds at a time.
SHARD_TOKENS = 1 << 20
#: BM25: saturation of repeats, and share of the length norm.
K1, B = 1.2, 0.75

_MIXERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B))


@lru_cache(maxsize=2)
def word_bpe_of(content: bytes) -> WordBpe:
    return WordBpe(content)


def _min_hashes(ids: np.ndarray) -> list[int]:
    out = []
    for mixer in _MIXERS:
        mixed = ids * mixer
        mixed ^= mixed >> np.uint32(15)
        out.append(int((mixed * _MIXERS[0]).min()))
    return out


def tokenized(docs: DataFrame, vocabulary: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its key, ids with the end id (16-bit integers if they fit), min-hashes, and a row number."""
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    work = docs.select(F.col(key).alias("key"), text_or_empty(docs[text]).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_bpe_of(content.value)
        row = TaskContext.get().partitionId() << 40
        for batch in bounded_slices(batches, "text", ARROW_BYTES):
            coded = [np.append(ids, np.uint32(end)) for ids in coder.encode_all(batch.column(1).to_pylist())]
            marks = np.array([_min_hashes(ids) for ids in coded], dtype=np.int64)
            narrow = [ids.astype("<u2" if ids.max() < 1 << 16 else "<u4") for ids in coded]
            columns = [batch.column(0), pa.array([a.tobytes() for a in narrow], pa.binary()), pa.array([len(a) for a in coded], pa.int64())]
            rows = pa.array(np.arange(row, row + len(coded)))
            row += len(coded)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(marks[:, 0]), pa.array(marks[:, 1]), rows], names=["key", "ids", "n", "a", "b", "row"])

    key_type = work.schema["key"].dataType.simpleString()
    return map_arrow(work, run, f"key {key_type}, ids binary, n long, a long, b long, row long")


class Shard:
    """A BM25 index over the documents of a shard; terms are token ids."""

    def __init__(self, documents: list[np.ndarray]) -> None:
        n, lengths = len(documents), np.array([len(d) for d in documents])
        tokens = np.concatenate(documents).astype(np.int64)
        pairs, counts = np.unique(np.repeat(np.arange(n), lengths) << 32 | tokens, return_counts=True)
        by_document, terms = pairs >> 32, pairs & 0xFFFFFFFF
        vocabulary, terms = np.unique(terms, return_inverse=True)
        self.n = n
        self.terms, self.begins = terms, np.searchsorted(by_document, np.arange(n + 1))
        order = np.argsort(terms, kind="stable")
        self.starts = np.searchsorted(terms[order], np.arange(len(vocabulary) + 1))
        self.documents = by_document[order]
        tf, frequency = counts[order], np.diff(self.starts)
        rarity = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        self.weights = rarity[terms[order]] * tf * (K1 + 1) / (tf + norm[self.documents])

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Documents not yet used, those most like ``seed`` first; equal scores by place."""
        own = self.terms[self.begins[seed] : self.begins[seed + 1]]
        starts, sizes = self.starts[own], self.starts[own + 1] - self.starts[own]
        at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        scores = np.bincount(self.documents[at], self.weights[at], minlength=self.n)
        left = np.flatnonzero(~used)
        return left[np.argsort(-scores[left], kind="stable")]


class Packer:
    """Windows of one task; pieces are (document, start, length, sequence, offset)."""

    def __init__(self, window: int, first: int) -> None:
        self.window, self.sequence = window, first
        self.open: list[tuple[int, int, int]] = []
        self.filled = 0
        self.done: list[tuple[int, int, int, int, int]] = []

    def _close(self, pieces: list[tuple[int, int, int]]) -> None:
        offset = 0
        for document, start, length in pieces:
            self.done.append((document, start, length, self.sequence, offset))
            offset += length
        self.sequence += 1

    def put(self, document: int, start: int, stop: int) -> int:
        """Put ids from ``start`` on into the open window; returns where it was cut, ``stop`` if not at all."""
        length = min(stop - start, self.window - self.filled)
        self.open.append((document, start, length))
        self.filled += length
        if self.filled == self.window:
            self._close(self.open)
            self.open, self.filled = [], 0
        return start + length

    def pack(self, documents: list[np.ndarray], names: list[int]) -> None:
        """All documents of a shard; the last window may stay open."""
        shard, used = Shard(documents), np.zeros(len(documents), dtype=bool)
        upto = 0
        seed, start = 0, 0
        while True:
            while start < len(documents[seed]):
                start = self.put(names[seed], start, len(documents[seed]))
            used[seed] = True
            begun = None
            if self.filled:
                for other in shard.neighbours(seed, used).tolist():
                    used[other] = True
                    stop = self.put(names[other], 0, len(documents[other]))
                    if stop < len(documents[other]):
                        begun = (other, stop)
                    if not self.filled:
                        break
            if begun:
                seed, start = begun
                continue
            while upto < len(used) and used[upto]:
                upto += 1
            if upto == len(used):
                return
            seed, start = upto, 0

    def finish(self) -> None:
        """Deal what is left into sequences whose lengths are powers of two, the longest first."""
        left = self.filled
        pieces, self.open, self.filled = self.open, [], 0
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            own = []
            while size:
                document, start, length = pieces.pop(0)
                own.append((document, start, min(length, size)))
                if length > size:
                    pieces.insert(0, (document, start + size, length - size))
                size -= own[-1][2]
            self._close(own)


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end: int = 2, key: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of sequences: key, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the piece's ids as little-endian 32-bit integers. Every id of every document lies in
    exactly one piece; a document ends with id ``end``. A null or empty text is that id alone. Rows
    with equal keys or texts, and null keys, are documents of their own. No rows: no pieces.
    Sequences have ``window`` ids, or a power of two below it. ``vocabulary``: a path that the driver can read.
    """
    rows = staged(tokenized(docs, vocabulary, end, key, text), "token-ids")
    dealt = rows.repartitionByRange(F.col("a"), F.col("b"), F.col("row")).sortWithinPartitions("a", "b", "row")
    schema = StructType([*docs.select(key).schema.fields, *StructType().add("start", "long").add("length", "long").add("ids", "binary").add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long").fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        held: dict[int, tuple] = {}  # documents with pieces that are not yet written: key and ids
        fresh, size, count = [], 0, 0

        def written() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(packer.done), 2048):
                part = packer.done[at : at + 2048]
                keys = pa.array([held[p[0]][0] for p in part], kind)
                ids = [held[d][1][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in part]
                longs = [pa.array(c, pa.int64()) for c in ([p[1] for p in part], [p[2] for p in part], [len(held[p[0]][1]) for p in part], [p[3] for p in part], [p[4] for p in part])]
                yield pa.RecordBatch.from_arrays([keys, longs[0], longs[1], pa.array(ids, pa.binary()), *longs[2:]], names=names)
            packer.done = []
            waiting = {p[0] for p in packer.open}
            for document in [d for d in held if d not in waiting]:
                del held[document]

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for name, data, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held[count] = (name, np.frombuffer(data, dtype="<u2" if len(data) == 2 * n else "<u4"))
                fresh.append(count)
                size, count = size + n, count + 1
                if size >= shard_tokens:
                    packer.pack([held[d][1] for d in fresh], fresh)
                    fresh, size = [], 0
                    yield from written()
        if fresh:
            packer.pack([held[d][1] for d in fresh], fresh)
        packer.finish()
        yield from written()

    return map_arrow(dealt.select("key", "ids", "n"), run, schema)
