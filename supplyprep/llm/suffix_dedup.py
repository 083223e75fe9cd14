"""Removal of repeated byte strings by bucket-pointer refinement of suffixes.

A byte goes if it lies in a string of ``length`` bytes that starts anywhere else, too. The suffixes
that matter are window starts, and equal windows must end up in one bucket:

1. Initial buckets. A window is put into the bucket of one q-gram in it, the one with the smallest
   hash (the leftmost of equals). Equal windows choose alike, neighbouring windows mostly choose
   the same q-gram, so one row stands for a run of windows: the anchor with the offsets at which
   windows start before it. Buckets of one row are dropped; most of the corpus ends here.
2. Rows of a bucket whose whole surroundings are equal are settled together, by an identifier of
   those bytes: all their windows are repeated. One of them stays as a partner for the others.
3. Refinement. What is left is split by offsets, and each part is refined by the identifiers of
   the bytes at later and earlier offsets that all windows of the part share; the identifier of
   the bucket above is reused, only the bytes that come new are added to it. A sub-bucket of one
   row is dropped. Within a sub-bucket, rows whose windows together are equal are settled and
   leave one partner; the others are split again, down to single windows.

Buckets are never gathered: every step counts identifiers by a combining aggregate and joins the
counts back. Identifiers are 128-bit hashes of bytes (64-bit ones only select buckets in step 1).
Texts are shuffled once; what follows reads only those that share a q-gram with anything.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.llm.common import bounded_slices, buffer_of, map_arrow, offsets_of, staged, text_bytes

GRAM = 48
#: Widths of the parts that the offsets of an anchor are split into, one after the other.
WIDTHS = (49, 7, 1)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 21
_SEGMENT = 1 << 20


# --- anchors -------------------------------------------------------------------------------


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` bytes, put together from runs of powers of two."""
    run = data.astype(np.uint64) * _ODD
    run ^= run >> np.uint64(32)
    width, done, total = 1, 0, None
    while True:
        if size & width:
            if total is None:
                total = run
            else:
                n = len(run) - done
                total = total[:n] * (_ODD + np.uint64(4 * width)) + run[done : done + n]
                total ^= total >> np.uint64(29)
            done += width
        width *= 2
        if width > size:
            return total
        n = len(run) - width // 2
        run = run[:n] * (_ODD + np.uint64(2 * width)) + run[width // 2 :]
        run ^= run >> np.uint64(31)


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        values = np.minimum(values[: size - width], values[width - size :])
    return values


def anchors(data: np.ndarray, length: int, gram: int = GRAM, segment: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of ``length`` bytes: place, first and last window start, hash.

    Long texts are cut into segments of window starts; an anchor at a cut is given once for each
    side, with its own windows.
    """
    parts, segment = [], segment or _SEGMENT
    for at in range(0, max(0, len(data) - length + 1), segment):
        hashes = gram_hashes(data[at : at + segment + length - 1], gram)
        marked = (hashes >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        place = (_least_in_windows(marked, length - gram + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], cuts])
        last = np.concatenate([cuts - 1, [len(place) - 1]])
        where = place[first]
        parts.append((where + at, first + at, last + at, hashes[where].view(np.int64)))
    if not parts:
        return (np.zeros(0, dtype=np.int64),) * 4
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


_ANCHORS = "doc long, place int, first int, last int, gram long, around binary"


def _anchor_rows(source: DataFrame, length: int, segment: int = _SEGMENT) -> DataFrame:
    """One row per anchor of every text; ``around`` identifies the offsets and all bytes of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in bounded_slices(batches, "bytes"):
            data, at, keys = buffer_of(batch.column(1)), offsets_of(batch.column(1)), batch.column(0).to_numpy()
            columns: list[list] = [[], [], [], [], []]
            around: list[bytes] = []
            for key, a, b in zip(keys, at[:-1], at[1:], strict=True):
                if b - a < length:
                    continue
                text = bytes(data[a:b])
                place, first, last, gram = anchors(np.frombuffer(text, dtype=np.uint8), length, segment=segment)
                for column, values in zip(columns, (np.full(len(place), key), place, first, last, gram), strict=True):
                    column.append(values)
                around += [digest(text[s : e + length] + struct.pack("<ii", p - e, p - s)) for p, s, e in zip(place.tolist(), first.tolist(), last.tolist(), strict=True)]
            if around:
                kinds = (np.int64, np.int32, np.int32, np.int32, np.int64)
                arrays = [pa.array(np.concatenate(c).astype(k)) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(around, pa.binary())], names=["doc", "place", "first", "last", "gram", "around"])

    return map_arrow(source.select("doc", "bytes"), run, _ANCHORS)


# --- refinement -------------------------------------------------------------------------------


def sub_buckets(text: bytes, row: dict, width: int, length: int) -> list[tuple]:
    """The parts of ``width`` offsets that a row splits into.

    A row has an anchor's place, the part from x to y (offsets of window starts before the anchor),
    the row's own window starts first to last, and the bucket's identifier. Each part gets its
    bounds, its own window starts, its bucket's identifier, and an identifier of all its windows
    if the row has every one of them, else none.
    """
    digest, out = xxhash.xxh3_128_digest, []
    p, x, y = row["place"], row["x"], row["y"]
    for c in range(x, y, width):
        d = min(c + width, y)
        low, high = max(c, p - row["last"]), min(d - 1, p - row["first"])
        if low > high:
            continue
        earlier, later = text[p - c : p - x], text[p - y + length + 1 : p - d + length + 1]
        bucket = digest(row["bucket"] + earlier + later + struct.pack("<ii", c, d))
        whole = digest(bucket + text[p - d + 1 : p - c + length]) if (low, high) == (c, d - 1) else None
        out.append((p, c, d, p - high, p - low, row["settled"], bucket, whole))
    return out


_PARTS = "doc long, place int, x int, y int, first int, last int, settled boolean, bucket binary, whole binary"


def _split(texts: DataFrame, rows: DataFrame, width: int, length: int) -> DataFrame:
    """Sub-buckets of ``rows``, whose texts are fetched from ``texts``."""
    fields = ("place", "x", "y", "first", "last", "settled", "bucket")
    work = texts.join(rows.groupBy("doc").agg(F.collect_list(F.struct(*fields)).alias("rows")), "doc").select("doc", "bytes", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _PARTS.split(", ")]
        kinds = [pa.int64(), *[pa.int32()] * 5, pa.bool_(), pa.binary(), pa.binary()]
        for batch in bounded_slices(batches, "bytes"):
            for doc, text, items in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = [(doc, *part) for row in items for part in sub_buckets(text, row, width, length)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    return map_arrow(work, run, _PARTS)


def _settle(parts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Removed strings of the rows whose windows are all repeated, and the rows to refine further.

    Parts without ``whole`` lack some windows and stand for themselves: both sides of a cut have
    the same place, so a part is told by its window starts, too.
    """
    alone = F.coalesce("whole", F.concat_ws(":", "doc", "place", "first", "last").cast("binary"))
    marked = parts.withColumn("whole", alone)
    kept = ("doc", "place", "x", "y", "first", "last", "settled")
    classes = staged(marked.groupBy("bucket", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*kept)).alias("one")), "classes")
    repeated = classes.where("n > 1").select("bucket", "whole")
    removed = marked.where("not settled").join(repeated, ["bucket", "whole"], "left_semi").select("doc", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))
    open_buckets = staged(classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("bucket"), "open-buckets")
    left = classes.join(open_buckets, "bucket", "left_semi")
    return removed, left.select("one.doc", "one.place", "one.x", "one.y", "one.first", "one.last", (F.col("one.settled") | (F.col("n") > 1)).alias("settled"), "bucket")


def repeated_strings(source: DataFrame, length: int, segment: int = _SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Strings to remove (doc, start, stop), overlapping ones included; and the texts they can lie in.

    ``source`` has doc (a key), doc_key and bytes; the second result adds to it what the texts that
    share nothing come to.
    """
    found = staged(_anchor_rows(source, length, segment), "anchors")
    # Counts are written before they are joined back: then a hot bucket can be split over tasks.
    shared = staged(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "shared-grams")
    near = staged(found.join(shared, "gram", "left_semi"), "shared-anchors")
    one = F.min(F.struct("doc", "place", "first", "last", "gram")).alias("one")
    classes = staged(near.groupBy("around").agg(F.count(F.lit(1)).alias("n"), one).select("around", "n", "one.*"), "surroundings")
    settled = near.join(classes.where("n > 1").select("around"), "around", "left_semi")
    removed = [settled.select("doc", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))]
    open_grams = staged(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gram"), "open-grams")
    rows = classes.join(open_grams, "gram", "left_semi").select(
        "doc", "place", F.lit(0).alias("x"), F.lit(length - GRAM + 1).alias("y"), "first", "last", (F.col("n") > 1).alias("settled"), F.encode(F.hex("gram"), "utf-8").alias("bucket")
    )
    touched = near.select("doc", F.lit(True).alias("touched")).distinct()
    texts = source.join(touched, "doc", "left")
    texts = texts.select("doc", "doc_key", F.octet_length("bytes").cast("long").alias("n_bytes"), F.when(F.col("touched"), F.col("bytes")).alias("bytes"), F.when(F.col("touched").isNull(), F.sha2("bytes", 256)).alias("whole_sha256"))
    texts = staged(texts, "texts")
    for width in WIDTHS:
        parts = staged(_split(texts.where("bytes is not null"), rows, width, length), "parts")
        gone, rows = _settle(parts, length)
        removed.append(gone)
    strings = removed[0]
    for more in removed[1:]:
        strings = strings.unionByName(more)
    return strings, texts


# --- documents -------------------------------------------------------------------------------


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals; neighbours without a gap are one run."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    fresh = np.concatenate([[True], starts[1:] > stops[:-1]])
    return starts[fresh], stops[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(stops) - 1]])]


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text", key: str = "doc_id", segment: int = _SEGMENT) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans and the bytes kept.

    Columns ``kept`` (binary) and ``kept_sha256``: ``kept`` is null where nothing was removed, as
    the text is unchanged. A null text is empty. Matches never cross documents. Rows with equal
    keys are documents of their own; fully equal rows repeat each other like any copies. Texts
    shorter than ``length`` lose nothing. Other columns are not read. ``segment``: window starts
    that are looked at at a time; the result does not depend on it.
    """
    if length < GRAM + 1:
        raise ValueError(f"length must be above {GRAM}")
    source = docs.select(F.col(key).alias("doc_key"), text_bytes(docs[text]).alias("bytes"))
    source = source.select(F.xxhash64("doc_key", "bytes").alias("doc"), "doc_key", "bytes")
    strings, texts = repeated_strings(source, length, segment)
    lists = strings.groupBy("doc").agg(F.collect_set(F.struct("start", "stop")).alias("strings"))
    work = texts.join(lists, "doc", "left").select("doc_key", "n_bytes", "bytes", "whole_sha256", F.col("strings.start").alias("starts"), F.col("strings.stop").alias("stops"))
    key_type = dict(source.dtypes)["doc_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "bytes"):
            rows = []
            for data, whole, starts, stops in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                if not starts:
                    rows.append((0, 0, None, whole or hashlib.sha256(data).hexdigest()))
                    continue
                a, b = merged(np.array(starts), np.array(stops))
                edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(data)]
                kept = b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))
                rows.append((int((b - a).sum()), len(a), kept, hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=[key, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return map_arrow(work, run, f"`{key}` {key_type}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
