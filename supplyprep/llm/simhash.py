"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits; a bit is set if it is set in over half of the hashes of the text's word
shingles. Two fingerprints that differ in at most d bits agree in at least k - d of any k blocks
the 64 bits are cut into. So each distinct fingerprint is put under every choice of k - d blocks,
fingerprints with equal blocks meet, and their Hamming distance is verified. k grows with the
number of fingerprints so that blocks of unrelated texts rarely meet.

Texts stay where they are; from there on only fingerprints move, each distinct one once. Within a
set of equal blocks a search over the fingerprints still unlinked finds a spanning forest of the
links instead of all pairs. Blocks that more than ``most`` fingerprints share are not gathered:
their fingerprints are matched by values half-way between two of them, which takes a fixed number
of rows for each and loses no link either.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from supplyprep.llm.common import bounded_slices, buffer_of, map_arrow, materialize, offsets_of, row_identity, small_side, staged, text_bytes
from supplyprep.llm.components import connected_components

BITS = 64
SEED = 42


# --- fingerprints -------------------------------------------------------------------------------


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of each word shingle of a text whose A-Z are lower-cased; words end at ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    digest = xxhash.xxh64_intdigest
    pairs = zip((ends - sizes)[: 1 - shingle or None].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64)


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64 bits of a text as a signed integer; zero for a text without words."""
    hashes = shingle_hashes(text, shingle)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) of every row; a null text is an empty one."""
    source = docs.select(F.col(key), text_bytes(docs[text]).alias("__bytes"))
    schema = StructType([*source.schema.fields[:1], *StructType().add("fingerprint", LongType(), False).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "__bytes"):
            values = batch.column(1)
            data, at = buffer_of(values), offsets_of(values)
            found = [fingerprint(bytes(data[a:b]), shingle) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=[key, "fingerprint"])

    return map_arrow(source, run, schema)


# --- links -------------------------------------------------------------------------------


def block_masks(distance: int, n_fingerprints: int) -> list[int]:
    """Bit masks of all choices of k - distance among k blocks.

    k is the smallest number for which a choice keeps two bits more than it takes to number the
    fingerprints, so that a block holds few unrelated ones; distance + 8 at most.
    """
    wanted = max(n_fingerprints, 2).bit_length() + 2
    k = next((k for k in range(distance + 1, distance + 8) if BITS // k * (k - distance) >= wanted), distance + 8)
    cuts = [BITS * i // k for i in range(k + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [reduce(int.__or__, chosen, 0) for chosen in combinations(blocks, k - distance)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def bits_between(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """Hamming distance of 64-bit values."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def spanning_links(values: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that join what is connected within ``distance`` bits: each value is compared with those no link has reached yet."""
    ends_a, ends_b = [], []
    left = values[1:]
    reached = [values[0]]
    while True:
        while reached and len(left):
            x = reached.pop()
            near = bits_between(left, x) <= distance
            if near.any():
                hit = left[near]
                ends_a.append(np.full(len(hit), x))
                ends_b.append(hit)
                reached.extend(hit)
                left = left[~near]
        if not len(left):
            return ends_a, ends_b
        reached, left = [left[0]], left[1:]


def _links_of_runs(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; rows of a block that are cut by the end of a batch are kept for the next."""
    rest = [np.zeros(0, dtype=np.int64)] * 3
    for batch in _with_end(batches):
        columns = rest if batch is None else [np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest)]
        choice, block, value = columns
        if not len(value):
            continue
        cuts = np.flatnonzero((np.diff(choice) != 0) | (np.diff(block) != 0)) + 1
        last = len(value) if batch is None else (int(cuts[-1]) if len(cuts) else 0)
        rest = [c[last:] for c in columns]
        starts = np.concatenate([[0], cuts])
        starts = starts[starts < last]
        stops = np.append(starts[1:], last)
        sizes = stops - starts
        found_a, found_b = [], []
        pairs = starts[sizes == 2]
        if len(pairs):
            a, b = value[pairs], value[pairs + 1]
            near = bits_between(a, b) <= distance
            found_a.append(a[near])
            found_b.append(b[near])
        for start, stop in zip(starts[sizes > 2].tolist(), stops[sizes > 2].tolist(), strict=True):
            more_a, more_b = spanning_links(value[start:stop], distance)
            found_a += more_a
            found_b += more_b
        if found_a:
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _halfway(batches: Iterator[pa.RecordBatch], near: int, far: int) -> Iterator[pa.RecordBatch]:
    """Each value with all values up to ``far`` bits away from it, and whether they are within ``near``."""
    flips = [0] + [reduce(int.__or__, (1 << i for i in chosen)) for r in range(1, far + 1) for chosen in combinations(range(BITS), r)]
    flips = np.array([_signed(f) for f in flips], dtype=np.int64)
    is_near = bits_between(flips, 0) <= near
    for batch in batches:
        for x in batch.column(0).to_numpy():
            yield pa.RecordBatch.from_pydict({"between": flips ^ x, "value": np.full(len(flips), x), "near": is_near})


def fingerprint_links(distinct: DataFrame, n_fingerprints: int, distance: int = 4, most: int = 20_000) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all pairs within ``distance`` bits."""
    masks = [F.struct(F.lit(i).cast("short").alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("block")) for i, m in enumerate(block_masks(distance, n_fingerprints))]
    blocks = distinct.select(F.explode(F.array(*masks)).alias("at"), "fingerprint").select("at.choice", "at.block", "fingerprint")
    hot, n_hot = materialize(blocks.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).drop("n"), "hot-blocks")
    crowded = None
    if n_hot:
        crowded = staged(blocks.join(hot, ["choice", "block"], "left_semi").select("fingerprint").distinct(), "crowded")
        blocks = blocks.join(hot, ["choice", "block"], "left_anti")
    met = blocks.repartition("choice", "block").sortWithinPartitions("choice", "block", "fingerprint")
    links = map_arrow(met, lambda batches: _links_of_runs(batches, distance), "a long, b long")
    if crowded is not None:
        near, far = distance // 2, distance - distance // 2
        between = map_arrow(crowded, lambda batches: _halfway(batches, near, far), "between long, value long, near boolean")
        hub = between.where("near").groupBy("between").agg(F.min("value").alias("a"))
        links = links.unionByName(between.join(hub, "between").where("a != value").select("a", F.col("value").alias("b")).distinct())
    return links


def simhash_components(docs: DataFrame, shingle: int = 4, distance: int = 4, text: str = "text", key: str = "doc_id", most: int = 20_000) -> DataFrame:
    """(key, fingerprint, component_id) of every row of ``docs``.

    Rows whose fingerprints differ in at most ``distance`` bits are linked; component_id is the
    smallest key reachable. Empty and null texts have fingerprint zero and are linked like any
    other. Repeated rows and rows with equal keys stay rows of their own. A row with a null key is
    linked like others; its component is null if no row of it has a key. No rows: no rows.
    Other columns are not read.
    """
    marked = staged(fingerprints(docs, shingle, text, key), "fingerprints")
    distinct, n = materialize(marked.groupBy("fingerprint").agg(F.min(key).alias("first")), "distinct-fingerprints")
    found = connected_components(fingerprint_links(distinct.select("fingerprint"), n, distance, most))
    linked = distinct.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    # Written before it is joined back: then a hot component can be split over tasks.
    smallest = staged(linked.groupBy("component").agg(F.min("first").alias("component_id")), "components")
    named = linked.join(smallest, "component").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select(key, "fingerprint", "component_id")


def keep_one_per_component(docs: DataFrame, shingle: int = 4, distance: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The first row, by key and then by text hash, of every component, with all columns.

    Rows without a key come last. Of rows equal in key and text one stays, the smallest by all
    columns (columns that cannot be ordered, maps, by their JSON text). Null and empty texts are one
    group. No rows: no rows.
    """
    row = row_identity(key, text)
    rows = docs.select(F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("key"), row.alias("row")).alias("at"), F.col(text).alias("text"))
    found = simhash_components(rows, shingle, distance, "text", "at")
    at = F.col("at.row").alias("__row")
    # Written first, as the losers and the repeated winners are both taken from it.
    found = staged(found.groupBy(at, (F.col("at.row") == F.col("component_id.row")).alias("first")).agg(F.count(F.lit(1)).alias("n")), "rows-of-components")
    dropped, n = materialize(found.where("not first").select("__row"), "near-copies")
    repeated, n_repeated = materialize(found.where("first and n > 1").select("__row"), "repeated-firsts")
    marked, same = docs.withColumn("__at", row), F.col("__at") == F.col("__row")
    kept = marked.join(small_side(dropped, n), same, "left_anti")
    if not n_repeated:
        return kept.drop("__at")
    repeated = small_side(repeated, n_repeated)
    single = kept.join(repeated, same, "left_anti").select(*docs.columns)
    # Combines on the map side, so that a hot row is one row of each task.
    rows = marked.join(repeated, same, "left_semi").groupBy("__at")
    maps = [f.name for f in docs.schema.fields if "map<" in f.dataType.simpleString()]
    order = F.struct(*[F.to_json(F.struct(c)).alias(c) if c in maps else F.col(c) for c in docs.columns])
    one = rows.agg((F.min_by(F.struct(*docs.columns), order) if maps else F.min(order)).alias("__one")).select("__one.*")
    return single.unionByName(one)
