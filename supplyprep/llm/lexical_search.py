"""Ranked lexical search by accumulator-limited term-at-a-time scoring.

Every document is read once and becomes a row of a forward index: its number of terms, and the
query terms in it with their counts. Corpus figures (documents, terms, documents of each query
term) are sums over that table. Scoring then goes over the table in blocks of documents, each a
small inverted index in the memory of a task:

* An item's terms are taken rarest first. Each adds its exact share to the accumulators of the
  documents in its list.
* A document that has no accumulator yet can still get the bounds of the terms left, a term's
  bound being its weight times the largest impact in the block. Once that sum is below the k-th
  best partial score, no accumulators are created any more.
* The accumulators there are go on being updated, by every term, so their scores are exact.

The k best of each block meet in one ranking. Partial scores only grow, so a document that a
block leaves out is below k documents of that block, and of the whole.

Items go to the tasks in blocks of bounded bytes, one after the other; there is no join of items
and documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from supplyprep.llm.common import bounded_slices, map_arrow, staged, text_bytes

#: Bytes of item texts that go to the tasks at a time.
ITEM_BYTES = 8 << 20
#: Query terms of documents (counted once for each document) that a block of documents holds.
BLOCK_POSTINGS = 2_000_000

_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    """The terms of a text's UTF-8 bytes: runs of ASCII letters, digits and all other characters, A-Z lower-cased."""
    return data.translate(_FOLDED).split()


def weight_of(documents: int, frequency: int) -> int:
    """A term's weight from the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class Block:
    """The inverted lists of a block of documents, and its search."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray, norms: np.ndarray, order: np.ndarray, vocabulary: int) -> None:
        """``terms`` and ``counts`` of all documents one after the other, ``sizes`` by document, ``order``: ranks of the document keys."""
        documents = np.repeat(np.arange(len(sizes)), sizes)
        by_term = np.argsort(terms, kind="stable")
        self.documents, tf = documents[by_term], counts[by_term]
        self.impacts = 1_000_000_000 * tf // (1000 * tf + 8 * norms[self.documents])
        self.starts = np.searchsorted(terms[by_term], np.arange(vocabulary + 1))
        self.n, self.order = len(sizes), order

    def best(self, query: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents above 0 and their scores; ``query``: terms, rarest first, and their weights."""
        lists = [(slice(self.starts[t], self.starts[t + 1]), w) for t, w in query if w > 0 and self.starts[t] < self.starts[t + 1]]
        bounds = [w * int(self.impacts[at].max()) for at, w in lists]
        left, least = sum(bounds), 0
        scores, has = np.zeros(self.n, dtype=np.int64), np.zeros(self.n, dtype=bool)
        for (at, w), bound in zip(lists, bounds, strict=True):
            found, shares = self.documents[at], w * self.impacts[at]
            if left < least:
                known = has[found]
                found, shares = found[known], shares[known]
            else:
                has[found] = True
            scores[found] += shares
            left -= bound
            if left >= least:  # else no accumulator can be made any more, whatever the k-th score
                made = scores[has]
                least = int(np.partition(made, len(made) - k)[len(made) - k]) if len(made) >= k else 0
        chosen = np.flatnonzero(has & (scores > 0))
        if len(chosen) > k:
            kth = np.partition(scores[chosen], len(chosen) - k)[len(chosen) - k]
            chosen = chosen[scores[chosen] >= kth]
        chosen = chosen[np.lexsort((self.order[chosen], -scores[chosen]))][:k]
        return chosen, scores[chosen]


def _forward_index(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Per document its key, number of terms, and the query terms in it with their counts."""
    work = docs.select(F.col(key).alias("key"), text_bytes(docs[text]).alias("bytes"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in bounded_slices(batches, "bytes"):
            sizes, terms, counts, ends = [], [], [], [0]
            for data in batch.column(1).to_pylist():
                words = terms_of(data)
                sizes.append(len(words))
                for word, n in Counter(words).items():
                    if word in known:
                        terms.append(known[word])
                        counts.append(n)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(values, pa.int32())) for values in (terms, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["key", "n", "terms", "counts"])

    key_type = work.schema["key"].dataType.simpleString()
    return map_arrow(work, run, f"key {key_type}, n long, terms array<int>, counts array<int>")


def _search_block(docs: DataFrame, items: pa.Table, k: int, key: str, text: str) -> DataFrame:
    """The k best documents of each of a bounded number of items."""
    queries = [sorted(set(terms_of((t or "").encode()))) for t in items.column("text").to_pylist()]
    words = sorted({w for q in queries for w in q})
    vocabulary = {w: i for i, w in enumerate(words)}
    index = staged(_forward_index(docs, vocabulary, key, text), "forward-index")
    totals = index.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # One row for each query term at most.
    frequency = dict(index.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    ranked = [
        [(t, weight_of(totals["documents"], frequency[t])) for t in sorted((vocabulary[w] for w in q if vocabulary[w] in frequency), key=lambda t: (frequency[t], t))]
        for q in queries
    ]
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((ranked, items.column("item").combine_chunks(), len(words)))
    n_documents, n_terms = totals["documents"], max(1, totals["terms"])
    names = ["q", "item", "key", "score"]

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        ranked, item_keys, size = shared.value
        table = pa.Table.from_batches(parts).combine_chunks()
        keys, n, terms, counts = (table.column(c).combine_chunks() for c in ("key", "n", "terms", "counts"))
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        n = n.to_numpy()
        order = np.empty(len(n), dtype=np.int64)
        order[pc.array_sort_indices(keys).to_numpy()] = np.arange(len(n))
        norms = 100 - 90 + (90 * n * n_documents) // n_terms
        sizes = pc.list_value_length(terms).to_numpy()
        block = Block(terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64), sizes, norms, order, size)
        hits = [block.best(query, k) for query in ranked]
        lengths = [len(h[0]) for h in hits]
        if not sum(lengths):
            return None
        q = pa.array(np.repeat(np.arange(len(hits)), lengths))
        at, scores = (np.concatenate([h[i] for h in hits]) for i in range(2))
        return pa.RecordBatch.from_arrays([q, item_keys.take(q), keys.take(pa.array(at)), pa.array(scores)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts.append(batch)
            held += len(batch.column(2).flatten())
            if held >= BLOCK_POSTINGS:
                if (out := found(parts)) is not None:
                    yield out
                parts, held = [], 0
        if parts and (out := found(parts)) is not None:
            yield out

    item_type = items.schema.field("item")
    kinds = {f.name: f.dataType for f in index.schema.fields}
    schema = StructType().add("q", LongType()).add("item", _spark_type(item_type)).add("key", kinds["key"]).add("score", LongType())
    best = map_arrow(index, run, schema)
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("key")))
    return best.withColumn("rank", place).where(F.col("rank") <= k)


def _spark_type(field: pa.Field):
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(field.type)


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item, rank (from 1), key, score.

    Only scores above 0 count; equal scores go by ascending key, null keys last. A null or empty
    text has no terms: such a document is found by nothing, such an item finds nothing. Rows with
    equal keys are documents of their own; equal rows of ``items`` are one item, rows that share
    only the id are ranked each by itself. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).distinct()
    total = wanted.agg(F.sum(F.octet_length(text_bytes("text")) + 64).alias("n")).first()["n"] or 0
    n_blocks = -(-total // item_bytes)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, n_blocks)))
    out = None
    for b in range(n_blocks):
        block = wanted.where(part == b).orderBy("item", "text").toArrow()
        if block.num_rows:
            hits = _search_block(docs, block, k, key, text)
            out = hits if out is None else out.unionByName(hits)
    if out is None:
        empty = StructType([*docs.select(F.col(key).alias("key")).schema.fields, *wanted.select("item").schema.fields]).add("rank", IntegerType()).add("score", LongType())
        out = spark.createDataFrame([], empty)
    return out.select(F.col("item").alias(item), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score")


#: The search in DuckDB; lists of terms of every document, so for small tables.
SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
    FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""
