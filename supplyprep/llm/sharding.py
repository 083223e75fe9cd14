"""Training shards by a two-pass external shuffle.

Pass one scatters the rows into buckets of about ``bucket_bytes`` by a seeded hash of the key and
the text, so neither a hot key nor a hot source fills a bucket. Rows that are equal in both would:
where the counts show a bucket far above the mean, the rows are written with a number of their own
and those of such buckets are scattered again by key, text and number. Pass two takes each bucket, puts
its rows in a fixed order, applies a Fisher-Yates shuffle seeded by the bucket, and writes them.
Buckets one after the other are one random order of all rows; shard s holds the places from
s * n / shards to (s + 1) * n / shards of it. So the counts of two shards differ by one at most
(the law ``rows``).

The bucket sizes are counted before the texts move; the texts are shuffled once. A task that is
run again deals its rows in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from supplyprep.llm.common import map_arrow, new_path, staged, text_bytes, text_or_empty

LAW = "rows"
#: A bucket with more rows than so many times the mean, and so many more, is scattered again.
FULL, SLACK = 1.5, 50


def _scatter_key(key: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key), F.col(text))


def scattered(source: DataFrame, n_buckets: int, seed: int, key: str, text: str) -> tuple[DataFrame, dict[int, int]]:
    """``source`` with its scatter hash ``__h`` and ``__bucket``, and the rows of each bucket.

    One number per bucket goes to the driver: 100 TB in buckets of 256 MB make 3 MB of counts.
    """
    bucket = F.pmod("__h", F.lit(n_buckets)).cast("int")
    scatter = source.withColumn("__h", _scatter_key(key, text, seed)).withColumn("__bucket", bucket)
    counts = dict(scatter.groupBy("__bucket").count().collect())
    mean = sum(counts.values()) / n_buckets
    full = [b for b, n in counts.items() if n > FULL * mean + SLACK]
    if not full:
        return scatter, counts
    # The number must be the same whenever it is read, so it is written.
    numbered = staged(scatter.withColumn("__copy", F.monotonically_increasing_id()), "numbered")
    again = F.xxhash64(F.lit(seed), "__h", "__copy")
    scatter = numbered.withColumn("__h", F.when(F.col("__bucket").isin(full), again).otherwise(F.col("__h")))
    scatter = scatter.drop("__copy").withColumn("__bucket", bucket)
    return scatter, dict(scatter.groupBy("__bucket").count().collect())


def write_shards(docs: DataFrame, n_shards: int = 16, seed: int = 17, key: str = "doc_id", text: str = "text", bucket_bytes: int = 16 << 20, path: str | None = None) -> str:
    """Write all rows of ``docs`` with ``shard`` and ``slot``; returns the table's path.

    Null keys and texts are rows like others. Rows equal in key and text may hold any share of the
    table; which of them comes first does not matter. No rows: an empty table. Columns of
    ``docs`` named shard or slot are replaced.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "shards")
    source = docs.drop("shard", "slot")
    total = source.agg(F.sum(F.octet_length(text_bytes(source[text])) + 64).alias("n")).first()["n"] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    scatter, counts = scattered(source, n_buckets, seed, key, text)
    firsts = np.concatenate([[0], np.cumsum([counts.get(b, 0) for b in range(n_buckets)])])
    bounds = np.array([s * int(firsts[-1]) // n_shards for s in range(n_shards + 1)])
    shared = spark.sparkContext.broadcast((firsts, bounds))
    schema = StructType([*source.schema.fields, *StructType().add("shard", IntegerType()).add("slot", LongType()).fields])
    names = [f.name for f in schema.fields]

    def shuffled(parts: list[pa.RecordBatch], bucket: int) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        firsts, bounds = shared.value
        order = np.arange(table.num_rows)
        np.random.default_rng([seed, bucket]).shuffle(order)  # Fisher-Yates
        place = firsts[bucket] + np.arange(table.num_rows)
        shard = np.searchsorted(bounds, place, side="right") - 1
        for start in range(0, len(order), 2048):
            part = slice(start, start + 2048)
            rows = table.take(pa.array(order[part])).combine_chunks()
            columns = [rows.column(i).combine_chunks() for i in range(len(names) - 2)]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(shard[part], pa.int32()), pa.array(place[part] - bounds[shard[part]])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        bucket = None
        for batch in batches:
            cells = batch.column(batch.num_columns - 1).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1, [len(cells)]])
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if start == stop:
                    continue
                if held and cells[start] != bucket:
                    yield from shuffled(held, bucket)
                    held = []
                bucket = int(cells[start])
                held.append(batch.slice(start, stop - start).select(list(range(batch.num_columns - 1))))
        if held:
            yield from shuffled(held, bucket)

    # A task takes its buckets one after the other, so memory goes by the bucket and tasks by the cluster.
    dealt = scatter.repartition("__bucket").sortWithinPartitions("__bucket", "__h", key, text)
    map_arrow(dealt.drop("__h"), run, schema).write.parquet(path)
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def shard_digest(shards: DataFrame, text: str = "text") -> DataFrame:
    """Per document: its size, the CRC-32 of its text, the law, and where it lies."""
    return shards.select(
        "doc_id",
        (F.octet_length(text_bytes(text)) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty(text)).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
