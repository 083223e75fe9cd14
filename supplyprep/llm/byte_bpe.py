"""Byte-level BPE encoding and decoding over Arrow batches.

The vocabulary file is read once by the driver and broadcast; its size is that of the file, about
1 MB, whatever the corpus. Each task encodes whole texts in slices of bounded bytes. There is no
shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from supplyprep.llm.common import bounded_slices, map_arrow, text_or_empty
from supplyprep.llm.tokens import GPT2_PATTERN, ByteLevelBpe


@lru_cache(maxsize=2)
def bpe_of(content: bytes, pattern: str = GPT2_PATTERN) -> ByteLevelBpe:
    """One coder per worker and vocabulary."""
    return ByteLevelBpe(content, pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str = GPT2_PATTERN, text: str = "text", ids: str = "token_ids", offsets: str | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``ids``, the token ids of ``text``.

    ``vocabulary`` is the path of a rank or tokenizer file that the driver can read. With
    ``offsets`` a column of that name tells in which code point of the text each token starts.
    A null or empty text has no ids. Rows are kept as they are, repeated ones and null keys
    included. A column of ``docs`` with the name of a new one is replaced.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    added = [ids] + ([offsets] if offsets else [])
    source = docs.drop(*added)
    work = source.withColumn("__coded_text", text_or_empty(source[text]))
    schema = StructType([*source.schema.fields, *StructType().add(ids, ArrayType(IntegerType(), False)).fields])
    if offsets:
        schema = schema.add(offsets, ArrayType(IntegerType(), False))

    names = [*source.columns, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe_of(content.value, pattern)
        for batch in bounded_slices(batches, "__coded_text"):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            coded = [coder.encode(t) for t in texts]
            starts = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            values = np.frombuffer(b"".join(coded), dtype="<i4")
            columns = [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(starts), pa.array(values))]
            if offsets:
                places = [coder.offsets(t, np.frombuffer(c, dtype="<u4")) for t, c in zip(texts, coded, strict=True)]
                columns.append(pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(places).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(work, run, schema)


def decode(coded: DataFrame, vocabulary: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """All columns of ``coded`` plus the bytes that its ids stand for; null ids give empty bytes.

    Any run of ids can be decoded. Bytes at its ends may belong to characters that are split over
    tokens outside it; :func:`as_text` shows those as replacement characters.
    """
    content = coded.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    source = coded.drop(decoded)
    schema = StructType([*source.schema.fields, *StructType().add(decoded, BinaryType()).fields])
    place, names = source.columns.index(ids), [*source.columns, decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe_of(content.value).token_bytes.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                column = part.column(place)
                found = [b"".join(map(table, column[i].values.to_pylist())) if column[i].is_valid else b"" for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=names)

    return map_arrow(source, run, schema)


def as_text(decoded: bytes) -> str:
    """Text of decoded bytes; cut characters at the ends become U+FFFD."""
    return decoded.decode("utf-8", errors="replace")


def code_round_trip(docs: DataFrame, vocabulary: str, pattern: str = GPT2_PATTERN, text: str = "text", ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """All columns of ``docs`` with ``token_ids`` and the bytes ``decoded`` from those very ids.

    What :func:`encode` and then :func:`decode` give, in one pass of one worker, so that texts are
    not sent through a second one.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    source = docs.drop(ids, decoded)
    work = source.withColumn("__coded_text", text_or_empty(source[text]))
    schema = StructType([*source.schema.fields, *StructType().add(ids, ArrayType(IntegerType(), False)).add(decoded, BinaryType()).fields])
    names = [*source.columns, ids, decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe_of(content.value, pattern)
        for batch in bounded_slices(batches, "__coded_text"):
            coded = [np.frombuffer(coder.encode(t), dtype="<i4") for t in batch.column(batch.num_columns - 1).to_pylist()]
            starts = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(coded)))
            found = pa.array([coder.decode(c) for c in coded], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, found], names=names)

    return map_arrow(work, run, schema)


def digests(coded: DataFrame, ids: str = "token_ids", decoded: str = "decoded") -> list:
    """Columns that stand for coded rows in comparisons: count of ids and digests of ids and bytes."""
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    ]
