"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from supplyprep.sources.storage import materialize, new_path, staged

__all__ = ["bounded_slices", "least_by_hash", "map_arrow", "materialize", "new_path", "read_table", "row_identity", "small_side", "staged", "text_bytes", "text_or_empty"]

#: Bytes of rows that are sent to a Python worker at a time; Spark's own limit counts rows only.
ARROW_BYTES = 4 << 20
#: Bytes of text that a task holds as Python objects at a time.
SLICE_BYTES = 2 << 20


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the workers once per application.

    Batches are bounded by bytes, as texts may be long; the setting stays in the session. The
    package travels like a file given to ``--py-files``: the driver alone reads the archive and
    serves it.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return df.mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column = "text") -> Column:
    """A missing text counts as an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def row_identity(key: str, text: str) -> Column:
    """128 bits that stand for a row's key and text; null and empty texts are the same."""
    return F.struct(F.xxhash64(F.col(key), text_or_empty(text)).alias("low"), F.xxhash64(text_or_empty(text), F.lit(1), F.col(key)).alias("high"))


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text."""
    return text_or_empty(text).cast("binary")


#: Rows of one or two longs up to which a side is broadcast, some 10 MB; larger ones are shuffled.
BROADCAST_ROWS = 250_000


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def least_by_hash(df: DataFrame, mark: Column, n: int, most: int) -> list[Row]:
    """About the ``most`` rows of ``df`` with the smallest hash ``mark``, never more; ``n`` is the number of its rows.

    Rows are cut by the hash before they are ordered, so the driver gets some ``most`` rows from
    all tasks together, not from each.
    """
    share = min(1.0, (1.1 * most + 100) / max(1, n))
    low = F.pmod(mark, F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    return df.where(low).orderBy(F.pmod(mark, F.lit(1 << 40))).limit(most).collect()


def bounded_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds at most ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(np.diff(offsets_of(values)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def offsets_of(values: pa.Array) -> np.ndarray:
    """Positions in the data buffer of a string or binary array, one more than rows."""
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    kind = np.int64 if wide else np.int32
    if len(values) == 0:
        return np.zeros(1, dtype=np.int64)
    return np.frombuffer(values.buffers()[1], dtype=kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)


def buffer_of(values: pa.Array) -> memoryview:
    """The data buffer that the positions of :func:`offsets_of` point into."""
    data = values.buffers()[2]
    return memoryview(data) if data is not None else memoryview(b"")
