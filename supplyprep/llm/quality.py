"""Quality scores by Bradley-Terry pairwise ranking.

A text is described by counts of its characters, words and lines. From labelled rows the model
draws preference pairs, a good text over a bad one, and fits weights so that the difference of
their features predicts the preference (logistic loss). The cut between good and bad is a quantile
of the scores of all labelled rows: the share of rows labelled bad. Scores are spread over 0 to 1
so that the cut lies at ``CUT``.

Weights are fitted to at most ``most`` labelled rows, those whose keys have the smallest hashes;
their features and counts of scores are all that reaches the driver. Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructType

from supplyprep.llm.common import bounded_slices, buffer_of, least_by_hash, map_arrow, materialize, offsets_of, staged, text_bytes

CUT = 0.3
FOLDS = 5

_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "high": range(128, 256),
    "stop": b".,;:?'\"()-",
    "symbol": b"!#$%&*+/<=>@[\\]^_`{|}~",
    "blank": b" \t\r\x0b\x0c",
    "line": b"\n",
}
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _i, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes), _i] = 1.0


def describe(text: bytes) -> list[float]:
    """Features of a text, all finite; those of an empty text are zeros and ones."""
    n = max(1, len(text))
    shares = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ _CLASS_OF / n if text else np.zeros(len(_CLASSES))
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.ones(1)
    letters = max(1e-9, shares[0] + shares[1])
    return [
        *shares.tolist(),
        shares[0] / letters,
        float(sizes.mean()),
        float(sizes.std()),
        float(np.log(sizes.max())),
        len(set(words)) / n_words**0.8,
        sum(map(eq, words, words[1:])) / n_words,
        len(set(lines)) / n_lines,
        n_words / n_lines / (20 + n_words / n_lines),
    ]


N_FEATURES = len(describe(b"a b"))


@dataclass
class Ranking:
    """Weights over standardised features and their squares; ``cut`` is the raw score of the quantile."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def _design(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.spread, -6, 6)
        return np.concatenate([z, np.minimum(z * z, 9)], axis=1)

    def raw(self, features: np.ndarray) -> np.ndarray:
        return self._design(features) @ self.weights

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Between 0 and 1; ``CUT`` at the cut."""
        x = self.slope * (self.raw(features) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def rank(features: np.ndarray, good: np.ndarray, pairs: int = 60_000, penalty: float = 1e-3, seed: int = 3) -> Ranking:
    """Fit the ranking to labelled features by Newton steps on sampled preference pairs.

    With labels of one kind only there is nothing to prefer: all rows score alike, at the cut if
    they are good and below it if they are bad.
    """
    mean, spread = (features.mean(axis=0), np.maximum(features.std(axis=0), 1e-6)) if len(features) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    model = Ranking(mean, spread, np.zeros(2 * N_FEATURES), 0.0, 1.0)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        model.cut = 0.0 if len(better) or not len(worse) else 1.0
        return model
    rng = np.random.default_rng(seed)
    x = model._design(features)
    difference = x[rng.choice(better, pairs)] - x[rng.choice(worse, pairs)]
    for _ in range(15):
        p = 1 / (1 + np.exp(np.clip(difference @ model.weights, -30, 30)))  # chance of the wrong order
        gradient = -difference.T @ p / pairs + penalty * model.weights
        curvature = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(curvature, gradient)
        model.weights = model.weights - step
        if np.abs(step).max() < 1e-4:
            break
    raw = x @ model.weights
    model.cut = float(np.quantile(raw, len(worse) / len(raw), method="midpoint"))
    model.slope = 4.0 / max(1e-9, float(np.median(raw[better]) - np.median(raw[worse])))
    return model


# --- tables -------------------------------------------------------------------------------


def held_out(key: str | Column = "doc_id") -> Column:
    """Rows that labels are not learned from: the CRC-32 of the key as text leaves no remainder by ``FOLDS``."""
    return F.coalesce(F.crc32((F.col(key) if isinstance(key, str) else key).cast("string")) % FOLDS == 0, F.lit(False))


def _features(source: DataFrame, column: str, schema: StructType) -> DataFrame:
    place = source.columns.index(column)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, column):
            rest = [c for i, c in enumerate(batch.columns) if i != place]
            flat = pa.array(np.array(_described(batch.column(place))).ravel())
            yield pa.RecordBatch.from_arrays([*rest, pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, N_FEATURES, dtype=np.int32)), flat)], names=names)

    return map_arrow(source, run, schema)


def _described(values: pa.Array) -> list[list[float]]:
    data, at = buffer_of(values), offsets_of(values)
    return [describe(bytes(data[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]


def at_rank(values: DataFrame, column: str, rank: int, cells: int = 1000) -> tuple[float, float]:
    """The values at ``rank`` (from 0) and at the next rank in ascending order, by counts of ever narrower cells."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    below, inside = 0, values
    while low < high:
        cell = F.floor((F.col(column) - low) / (high - low) * cells)
        found = inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy("cell").collect()
        for row in found:  # at most cells + 1 rows
            if below + row["n"] > rank:
                break
            below += row["n"]
        low, high = row["low"], row["high"]
        inside = values.where(F.col(column).between(low, high))
    up_to, after = values.agg(F.count(F.when(F.col(column) <= low, 1)), F.min(F.when(F.col(column) > low, F.col(column)))).first()
    return low, low if up_to > rank + 1 or after is None else after


def _raw_scores(labelled: DataFrame, model: Ranking) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(features))], names=["raw"])

    return map_arrow(labelled.select("features"), run, "raw double")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", most: int = 20_000) -> Ranking:
    """A ranking learned from at most ``most`` labelled rows outside the held-out fold, cut by all of them.

    A key with several labels takes their mean, good from one half up; null keys and labels do not
    count. Documents with equal keys are labelled rows each.
    """
    source = docs.where(~held_out(docs[key]) & docs[key].isNotNull()).select(F.col(key), text_bytes(docs[text]).alias("__bytes"))
    schema = StructType([*source.schema.fields[:1]]).add("features", ArrayType(DoubleType(), False))
    described = _features(source, "__bytes", schema)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg((F.avg(label) >= 0.5).alias("good"))
    labelled, n = materialize(described.join(known, key), "labelled")
    rows = least_by_hash(labelled, F.xxhash64(key, "features"), n, most)
    features = np.array([r["features"] for r in rows]).reshape(-1, N_FEATURES)
    model = rank(features, np.array([r["good"] for r in rows], dtype=bool))
    bad = labelled.where("not good").count()
    if len(rows) < n and model.weights.any() and 0 < bad < n:
        model.cut = sum(at_rank(staged(_raw_scores(labelled, model), "raw-scores"), "raw", bad - 1)) / 2
    return model


def score(docs: DataFrame, model: Ranking, text: str = "text", key: str = "doc_id", scored: str = "score", predicted: str = "predicted", held: str = "held_out") -> DataFrame:
    """All columns of ``docs`` plus ``held``, ``scored`` and ``predicted``.

    Null texts are empty ones and have a score as well; every row stays. A null key is not held
    out. Columns of ``docs`` with the names of new ones are replaced.
    """
    added = [held, scored, predicted]
    source = docs.drop(*added)
    work = source.withColumn("__held", held_out(source[key])).withColumn("__bytes", text_bytes(source[text]))
    schema = StructType(source.schema.fields[:]).add(held, BooleanType(), False).add(scored, DoubleType(), False).add(predicted, IntegerType(), False)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "__bytes"):
            scores = model.scores(np.array(_described(batch.column(batch.num_columns - 1))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores), pa.array((scores >= CUT).astype(np.int32))], names=names)

    return map_arrow(work, run, schema)
