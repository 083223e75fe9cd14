"""The corpus pipeline: documents through quality, near copies, benchmark leaks, secrets and token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Between two stages the rows are written and read again. In every stage a
null text counts as an empty one and stays null, a null or repeated doc_id is a key like others, no
rows give no rows, and further columns, whatever their names, are passed on by all but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyprep.llm import byte_bpe, decontaminate, quality, secret_scan, simhash
from supplyprep.llm.common import read_table, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut; the ranking is learned from the labels of these documents.

    Equal texts have equal scores, so they stay or go together. Without labels of both kinds all
    documents have the same score.
    """
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, scored="__score", predicted="__good", held="__held")
    return scored.where(F.col("__good") == 1).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose fingerprints are linked by 4 bits or fewer.

    Null, empty and blank texts are one group. Of rows equal in doc_id and text one stays.
    """
    return simhash.keep_one_per_component(docs, shingle=4, distance=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Items without words are in no document; rows go by doc_id and text."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by their kind; n_chars follows the text."""
    scanned = secret_scan.scan(docs, secret_scan.train(docs), spans="__spans", redacted="text")
    n_chars = F.when(F.size("__spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return scanned.withColumn("n_chars", n_chars).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its very bytes. A null or empty text has no ids."""
    coded = byte_bpe.code_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", exact.alias("exact"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_copies", keep_one_of_near_copies),
    ("benchmark", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("token_ids", encode),
]

#: Learned models decide, so SQL cannot express the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
