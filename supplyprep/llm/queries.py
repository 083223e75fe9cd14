"""The queries of this package, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyprep.llm import byte_bpe, cover_tree, decontaminate, lexical_search, packing, pii, quality, re_pair, secret_scan, sharding, simhash, suffix_dedup, turn_alignment
from supplyprep.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(read_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"), 0.95)


ORACLE_SQL["op2_cover_tree"] = cover_tree.SQL


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), 400).drop("kept")


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", "held_out", "score", "predicted")


#: A key for the test tables; a real one comes from a secret store.
DEMO_KEY = b"test tables"


@query
def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read_table(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)


@query
def op6_re_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = re_pair.write_token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return re_pair.token_rows(spark, path)


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op7_decontaminate"] = decontaminate.SQL


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sharding.write_shards(read_table(spark, sf_dir, "documents"))
    return sharding.shard_digest(sharding.read_shards(spark, path))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    return secret_scan.scan_digest(found.drop("text"))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.code_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", *byte_bpe.digests(coded))


@query
def op11_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_alignment.damaged(read_table(spark, sf_dir, "conversations"))
    return turn_alignment.digests(turn_alignment.repair(turns, times="times"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


ORACLE_SQL["op12_lexical_search"] = lexical_search.SQL


@query
def op13_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
