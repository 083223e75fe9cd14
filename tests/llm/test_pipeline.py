from __future__ import annotations

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from supplyprep.llm import queries
from supplyprep.llm.common import staged
from supplyprep.llm.tokens import ByteLevelBpe


def test_stages_take_effect(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, data), name)
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4]
    kept = docs.collect()
    texts = {r["doc_id"]: r["text"] for r in kept}
    assert all(r["n_chars"] == len(r["text"]) for r in kept)
    assert not any('token = "' in t for t in texts.values())
    coder = ByteLevelBpe(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    rows = corpus_pipeline.run(spark, data).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and all(r["exact"] for r in rows)
    for row in rows:
        assert coder.decode(np.array(row["token_ids"])) == texts[row["doc_id"]].encode()


def test_stages_take_odd_rows_and_empty_tables(spark, data, edge, none):
    odd = edge.withColumn("n_chars", F.length("text").cast("long")).withColumn("source", F.lit("own source"))
    for docs in (odd, none.select("*", *[F.lit("x").alias(c) for c in odd.columns if c not in ("doc_id", "text", "n_chars")], F.lit(1).cast("long").alias("n_chars"))):
        columns, given = docs.columns, {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()}
        for name, stage in corpus_pipeline.STAGES[1:-1]:
            docs = staged(stage(spark, docs, data), name)
            assert docs.columns == columns, name
            assert {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()} <= given, name
        last = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
        assert len(last) == docs.count() and all(r["exact"] for r in last)
        assert all(r["n_tokens"] == 0 for r in last if r["doc_id"] == 2)
    good = staged(corpus_pipeline.keep_good(spark, odd, data), "good")
    assert good.columns == odd.columns and good.exceptAll(odd).count() == 0
    assert corpus_pipeline.keep_good(spark, none, data).count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))


def test_sql_counterparts(spark, data):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    for name, sql in queries.oracle_sql().items():
        mine = queries.queries()[name](spark, data).toPandas()
        theirs = connection.execute(sql).df()[list(mine.columns)]
        assert len(mine) > 0
        assert sorted(mine.itertuples(index=False, name=None)) == sorted(theirs.itertuples(index=False, name=None))
