"""Benchmark decontamination: test items whose word shingles lie inside documents.

Test items are short and documents long, so what counts is containment: the share of an item's
distinct shingles that the document has. Items are partitioned by size; within a partition of
items of at most u shingles, an item that is contained to a share t or more misses at most
(1 - t) u of them. So the MinHash sketch of an item is the floor((1 - t) u) + 1 smallest hashes of
its shingles: a document that contains the item has at least one of them, and none is lost.

Documents are read once. Of their shingles only those that any item has go on, which is a small
table whatever the corpus. On it the sketches find candidate pairs, and all shingles of the item
verify them exactly. Shingles are identified by 64-bit hashes of their words; a false pair would
need four fifths of an item's shingles to collide. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.llm.common import materialize, row_identity, small_side, staged, text_or_empty

WORDS = 5
SHARE = 0.8


def words(text: str | Column) -> Column:
    """Words of a text: its runs of letters and digits, lower-cased."""
    return F.array_remove(F.split(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+"), "")


def _shingles(hashes: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` word hashes, repeats included; none if there are fewer."""
    run = lambda i: F.xxhash64(F.lit(width), *[F.get(hashes, i + k) for k in range(width)])
    return F.when(F.size(hashes) >= width, F.transform(F.sequence(F.lit(0), F.size(hashes) - width), run)).otherwise(F.array().cast("array<long>"))


def item_shingles(items: DataFrame, key: str = "item_id", text: str = "text", share: float = SHARE, width: int = WORDS) -> DataFrame:
    """(item, key, width, n, gram, sketched): the distinct shingles of each item, and whether its sketch has them.

    An item of fewer words than ``width`` is one shingle of its whole length. Items without words
    have none. Rows with equal key and text are one item.
    """
    rows = items.select(F.col(key), F.xxhash64(F.col(key), text_or_empty(text)).alias("item"), F.transform(words(text), lambda w: F.xxhash64(w)).alias("h")).where(F.size("h") > 0)
    rows = rows.dropDuplicates(["item"]).withColumn("width", F.least(F.size("h"), F.lit(width)))
    by_width = F.coalesce(*[F.when(F.col("width") == w, _shingles(F.col("h"), w)) for w in range(1, width + 1)])
    rows = rows.withColumn("grams", F.array_sort(F.array_distinct(by_width))).withColumn("n", F.size("grams"))
    most = F.pow(F.lit(2), F.floor(F.log2(F.col("n"))) + 1) - 1  # the largest size of the item's partition
    rows = rows.withColumn("sketch", F.floor(F.round(most * (1 - share), 6)) + 1)
    return rows.select("item", key, "width", "n", "sketch", F.posexplode("grams").alias("place", "gram")).select("item", key, "width", "n", "gram", (F.col("place") < F.col("sketch")).alias("sketched"))


def _pairs(docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str, share: float, width: int) -> DataFrame:
    """(doc, key, item, item_key, n, n_shared) of every document and item that it contains to ``share`` or more."""
    grams, n_grams = materialize(item_shingles(items, item_key, item_text, share, width), "item-shingles")
    widths = sorted(r["width"] for r in grams.select("width").distinct().collect())  # at most `width` numbers
    if not widths:
        widths = [width]
    wanted = grams.select("gram").distinct()
    rows = docs.select(F.col(key), row_identity(key, text).alias("doc"), F.transform(words(text), lambda w: F.xxhash64(w)).alias("h"))
    rows = rows.select(key, "doc", F.explode(F.concat(*[_shingles(F.col("h"), w) for w in widths])).alias("gram"))
    found = staged(rows.join(small_side(wanted, n_grams), "gram").distinct(), "shared-shingles")
    candidates = found.join(small_side(grams.where("sketched"), n_grams), "gram").select("doc", key, "item", item_key, "n").distinct()
    tried = candidates.join(small_side(grams.select("item", "gram"), n_grams), "item")
    shared = tried.join(found.select("doc", "gram"), ["doc", "gram"]).groupBy("doc", key, "item", item_key, "n").agg(F.count(F.lit(1)).alias("n_shared"))
    return shared.where(F.col("n_shared") >= F.ceil(F.round(F.lit(share) * F.col("n"), 6)))


def contained_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", share: float = SHARE, width: int = WORDS) -> DataFrame:
    """One row per document and item that it contains to ``share`` or more.

    Columns: the two keys, n_shingles of the item, n_shared of them in the document, containment.
    Null and empty texts, of either side, are in no row. A null key is a key like others. Rows of
    documents with equal key and text count once; rows with equal keys but other texts are
    documents of their own, and the best of them is given. Other columns are not read. The two
    keys must have different names.
    """
    kept = _pairs(docs, items, key, text, item_key, item_text, share, width)
    best = kept.groupBy(key, item_key).agg(F.max(F.struct(F.col("n_shared") / F.col("n"), F.col("n_shared"), F.col("n"))).alias("b"))
    return best.select(key, item_key, F.col("b.n").cast("long").alias("n_shingles"), F.col("b.n_shared").alias("n_shared"), (F.col("b.n_shared") / F.col("b.n")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text contains no item, with all columns.

    Rows go by key and text: others with the same key, or without one, stay if their texts are clean.
    """
    pairs = _pairs(docs, items, key, text, item_key, item_text, SHARE, WORDS)
    hit, n = materialize(pairs.select(F.col("doc").alias("__hit")).distinct(), "contaminated")
    return docs.withColumn("__doc", row_identity(key, text)).join(small_side(hit, n), F.col("__doc") == F.col("__hit"), "left_anti").drop("__doc")


SQL = r"""
WITH item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws
  FROM benchmark),
item_lists AS (
  SELECT item_id, least(len(ws), 5) AS width,
         list_distinct(list_transform(generate_series(1, len(ws) - least(len(ws), 5) + 1),
                                      lambda i: array_to_string(ws[i : i + least(len(ws), 5) - 1], ' '))) AS grams
  FROM item_words WHERE len(ws) > 0),
item_grams AS (SELECT item_id, width, len(grams) AS n, unnest(grams) AS gram FROM item_lists),
doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws
  FROM documents),
doc_grams AS (
  SELECT DISTINCT doc_id, width, gram FROM (
    SELECT doc_id, width, unnest(list_transform(generate_series(1, len(ws) - width + 1),
                                                lambda i: array_to_string(ws[i : i + width - 1], ' '))) AS gram
    FROM doc_words, (SELECT DISTINCT width FROM item_lists) WHERE len(ws) >= width))
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_shared, count(*) / n AS containment
FROM doc_grams JOIN item_grams USING (width, gram)
GROUP BY doc_id, item_id, n HAVING count(*) >= ceil(round(0.8 * n, 6))
"""
