"""Connected components of a graph given as a table of links.

Large-star and small-star steps by turns: each node hands its larger neighbours (then all of them)
to the smallest node it knows, until every component is a star around its smallest node. A step is
an aggregate of minima, combined before it is shuffled, and a join back. Minima and links are
written to the shared folder: lineage stays short, a lost executor costs one step, and the join
reads tables on both sides, so that the links of a node with very many can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from supplyprep.llm.common import new_path, staged


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest node reachable.

    Links are undirected pairs of longs. Links of a node with itself and links with a null end do
    not count; repeated links count once.
    """
    edges, seen = _stored(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))))
    while True:
        edges, now = _stored(_small_star(_large_star(edges)))
        if now == seen:
            break
        seen = now
    roots = edges.select("lo").distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots.select(F.col("lo").alias("node"), F.col("lo").alias("component")))


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct links, written; and what tells whether two rounds are equal."""
    spark = edges.sparkSession
    path, seen = new_path(spark, "links"), Observation()
    mark = F.xxhash64("hi", "lo")
    edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 20)).alias("s")).write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path), tuple(seen.get.values())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = staged(least, "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = staged(edges.groupBy("hi").agg(F.min("lo").alias("m")), "least")
    moved = edges.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo")))
