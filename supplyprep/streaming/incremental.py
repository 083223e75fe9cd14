"""Structured Streaming forms of the two incremental steps.

Rows whose partners come by another stream are matched first (``stream_matched``), in either order of
arrival; those that wait are tables as well. All take files as they arrive, process what is there (``availableNow``) and keep the result in a
table that is cut into buckets by key: a batch reads and rewrites only the buckets of the keys it
brings. The stream checkpoint takes the place of a stored last run time. A batch that is repeated
after a failure gives the same table, since a newer row of a key always wins, also over a row that
arrives later.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from supplyprep.context import RunContext
from supplyprep.operators.groups import keep_latest
from supplyprep.operators.rows import upsert
from supplyprep.sources.storage import new_path, remove_folder
from supplyprep.sources.manifest import expire, live_parts
from supplyprep.sources.writers import read_buckets, with_bucket, write_buckets

#: Parts of a target table; as many as keep one part to some hundred megabytes.
BUCKETS = 64
#: Versions of a target table that stay; what only older ones name is removed after each batch.
KEPT_VERSIONS = 10


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **options: str
) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).format(format).load(path)


def _run(
    stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _merge(
    spark: SparkSession,
    rows: DataFrame,
    target: str,
    keys: Sequence[str],
    buckets: int,
    ctx: RunContext,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Merge a batch into the buckets that its keys fall into.

    The batch is written first and read by ``spark``, the user's session: that of a batch has no
    adaptive execution, so it would write a file of each bucket in every shuffle partition.
    """
    shaped, path = with_bucket(rows, keys, buckets), new_path(spark, "arrived")
    shaped.write.parquet(path)
    new = spark.read.schema(shaped.schema).parquet(path)
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
    if touched:
        version, _ = live_parts(spark, target)
        old = read_buckets(spark, target, rows.schema, touched, version)
        write_buckets(with_bucket(merge(old, new.drop("bucket")), keys, buckets), target, ctx, version)
        expire(spark, target, KEPT_VERSIONS)


def _reached(clock: dict[str, int | None], delay: str) -> Column | None:
    """The moment up to which both streams are complete; none before both have brought a time."""
    if None in clock.values():
        return None
    return F.timestamp_micros(F.lit(min(clock.values()))) - F.expr(f"INTERVAL {delay}")


def stream_matched(
    rows: DataFrame,
    partners: DataFrame,
    on: Sequence[tuple[str, str]],
    time: str,
    partner_time: str,
    before: str,
    after: str = "0 seconds",
    delay: str = "1 day",
    *,
    state: str,
) -> DataFrame:
    """A stream of ``rows`` with the columns of their partner from another stream, whichever arrives first.

    Partners have equal keys (``on``: pairs of columns, none null) and a time from ``before`` before the row's own to
    ``after`` after it. A row waits for its partners. It is given out once
    for each partner, or without one as soon as both streams are ``delay`` past the last moment at
    which a partner might still come; what is later than that is late and dropped. So what waits
    is bounded by the rows of that span, whatever the length of the streams. A row or partner
    without a time never matches: give it one, or leave it out, before.

    What is there is matched before the function returns, as one batch; the stream that it returns reads the
    files of matched rows. ``state`` is a folder of this match alone: its checkpoint, the matched rows, and for
    each batch what waits after it. A batch reads all that waits and writes what goes on waiting, so batches should
    not be small against it. A partner waits until every row that it may match is due; so a row that is due
    has met a partner exactly if it finds one. A repeated batch reads the folder before its own and replaces its own.
    """
    spark = rows.sparkSession
    sides = {"row": rows, "partner": partners}
    shape = T.StructType([T.StructField(side, df.schema) for side, df in sides.items()]).add("side", "string")
    # Arrived rows of both streams as one stream: each has one of two structs.
    both = [
        df.select(*[(F.struct(*df.columns) if s == side else F.lit(None).cast(shape[s].dataType)).alias(s) for s in sides], F.lit(side).alias("side"))
        for side, df in sides.items()
    ]
    times = {"row": F.col(f"row.{time}"), "partner": F.col(f"partner.{partner_time}")}
    past, ahead = F.expr(f"INTERVAL {before}"), F.expr(f"INTERVAL {after}")
    last = F.coalesce(times["row"] + ahead, times["partner"] + past + ahead)
    met = times["partner"].between(times["row"] - past, times["row"] + ahead)
    for own, theirs in on:
        met = met & (F.col(f"row.{own}") == F.col(f"partner.{theirs}"))
    added = [c for c in partners.columns if c not in rows.columns]

    def batch(arrived: DataFrame, number: int) -> None:
        own, before_it = (f"{state}/batch-{n}" for n in (number, number - 1))
        clock = spark.read.json(f"{before_it}/clock", "row long, partner long").first().asDict() if number else dict.fromkeys(sides)
        reached, seen = _reached(clock, delay), Observation()
        timely = F.coalesce(*times.values())
        timely = timely.isNotNull() if reached is None else timely > reached
        latest = [F.max(F.unix_micros(c.cast("timestamp"))).alias(side) for side, c in times.items()]
        arrived.observe(seen, *latest).filter(timely).write.mode("overwrite").partitionBy("side").parquet(f"{own}/new")
        clock = {side: max((t for t in (clock[side], seen.get[side]) if t is not None), default=None) for side in sides}
        new = spark.read.schema(shape).parquet(f"{own}/new")
        old = new.limit(0)
        if number:
            old = spark.read.schema(shape).parquet(f"{before_it}/new").union(spark.read.schema(shape).parquet(f"{before_it}/kept"))
            old = old if reached is None else old.filter(last > reached)
        reached = _reached(clock, delay)
        due = F.lit(False) if reached is None else last <= reached
        old.filter(~due).write.mode("overwrite").partitionBy("side").parquet(f"{own}/kept")
        waiting = new.withColumn("fresh", F.lit(True)).union(old.withColumn("fresh", F.lit(False)))
        left, right = (
            waiting.filter(F.col("side") == side).select(side, F.col("fresh").alias(f"{side}_fresh"), *more)
            for side, more in (("row", [F.when(F.col("row").isNotNull(), due).alias("due")]), ("partner", []))
        )
        joined = left.join(right, met, "left")
        given = F.when(F.col("partner_fresh").isNull(), F.col("due")).otherwise(F.col("row_fresh") | F.col("partner_fresh"))
        matched = joined.filter(given).select("row.*", *[F.col(f"partner.{c}").alias(c) for c in added])
        matched.write.mode("overwrite").parquet(f"{state}/matched/{number}")
        spark.createDataFrame([(clock["row"], clock["partner"])], "row long, partner long").write.mode("overwrite").json(f"{own}/clock")
        remove_folder(spark, f"{state}/batch-{number - 2}")

    _run(both[0].union(both[1]), f"{state}/checkpoint", batch).awaitTermination()
    schema = T.StructType([*rows.schema.fields, *[partners.schema[c] for c in added]])
    return file_stream(spark, f"{state}/matched/*", schema)


def stream_upsert(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    update: Sequence[str],
    ctx: RunContext,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Upsert arriving rows into a table; a row that is not newer than the stored one is left out.

    ``order`` are columns of the table, the larger the newer. ``prepare`` turns the raw rows into
    target rows (for instance joins with static tables).
    """

    def merge(old: DataFrame, newest: DataFrame) -> DataFrame:
        stored = old.select(
            *[F.col(k).alias(f"__s_{k}") for k in keys], F.struct(*order).alias("__stored")
        )
        same = [F.col(k) == F.col(f"__s_{k}") for k in keys]
        newer = newest.join(stored, same, "left").filter(
            F.col("__stored").isNull() | (F.struct(*order) > F.col("__stored"))
        )
        return upsert(old, newer.select(*newest.columns), list(keys), list(update))

    def batch(rows: DataFrame, _: int) -> None:
        shaped = rows if prepare is None else prepare(rows)
        _merge(stream.sparkSession, keep_latest(shaped, list(keys), list(order)), target, keys, buckets, ctx, merge)

    return _run(stream, checkpoint, batch)


def stream_latest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    ctx: RunContext,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the newest row per key over everything that has arrived."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return keep_latest(old.unionByName(new), list(keys), list(order))

    def batch(rows: DataFrame, _: int) -> None:
        _merge(stream.sparkSession, keep_latest(rows, list(keys), list(order)), target, keys, buckets, ctx, merge)

    return _run(stream, checkpoint, batch)
