"""Open purchase orders: ordered minus received, merged onto an initial list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyprep.context import RunContext
from supplyprep.operators.joins import exists_in, sum_lookup
from supplyprep.operators.rows import delete_where, upsert
from supplyprep.plans import rules
from supplyprep.sources.readers import rolling_lookback

COLUMNS = (
    "ebeln", "ebelp", "matnr", "werks", "aedat_h", "lifnr", "menge", "openqty", "created_at", "tex"
)


def open_quantity(
    orders: DataFrame, receipts: DataFrame, keys: Sequence[str], ordered: str, received: str
) -> DataFrame:
    """Ordered minus received per order line, as ``openqty``.

    Receipts are first cut to the lines asked for, then summed before they are joined.
    """
    relevant = exists_in(receipts, orders, keys)
    summed = sum_lookup(orders, relevant, keys, received, "__received")
    return summed.withColumn(
        "openqty", F.coalesce(F.col(ordered), F.lit(0)) - F.col("__received")
    ).drop("__received")


def open_po(
    po: DataFrame,
    receipts: DataFrame,
    init: DataFrame,
    conf: DataFrame,
    ctx: RunContext,
    keys: Sequence[str] = ("ebeln", "ebelp", "matnr"),
    plants: Sequence[str] = rules.OPEN_PO_PLANTS,
    days: int = 365,
) -> DataFrame:
    """Open lines of recent orders on top of the initial list.

    ``keys`` identify a line when the two are merged; the source key must be unique.
    """
    recent = rolling_lookback(po.filter(F.col("werks").isin(*plants)), "aedat_h", ctx, days)
    recent = recent.filter(F.col("loekz_l").isNull() & F.col("loekz_h").isNull())
    line = ["ebeln", "ebelp"]
    current = open_quantity(recent, receipts, line, "menge", "wemng").withColumn(
        "created_at", F.lit(ctx.run_ts)
    )
    listed = init.select(
        F.col("po_id").alias("ebeln"),
        F.coalesce("po_line_id", F.lit(rules.OPEN_PO_LINE)).alias("ebelp"),
        F.col("item").alias("matnr"),
        F.col("siteid").alias("werks"),
        F.col("po_creation_date").alias("aedat_h"),
        F.col("supplierid").alias("lifnr"),
        F.col("po_qty").alias("menge"),
        F.lit(ctx.run_ts).alias("created_at"),
        F.col("remarks").alias("tex"),
    )
    listed = open_quantity(listed, receipts, line, "menge", "wemng").select(*COLUMNS)
    merged = upsert(listed, current.select(*COLUMNS), list(keys), update=["openqty"])
    excluded = conf.filter(
        (F.col("pdomain") == rules.CONF_SITES)
        & F.col("pvalue").isin(*rules.OPEN_PO_EXCLUDED_SITES)
    ).select("pattribute")
    merged = delete_where(
        merged,
        (F.col("lifnr") == rules.OPEN_PO_EXCLUDED_SUPPLIER) | (F.col("openqty") <= 0),
    )
    return exists_in(merged, excluded, [("lifnr", "pattribute")], negate=True)
