"""Netting of shipments against receipts, reservation demand and supplier attribution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.context import RunContext
from supplyprep.functions.clean import fallback, join_text, pad_line
from supplyprep.functions.dates import parse_mixed_date
from supplyprep.operators.groups import keep_latest, signed_sum
from supplyprep.operators.joins import exists_in
from supplyprep.operators.rows import Lookup, fill_cascade, holds, upsert
from supplyprep.plans import rules
from supplyprep.sources.readers import net_change_window


def reservation_demand(inventory: DataFrame, reservation: DataFrame) -> DataFrame:
    """Per site and item: stock, reserved quantity and what the reservation lacks.

    Both feeds are summed before they meet; the side that is missing counts as 0.
    """
    stock = inventory.groupBy("odm", fallback("item", "site_pn").alias("item")).agg(
        F.sum(F.coalesce("inv_qty", F.lit(0))).alias("inv_qty")
    )
    reserved = reservation.groupBy("odm", fallback("item", "odm_item").alias("item")).agg(
        F.sum(F.coalesce("res_qty", F.lit(0))).alias("resv_qty")
    )
    both = stock.join(reserved, ["odm", "item"], "full_outer").select(
        "odm",
        "item",
        F.coalesce("inv_qty", F.lit(0)).alias("inv_qty"),
        F.coalesce("resv_qty", F.lit(0)).alias("resv_qty"),
    )
    return both.withColumn("demand_qty", F.col("resv_qty") - F.col("inv_qty"))


def net_receipts(
    mat_doc: DataFrame, keys: Sequence[str], plant: str, before: Column, loaded_from: str
) -> DataFrame:
    """Received minus reversed quantity per key, booked before the given day."""
    rows = mat_doc.filter(
        F.col("bwart").isin(*rules.RECEIPT_CODES, *rules.REVERSAL_CODES)
        & (F.col("werks") == plant)
        & (F.to_date("budat") < before)
        & (F.col("cpudt") >= F.to_date(F.lit(loaded_from)))
    )
    return rows.groupBy(*keys).agg(
        signed_sum("menge", "bwart", rules.RECEIPT_CODES, rules.REVERSAL_CODES).alias("gr")
    )


def shipment_minus_receipt(
    shipments: DataFrame,
    mat_doc: DataFrame,
    orders: DataFrame,
    before: Column,
    plant: str = rules.NETTED_PLANT,
    loaded_from: str = rules.NETTED_RECEIPTS_FROM,
) -> DataFrame:
    """Shipped and not yet received quantity per order line of one plant, never below 0."""
    line = pad_line("lineid")
    wanted = orders.filter(F.col("werks") == plant)
    shipped = exists_in(
        shipments.withColumn("poline", line), wanted, [("po", "ebeln"), ("poline", "ebelp")]
    )
    shipped = shipped.groupBy("po", "lineid", "poline", "material", "odm", "bu").agg(
        F.sum("ship_qty").alias("ship_qty")
    )
    received = net_receipts(mat_doc, ["ebeln", "ebelp"], plant, before, loaded_from)
    rest = F.col("ship_qty") - F.coalesce("gr", F.lit(0))
    return shipped.join(
        received, (F.col("po") == F.col("ebeln")) & (F.col("poline") == F.col("ebelp")), "left"
    ).select(
        "po",
        "poline",
        F.col("material").alias("item"),
        F.col("odm").alias("fromid"),
        F.lit(plant).alias("tositeid"),
        F.greatest(rest, F.lit(0)).alias("intransitqty"),
        "bu",
    )


def intransit_export(netted: DataFrame, ctx: RunContext, source: str) -> DataFrame:
    """Netted lines in the shape of the in-transit snapshot."""
    return netted.select(
        join_text("po", "poline").alias("shipmentid"),
        "item",
        "tositeid",
        F.col("fromid").alias("fromsiteid"),
        F.col("intransitqty").alias("shipmentqty"),
        F.lit(ctx.run_date).alias("scheduleddate"),
        "intransitqty",
        F.lit(0).alias("receiptqty"),
        F.lit(ctx.run_ts).alias("ts"),
        F.lit(source).alias("sys_source"),
        "bu",
    )


def linked_orders(
    sales: DataFrame, purchases: DataFrame, sales_plant: str, since: str, types: Sequence[str]
) -> DataFrame:
    """Sales orders placed for purchase orders of the receiving plant."""
    bought = purchases.filter(
        (F.col("werks") == rules.ORDER_PLANT)
        & F.col("bsart").isin(*types)
        & F.col("lifnr").isin(*rules.ORDER_SUPPLIERS)
        & (F.coalesce("loekz_l", F.lit(" ")) != "L")
        & (F.col("aedat_h") >= F.to_date(F.lit(since)))
    )
    chosen = sales.filter(
        F.col("l_abgru").isNull()
        & (F.col("werks") == sales_plant)
        & (F.col("erdat") >= F.to_date(F.lit(since)))
    )
    return exists_in(chosen, bought, [("bstkd", "ebeln")]).select(
        F.col("bstkd").alias("po"), F.col("vbeln").alias("orderid")
    )


def intransit_by_po(
    orders: DataFrame,
    deliveries: DataFrame,
    mat_doc: DataFrame,
    shells: DataFrame,
    ctx: RunContext,
    before: Column,
    delivery_plant: str = rules.ORDER_DELIVERY_PLANT,
    order_plant: str = rules.ORDER_PLANT,
    since: str = rules.ORDER_DATA_FROM,
    legacy_order_receipts: bool = False,
    source: str = "supplyprep",
) -> DataFrame:
    """Issued minus received quantity per purchase order, item and site; settled ones drop out.

    Receipts are summed per order and item before the join, so issues are never multiplied by
    receipt rows and a receipt settles its own item only. Both sides take the item of the shell
    list. Receipts without an item settle nothing. ``legacy_order_receipts`` subtracts all receipts
    of an order from each of its items.
    """
    removed = F.lit(False)
    for order, delivery in rules.ORDER_DELETED:
        removed |= (F.col("orderid") == order) & (F.col("vbeln") == delivery)
    issued = deliveries.filter(
        (F.col("werks") == delivery_plant)
        & (F.to_date("wadat_ist") < before)
        & (F.col("erdat") >= F.to_date(F.lit(since)))
    )
    # Orders repeat per line; the delivery is wanted once per (order, purchase order).
    linked = issued.join(orders.distinct(), F.col("vbgel") == F.col("orderid"))
    linked = linked.filter(~F.coalesce(removed, F.lit(False)))
    alias = shells.groupBy(F.col("purchaseshell").alias("__shell")).agg(
        F.min("dummyshell").alias("__dummy")
    )
    named = linked.join(alias, F.col("matnr") == F.col("__shell"), "left").select(
        F.substring("po", 1, 10).alias("po"),
        F.coalesce("__dummy", "matnr").alias("item"),
        F.col("werks").alias("fromsiteid"),
        F.coalesce("lfimg", F.lit(0)).alias("gi"),
    )
    shipped = named.groupBy("po", "item", "fromsiteid").agg(F.sum("gi").alias("shipmentqty"))
    booked = mat_doc.filter(F.col("lifnr").isin(*rules.ORDER_SUPPLIERS))
    match = F.col("po") == F.col("ebeln")
    if legacy_order_receipts:
        received = net_receipts(booked, ["ebeln"], order_plant, before, since)
    else:
        booked = booked.join(alias, F.col("matnr") == F.col("__shell"), "left").withColumn(
            "__item", F.coalesce("__dummy", "matnr")
        )
        received = net_receipts(booked, ["ebeln", "__item"], order_plant, before, since)
        match &= F.col("item") == F.col("__item")
    gr = F.coalesce("gr", F.lit(0))
    netted = shipped.join(received, match, "left").select(
        F.col("po").alias("shipmentid"),
        "item",
        F.lit(order_plant).alias("tositeid"),
        "fromsiteid",
        "shipmentqty",
        F.lit(ctx.run_date).alias("scheduleddate"),
        (F.col("shipmentqty") - gr).alias("intransitqty"),
        gr.alias("receiptqty"),
        F.lit(ctx.run_ts).alias("ts"),
        F.lit(source).alias("sys_source"),
        F.lit(rules.ORDER_BU).alias("bu"),
    )
    return netted.filter(F.col("intransitqty") != 0)


def ledger(
    asn: DataFrame, receipts: DataFrame, share: DataFrame, cutoff: Column
) -> DataFrame:
    """Issues per delivery and their receipts as negative rows, marked by ``measure``.

    Issues from the cut-off day on are not loaded; receipts from then on are marked as left out.
    """
    known = share.filter(F.col("display_type") != rules.SHARE_EXCLUDED_DISPLAY)
    issued_on = F.to_date("erdat", "yyyy-MM-dd")
    rows = asn.filter(F.col("status").isin(*rules.LEDGER_STATUS) & (issued_on < cutoff))
    rows = exists_in(rows, known, [("matnr", "item")])
    bu = None
    for plant, name in rules.LEDGER_BU.items():
        test = F.col("werks") == plant
        bu = F.when(test, name) if bu is None else bu.when(test, name)
    issues = rows.groupBy(F.col("verur").alias("delivery")).agg(
        F.max("matnr").alias("item"),
        F.max(bu).alias("bu"),
        F.max("ship_to_name").alias("site"),
        F.sum("lfimg").alias("qty"),
        F.max(issued_on).alias("moved_on"),
        F.max("ship_from_name").alias("type"),
        F.lit("GI").alias("measure"),
    )
    received_on = parse_mixed_date("receipt_date")
    received = receipts.filter(F.col("status") != "ERROR").select(
        "delivery_notes", (-F.col("qty")).alias("__qty"), received_on.alias("__on")
    )
    returns = received.join(issues, F.col("delivery_notes") == F.col("delivery")).select(
        "delivery",
        "item",
        "bu",
        "site",
        F.col("__qty").alias("qty"),
        F.col("__on").alias("moved_on"),
        "type",
        F.when(F.col("__on") >= cutoff, "GR_Deleted").otherwise("GR").alias("measure"),
    )
    return issues.unionByName(returns)


def ledger_balance(rows: DataFrame, sites: Sequence[str] = rules.LEDGER_SITES) -> DataFrame:
    """Balance per item, site and business unit with the issue and receipt sums beside it."""
    counted = rows.filter(F.col("site").isin(*sites) & (F.col("measure") != "GR_Deleted"))

    def part(measure: str) -> Column:
        return F.sum(F.when(F.col("measure") == measure, F.col("qty")))

    known = F.col("bu").isNotNull() & F.col("item").isNotNull()
    return (
        counted.groupBy("item", "site", "bu")
        .agg(F.sum("qty").alias("qty"), part("GI").alias("qty_gi"), part("GR").alias("qty_gr"))
        .withColumns(
            {c: F.when(known, F.col(c)) for c in ("qty_gi", "qty_gr")}
        )
        .withColumns(
            {
                "supplierid": F.lit(None).cast("string"),
                "supplier_name": F.lit(None).cast("string"),
            }
        )
    )


def attribute_supplier(balance: DataFrame, share: DataFrame) -> DataFrame:
    """Supplier of each balance row by ordered fallbacks over the share list."""
    listed = share.filter(F.col("display_type") != rules.SHARE_EXCLUDED_DISPLAY).withColumn(
        "bu_upper", F.upper("bu")
    )
    group, members = rules.SHARE_GROUP
    grouped = listed.filter(F.col("bu").isin(*members)).withColumn("bu_upper", F.lit(group))
    any_bu = listed.filter(F.col("bu") == rules.SHARE_ANY_BU)
    item, bu, site = ("item", "item"), ("bu", "bu_upper"), ("site", "siteid")

    def any_site(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("siteid") == rules.SHARE_ANY_SITE)

    levels = [
        Lookup(listed, [item, bu, site]),
        Lookup(grouped, [item, bu, site]),
        Lookup(any_bu, [item, site]),
        Lookup(any_site(listed), [item, bu]),
        Lookup(any_site(grouped), [item, bu]),
        Lookup(any_site(any_bu), [item]),
    ]
    return fill_cascade(
        balance, levels, {"supplierid": "vendor_code", "supplier_name": "supplier"}
    )


SHIP_UPDATED = ["state", "werks", "shipdate", "shipqty"]
SHIP_KEYS = ["deliveryno", "deliveryline"]


def ship_changes(
    sales: DataFrame,
    deliveries: DataFrame,
    component: DataFrame,
    kind: str,
    low: Column | None = None,
    high: Column | None = None,
) -> DataFrame:
    """Delivery lines of one component class that changed in the window; returns are negative.

    Of several changes of a line the newest counts.
    """
    rows = _ship_lines(sales, deliveries, component, [kind], low, high).drop(f"__is_{kind}")
    return keep_latest(rows, SHIP_KEYS, ["__changed"]).drop("__changed")


def _ship_lines(
    sales: DataFrame,
    deliveries: DataFrame,
    component: DataFrame,
    kinds: Sequence[str],
    low: Column | None,
    high: Column | None,
) -> DataFrame:
    """Changed delivery lines of any of the component classes, with a flag ``__is_`` for each class."""
    moved = deliveries.filter(F.col("vbtyp").isin(rules.DELIVERY_TYPE, rules.RETURN_TYPE))
    if low is not None and high is not None:
        moved = net_change_window(moved, "sys_last_modified_date", low, high)
    flags = [f"__is_{kind}" for kind in kinds]
    listed = component.groupBy(F.col("component").alias("__component")).agg(
        *[F.bool_or(holds(F.col("hier5_code").isin(*rules.SHIP_CLASSES[k]))).alias(f) for k, f in zip(kinds, flags)]
    )
    wanted = [holds(F.col("auart").isin(*rules.SHIP_ORDER_TYPES[k]) & F.col(f)).alias(f) for k, f in zip(kinds, flags)]
    orders = sales.filter(F.col("werks").isin(*rules.SHIP_PLANTS)).join(listed, F.col("matnr") == F.col("__component"))
    orders = orders.select(
        F.col("vbeln").alias("__order"),
        F.col("posnr").alias("__line"),
        "werks",
        "kwmeng",
        "auart",
        "sold2_kunnr",
        *wanted,
    ).filter(reduce(or_, map(F.col, flags)))
    quantity = F.when(F.col("vbtyp") == rules.RETURN_TYPE, -F.col("lfimg")).otherwise(
        F.col("lfimg")
    )
    lines = moved.drop("werks").join(
        orders, (F.col("vbgel") == F.col("__order")) & (F.col("vgpos") == F.col("__line"))
    )
    return lines.select(
        "werks",
        F.col("vbeln").alias("deliveryno"),
        F.col("posnr").alias("deliveryline"),
        F.col("vbgel").alias("lineid"),
        F.col("matnr").alias("item"),
        F.col("vgpos").alias("orderid"),
        F.col("kwmeng").alias("orderqty"),
        quantity.alias("shipqty"),
        F.col("auart").alias("ordertype"),
        F.col("wadat_ist").alias("shipdate"),
        F.col("sold2_kunnr").alias("soldto"),
        F.col("sys_ent_state").alias("state"),
        F.col("sys_last_modified_date").alias("__changed"),
        *flags,
    )


def ship_fact_merge(
    fact: DataFrame,
    sales: DataFrame,
    deliveries: DataFrame,
    component: DataFrame,
    low: Column | None = None,
    high: Column | None = None,
    kinds: Sequence[str] = tuple(rules.SHIP_ORDER_TYPES),
) -> DataFrame:
    """Merge the changes of several component classes, as :func:`ship_changes` and :func:`ship_fact_upsert` would one by one.

    Deliveries meet their orders once. A new line that changed in several classes is inserted from the first of them
    and updated from the last; lines without a key are inserted from each.
    """
    rows = _ship_lines(sales, deliveries, component, kinds, low, high)
    rest = [c for c in rows.columns if c not in SHIP_KEYS and not c.startswith("__")]
    newest = F.struct(F.col("__changed").isNull().alias("__missing"), "__changed", *rest)
    found = rows.groupBy(*SHIP_KEYS).agg(*[F.max(F.when(F.col(f"__is_{k}"), newest)).alias(k) for k in kinds])
    columns = [F.col(k) for k in kinds]
    keyed = F.col(SHIP_KEYS[0]).isNotNull() & F.col(SHIP_KEYS[1]).isNotNull()

    def merged(source: DataFrame, first: Column, last: Column) -> DataFrame:
        picked = {c: (last if c in SHIP_UPDATED else first)[c] for c in rest}
        return source.select(*[picked.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fact.schema.fields])

    changes = merged(found.filter(keyed), F.coalesce(*columns), F.coalesce(*reversed(columns)))
    loose = found.filter(~keyed).select(*SHIP_KEYS, F.explode(F.array_compact(F.array(*columns))).alias("__row"))
    return ship_fact_upsert(fact, changes).unionByName(merged(loose, F.col("__row"), F.col("__row")))


def ship_fact_upsert(fact: DataFrame, changes: DataFrame) -> DataFrame:
    """Merge changed delivery lines into the fact table."""
    return upsert(fact, changes, SHIP_KEYS, update=SHIP_UPDATED)
