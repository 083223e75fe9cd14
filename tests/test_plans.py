"""Pipelines on small hand-made tables."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from supplyprep.catalog import supply as catalog_supply
from supplyprep.catalog.tables import Tables
from supplyprep.context import RunContext
from supplyprep.plans import netting, rules, runs, supply
from supplyprep.plans.bom import Dimensions, build_bom, correct_source
from supplyprep.plans.bom_init import build_bom_init, conform_feed
from supplyprep.plans.common import shape_like
from supplyprep.plans.open_po import open_po
from supplyprep.schemas import INPUTS, OUTPUTS
from supplyprep.sources import storage

CTX = RunContext(run_ts=datetime(2024, 5, 16, 8))
CONF = "pdomain string, pname string, pvalue string, pattribute string, bom_source string, inv_source string, asn_source string, monitor_flag string"


def make(spark, schema, *dicts):
    """Rows from dictionaries in a declared schema; missing columns are null."""
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema.fields) for d in dicts], schema)


def conf(spark, *site_rows):
    return spark.createDataFrame(
        [("ODM_CODE", "SITE", site, site, feed, feed, feed, flag) for site, feed, flag in site_rows], CONF
    )


def raw(father, child, site_father, site_child, **more):
    base = {
        "bu": "ThinkNB",
        "odm": "QUANTA",
        "father_item": father,
        "child_item": child,
        "odm_father_item": site_father,
        "odm_child_item": site_child,
        "quantity_per": Decimal(1),
    }
    return {**base, **more}


def test_bom_init_repairs_edges(spark):
    schema = INPUTS["bom_raw"]
    feed = make(
        spark,
        schema,
        raw("SBB1", "A&B", "s1", "s2", alternative_code="g"),
        raw("A", "A", "s2", "s3"),
        raw("12345", "00-00", "s4", "s5", alternative_code="N/A"),
        raw("A1", "A2", "s2", "s6"),
        raw("A2", "A1", "s6", "s2"),
        raw("V", "W", "v$01", "w"),
        raw("V", "W", "v", "w"),
        raw("X", "Y", "x", "y", bu="ISG"),
        raw("X", "Y", "x", "y", odm="NOWHERE"),
    )
    subs = spark.createDataFrame([("SBB1",)], "sbb string")
    component = spark.createDataFrame([("none",)], "component string")
    edges, cycles = build_bom_init(
        feed, feed.limit(0), conf(spark, ("QUANTA", "SCC", "N")), subs, component
    )
    assert rows(edges, "father_item", "child_item", "odm_father_item", "alternative_code") == [
        ("000000000000012345", None, "s4", None),
        ("A", None, "s2", None),
        ("A1", "A2", "s2", None),
        ("SBB1", "A", "s1", "g"),
        ("SBB1", "B", "s1", "g"),
        ("V", "W", "v", None),
    ]
    assert rows(cycles, "odm_father_item", "odm_child_item") == [("s6", "s2")]


def test_long_group_codes_get_a_rank(spark):
    schema = INPUTS["bom_raw"]
    feed = make(
        spark,
        schema,
        raw("a", "b", "F2", "x", odm="FOXCONN", alternative_code="a-long-group-code"),
        raw("a", "b", "F1", "x", odm="FOXCONN", alternative_code="another-long-code"),
        raw("a", "b", "F1", "x", odm="FOXCONN", alternative_code="short"),
        raw("a", "b", "F1", "x", odm="QUANTA", alternative_code="a-long-group-code"),
    )
    assert rows(conform_feed(feed), "alternative_code") == [
        ("F1-1",), ("F2-3",), ("a-long-group-code",), ("short",)
    ]


def edge(odm, father, father_site, son, son_site, **more):
    base = {
        "odm": odm,
        "father_pn": father,
        "father_site_pn": father_site,
        "son_pn": son,
        "son_site_pn": son_site,
        "qtyper": Decimal(1),
        "eff_start": date(2024, 1, 3),
        "eff_end": date(9999, 12, 31),
        "alt_group": None,
        "created_at": datetime(2024, 1, 3),
    }
    return {**base, **more}


def test_source_corrections(spark):
    rows_in = make(
        spark,
        OUTPUTS["bom"],
        edge("AVC", "A/B", "f", "C/D", "s"),
        edge("X", "P", "f", "41U4034", "s"),
        edge("X", "P", "000000087084100002", "S", "s"),
        edge("X", "SB20N60893", "f1", "S", "s"),
        edge("X", "SB20N60893", "f2", "S", "s"),
        edge("X", "G", "g", "S1", "s1", alt_group="one"),
        edge("X", "G", "g", "S2", "s2", alt_group="two"),
        edge("X", "G", "g", "S3", "s3", alt_group="two"),
    )
    out = rows(correct_source(rows_in), "father_pn", "father_site_pn", "son_pn", "alt_group")
    assert out == sorted(
        [
            ("AB", "f", "CD", None),
            (None, "000000087084100002", "S", None),
            ("SB20N60893", "f1", "S", None),
            ("G", "g", "S1", None),
            ("G", "g", "S2", "two"),
            ("G", "g", "S3", "two"),
        ],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def dims(spark):
    def one(columns, *values):
        return spark.createDataFrame(list(values), columns)

    return Dimensions(
        component=one("component string, hier1_code string, hier5_code string", ("ABCDEFG", "ZZ", "x"), ("COMP", "ZERS", "x")),
        product=one("product string", ("PROD",)),
        sub_assembly=one("sbb string", ("SBB7",)),
        forecast=one("family string, item string, itemtype string, bu string, planning_item_id string", ("f", "EXC", "CTO_SBB", "IdeaNB", None)),
        product_bom=one("product string, sbb string", ("none", "none")),
        share=one("item string, display_type string, commodity string", ("TOUCH", "NX", "Touchpanel")),
        stock_history=one("odm string, item string", ("LCFC", "SB2X")),
        region_feed=one(
            "from_odm string, item string, odm_pn string, odm_created_date date, create_time timestamp, version string",
            ("COMPAL_VN", "36X", "r1", date(2024, 5, 1), datetime(2024, 5, 2), "2024051601"),
            ("COMPAL_VN", "36X", "r1", date(2024, 5, 1), datetime(2024, 5, 2), "2024051602"),
            ("COMPAL_VN", "36OLD", "r2", date(2024, 5, 1), datetime(2024, 5, 2), "20240515"),
            ("LCFC_VN", "99", "r3", date(2024, 5, 1), datetime(2024, 5, 2), "20240516"),
        ),
    )


def test_bom_rules(spark):
    files = make(
        spark,
        INPUTS["bom_feed"],
        edge("MSI", "PROD", "p", "SBB9", "m1"),  # father is a product: stays
        edge("MSI", "OTHER", "o", "SBB9", "m1"),  # forbidden
        edge("MSI", "EXC", "e", "SBB9", "m1"),  # exception list
        edge("WISTRON", "W", "w", "ABCDEFG99", "ws"),  # shortened to the known prefix
        edge("MSI", "T1_T2", "t", "U1_U2", "u"),  # two sons
        edge("MSI", "I", "c1", "S", "s"),  # item with two site codes
        edge("MSI", "I", "c2", "S", "s"),
        edge("MSI", "TOP", "top", "I", "c1"),  # ambiguous son with edges of its own
        edge("MSI", "OLD", "old", "S", "s", eff_end=date(2024, 5, 1)),  # expired
        edge("HUAQIN", "H", "h", "N/A", "s"),
        edge("LCFC", "PROD", "lp", "SBB7", "mid"),
        edge("LCFC", "SBB7", "mid", "LEAF", "leaf"),
        edge("LCFC", "TOUCH", "tt", "Q", "q"),  # share list
    )
    init = make(spark, INPUTS["bom_raw"])
    sites = [(s, "FTP", "N") for s in ("MSI", "WISTRON", "HUAQIN", "LCFC")]
    out = build_bom(init, files, conf(spark, *sites), dims(spark), CTX)
    got = {tuple(r) for r in out.select("odm", "father_pn", "father_site_pn", "son_pn", "son_site_pn", "created_by").collect()}
    own = "supplyprep"
    assert got == {
        ("MSI", "PROD", "p", "SBB9", "m1", own),
        ("MSI", "EXC", "e", "SBB9", "m1", own),
        ("WISTRON", "W", "w", "ABCDEFG", "ws", own),
        ("MSI", "T1_T2", "t", "U1", "u", own),
        ("MSI", "T1_T2", "t", "U2", "u", own),
        ("MSI", "I", None, "c1", "c1", "BOM_ADJUST_INSERT"),
        ("MSI", "I", None, "c2", "c2", "BOM_ADJUST_INSERT"),
        ("MSI", "c1", "c1", "S", "s", "BOM_ADJUST_UPDATE"),
        ("MSI", "c2", "c2", "S", "s", "BOM_ADJUST_UPDATE"),
        ("MSI", "TOP", "top", None, "c1", own + "_FIX"),
        ("HUAQIN", "H", "h", None, "s", own),
        ("HUAQIN_VN", "H", "h", None, "s", own),
        ("LCFC", "PROD", "lp", "SBB7", "mid", own),
        ("LCFC", "PROD", "lp", "LEAF", "leaf", own),
        ("LCFC", "SBB7", "mid", "LEAF", "leaf", own),
        ("COMPAL_VN", "36X", "36X", "r1", "r1", own + "_LEVEL"),
    }
    flags = {r["flag"] for r in out.filter("odm IN ('WISTRON', 'COMPAL_VN')").collect()}
    assert flags == {"Y", "VN"}
    start = out.filter("odm = 'MSI' AND father_pn = 'PROD'").first()["eff_start"]
    assert start == date(2024, 1, 3)


def test_group_total_is_added_once_unless_legacy(spark):
    stock = spark.createDataFrame(
        [("S05", "G", "L1", "a", "X", Decimal(1)), ("S05", "G", "L1", "b", "X", Decimal(2)), ("S05", "M", "L1", None, "X", Decimal(4))],
        "rule_id string, item string, siteid string, lgort string, supplierid string, z_inv decimal(18,4)",
    )
    members = make(spark, INPUTS["group_items"], {"item": "M", "siteid": "L1", "fcst_pn": "G", "qty": Decimal(10)})
    once = supply.add_group_quantities(stock, members)
    assert [float(r[0]) for r in rows(once, "z_inv")] == [11.0, 2.0, 4.0]
    legacy = supply.add_group_quantities(stock, members, legacy=True)
    assert sorted(float(r[0]) for r in rows(legacy, "z_inv")) == [4.0, 11.0, 12.0]
    assert rows(supply.rename_members(stock, members), "item") == [("G",)] * 3


def test_class_rules_overwrite_in_order(spark):
    columns = "item string, itemclass string, inv_type string, source string, inv_type_detail string, category string"
    table = spark.createDataFrame(
        [(i, None, "FGI", "MRPNB_SNAP_FG", None, "kept") for i in ("SBB1", "SBB2", "C1", "P1")]
        + [("P1", None, "FGI", "OWN", None, "kept")],
        columns,
    )
    product = spark.createDataFrame([("SBB2", "MTM"), ("C1", "MTM")], "product string, itemclass string")
    subs = spark.createDataFrame([("C1",)], "component string")
    kinds = spark.createDataFrame(
        [("FGI", "detail", "cat", "PN", "MRPNB_SNAP_FG")] * 2 + [("FGI", "own", "own", "PN", "OWN")],
        "inv_type string, inv_type_detail string, category string, itemclass string, data_source string",
    )
    out = supply.classify(table, product, subs, kinds)
    assert rows(out, "item", "itemclass", "inv_type_detail", "category") == [
        ("C1", "SFG", None, "kept"),
        ("P1", "PN", "detail", "cat"),
        ("P1", "PN", None, "kept"),
        ("SBB1", "SBB", None, "kept"),
        ("SBB2", "MTM", None, "kept"),
    ]


def test_open_orders(spark):
    po = make(
        spark,
        INPUTS["po"],
        {"ebeln": "1", "ebelp": "00010", "matnr": "m", "werks": "H021", "aedat_h": date(2024, 1, 1), "lifnr": "s", "menge": Decimal(10)},
        {"ebeln": "2", "ebelp": "00010", "matnr": "m", "werks": "H021", "aedat_h": date(2024, 1, 1), "lifnr": "s", "menge": Decimal(5)},
        {"ebeln": "3", "ebelp": "00010", "matnr": "m", "werks": "H021", "aedat_h": date(2024, 1, 1), "lifnr": "w", "menge": Decimal(5)},
        {"ebeln": "4", "ebelp": "00010", "matnr": "m", "werks": "H021", "aedat_h": date(2022, 1, 1), "lifnr": "s", "menge": Decimal(5)},
        {"ebeln": "5", "ebelp": "00010", "matnr": "m", "werks": "H021", "aedat_h": date(2024, 1, 1), "lifnr": "s", "menge": Decimal(5), "loekz_l": "L"},
    )
    receipts = make(
        spark,
        INPUTS["po_receipt"],
        {"ebeln": "1", "ebelp": "00010", "wemng": Decimal(4)},
        {"ebeln": "2", "ebelp": "00010", "wemng": Decimal(9)},
        {"ebeln": "9", "ebelp": "00010", "wemng": Decimal(1)},
    )
    init = make(
        spark,
        INPUTS["po_init"],
        {"po_id": "1", "po_line_id": None, "item": "m", "po_qty": Decimal(20), "supplierid": "s"},
        {"po_id": "9", "po_line_id": None, "item": "m", "po_qty": Decimal(3), "supplierid": None},
    )
    excluded = conf(spark, ("WISTRON", "SCC", "N")).withColumn("pattribute", F.lit("w"))
    out = open_po(po, receipts, init, excluded, CTX)
    assert [(r[0], float(r[1]), float(r[2])) for r in rows(out, "ebeln", "menge", "openqty")] == [
        ("1", 20.0, 6.0),
        ("9", 3.0, 2.0),
    ]


def test_receipts_are_not_multiplied_by_items(spark):
    orders = spark.createDataFrame([("PO1", "O1"), ("PO1", "O1")], "po string, orderid string")
    moved = {"werks": "L220", "wadat_ist": date(2024, 1, 2), "erdat": date(2024, 1, 2), "vbgel": "O1"}
    deliveries = make(
        spark, INPUTS["delivery"], {**moved, "vbeln": "d1", "matnr": "A", "lfimg": Decimal(10)}, {**moved, "vbeln": "d2", "matnr": "A", "lfimg": Decimal(5)}
    )
    booked = {"ebeln": "PO1", "werks": "X420", "lifnr": "0001000210", "budat": date(2024, 1, 3), "cpudt": date(2024, 1, 3)}
    documents = make(
        spark,
        INPUTS["mat_doc"],
        {**booked, "ebelp": "1", "matnr": "A", "bwart": "101", "menge": Decimal(4)},
        {**booked, "ebelp": "2", "matnr": "A", "bwart": "101", "menge": Decimal(3)},
        {**booked, "ebelp": "2", "matnr": "A", "bwart": "102", "menge": Decimal(1)},
        {**booked, "ebelp": "2", "matnr": "A", "bwart": "105", "menge": Decimal(99)},
    )
    shells = make(spark, INPUTS["shell_mapping"], {"purchaseshell": "A", "dummyshell": "DUMMY"})
    out = netting.intransit_by_po(orders, deliveries, documents, shells, CTX, F.lit(date(2024, 5, 1)))
    got = out.select("item", "shipmentqty", "receiptqty", "intransitqty").first()
    assert [got[0], *[float(v) for v in got[1:]]] == ["DUMMY", 15.0, 6.0, 9.0]


def test_receipts_settle_their_own_item(spark):
    orders = spark.createDataFrame([("PO1", "O1")], "po string, orderid string")
    moved = {"werks": "L220", "wadat_ist": date(2024, 1, 2), "erdat": date(2024, 1, 2), "vbgel": "O1", "lfimg": Decimal(10)}
    deliveries = make(spark, INPUTS["delivery"], {**moved, "vbeln": "d1", "matnr": "A"}, {**moved, "vbeln": "d2", "matnr": "B"})
    booked = {"ebeln": "PO1", "werks": "X420", "lifnr": "0001000210", "budat": date(2024, 1, 3), "cpudt": date(2024, 1, 3), "bwart": "101", "menge": Decimal(10)}
    documents = make(spark, INPUTS["mat_doc"], {**booked, "matnr": "A"}, {**booked, "matnr": None, "menge": Decimal(3)})
    shells = make(spark, INPUTS["shell_mapping"], {"purchaseshell": "A", "dummyshell": "DUMMY"})
    before = F.lit(date(2024, 5, 1))
    out = netting.intransit_by_po(orders, deliveries, documents, shells, CTX, before)
    assert [(r["item"], float(r["intransitqty"])) for r in out.collect()] == [("B", 10.0)]
    legacy = netting.intransit_by_po(orders, deliveries, documents, shells, CTX, before, legacy_order_receipts=True)
    assert sorted((r["item"], float(r["intransitqty"])) for r in legacy.collect()) == [("B", -3.0), ("DUMMY", -3.0)]


def test_ledger_cut_off_and_dates(spark):
    share = make(spark, INPUTS["share"], {"item": "m", "bu": "ThinkNB", "siteid": "LCFC", "supplier": "S", "vendor_code": "V", "display_type": "DS"})
    asn = make(
        spark,
        INPUTS["ledger_asn"],
        {"verur": "d1", "matnr": "m", "werks": "H000", "ship_to_name": "LCFC", "lfimg": Decimal(10), "erdat": "2024-05-01", "status": "ASN_GR"},
        {"verur": "d2", "matnr": "m", "werks": "H000", "ship_to_name": "LCFC", "lfimg": Decimal(7), "erdat": "2024-05-16", "status": "ASN_GR"},
        {"verur": "d3", "matnr": "other", "werks": "H000", "ship_to_name": "LCFC", "lfimg": Decimal(7), "erdat": "2024-05-01", "status": "ASN_GR"},
    )
    receipts = make(
        spark,
        INPUTS["ledger_gr"],
        {"delivery_notes": "d1", "qty": Decimal(3), "receipt_date": "02-05-24", "status": "OK"},
        {"delivery_notes": "d1", "qty": Decimal(2), "receipt_date": "2024-05-20", "status": "OK"},
        {"delivery_notes": "d1", "qty": Decimal(1), "receipt_date": None, "status": "ERROR"},
    )
    ledger = netting.ledger(asn, receipts, share, F.lit(date(2024, 5, 16)))
    assert rows(ledger.groupBy("measure").count()) == [("GI", 1), ("GR", 1), ("GR_Deleted", 1)]
    balance = netting.attribute_supplier(netting.ledger_balance(ledger), share)
    got = balance.select("qty", "qty_gi", "qty_gr", "supplierid").first()
    assert [float(v) for v in got[:3]] == [7.0, 10.0, -3.0] and got[3] == "V"


def test_two_windows_equal_one(spark):
    sales = make(spark, INPUTS["so"], {"vbeln": "o", "posnr": "1", "matnr": "lcd", "kwmeng": Decimal(5), "auart": "YSSA", "werks": "H000"})
    component = make(spark, INPUTS["component_dim"], {"component": "lcd", "hier5_code": "DISPLAY"})
    base = {"vbgel": "o", "vgpos": "1", "matnr": "lcd"}
    deliveries = make(
        spark,
        INPUTS["delivery"],
        {**base, "vbeln": "d", "posnr": "1", "lfimg": Decimal(5), "vbtyp": "J", "sys_last_modified_date": datetime(2024, 1, 1)},
        {**base, "vbeln": "d", "posnr": "1", "lfimg": Decimal(4), "vbtyp": "J", "sys_last_modified_date": datetime(2024, 1, 3)},
        {**base, "vbeln": "r", "posnr": "1", "lfimg": Decimal(1), "vbtyp": "T", "sys_last_modified_date": datetime(2024, 1, 2)},
    )
    whole = netting.ship_changes(sales, deliveries, component, "display")

    def window(low, high):
        return netting.ship_changes(sales, deliveries, component, "display", F.lit(low), F.lit(high))

    first = window(datetime(2024, 1, 1), datetime(2024, 1, 2))
    second = window(datetime(2024, 1, 2), datetime(2024, 1, 9))
    empty = shape_like(whole.limit(0), OUTPUTS["ship_fact"])
    fact = netting.ship_fact_upsert(netting.ship_fact_upsert(empty, first), second)
    columns = ["deliveryno", "deliveryline", "shipqty", "item"]
    assert [str(r) for r in rows(fact, *columns)] == [str(r) for r in rows(whole.select(*[F.col(c).cast(OUTPUTS["ship_fact"][c].dataType) for c in columns]), *columns)]
    assert float(fact.filter("deliveryno = 'r'").first()["shipqty"]) == -1.0


def test_rows_do_not_depend_on_partitions(spark):
    schema = INPUTS["bom_raw"]
    data = [raw(f"I{k}", f"I{2 * k}&J{k}", f"s{k}", f"s{2 * k}", alternative_code=f"g{k % 3}") for k in range(1, 40)]
    feed = make(spark, schema, *data)
    subs = spark.createDataFrame([("SBB1",)], "sbb string")
    component = spark.createDataFrame([("none",)], "component string")
    results = []
    for n in (1, 3):
        edges, _ = build_bom_init(feed.repartition(n), feed.limit(0), conf(spark, ("QUANTA", "SCC", "N")), subs, component)
        results.append(rows(edges, "father_item", "child_item", "ratio", "alternative_code"))
    assert results[0] == results[1] and len(results[0]) == 78


def test_order_types_are_merged_at_once_as_one_by_one(spark):
    """Lines of both types, of one, without a key, and known ones."""
    sales = spark.createDataFrame(
        [("A", "1", "D", 1, "YSSA", "H000", "c1"), ("A", "1", "T", 2, "YSSF", "H000", "c2"), ("B", "1", "D", 3, "YSSB", "H121", "c3"), ("C", "1", "T", 4, "YSSF", "H112", "c4"),
         ("D", "1", "B", 5, "YSSA", "H000", "c5"), ("E", "1", "T", 6, "YSSB", "H000", "c6"), ("F", "1", None, 7, "YSSA", "H000", "c7")],
        "vbeln string, posnr string, matnr string, kwmeng int, auart string, werks string, sold2_kunnr string",
    )
    lines = [(f"{order}{n}" if n else None, str(n), order, "1", "m", 10 * n + k, "JT"[k], "x", None, "S", 10 * n + k) for order in "ABCDEF" for n in range(3) for k in range(2)]
    deliveries = spark.createDataFrame(
        lines, "vbeln string, posnr string, vbgel string, vgpos string, matnr string, lfimg int, vbtyp string, werks string, wadat_ist date, sys_ent_state string, sys_last_modified_date long"
    )
    component = spark.createDataFrame([("D", "DISPLAY"), ("T", "TOUCH"), ("B", "DISPLAY"), ("B", "TOUCHPANEL"), (None, "TOUCH"), ("D", None)], "component string, hier5_code string")
    fact = shape_like(spark.createDataFrame([("A1", "1", "old"), (None, "1", "old"), ("Z", "1", "old")], "deliveryno string, deliveryline string, state string"), OUTPUTS["ship_fact"])
    for window in ((None, None), (F.lit(0), F.lit(10))):
        expected = fact
        for kind in rules.SHIP_ORDER_TYPES:
            changes = netting.ship_changes(sales, deliveries, component, kind, *window)
            expected = netting.ship_fact_upsert(expected, changes.select(*fact.columns))
        found = netting.ship_fact_merge(fact, sales, deliveries, component, *window)
        assert rows(found, *fact.columns) == rows(expected, *fact.columns)


@pytest.fixture
def stand_in(spark, tmp_path):
    """The stand-in snapshots over a few order lines, some of them twice, some without a part or a class."""
    folder = str(tmp_path / "tables")
    types = "element_at(array('SMALL', 'LARGE', 'PROMO', 'MEDIUM', 'STANDARD', 'ECONOMY'), CAST(id % 6 + 1 AS int))"
    made = {
        "part": spark.range(24).selectExpr(
            "id AS p_partkey", "'n' AS p_name", "concat('Brand#', id % 5 + 5) AS p_brand",
            f"IF(id = 23, NULL, {types}) AS p_type", "CAST(id * 2 AS int) AS p_size", "1D AS p_retailprice",
        ),
        "orders": spark.range(12).selectExpr(
            "id AS o_orderkey", "id AS o_custkey", "element_at(array('F', 'O'), CAST(id % 2 + 1 AS int)) AS o_orderstatus",
            "1D AS o_totalprice", "timestamp_ntz'2001-01-01' AS o_orderdate", "concat('p', id % 2) AS o_orderpriority",
        ),
        "lineitem": spark.range(600).selectExpr("id", "explode(IF(id % 7 = 0, array(1, 2), array(1))) AS copy").selectExpr(
            "id % 12 AS l_orderkey", "IF(id = 5, NULL, id % 24) AS l_partkey", "id % 3 AS l_suppkey",
            "CAST(id % 7 + 1 AS int) AS l_linenumber", "CAST((id * 7 + copy * 11) % 50 + 1 AS double) AS l_quantity",
            "1D AS l_extendedprice", "0D AS l_discount", "(id % 3) * 0.04D AS l_tax",
            "element_at(array('A', 'N', 'R'), CAST(id div 24 % 3 + 1 AS int)) AS l_returnflag",
            "element_at(array('F', 'O'), CAST(id div 72 % 2 + 1 AS int)) AS l_linestatus",
            "timestamp_ntz'2001-01-01' AS l_shipdate",
        ),
    }
    for name, table in made.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return catalog_supply.StandIn(Tables(spark, folder), whole=True)


def test_a_rule_for_rows_above_0_adds_up_only_those(spark, stand_in):
    base = {"mfgsite": "L210", "lgort": "LOC2", "product": "P1", "itemclass": "MTM", "supplierid": "X"}
    lines = [("X", 5, "u"), ("X", -9, "v"), ("7", 4, "u"), ("7", -1, "u"), ("8", -1, "u")]
    table = make(spark, stand_in.goods("DT").schema, *[{**base, "orderid": o, "qty": Decimal(q), "biz_unit": u} for o, q, u in lines])
    stand_in.inputs.fg_dt = table
    found = supply.finished_goods_supply(stand_in.inputs, "DT", CTX)
    # S26 takes all rows of the stock, whose sum is below 0; S24 and S28 those above 0.
    assert rows(found, "rule_id", "orderid", F.col("z_inv").cast("int")) == [("S24", "X", 5), ("S28", "7", 4)]


def test_slices_of_items_give_the_rows_of_the_whole(stand_in):
    inputs = stand_in.inputs
    for bu in ("NB", "DT"):
        for build in (supply.inventory_supply, lambda i, b: supply.wip_supply(i, b, CTX), lambda i, b: supply.finished_goods_supply(i, b, CTX)):
            parts = [build(supply.ItemSlice(inputs, n, 2), bu) for n in range(2)]
            assert rows(parts[0].unionByName(parts[1])) == rows(build(inputs, bu))
            assert all(part.limit(1).count() for part in parts)


def test_the_supply_table_is_built_part_by_part(spark, stand_in, monkeypatch):
    """What is returned only reads written tables; no work table of a part is left."""
    slices = []
    real = supply.staged_slices
    monkeypatch.setattr(supply, "staged_slices", lambda spark, label, n, build: slices.append(n) or real(spark, label, n, build))
    monkeypatch.setattr(supply, "SLICE_BYTES", 1)
    monkeypatch.setattr(supply, "MOST_SLICES", 2)
    with storage.work_scope(spark, "build"):
        folder = Path(storage.new_path(spark, "any").removeprefix("file:")).parent
        built = supply.build_supply(stand_in.inputs, CTX)
        plan = built._jdf.queryExecution().executedPlan().toString()
        left = sorted(path.name.split("-")[0] for path in folder.iterdir())
        assert built.count() > 100
    assert slices == [2] * 6
    assert "Exchange" not in plan
    assert left == ["stand_in_lines", "supply_goods", "supply_goods", "supply_hub", "supply_placed", "supply_wip", "supply_wip"]


def test_a_supply_run_leaves_its_published_tables_only(spark, stand_in, monkeypatch):
    """Feeds and parts are gone afterwards, the parts already when history and backup are written."""
    with storage.work_scope(spark, "query"):
        folder = Path(storage.new_path(spark, "any").removeprefix("file:")).parent
        parts, copied = [], runs.rolling_backup
        monkeypatch.setattr(
            runs, "rolling_backup", lambda *a: parts.extend(folder.rglob("supply_wip-*")) or copied(*a)
        )
        found = catalog_supply.q_run_supply(stand_in.t)
        left = [path.name.split("-")[0] for path in folder.iterdir()]
        (run,) = folder.iterdir()
        tables = {path.name for path in run.iterdir()}
        assert found.count() > 100
    assert parts == []
    assert left == ["run"]
    assert tables == {"supply", "supply_history", "supply_backup"}
