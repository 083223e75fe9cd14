"""Fixed values of the business rules: site lists, code maps, labels and hand-kept corrections.

Everything in this module is data that the results depend on; the logic that applies it is in
the pipelines.
"""

from __future__ import annotations

from supplyprep.operators.rows import Correction

# --- feeds ------------------------------------------------------------------------------------

OVERRIDE_SITES = ("BOE", "TPV")
EXCLUDED_BU = ("ISG", "FCCL")
EXCLUDED_BU_PREFIX = "Mobile"
NO_ITEM = ("N/A", " ")
CONF_SITES = "ODM_CODE"

# --- bill of material ---------------------------------------------------------------------------

BOM_EXCLUDED_BU = "ThinkOption"
BOM_EXCLUDED_BU_SITES = ("USI_HUIZHOU", "USI_TAIWAN", "USI_VN", "WISTRON", "WISTRON_VN")
BOM_SITE_ALIASES = {"USI_HUIZHOU": "USI"}
GROUP_CODE_SITE = "FOXCONN"
SUFFIX_SITES_FIRST = ("WISTRON", "WISTRON ZS")
SUFFIX_SITES = ("WISTRON", "WISTRON ZS", "WISTRON_VN_NB", "WISTRON_VN")
PREFIX_LENGTHS_BOM = (7, 8, 9, 10, 11, 12)
DEDUP_SITE = "WISTRON"
ZERO_GROUP_SITE = "BITLAND"
SUB_ASSEMBLY_PREFIX = "SBB"
COMPOUND_MARKS = ("SB20", "SBB")
SERVICE_CLASSES = ("ZERS", "ZPPN")
EXCEPTION_BU = "IdeaNB"
EXCEPTION_DIRECT_TYPE = "CTO_SBB"
EXCEPTION_PRODUCT_TYPE = "MTM"
FORBIDDEN_EXEMPT_SITE = "COMPAL"
BYPASS_SITE = "LCFC"
PREFERRED_ITEM_PREFIX = "SB2"
PREFERRED_CODE_PREFIX = "451"
MULTI_CODE_FATHER_PREFIXES = ("SBG", "SB2")
SLASH_SITE = "AVC"
BAREBONE_CLASS = "BAREBONE"
NULL_CHILD_SITES = ("QUANTA",)
READMIT_BRAND = "X420"
REGION_FLAG = "VN"
REGION_LEVELS = (("COMPAL_VN", "36"), ("LCFC_VN", "PV"))
CLONED_SITE = ("HUAQIN", "HUAQIN_VN")
SHARE_DISPLAY_EXEMPT = ("DS", "DB", "FLEX")
SHARE_COMMODITY = "Touchpanel"

LOOPED_CODES = (
    "SB20N60893",
    "SB20N60890",
    "SB20N60928",
    "SB20N60965",
    "SB20N60961",
    "SB20N60962",
)

# Corrections of the BOM source rows, before and after the group codes are blanked.
SOURCE_CORRECTIONS = (
    Correction({"son_pn": ("41U4034",)}),
    Correction({"father_site_pn": ("000000087084100002",)}, {"father_pn": None}),
)
SOURCE_CORRECTIONS_LATE = (
    Correction(
        {"son_pn": ("SM30U64434", "SM30U64433"), "odm": ("LCFC",)}, {"son_pn": None}
    ),
    Correction(
        {"father_pn": ("SM30U64434", "SM30U64433"), "odm": ("LCFC",)}, {"father_pn": None}
    ),
)
GROUP_CORRECTION = {
    "father_pn": ("SBB0Q20867", "SBB0Q17719"),
    "son_site_pn": ("2A585K700-G98-G",),
    "odm": ("FOXCONN",),
}
GROUP_CORRECTION_KEPT = ("1", "7")
# Corrections of the conformed BOM.
BOM_CORRECTIONS = (
    Correction(
        {
            "odm": ("LCFC",),
            "son_pn": ("SP10K38391",),
            "father_pn": (
                "SSA0S71773",
                "SSA0S71774",
                "SSA0T37581",
                "SW10A11646",
                "SW10K97446",
                "5D10K81086",
            ),
        },
        {"son_pn": None},
    ),
)
BOM_CORRECTIONS_SPLIT = (Correction({"father_pn": ("5SB0N24830",), "odm": ("LCFC",)}),)
BOM_CORRECTIONS_LAST = (
    Correction({"odm": ("COMPAL",), "father_pn": ("5SB0R47677", "5SB0R47678")}),
    Correction(
        {
            "father_pn": ("SA10R16873", "SB10K97655", "SB10K97656", "SA10R16867", "SA10R16871"),
            "odm": ("LCFC",),
        }
    ),
)

# --- shipment notices ------------------------------------------------------------------------------

ASN_BU = "IDG"
ASN_ORDER_SUFFIX = "PO"
ASN_EXCLUDED_PLANTS = ("H301", "H510", "H520", "X410", "X420", "I020", "I021")
ASN_EXCLUDED_SUPPLIER = "1000031525"
ASN_LATEST_ONLY_SITE = "AVC"
ASN_SITE_VENDOR = ("0001000338", "LCFC")
IN_TRANSIT_PREFIX = "In transit"
HUB_STATUS_MISMATCH = "mismatch"

# --- inventory ---------------------------------------------------------------------------------------

INVENTORY_LATEST_SITE = "PTSN"
INVENTORY_LOCATION_TYPES = ("inspection", "unrestricted")
INVENTORY_BU_RULES = {
    "QUANTA": ("cto_po", {"LBG": "IDEANB", "TBG": "THINKNB"}),
    "LCFC": (
        "bu",
        {
            "T-NB": "THINKNB",
            "T-DT": "THINKDT",
            "L-DT": "IDEADT",
            "L-NB": "IDEANB",
            "T-WS": "WorkStation",
            "T-SSD": "NOUSE",
            "T-SV": "NOUSE",
            "SD": "NOUSE",
            "JV-EC": "NOUSE",
            "JV-NBI": "NOUSE",
            "JV-SVC": "NOUSE",
        },
    ),
}
PREFIX_LENGTHS = (7, 10)
PREFIX_SITES_INVENTORY = ("WISTRON", "WISTRON ZS", "WISTRON_VN", "WISTRON_VN_NB")
PREFIX_SITES_WIP = ("WISTRON", "WISTRON ZS", "WISTRON_VN_NB")
PREFIX_SITES = ("WISTRON", "WISTRON ZS")
FIRST_TOKEN_SITE = "COMPAL"
ITEM_SUFFIX_RULE = ("BITLAND", "ForLCFC")
BU_RULE_SITE = "WISTRON"
BU_FROM_ORDER_SITE = "QUANTA"
OPTION_BRAND = "IDEAOPTION"
OPTION_CLASS = "OPTION"

# --- WIP, reservations, service parts ------------------------------------------------------------------

FAMILY_DEFAULT_BU = "IdeaNB"
WIP_FAMILY_SITES = ("WISTRON", "QUANTA")
RESERVATION_FAMILY_SITES = ("QUANTA",)
RESERVATION_BU_SITES = ("LITEON", "FOXCONNL6")
RESERVATION_BU_MAP = {"TBG": "ThinkDT", "LBG": "IdeaDT"}

# --- shipments and in-transit ------------------------------------------------------------------------------

MAX_ITEM_LENGTH = 30
DESTINATION_SITE = "LITEON"
DESTINATION_PREFIX = ("FLEX", "FLEX_DT")
REBALANCE_MODE = "ODM Internal Rebalance"
REBALANCE_SITES = (
    "WISTRON",
    "LCFC",
    "HUAQIN",
    "LCFC_VN",
    "HUAQIN_VN",
    "COMPAL_VN",
    "WISTRON_VN_NB",
)
REBALANCE_BU_PART = "NB"
MAPPED_MOVE_SITES = ("COMPAL",)
PART_MAP_SITE = "COMPAL_VN"
NO_ITEM_SITES = ("HUAQIN", "COMPAL", "COMPAL_VN", "WISTRON", "WISTRON_VN_NB")

# --- source map ---------------------------------------------------------------------------------------

REGION_SITES = ("WISTRON_VN_NB", "LCFC_VN", "COMPAL_VN", "HUAQIN_VN")
REGION_MEASURE = "VN_BAREBONE"
TO_SITE_ALIASES = {"WISTRONZS": "WISTRON ZS"}
SOURCE_CORRECTIONS_MAP = (Correction({"site_pn": ("713100840081",)}, {"site_pn": "SB21C42346"}),)

# --- open orders, net change, in-transit netting ------------------------------------------------------------

OPEN_PO_PLANTS = ("H021", "H022", "H023")
OPEN_PO_LINE = "00010"
OPEN_PO_EXCLUDED_SUPPLIER = "0004007310"
OPEN_PO_EXCLUDED_SITES = ("WISTRON",)
SHIP_ORDER_TYPES = {"display": ("YSSA", "YSSB", "YSSF"), "touch": ("YSSA", "YSSF")}
SHIP_CLASSES = {"display": ("DISPLAY",), "touch": ("TOUCH", "TOUCHPANEL")}
SHIP_PLANTS = ("H000", "H121", "H112")
DELIVERY_TYPE, RETURN_TYPE = "J", "T"
RECEIPT_CODES, REVERSAL_CODES = ("101",), ("102",)
NETTED_PLANT = "X220"
NETTED_RECEIPTS_FROM = "2024-01-01"
ORDER_PLANT = "X420"
ORDER_DATA_FROM = "2019-01-01"
ORDER_SUPPLIERS = ("0001000210", "0001000835")
ORDER_DELIVERY_PLANT = "L220"
ORDER_BU = "ThinkNB"
ORDER_DELETED = (("4119236625", "8985836975"), ("4119236627", "8985836976"))
LEDGER_BU = {"H121": "IDEANB", "H112": "IDEADT", "H000": "THINK"}
LEDGER_SITES = ("LCFC", "COMPAL")
LEDGER_STATUS = ("ASN_GR", "ASN_SENT")
SHARE_EXCLUDED_DISPLAY = "FLEX"
SHARE_GROUP = ("THINK", ("ThinkNB", "ThinkDT"))
SHARE_ANY_BU = "ALL"
SHARE_ANY_SITE = "ODM"

# --- supply rules ---------------------------------------------------------------------------------------------

FG_LOCATION_TYPE = "FG_GEO"
NOT_COUNTABLE = "NON_CVD_FG_INV"
SHARED_LOCATION = "MRWS"
SUPPLY_SITE_PREFIX_OUT = "C1"
SOI_NB_SITE_OUT = "T220"
LOI_DT_SITES = ("L210", "X210", "E010")
NB_SITES = ("L220", "L420", "L215", "T220", "X220", "I220", "I021")
NB_NETTED = ("L220", "L420")
NB_NOT_NETTED = ("L215", "T220", "X220", "I021", "I220")
DT_NETTED = ("L210", "E010")
DT_NOT_NETTED = ("9116", "T116", "9117", "9118", "L211", "9104", "X210", "I210", "I020")
DT_WIP_SITES = (
    "L210", "9116", "T116", "9117", "9118", "L211", "9104", "X210", "E010", "I210", "I020"
)
DT_FG_SITES = ("L210", "X210", "E010", "I210", "I020")
DT_FG_OTHER_SITES = (
    "0116", "2116", "4116", "4118", "9116", "T116", "9117", "9118", "L211", "9104"
)
SFG_SITE = "T220"
SFG_DRAWINGS = ("BDPLANAR", "CARDPOP", "BS_GBM")
HUB_FEED = "THKODM"
HUB_BU_PREFIX_OUT = "Idea"
HUB_SECOND_SITES = ("H121", "H111", "H112")
HUB_SECOND_LOCATION_OUT = "I070"
SUPPLY_SITE_CORRECTIONS = (Correction({"siteid": ("CQlaibao",)}, {"siteid": "CQLaibao"}),)
INV_TYPE_EXCLUDED = "OOI"
