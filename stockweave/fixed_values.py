"""Names, words and formats which results have to agree on."""

# Branch names, in the order in which the stores are read.
STORES = (
    "Samyan",
    "Circle",
    "Rama 9",
    "Eastville",
    "Mega",
    "Embassy",
    "EmQuartier",
    "Gaysorn Centre",
)
ONLINE_BRANCH = "On Time"
HQ_BRANCH = "HQ"
DEPOT_BRANCH = "Saimai"

# Branch groups of the dashboard. A branch in no group has the group "".
BRANCH_GROUPS = {
    "store": ("Samyan", "Circle", "Rama 9", "Eastville", "Mega", "Embassy", "EmQuartier"),
    "hq": ("HQ",),
    "online": ("On Time",),
    "vending": ("True Digital Park", "T One Building"),
}

# Depot SKU -> SKU used everywhere else.
DEPOT_SKU_ALIASES = {
    "EW-VSD": "P_EW-US",
    "EW-VD": "P_EW-INT",
    "EW-ORTHO": "P_EW-PO",
    "EW-WJ180": "PEW-WJ180",
    "EW-GUM75": "P_EW-GUM75",
    "EW-TW75": "P_EW-TW75",
    "EW-PL70": "P_EW-FT70",
    "EW-SG2A": "P_EW-Refill-DC",
    "EW-SG2B": "P_EW-Refill-TF",
    "EW-SG2W": "P_EW-Refill-WH",
    "EW-VW": "P_EW-SE",
    "EW-XF50": "P_EW-SF",
    "EW-SG8": "P_EW-SG8",
    "EW-GUM12": "P_F_EW_CRF12",
    "EW-TW12": "P_F_EW_WHT12",
    "EW-VSD2": "PEW-US-Duo",
    "EW-SG8+": "EW-SG8PLUS",
    "EW-PC70": "P_EW-FTGR",
    "EW-SR75": "P_EW-SR75",
    "EW-SR12": "P_F_EW_STS12",
}

# Column names of a store's table.
STORE_ITEM, STORE_SKU, STORE_QTY = "Item", "SKU", "Available Qty."

# Cell texts which a CSV reader takes for a missing value.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Snapshot names, the index file, the clock and the label in the snapshot list.
SNAPSHOT_SUFFIX = ".json"
INDEX_NAME = "file_list.json"
TIME_ZONE = "Asia/Bangkok"
LABEL_PREFIX = "วันที่ "

# Stock bands: below the first limit critical, below the second low.
CRITICAL_BELOW, LOW_BELOW = 5, 10

# Page sizes offered by the dashboard; None shows all rows.
PAGE_SIZES = (30, 50, 100, None)
