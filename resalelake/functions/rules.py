"""Business constants. Everything here is data; the code that applies it lives next door."""

from __future__ import annotations

from pyspark.sql import types as T

STORE_ZONE = "America/Vancouver"

MONEY = T.DecimalType(18, 4)      # one raw amount or quantity
PRODUCT = T.DecimalType(28, 8)    # amount x quantity, and sums of it
RATIO = T.DecimalType(28, 10)     # a quotient about to be rounded

# --- fixed values: sales channel by source application -----------------------
CHANNEL_BY_APP = {
    "Point of Sale": "Retail",
    "Online Store": "Ecomm",
    "Shop": "Ecomm",
    "Draft Orders": "Draft",
    "3890849": "Gorgias",
}
OTHER_CHANNEL = "Other"

# --- fixed values: application name by payload source name -------------------
APP_BY_SOURCE_NAME = {
    "web": "Online Store",
    "pos": "Point of Sale",
    "mobile": "Shop",
    "shopify_draft_order": "Draft Orders",
    "iphone": "Shop",
    "android": "Shop",
}
UNKNOWN_APP = "Unknown"

# --- fixed values: store name by location id ---------------------------------
STORE_BY_LOCATION_ID = {
    "61845110897": "2061 West 4th Ave",
    "34791915633": "418 Davie Street, Vancouver",
    "70972768369": "486 Front St W - The Well, Toronto",
    "69315657841": "510 8 Ave SW - Holt Renfrew, Calgary",
    "61826072689": "79 Yorkville, Toronto",
    "42702532": "1025 Howe Street, Vancouver",
    "61808017521": "Consignment - Real Real",
    "61822697585": "Courtney's Closet",
    "191632": "Storage Locker",
    "61841834097": "West 4th - Back of House (Archived)",
}
UNKNOWN_STORE = "Unknown Location"

# --- fixed values: titles that are not merchandise ---------------------------
NON_MERCHANDISE_TITLES = ("gift card", "paper bag", "")

# --- fixed values: stock age buckets, upper edge in days -> label ------------
AGE_BUCKETS = ((30, "0-30 days"), (60, "31-60 days"), (90, "61-90 days"), (180, "91-180 days"))
OLDEST_BUCKET = "180+ days"

# --- fixed values: product attributes read by the facts (namespace, key) -----
INVENTORY_ATTRIBUTES = {
    "contract_type": ("buy", "contract_type"),
    "buy_date": ("buy", "date"),
    "seller_name": ("buy", "seller_name"),
    "msrp": ("buy", "msrp"),
    "condition_grade": ("custom", "condition"),
    "location_text": ("custom", "location"),
}
SELLER_ATTRIBUTES = {
    "seller_name": ("buy", "seller_name"),
    "contract_type": ("buy", "contract_type"),
    "buy_date": ("buy", "date"),
    "location_text": ("custom", "location"),
}

#: The buyer's id as recorded at intake, where it is.
SELLER_IDENTITY = {"seller_name": ("buy", "seller_name"), "seller_customer_id": ("buy", "customer_id")}

# --- fixed values: contract types, consignor tag, seller words in notes ------
CONSIGNMENT = "consignment"
BUYOUT = "buyout"
STORE_CREDIT = "store_credit"
CONSIGNOR_TAG = "cognito-consignment"
SELLER_WORDS = ("seller", "consign", "buyout", "sell to us", "supplier", "vendor")
