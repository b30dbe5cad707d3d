"""Declared schemas and the fixed values of the retail data model."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values. Headers, column lists, keys and tokens below define the data
# model; results are only right when they are exactly these.
# ---------------------------------------------------------------------------

# Raw header of each Orders column and its declared type, in sheet order.
ORDERS_SHEET = {
    "Row ID": "bigint",
    "Order ID": "string",
    "Order Date": "timestamp_ntz",
    "Ship Date": "timestamp_ntz",
    "Ship Mode": "string",
    "Customer ID": "string",
    "Customer Name": "string",
    "Segment": "string",
    "Country/Region": "string",
    "City": "string",
    "State/Province": "string",
    "Postal Code": "string",
    "Region": "string",
    "Product ID": "string",
    "Category": "string",
    "Sub-Category": "string",
    "Product Name": "string",
    "Sales": "double",
    "Quantity": "bigint",
    "Discount": "double",
    "Profit": "double",
}
PEOPLE_SHEET = {"Regional Manager": "string", "Region": "string"}
RETURNS_SHEET = {"Returned": "string", "Order ID": "string"}

# Headers renamed by name; every other header is only snake-cased.
ORDERS_RENAMES = {
    "Country/Region": "country",
    "State/Province": "province",
    "Postal Code": "post_code",
}
PEOPLE_RENAMES = {"Regional Manager": "manager", "Region": "region"}

# Collapsing repeated order lines.
LINE_KEYS = ("order_id", "product_id")
SUMMED = ("sales", "quantity", "profit")
ROW_ORDER = "row_id"

# Measures rounded to two decimals, and the one cast to a whole number.
MONEY = ("sales", "discount", "profit")
WHOLE = ("quantity",)

# Star schema.
ORDERS_COLUMNS = (
    "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id",
    "sales", "quantity", "discount", "profit", "returned",
)
CUSTOMERS_COLUMNS = (
    "customer_id", "customer_name", "segment", "country", "city", "province", "post_code", "region",
)
PRODUCTS_COLUMNS = ("product_id", "product_name", "category", "sub_category")
REGIONS_COLUMNS = ("region", "manager")

# Keep-first keys: one customer row per address, or per customer.
CUSTOMER_ADDRESS = ("customer_id", "country", "city", "province", "post_code", "region")
CUSTOMER_ID = ("customer_id",)
PRODUCT_ID = ("product_id",)

# Merge keys of the four target tables.
MERGE_KEYS = {
    "orders": ("order_id", "product_id"),
    "customers": ("customer_id",),
    "products": ("product_id",),
    "regions": ("region",),
}

# Key subsets on which order lines are checked for duplicates.
DUPLICATE_KEYS = (
    ("order_id", "product_id"),
    ("order_id", "product_id", "order_date", "ship_date", "ship_mode"),
)

# Cell texts that count as missing while a sheet is read.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Texts that count as missing once stripped and lower-cased.
NULL_TEXTS = ("null", "")

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

YES, NO = "Yes", "No"

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------

# The uncleaned line keys, kept beside the cleaned ones: keep-first follows
# the order of the keys as they were grouped, before cells are cleaned.
GROUPED_KEYS = {"order_id": "grouped_order_id", "product_id": "grouped_product_id"}
