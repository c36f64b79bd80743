"""Declared schemas and sentinel texts of the offers data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: sentinel texts that must equal the original tool's -------
UNKNOWN = "Unknown"            # a field that was never filled
NOT_FOUND = "Not found"        # selector absent on the page
NO_DATA = "No data"            # column absent from a record at write time
ACTIVE_NO = "No"               # dead or expired page
ACTIVE_LIVE = "True"           # a parsed live page
# ---------------------------------------------------------------------------

SENTINELS = (UNKNOWN, NOT_FOUND, NO_DATA)

# Columns of the offers table, key first (the original's row id is not kept:
# nothing reads it and `url` is the real key).
OFFER_COLUMNS = ["url", "category", "website", "offer_id", "price",
                 "offer_title", "location", "active"]
VALUE_COLUMNS = OFFER_COLUMNS[1:]

# Column defaults of the table; `url` and `website` have none (not null).
OFFER_DEFAULTS = {
    "category": UNKNOWN,
    "offer_id": UNKNOWN,
    "price": UNKNOWN,
    "offer_title": UNKNOWN,
    "location": UNKNOWN,
    "active": UNKNOWN,
}

OFFERS = T.StructType(
    [T.StructField("url", T.StringType(), False)]
    + [T.StructField(c, T.StringType(), c != "website" and c != "category")
       for c in VALUE_COLUMNS]
)

# One offer-map value: {url: {size_category, offer_id, price, ...}}.  Every
# field but `size_category` may be absent.
OFFER_MAP_VALUE = T.StructType([
    T.StructField("size_category", T.StringType()),
    T.StructField("offer_id", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("offer_title", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("is_active", T.StringType()),  # true/false or 1/0
])
OFFER_MAP = T.MapType(T.StringType(), OFFER_MAP_VALUE)

# Parsed record as the extraction step emits it, keyed by url.
PARSED_RECORD = T.StructType(
    [T.StructField(c, T.StringType()) for c in OFFER_COLUMNS]
)

STATUS_UPDATE = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("status", T.StringType()),
])

QUARANTINE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("reason", T.StringType(), False),
])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
