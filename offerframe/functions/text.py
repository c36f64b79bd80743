"""Scalar text expressions on URLs and field values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SENTINELS

# --- fixed values: URL pieces the website rule splits on --------------------
DEFAULT_TLD_TOKEN = ".pl"
WWW_TOKEN = "www."
# ---------------------------------------------------------------------------


def website_from_url(url: Column, tld_token: str = DEFAULT_TLD_TOKEN) -> Column:
    """Text before the first `tld_token`, then the piece after the first `www.`.

    Literal splits (`split_part`), so `.` needs no escaping.  A URL without
    `www.`, or without the token, gives NULL (the caller quarantines it)
    instead of an error or of half the path.
    """
    head = F.split_part(url, F.lit(tld_token), F.lit(1))
    return F.when(url.contains(tld_token), F.nullif(F.split_part(head, F.lit(WWW_TOKEN), F.lit(2)), F.lit("")))


def split_after(text: Column, delimiter: str) -> Column:
    """Piece after the first `delimiter` up to the next one; NULL when absent."""
    return F.nullif(F.split_part(text, F.lit(delimiter), F.lit(2)), F.lit(""))


def base_of_url(url: Column) -> Column:
    """`scheme://host` of an absolute URL ('' when not absolute)."""
    return F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)


def null_if_sentinel(value: Column) -> Column:
    """NULL for the sentinel texts and blanks; the value otherwise."""
    return F.when(
        value.isNull() | (F.trim(value) == "") | value.isin(*SENTINELS)
        | value.startswith("Unknown exception at "),
        F.lit(None).cast("string"),
    ).otherwise(value)


def is_present(value: Column) -> Column:
    return null_if_sentinel(value).isNotNull()
