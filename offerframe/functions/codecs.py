"""Flag codecs, the active-status reading, and the snapshot stamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: `active` encodings found in stored tables ----------------
ACTIVE_TRUE_TEXTS = ("True", "Yes", "1")
ACTIVE_FALSE_TEXTS = ("No", "0", "False")
STAMP_FORMAT = "yyyyMMddHHmm"
# ---------------------------------------------------------------------------


def get_bool(flag: Column) -> Column:
    """0 -> false, anything else (NULL included) -> true."""
    return F.coalesce(flag != 0, F.lit(True))


def put_bool(flag: Column) -> Column:
    """true -> 1, anything else (NULL included) -> 0."""
    return F.when(flag, F.lit(1)).otherwise(F.lit(0))


def is_active(active: Column) -> Column:
    """Derived boolean over the raw `active` text; NULL when undecided."""
    return (F.when(active.isin(*ACTIVE_TRUE_TEXTS), F.lit(True))
             .when(active.isin(*ACTIVE_FALSE_TEXTS), F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))


def snapshot_stamp(ts: Column) -> Column:
    """`YYYYMMDDHHMM` in the session time zone."""
    return F.date_format(ts, STAMP_FORMAT)
