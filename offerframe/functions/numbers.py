"""Text -> number with the analysis tool's coercion rules.

`strict_number` follows pandas `to_numeric(errors="coerce")`: plain decimal
or scientific text, optional sign and padding; `inf`/`infinity` only without
padding; everything else (currency, grouping, `1d`, `1_000`, `nan`, blank)
is NULL.  A bare `try_cast` is not enough: Spark accepts `1d` and DuckDB
accepts `1_000`.  Overflowing finite text (`1e400`) is NULL as well.

`lenient_number` is a separate, clearly named option for real listing
prices: strips spaces, currency words and signs, reads a decimal comma.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the shapes the strict parse accepts ----------------------
FINITE_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITE_PATTERN = r"^[+-]?(?i:inf|infinity)$"
# ---------------------------------------------------------------------------

# Java `\s` and RE2 `\s` differ on \x0B; spell the class out in Spark.
_FINITE_JAVA = r"^[ \t\n\x0B\f\r]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\x0B\f\r]*$"
_INFINITE_JAVA = r"^[+-]?(?i:inf|infinity)$"


def strict_number(text: Column) -> Column:
    trimmed = F.regexp_replace(text, r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")
    value = trimmed.try_cast("double")
    finite = text.rlike(_FINITE_JAVA)
    infinite = text.rlike(_INFINITE_JAVA)
    is_inf = (value == float("inf")) | (value == float("-inf"))
    return (F.when(finite & ~is_inf, value)
             .when(infinite, value)
             .otherwise(F.lit(None).cast("double")))


def lenient_number(text: Column) -> Column:
    """`1 250 000 zł`, `450.000,50 PLN`, `€ 1.5` -> numbers; others NULL."""
    t = F.regexp_replace(text, r"(?i)(zł|pln|eur|usd|€|\$)", "")
    t = F.regexp_replace(t, "[ \t\u00a0\u202f]", "")
    t = F.when(t.contains(","), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))\
         .otherwise(t)
    return strict_number(t)
