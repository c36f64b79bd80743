"""Merging new offer records into the offers table (M1-M8).

The table is an immutable snapshot; a merge is a join that yields the next
snapshot (see `sources.snapshots`).  All merges key on `url`:

* M1 `upsert_overwrite`  -- last record per key replaces the row entirely;
* M2 `merge_fill_unknown` -- insert new keys with defaults; for known keys
  only an `Unknown` active status is filled in;
* M3 `merge_conditional` -- known keys still `Unknown` get every column,
  keys already decided get `active` only;
* M4 `status_update`     -- set `active` for known keys, report the rest;
* M5 `key_lookup`        -- rows for a set of keys.

Updates are first reduced to one row per key by an explicit sequence with
`max_by` / `min_by` (a partial aggregate: a key updated a million times is
collapsed map-side before the shuffle).  The joins are then one-to-one on
`url`.  The reduction gives what merging the updates one by one would give, so
a stream's result does not depend on how its records fall into batches: under
M1 the last record stays; under M2 the first one (it inserts the key or fills
the status, later ones find it decided); under M3 the first one's fields with
the last one's status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codecs import put_bool
from ..functions.text import DEFAULT_TLD_TOKEN, website_from_url
from ..schema import NO_DATA, OFFER_COLUMNS, UNKNOWN, VALUE_COLUMNS

MAP_FIELDS = ("offer_id", "price", "offer_title", "location")


def project_record(df: DataFrame, columns=OFFER_COLUMNS, missing: str = NO_DATA) -> DataFrame:
    """M6: keep the accepted columns; absent (or NULL) values -> `No data`;
    extra columns are ignored.  `url` is never defaulted."""
    return df.select(*[_projected(df, c, missing) for c in columns])


def value_or_default(value: Column, default: str) -> Column:
    """M7: the value when present, the default only on absence."""
    return F.coalesce(value, F.lit(default))


def latest_per_key(df: DataFrame, key: str, seq: list[str] | str,
                   columns: list[str] | None = None) -> DataFrame:
    """One row per key: the one with the greatest `seq` (make it total).

    `max_by` over a struct is a partial aggregate, so hot keys are reduced
    before the shuffle instead of landing whole in one task.
    """
    seq = [seq] if isinstance(seq, str) else list(seq)
    columns = columns or [c for c in df.columns if c != key]
    payload = F.struct(*[F.col(c) for c in columns])
    order = F.struct(*[F.col(c) for c in seq])
    return (df.groupBy(key).agg(F.max_by(payload, order).alias("_last"))
            .select(key, *[F.col(f"_last.{c}").alias(c) for c in columns]))


def _as_list(seq) -> list[str]:
    if not seq:
        return []
    return [seq] if isinstance(seq, str) else list(seq)


def _projected(updates: DataFrame, c: str, missing: str = NO_DATA) -> Column:
    if c == "url":
        return F.col("url")
    if c in updates.columns:
        return F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c)
    return F.lit(missing).alias(c)


def upsert_overwrite(base: DataFrame, updates: DataFrame, seq: list[str] | str,
                     key: str = "url") -> DataFrame:
    """M1 (+M6): last update per key wins and replaces every column; new keys
    are inserted.  One full outer join, each side shuffled once on `url`."""
    seq_cols = _as_list(seq)
    rec = (updates.filter(F.col(key).isNotNull())   # `url` is NOT NULL in the table
           .select(*[_projected(updates, c) for c in OFFER_COLUMNS], *seq_cols))
    u = latest_per_key(rec, key, seq_cols, columns=VALUE_COLUMNS).alias("u")
    b = base.select(*OFFER_COLUMNS).alias("b")
    j = b.join(u, F.col(f"b.{key}") == F.col(f"u.{key}"), "full_outer")
    hit = F.col(f"u.{key}").isNotNull()
    return j.select(
        F.coalesce(F.col(f"u.{key}"), F.col(f"b.{key}")).alias(key),
        *[F.when(hit, F.col(f"u.{c}")).otherwise(F.col(f"b.{c}")).alias(c)
          for c in VALUE_COLUMNS])


def _map_updates(updates: DataFrame, seq, last_status: bool = False) -> DataFrame:
    """Offer-map rows -> one per url: its first record by `seq`, with
    `last_status` the `is_active` of its last one.  Without a sequence the
    whole record orders, so a repeated url still gives one row."""
    cols = ["url", "size_category", *MAP_FIELDS, "is_active"]
    present = [c for c in cols if c in updates.columns]
    missing = [c for c in cols if c not in updates.columns]
    upd = updates.filter(F.col("url").isNotNull()).select(
        *present, *[F.lit(None).cast("string" if c != "is_active" else "boolean").alias(c)
                    for c in missing],
        *[F.col(s) for s in _as_list(seq)])
    order = F.struct(*[F.col(c) for c in (_as_list(seq) or cols[1:])])
    first = F.min_by(F.struct(*[F.col(c) for c in cols[1:]]), order).alias("_first")
    status = F.max_by(F.struct("is_active"), order).alias("_last")
    rows = upd.groupBy("url").agg(first, status)
    picked = [F.col(f"_first.{c}").alias(c) for c in cols[1:-1]]
    return rows.select("url", *picked, F.col(("_last" if last_status else "_first") + ".is_active").alias("is_active"))


def _insert_values(tld_token: str, u: str = "u") -> dict[str, Column]:
    """Column values for a key that is new to the table (M2/M3 insert path)."""
    return {
        "category": value_or_default(F.col(f"{u}.size_category"), UNKNOWN),
        "website": website_from_url(F.col(f"{u}.url"), tld_token),
        **{c: value_or_default(F.col(f"{u}.{c}"), UNKNOWN) for c in MAP_FIELDS},
        "active": put_bool(F.coalesce(F.col(f"{u}.is_active"), F.lit(True))).cast("string"),
    }


def _merge(base: DataFrame, updates: DataFrame, seq, when_matched, tld_token: str, last_status: bool = False) -> DataFrame:
    b = base.select(*OFFER_COLUMNS).alias("b")
    u = _map_updates(updates, seq, last_status).alias("u")
    j = b.join(u, F.col("b.url") == F.col("u.url"), "full_outer")
    in_b = F.col("b.url").isNotNull()
    in_u = F.col("u.url").isNotNull()
    ins = _insert_values(tld_token)
    cols = [F.coalesce(F.col("b.url"), F.col("u.url")).alias("url")]
    for c in VALUE_COLUMNS:
        matched = when_matched(c, ins)
        cols.append(F.when(in_b & in_u, matched)
                    .when(in_b, F.col(f"b.{c}"))
                    .otherwise(ins[c]).alias(c))
    change = (F.when(in_b & in_u, F.lit("matched"))
               .when(in_b, F.lit("kept"))
               .otherwise(F.lit("inserted")))
    out = j.select(*cols, change.alias("change"))
    # `website` is NOT NULL in the table: a new key without one stays out and
    # is reported by `merge_rejects`.
    return out.filter(F.col("website").isNotNull())


def merge_fill_unknown(base: DataFrame, updates: DataFrame, seq=None,
                       tld_token: str = DEFAULT_TLD_TOKEN) -> DataFrame:
    """M2: insert new keys with defaults; a known key whose `active` is
    still `Unknown` gets the update's flag (1/0, absent = 1); else unchanged."""
    def matched(c, ins):
        if c == "active":
            return F.when(F.col("b.active") == UNKNOWN, ins["active"]).otherwise(F.col("b.active"))
        return F.col(f"b.{c}")
    return _merge(base, updates, seq, matched, tld_token)


def merge_conditional(base: DataFrame, updates: DataFrame, seq=None,
                      tld_token: str = DEFAULT_TLD_TOKEN) -> DataFrame:
    """M3: a known key still `Unknown` takes every column of the update; a
    key already decided takes the update's `active` only."""
    def matched(c, ins):
        undecided = F.col("b.active") == UNKNOWN
        if c == "active":
            return ins["active"]
        if c == "website":
            return F.coalesce(F.when(undecided, ins["website"]), F.col("b.website"))
        return F.when(undecided, ins[c]).otherwise(F.col(f"b.{c}"))
    return _merge(base, updates, seq, matched, tld_token, last_status=True)


def merge_rejects(base: DataFrame, updates: DataFrame, seq=None,
                  tld_token: str = DEFAULT_TLD_TOKEN) -> DataFrame:
    """New keys that M2/M3 keep out of the table (no website in the URL)."""
    u = _map_updates(updates, seq)
    new = u.join(base.select("url"), "url", "left_anti")
    return (new.filter(website_from_url(F.col("url"), tld_token).isNull())
            .select("url", F.lit("no www. in url").alias("reason")))


def status_update(base: DataFrame, updates: DataFrame, seq: list[str] | str | None = None,
                  status_col: str = "status") -> DataFrame:
    """M4: `active` := status for keys in the table; the rest are reported
    by `status_unmatched`.  Adds `updated` (boolean)."""
    upd = (updates.filter(F.col("url").isNotNull())
           .select("url", F.col(status_col).alias("_status"), *_as_list(seq)))
    upd = latest_per_key(upd, "url", seq, ["_status"]) if seq else \
        upd.groupBy("url").agg(F.max("_status").alias("_status"))
    j = base.select(*OFFER_COLUMNS).join(upd, "url", "left")
    hit = F.col("_status").isNotNull()
    cols = [F.when(hit, F.col("_status")).otherwise(F.col("active")).alias("active")
            if c == "active" else F.col(c) for c in OFFER_COLUMNS]
    return j.select(*cols, hit.alias("updated"))


def status_unmatched(base: DataFrame, updates: DataFrame) -> DataFrame:
    """M4 report: update keys that are not in the table (nothing inserted)."""
    return updates.select("url").distinct().join(base.select("url"), "url", "left_anti")


def lookup_one(base: DataFrame, url: str, key: str = "url") -> DataFrame:
    """M5 for a single key: an equality filter, pushed into the Parquet scan
    (with url-sorted snapshot files most row groups are skipped)."""
    return base.filter(F.col(key) == F.lit(url))


def key_lookup(base: DataFrame, keys: DataFrame, key: str = "url") -> DataFrame:
    """M5: the rows for a key set (semi join); a single key is a plain
    filter, which Parquet pushes down."""
    return base.join(keys.select(key).distinct(), key, "left_semi")
