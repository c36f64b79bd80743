"""Offer maps: `{url: {size_category, ...}}`.

The original format is one indented JSON object per file; our sink writes JSON
Lines where every line is itself a one-entry offer map.  The reader takes both, and
anything between, without looking which it is: see `sources.jsonsplit`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import OFFER_MAP_VALUE
from . import fs
from . import jsonsplit as JS

PREFIX = "offers_"
NO_ENTRY = "not an offer-map object"


def write_offer_map(links: DataFrame, root: str, stamp: str, url_col: str = "url",
                    category_col: str = "category", extra: tuple[str, ...] = ()) -> str:
    """One line per URL, `{"<url>": {"size_category": ..., ...}}`."""
    path = f"{root.rstrip('/')}/{PREFIX}{stamp}"
    value = F.struct(F.col(category_col).alias("size_category"), *[F.col(c) for c in extra])
    line = F.to_json(F.create_map(F.col(url_col), value))
    links.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


FLAG = ("CASE WHEN lower(trim({0})) IN ('true', '1') THEN true "
        "WHEN lower(trim({0})) IN ('false', '0') THEN false END")  # a flag in any of its spellings


@dataclass(frozen=True)
class OfferMap:
    """What a set of map files holds: rows (seq, url, size_category, ..., is_active) and rejects (raw, reason)."""

    rows: DataFrame
    rejects: DataFrame


def offer_map_of(raw: DataFrame, work: str | None = None) -> OfferMap:
    """The offer map in the files behind `raw` (`jsonsplit.with_place`), batch or micro-batch."""
    split = JS.split_map(raw, work)
    # One entry mostly; a value that is no object comes together with the entry behind it.
    raw = F.regexp_replace(F.expr("substring(body, 2, length(body) - 2)"), "\\s+$", "")  # without the map's own braces
    texts = split.entries.select("seq", raw.alias("raw"), F.from_json("body", "map<string, string>").alias("_m"))
    one = texts.select("seq", "raw", F.explode_outer("_m").alias("url", "text"))
    one = one.withColumn("v", F.when(F.col("text").startswith("{"), F.from_json("text", OFFER_MAP_VALUE)))
    rows = one.where(F.col("url").isNotNull() & F.col("v").isNotNull()).select("seq", "url", "v.*")
    own = F.concat(F.lit('"'), F.col("url"), F.lit('": '), F.coalesce("text", F.lit("null")))
    bad = one.where(F.col("url").isNull() | F.col("v").isNull()).select(F.coalesce(own, F.col("raw")).alias("raw"))
    rejects = split.rejects.unionByName(bad).select("raw", F.lit(NO_ENTRY).alias("reason"))
    return OfferMap(rows.withColumn("is_active", F.expr(FLAG.format("is_active"))), rejects)


def open_offer_map(spark: SparkSession, path: str) -> OfferMap:
    """The map's files split among tasks wherever they can be, and read once."""
    return offer_map_of(JS.read_raw(spark, path))


def read_offer_map(spark: SparkSession, path: str) -> DataFrame:
    """Rows (url, size_category, offer_id, price, offer_title, location,
    is_active); fields absent in the JSON are NULL."""
    return open_offer_map(spark, path).rows.drop("seq")


def newest_offer_map_path(spark: SparkSession, root: str) -> str:
    """S3: newest offer map under `root`; none -> FileNotFoundError."""
    entries = [e for e in fs.list_entries(spark, root)
               if e.name.startswith(PREFIX) or e.name.endswith(".json")]
    return fs.newest(entries).path


def read_newest_offer_map(spark: SparkSession, root: str) -> tuple[str, DataFrame]:
    path = newest_offer_map_path(spark, root)
    return path, read_offer_map(spark, path)


def offer_map_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Input that `read_offer_map` cannot use -- text that is no entry of an
    offer map -- with the reason, so nothing is lost silently."""
    return open_offer_map(spark, path).rejects
