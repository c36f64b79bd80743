"""Offer-shaped inputs derived from the driver's tables.

The driver's tables hold no listings, so the offers queries run on a view
derived deterministically from `part` joined to `nation`; every row of
`part` becomes one offer and the same derivation is written in SQL for
the oracle (plans/oracle.py).  Modulo arithmetic below only *chooses
values* (which rows carry a sentinel); it never drops rows.

Merge inputs split `part` by size, not by key, so that all three kinds of
keys exist: base = sizes 1-30, update round 1 = sizes 20-50, round 2 =
sizes 40-50 (a later re-scrape, sequence 2).  Together they cover the
whole table.

Per-row value choices are single SQL expressions (`F.expr`): one call to
build instead of dozens of Column calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import strict_number
from ..functions.text import website_from_url
from ..operators.bands import last_band
from ..operators.rank import spread


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A read-only input table, resolved once per session (file listing and
    footer read happen once, like registering it in a catalog; no data is
    cached)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        owner = spark.sparkContext.applicationId
    except Exception:  # sessions without a local context (Spark Connect)
        owner = str(id(spark))
    key = (owner, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def part_url(key: str = "p_partkey", host_www: bool = True) -> Column:
    """Offer URL of a part key column."""
    prefix = "https://www." if host_www else "https://"
    return F.expr(f"concat('{prefix}', CASE WHEN {key} % 2 = 0 THEN 'sitea' ELSE 'siteb' END, "
                  f"'.pl/d/', CAST({key} AS STRING), '.html')")


PRICE_TEXT = """CASE p_partkey % 17 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Not found' WHEN 2 THEN '1d'
    WHEN 3 THEN '1_000' WHEN 4 THEN 'nan' WHEN 5 THEN ''
    WHEN 6 THEN concat(' ', CAST(p_retailprice AS STRING), ' ')
    ELSE CAST(p_retailprice AS STRING) END"""

ACTIVE_TEXT = """CASE p_partkey % 7 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'No' WHEN 2 THEN 'Yes'
    WHEN 3 THEN 'True' WHEN 4 THEN '1' WHEN 5 THEN '0' ELSE 'No data' END"""

OFFER_ID_TEXT = "CASE WHEN p_partkey % 13 = 0 THEN 'Unknown' ELSE CAST(p_partkey AS STRING) END"
TITLE_TEXT = "CASE WHEN p_partkey % 19 = 0 THEN concat('O' || chr(39), p_name) ELSE p_name END"
LOCATION_TEXT = "CASE WHEN p_partkey % 11 = 0 THEN 'Unknown' ELSE n_name END"


def _with_url(df: DataFrame, host_www: bool = True) -> DataFrame:
    return df.select(part_url("p_partkey", host_www).alias("url"), "*")


def offers_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, category, website, offer_id, price, offer_title, location, active
    (+ p_size for the merge splits)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = _with_url(part.join(nation, F.expr("p_partkey % 25") == nation["n_nationkey"], "left"))
    return joined.select(
        "url",
        last_band(F.col("p_size") * 5).alias("category"),
        website_from_url(F.col("url")).alias("website"),
        F.expr(OFFER_ID_TEXT).alias("offer_id"),
        F.expr(PRICE_TEXT).alias("price"),
        F.expr(TITLE_TEXT).alias("offer_title"),
        F.expr(LOCATION_TEXT).alias("location"),
        F.expr(ACTIVE_TEXT).alias("active"),
        "p_size",
    )


def offers_with_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = offers_view(spark, sf_dir)
    return v.withColumn("price_numeric", strict_number(F.col("price")))


def merge_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers_view(spark, sf_dir).filter(F.col("p_size") <= 30).drop("p_size")


def whole_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offers of all parts (base of status updates and lookups)."""
    return offers_view(spark, sf_dir).drop("p_size")


def record_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed records from two scrape rounds (M1 input), with `seq`.
    Round 2 has no `location` (NULL = absent -> `No data` under M6)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type", "p_brand")
    r1 = _with_url(part.filter(F.col("p_size") >= 20)).select(
        "url",
        last_band(F.col("p_size") * 5).alias("category"),
        website_from_url(F.col("url")).alias("website"),
        F.expr("CAST(p_partkey AS STRING)").alias("offer_id"),
        F.expr("CAST(p_partkey * 10 + p_size AS STRING)").alias("price"),
        F.col("p_name").alias("offer_title"),
        F.col("p_brand").alias("location"),
        F.lit("Yes").alias("active"),
        F.lit(1).alias("seq"),
    )
    r2 = _with_url(part.filter(F.col("p_size") >= 40)).select(
        "url",
        last_band(F.col("p_size") * 5).alias("category"),
        website_from_url(F.col("url")).alias("website"),
        F.expr("CAST(p_partkey AS STRING)").alias("offer_id"),
        F.expr("CAST(p_partkey * 10 + p_size + 1 AS STRING)").alias("price"),
        F.upper(F.col("p_name")).alias("offer_title"),
        F.lit(None).cast("string").alias("location"),
        F.expr("CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'No' ELSE 'True' END").alias("active"),
        F.lit(2).alias("seq"),
    )
    return r1.unionByName(r2)


def map_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer-map rows (M2/M3 input): some fields absent (NULL), `is_active`
    sometimes absent; round 2 re-lists sizes 40-50, and size 50 under a
    host without `www.` (kept out of the table)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type")
    r1 = part.filter(F.col("p_size") >= 20).select(
        part_url("p_partkey").alias("url"),
        last_band(F.col("p_size") * 5).alias("size_category"),
        F.expr("CAST(p_partkey AS STRING)").alias("offer_id"),
        F.expr("CASE WHEN p_size >= 25 THEN CAST(p_partkey * 10 + p_size AS STRING) END").alias("price"),
        F.col("p_name").alias("offer_title"),
        F.lit(None).cast("string").alias("location"),
        F.expr("CASE WHEN p_type = 'SMALL' THEN CAST(NULL AS BOOLEAN) ELSE p_type <> 'PROMO' END")
         .alias("is_active"),
        F.lit(1).alias("seq"),
    )
    r2 = part.filter(F.col("p_size") >= 40).select(
        F.when(F.col("p_size") == 50, part_url("p_partkey", host_www=False))
         .otherwise(part_url("p_partkey")).alias("url"),
        last_band(F.col("p_size") * 5).alias("size_category"),
        F.lit(None).cast("string").alias("offer_id"),
        F.expr("CAST(p_partkey * 10 + p_size + 1 AS STRING)").alias("price"),
        F.upper(F.col("p_name")).alias("offer_title"),
        F.col("p_type").alias("location"),
        F.expr("p_type <> 'LARGE'").alias("is_active"),
        F.lit(2).alias("seq"),
    )
    return r1.unionByName(r2)


def status_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per part; those of the `STANDARD` parts name a host without
    `www.`, so no offer has their URL.  NULL status (size 1) updates nothing."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    return part.select(
        F.when(F.col("p_type") == "STANDARD", part_url("p_partkey", host_www=False))
         .otherwise(part_url("p_partkey")).alias("url"),
        F.expr("CASE WHEN p_size = 1 THEN NULL WHEN p_type = 'PROMO' THEN 'No' ELSE 'Yes' END").alias("status"),
    )


# One listing page per part, in the markup the original tool's rules expect; the
# part's key chooses the case (see oracle.LISTING_OFFERS for what must come out)
# and how the markup is written: with a nested element of the wanted name before the
# wanted child, an unquoted attribute, a `>` inside a value, the child in a second element only.
_LISTING_URL = """concat(CASE WHEN kind IN (1, 7, 9) THEN 'https://www.otodom.pl/pl/oferta/'
    WHEN kind = 2 THEN 'https://www.other.pl/oferta/' WHEN kind = 3 THEN 'https://olx.pl/d/oferta/'
    ELSE 'https://www.olx.pl/d/oferta/' END, p_partkey, '.html')"""

_SIMILAR = '<section><h2>Similar</h2><h3>999 zł similar offer</h3><h4>Other flat</h4><p>Elsewhere</p></section>'

_OLX = """concat('<html><head><title>', CASE WHEN kind = 4 THEN 'Archiwalne: ' ELSE '' END, p_name, '</title>',
    '<script>var t = "<div data-cy=\\'ad_title\\'><h4>script</h4></div>";</script></head><body><div id="mainContent"><div><div>nav<br></div>',
    '<div><div>a</div><div>b<img src="x"></div><div><div>x</div><div><div>y</div><div><div><section><div><div><p>', n_name,
    '</p><p>district</p></div></div><div><p>map</p></div></section></div></div></div></div></div></div></div>',
    CASE kind WHEN 5 THEN '<div data-testid="ad-inactive-msg"><div><h4>gone</h4></div></div>'
              WHEN 8 THEN '<div data-testid="ad-inactive-msg"></div>' ELSE '' END,
    CASE p_partkey % 5 WHEN 1 THEN '<div data-cy="ad_title"><div><h4>Old title</h4><div>x</div></div><h4>'
                       WHEN 2 THEN '<div class=a data-cy=ad_title><div><span>top</span></div><h4>'
                       ELSE '<div data-cy="ad_title"><div><span>top</span></div><h4>' END,
    CASE WHEN kind = 10 THEN concat('<b>', p_name, '</b> &amp; &quot;', n_name, '&quot; &#243;') ELSE p_name END, '</h4></div>',
    CASE WHEN kind = 6 THEN concat('<div data-testid="ad-price-container">',
                                   CASE WHEN p_partkey % 5 = 1 THEN '<div><h3>1 zł</h3></div>' ELSE '' END, '<b>ask</b></div>')
         ELSE concat(CASE p_partkey % 5
             WHEN 1 THEN '<div data-testid="ad-price-container"><div><h3>1 zł</h3></div>'
             WHEN 2 THEN '<div data-testid=ad-price-container>'
             WHEN 3 THEN '<div title="a > b" data-testid="ad-price-container"><div>price</div>'
             WHEN 4 THEN '<div data-testid="ad-price-container"><b>from</b></div><div data-testid="ad-price-container"><div>price</div>'
             ELSE '<div data-testid="ad-price-container"><div>price</div>' END, '<h3>', p_size, ' 000 zł</h3></div>') END,
    '<div data-testid="ad-footer-bar-section"><span>ID: ', p_partkey, '</span><span>seen</span></div>', '{similar}',
    '</body></html>')""".replace("{similar}", _SIMILAR)

_OTODOM = """concat('<html><head><title>', p_name, '</title></head><body><h1 class="t" data-cy="adPageAdTitle">', p_name, '</h1>',
    CASE WHEN kind = 7 THEN '<!-- <strong aria-label="Cena">1 zł</strong> -->' ELSE concat(
        '<strong aria-label="Cena">', p_size, ' 000 zł</strong><p>Date: 1</p><p> ',
        CASE WHEN kind = 9 THEN '<span>I<!-- x -->D</span>: ' ELSE 'ID: ' END, p_partkey, '</p>',
        '<div class="m" id="map"><div>', n_name, '</div><div>tiles</div></div>') END, '{similar}', '</body></html>')""".replace(
    "{similar}", _SIMILAR)


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, html: one offer page per part, of both sites and every kind (parts are dealt out before they grow to pages)."""
    part = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = part.join(nation, F.expr("p_partkey % 25") == nation["n_nationkey"]).withColumn("kind", F.expr("p_partkey % 12"))
    html = f"CASE WHEN kind = 11 THEN '  ' WHEN kind IN (1, 7, 9) THEN {_OTODOM} ELSE {_OLX} END"
    return rows.select(F.col("p_partkey").alias("page_id"), F.expr(_LISTING_URL).alias("url"), F.expr(html).alias("html"))


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, html: one search result page per part, with links of every kind."""
    html = """concat('<html><body><a class="x" href="/d/oferta/', k, '.html">a</a>',
        '<a href="https://www.otodom.pl/pl/oferta/', k, '.html">b</a><a href="https://www.other.pl/', k, '.html">c</a>',
        '<a href="https://www.olx.pl/abs-', k, '.html">d</a><a href="/d/oferta/', k, '">e</a>',
        '<a data-href="/d/no-', k, '.html" href="/d/o', chr(39), 'hara-', k, '.html">f</a>',
        '<a href=/d/plain-', k, '.html>g</a><a href = ', chr(39), '/d/spaced-', k, '.html', chr(39), '>h</a>',
        '<a href="/d/q?a=1&amp;b=', k, '.html">i</a><a name="top">j</a><!-- <a href="/d/hidden.html">k</a> -->',
        '</body></html>')"""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("page_id"), F.lit("https://www.olx.pl/search").alias("url"),
        F.expr(html.replace(" k,", " CAST(p_partkey AS STRING),")).alias("html"))


def write_object_maps(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Offer maps in the original format below `root`: per brand and size group one indented JSON object of all its
    parts, one folder each.  Titles hold braces, quotes, backslashes and line feeds, some values are nested or no
    object, and the objects of one size group start with a damaged entry."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    part = part.withColumn("title", F.expr(OBJECT_TITLE)).withColumn("url", part_url())
    entry = F.when(F.col("p_partkey") % 23 == 0, F.concat(F.to_json(F.struct("url")).substr(F.lit(8), F.length("url") + 2), F.lit(": 17"))).otherwise(F.concat(
        F.lit('"'), "url", F.lit('": {\n        "size_category": "'), (F.col("p_size") * 5).cast("string"),
        F.when(F.col("p_partkey") % 29 == 0, F.lit('",\n        "extra": {"a": [{"b": "}"}, 1]},\n        "offer_title": ')).otherwise(
            F.lit('",\n        "offer_title": ')),
        F.to_json(F.struct("title")).substr(F.lit(10), F.length(F.to_json(F.struct("title"))) - 10), F.lit("\n    }")))
    groups = (part.withColumn("entry", F.concat(F.lit("\n    "), entry)).groupBy("p_brand", F.expr("p_size % 8").alias("g"))
              .agg(F.array_sort(F.collect_list(F.struct("p_partkey", "entry"))).alias("e")))
    damage = F.when(F.col("g") == 3, F.lit('\n    "https://www.cut.pl/d/x": {"size_category": "a\n},')).otherwise(F.lit(""))
    text = F.concat(F.lit("{"), damage, F.array_join(F.transform("e", lambda x: x["entry"]), ","), F.lit("\n}"))
    groups.select(text.alias("value"), "p_brand", "g").write.partitionBy("p_brand", "g").option("lineSep", "\n").text(root)


# A title's text; as JSON it has escaped quotes, braces and backslashes.
OBJECT_TITLE = """CASE p_partkey % 5 WHEN 0 THEN concat(p_name, ' {', p_size, '}') WHEN 1 THEN concat('"', p_name, '", "x": {')
    WHEN 2 THEN concat(p_name, ' ', chr(92), '} ', chr(92)) WHEN 3 THEN concat(p_name, chr(10), '}{') ELSE p_name END"""


def lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part a line item refers to, as offer URLs."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey")
    return li.select(part_url("l_partkey").alias("url"))


def page_slice(html: Column) -> Column:
    """Stand-in slice of a stored result page (the generated pages carry no
    search filter): the band of its length in hundreds of characters."""
    return F.floor(F.length(html) / 100)
