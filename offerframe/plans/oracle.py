"""DuckDB SQL for every registered query (the correctness oracle).

Written as plain SQL over the driver's views, with patterns of its own (only
selectors, markers and bands, which are data, come from `profiles`).  The
listing queries go further: their pages are built from table columns, and the
SQL states the expected fields from those columns without looking at a page.
"""

from __future__ import annotations

from ..functions.html import Selector
from ..functions.numbers import FINITE_PATTERN, INFINITE_PATTERN
from ..profiles import REFERENCE_BANDS, band_request_suffix
from .catalog import LINK_RULES, PAGE_RULES


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean(col: str) -> str:
    for element in ("script", "style"):
        col = f"regexp_replace({col}, '(?is)<{element}(\\s[^>]*)?>.*?</{element}\\s*>', '', 'g')"
    return f"regexp_replace({col}, '(?s)<!--.*?-->', '', 'g')"


# --- fixed values: elements that break a line, character references ------------
_BREAKING = ("br p div li ul ol h1 h2 h3 h4 h5 h6 tr td th table section article header footer nav main aside "
             "dd dt dl blockquote pre form").split()
_REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "#39": "'", "apos": "'", "nbsp": " ", "copy": "©", "middot": "·",
               "amp": "&"}


def references(text: str) -> str:
    for name, char in _REFERENCES.items():
        text = f"replace({text}, {lit('&' + name + ';')}, {lit(char)})"
    return text


def element_text(frag: str) -> str:
    t = f"regexp_replace({frag}, '(?i)</?({'|'.join(_BREAKING)})([\\s/][^>]*)?>', ' ', 'g')"
    t = references(f"regexp_replace({t}, '<[^>]*>', '', 'g')")
    return f"nullif(trim(regexp_replace({t}, '[ \\t\\r\\n\\f]+', ' ', 'g')), '')"


def _opening(tag: str, attrs=()) -> str:
    inside = "".join(f"[^>]*\\s{name}=[\"']{value}[\"']" for name, value in attrs)
    return f"<{tag}{inside}[^>]*>" if attrs else f"<{tag}(?:[\\s/][^>]*)?>"


def _elements(cl: str, sel: Selector) -> str:
    """List of the inner markup of all elements that the selector names."""
    pat = lit(f"(?is){_opening(sel.tag, sel.attrs)}(.*?)</{sel.tag}\\s*>")
    if sel.child is None:
        return f"regexp_extract_all({cl}, {pat}, 1)"
    body = lit(f"(?is){_opening(sel.tag, sel.attrs)}(.*?)(?:</{sel.tag}\\s*>|\\z)")
    child = lit(f"(?is){_opening(sel.child)}(.*?)</{sel.child}\\s*>")
    return f"regexp_extract_all(regexp_extract({cl}, {body}, 1), {child}, 1)"


def select_text(cl: str, sel: Selector) -> str:
    return element_text(f"{_elements(cl, sel)}[{sel.nth}]")


def select_found(cl: str, sel: Selector) -> str:
    return f"(len({_elements(cl, sel)}) >= {sel.nth})"


def anchors(columns: str, source: str) -> str:
    """One row per anchor with an href: the columns and `href`."""
    value = ("regexp_extract(t, '(?is)\\shref\\s*=\\s*(?:\"[^\"]*\"|''[^'']*''|[^\\s>\"'']+)', 0)")
    bare = f"regexp_replace(regexp_replace({value}, '(?is)^\\shref\\s*=\\s*', ''), '^[\"'']|[\"'']$', '', 'g')"
    tags = f"SELECT {columns}, unnest(regexp_extract_all({clean('html')}, '(?is)<a\\s[^>]*>', 0)) AS t FROM {source}"
    return f"SELECT {columns}, {references(bare)} AS href FROM ({tags}) WHERE {value} <> ''"


def website(url: str, token: str) -> str:
    return (f"(CASE WHEN contains({url}, {lit(token)}) THEN "
            f"nullif(split_part(split_part({url}, {lit(token)}, 1), 'www.', 2), '') END)")


def strict_number(col: str) -> str:
    ws = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
    val = f"TRY_CAST(trim({col}, {ws}) AS DOUBLE)"
    return (f"(CASE WHEN regexp_matches({col}, {lit(FINITE_PATTERN)}) AND NOT isinf({val}) THEN {val}"
            f" WHEN regexp_matches({col}, {lit(INFINITE_PATTERN)}) THEN TRY_CAST({col} AS DOUBLE) END)")


def _null_int(v):
    return "CAST(NULL AS INTEGER)" if v is None else str(v)


BANDS_CTE = "bands(ord, label, lo, hi) AS (VALUES " + ", ".join(
    f"({b.ord}, {lit(b.label)}, {_null_int(b.lo)}, {_null_int(b.hi)})" for b in REFERENCE_BANDS) + ")"


def band_match(v: str, alias: str = "b") -> str:
    return (f"({alias}.lo IS NULL OR {v} >= {alias}.lo) AND ({alias}.hi IS NULL OR {v} <= {alias}.hi)")


def last_label(v: str) -> str:
    return f"(SELECT arg_max(bb.label, bb.ord) FROM bands bb WHERE {band_match(v, 'bb')})"


def last_ord(v: str) -> str:
    return f"(SELECT max(bb.ord) FROM bands bb WHERE {band_match(v, 'bb')})"


# --- links ------------------------------------------------------------------

ANCHORS = anchors("page_id, url", "pages")


def _link_expr(href: str, page_url: str) -> str:
    base = f"regexp_extract({page_url}, {lit('^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)')}, 1)"
    partner = " OR ".join(f"starts_with({href}, {lit(p)})" for p in LINK_RULES.allowed_prefixes) or "FALSE"
    return (f"(CASE WHEN {href} IS NOT NULL AND ends_with({href}, {lit(LINK_RULES.suffix)}) THEN "
            f"CASE WHEN starts_with({href}, '/') THEN {base} || {href} WHEN {partner} THEN {href} END END)")


LINKS_ABSOLUTE = (f"SELECT page_id, link FROM (SELECT page_id, {_link_expr('href', 'url')} AS link "
                  f"FROM ({ANCHORS})) WHERE link IS NOT NULL")

SLICED_PAGES = (f"SELECT page_id, url, html, {last_label('floor(length(html) / 100)')} AS slice, "
                f"{last_ord('floor(length(html) / 100)')} AS slice_ord FROM pages")

SLICE_LINKS = (f"SELECT link AS url, slice AS category, slice_ord AS ord FROM ("
               f"SELECT slice, slice_ord, {_link_expr('href', 'url')} AS link FROM ("
               f"{anchors('url, slice, slice_ord', 'sp')})) WHERE link IS NOT NULL")

REQUESTS_CTE = "reqs(ord, category, suffix) AS (VALUES " + ", ".join(
    f"({b.ord}, {lit(b.label)}, {lit(band_request_suffix(b))})" for b in REFERENCE_BANDS) + ")"

# --- pages ------------------------------------------------------------------

_R = PAGE_RULES


def _route(url: str) -> str:
    arms = " ".join(f"WHEN contains({url}, {lit(p.url_contains)}) THEN {lit(p.site)}" for p in _R.profiles)
    return f"(CASE {arms} END)"


def _field(name: str) -> str:
    arms = []
    for p in _R.profiles:
        rule = next((f for f in p.fields if f.name == name), None)
        if rule is None:
            expr = "'Not found'"
        else:
            expr = select_text("cl", rule.selector)
            if rule.post_split:
                expr = f"nullif(split_part({expr}, {lit(rule.post_split)}, 2), '')"
            expr = f"coalesce({expr}, 'Not found')"
        arms.append(f"WHEN site = {lit(p.site)} THEN {expr}")
    return f"(CASE {' '.join(arms)} END)"


_dead = " OR ".join(f"contains(coalesce(title, ''), {lit(m)})" for m in _R.dead_title_markers) or "FALSE"

PAGE_STAGE = f"""
SELECT page_id, url, category, cl, empty, website, title, expired, site,
       CASE WHEN {_dead} THEN 'dead' WHEN expired THEN 'expired' ELSE 'live' END AS st
FROM (
  SELECT page_id, url, category, cl, empty,
         {website('url', _R.tld_token)} AS website,
         {select_text('cl', Selector('title'))} AS title,
         {select_found('cl', _R.expired)} AS expired,
         {_route('url')} AS site
  FROM (SELECT page_id, url, slice AS category, {clean('html')} AS cl,
               (html IS NULL OR trim(html) = '') AS empty FROM sp)
)"""

PAGE_REASON = f"""
SELECT *, CASE WHEN empty THEN 'empty page' WHEN website IS NULL THEN 'no www. in url'
               WHEN st <> 'live' THEN NULL WHEN site IS NULL THEN 'unknown site' END AS reason
FROM ({PAGE_STAGE})"""

_active = " ".join(f"WHEN live AND site = {lit(p.site)} THEN {lit(p.active_text)}" for p in _R.profiles)

PAGE_OFFERS = f"""
SELECT page_id, url,
       CASE WHEN ok THEN category END AS category,
       CASE WHEN ok THEN website END AS website,
       {', '.join(f"CASE WHEN live THEN {_field(n)} WHEN ok THEN 'Unknown' END AS {n}"
                  for n in ('offer_id', 'price', 'offer_title', 'location'))},
       CASE WHEN ok AND NOT live THEN 'No' {_active} END AS active,
       CASE WHEN ok THEN st ELSE 'quarantine' END AS status,
       reason
FROM (SELECT *, reason IS NULL AS ok, (st = 'live' AND reason IS NULL) AS live FROM ({PAGE_REASON}))"""

# --- listing pages: what the pages of fixtures.listing_pages must give -------------

LISTING_OFFERS = f"""
SELECT p_partkey AS page_id, {{url}} AS url,
       CASE WHEN kind NOT IN (2, 3, 11) THEN 'Unknown' END AS category,
       CASE WHEN kind IN (1, 7, 9) THEN 'otodom' WHEN kind NOT IN (2, 3, 11) THEN 'olx' END AS website,
       CASE WHEN kind IN (0, 1, 6, 8, 9, 10) THEN CAST(p_partkey AS VARCHAR) WHEN kind = 7 THEN 'Not found'
            WHEN kind IN (4, 5) THEN 'Unknown' END AS offer_id,
       CASE WHEN kind IN (0, 1, 8, 9, 10) THEN CAST(p_size AS VARCHAR) || ' 000 zł' WHEN kind IN (6, 7) THEN 'Not found'
            WHEN kind IN (4, 5) THEN 'Unknown' END AS price,
       CASE WHEN kind = 10 THEN p_name || ' & "' || n_name || '" ó' WHEN kind IN (0, 1, 6, 7, 8, 9) THEN p_name
            WHEN kind IN (4, 5) THEN 'Unknown' END AS offer_title,
       CASE WHEN kind IN (0, 1, 6, 8, 9, 10) THEN n_name WHEN kind = 7 THEN 'Not found' WHEN kind IN (4, 5) THEN 'Unknown' END
           AS location,
       CASE WHEN kind IN (4, 5) THEN 'No' WHEN kind NOT IN (2, 3, 11) THEN 'True' END AS active,
       CASE WHEN kind = 4 THEN 'dead' WHEN kind = 5 THEN 'expired' WHEN kind IN (2, 3, 11) THEN 'quarantine' ELSE 'live' END
           AS status,
       CASE kind WHEN 2 THEN 'unknown site' WHEN 3 THEN 'no www. in url' WHEN 11 THEN 'empty page' END AS reason
FROM (SELECT *, p_partkey % 12 AS kind FROM part JOIN nation ON n_nationkey = p_partkey % 25)""".replace("{url}", """(CASE
    WHEN kind IN (1, 7, 9) THEN 'https://www.otodom.pl/pl/oferta/' WHEN kind = 2 THEN 'https://www.other.pl/oferta/'
    WHEN kind = 3 THEN 'https://olx.pl/d/oferta/' ELSE 'https://www.olx.pl/d/oferta/' END || p_partkey || '.html')""")

LISTING_LINKS = """
SELECT p_partkey AS page_id, unnest([
    'https://www.olx.pl/d/oferta/' || p_partkey || '.html',
    'https://www.otodom.pl/pl/oferta/' || p_partkey || '.html',
    'https://www.olx.pl/d/o''hara-' || p_partkey || '.html',
    'https://www.olx.pl/d/plain-' || p_partkey || '.html',
    'https://www.olx.pl/d/spaced-' || p_partkey || '.html',
    'https://www.olx.pl/d/q?a=1&b=' || p_partkey || '.html']) AS link
FROM part"""

# --- offers view and merge inputs --------------------------------------------


def _url(k: str, www: bool = True) -> str:
    prefix = "'https://www.'" if www else "'https://'"
    return (f"({prefix} || CASE WHEN {k} % 2 = 0 THEN 'sitea' ELSE 'siteb' END || '.pl/d/' || "
            f"CAST({k} AS VARCHAR) || '.html')")


OFFERS_VIEW = f"""
SELECT {_url('p.p_partkey')} AS url,
       {last_label('p.p_size * 5')} AS category,
       {website(_url('p.p_partkey'), '.pl')} AS website,
       CASE WHEN p.p_partkey % 13 = 0 THEN 'Unknown' ELSE CAST(p.p_partkey AS VARCHAR) END AS offer_id,
       CASE p.p_partkey % 17 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Not found' WHEN 2 THEN '1d'
            WHEN 3 THEN '1_000' WHEN 4 THEN 'nan' WHEN 5 THEN ''
            WHEN 6 THEN ' ' || CAST(p.p_retailprice AS VARCHAR) || ' '
            ELSE CAST(p.p_retailprice AS VARCHAR) END AS price,
       CASE WHEN p.p_partkey % 19 = 0 THEN 'O''' || p.p_name ELSE p.p_name END AS offer_title,
       CASE WHEN p.p_partkey % 11 = 0 THEN 'Unknown' ELSE n.n_name END AS location,
       CASE p.p_partkey % 7 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'No' WHEN 2 THEN 'Yes'
            WHEN 3 THEN 'True' WHEN 4 THEN '1' WHEN 5 THEN '0' ELSE 'No data' END AS active,
       p.p_size
FROM part p LEFT JOIN nation n ON n.n_nationkey = p.p_partkey % 25"""

COLS = ("category", "website", "offer_id", "price", "offer_title", "location", "active")
ALL_COLS = ("url",) + COLS

BASE = f"SELECT {', '.join(ALL_COLS)} FROM ov WHERE p_size <= 30"

WHOLE_BASE = f"SELECT {', '.join(ALL_COLS)} FROM ov"

RECORD_UPDATES = f"""
SELECT {_url('p_partkey')} AS url, {last_label('p_size * 5')} AS category,
       {website(_url('p_partkey'), '.pl')} AS website, CAST(p_partkey AS VARCHAR) AS offer_id,
       CAST(p_partkey * 10 + p_size AS VARCHAR) AS price, p_name AS offer_title,
       p_brand AS location, 'Yes' AS active, 1 AS seq
FROM part WHERE p_size >= 20
UNION ALL
SELECT {_url('p_partkey')}, {last_label('p_size * 5')}, {website(_url('p_partkey'), '.pl')},
       CAST(p_partkey AS VARCHAR), CAST(p_partkey * 10 + p_size + 1 AS VARCHAR), upper(p_name),
       CAST(NULL AS VARCHAR), CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'No' ELSE 'True' END, 2
FROM part WHERE p_size >= 40"""

MAP_UPDATES = f"""
SELECT {_url('p_partkey')} AS url, {last_label('p_size * 5')} AS size_category,
       CAST(p_partkey AS VARCHAR) AS offer_id,
       CASE WHEN p_size >= 25 THEN CAST(p_partkey * 10 + p_size AS VARCHAR) END AS price,
       p_name AS offer_title, CAST(NULL AS VARCHAR) AS location,
       CASE WHEN p_type = 'SMALL' THEN CAST(NULL AS BOOLEAN) ELSE p_type <> 'PROMO' END AS is_active,
       1 AS seq
FROM part WHERE p_size >= 20
UNION ALL
SELECT CASE WHEN p_size = 50 THEN {_url('p_partkey', www=False)} ELSE {_url('p_partkey')} END,
       {last_label('p_size * 5')}, CAST(NULL AS VARCHAR),
       CAST(p_partkey * 10 + p_size + 1 AS VARCHAR), upper(p_name), p_type, p_type <> 'LARGE', 2
FROM part WHERE p_size >= 40"""

MAP_FIRST = ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS rn "
             "FROM mu) WHERE rn = 1")
MAP_FIRST_LAST = ("SELECT f.* REPLACE (l.is_active AS is_active) FROM (" + MAP_FIRST + ") f JOIN ("
                  "SELECT url, is_active FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq DESC) AS rn "
                  "FROM mu) WHERE rn = 1) l ON f.url = l.url")

STATUS_UPDATES = f"""
SELECT CASE WHEN p_type = 'STANDARD' THEN {_url('p_partkey', www=False)} ELSE {_url('p_partkey')} END AS url,
       CASE WHEN p_size = 1 THEN NULL WHEN p_type = 'PROMO' THEN 'No' ELSE 'Yes' END AS status
FROM part"""

_ins = {
    "category": "coalesce(u.size_category, 'Unknown')",
    "website": website("u.url", ".pl"),
    "offer_id": "coalesce(u.offer_id, 'Unknown')",
    "price": "coalesce(u.price, 'Unknown')",
    "offer_title": "coalesce(u.offer_title, 'Unknown')",
    "location": "coalesce(u.location, 'Unknown')",
    "active": "CASE WHEN coalesce(u.is_active, TRUE) THEN '1' ELSE '0' END",
}


def _merge_sql(matched: dict[str, str], reduced: str) -> str:
    cols = ["coalesce(b.url, u.url) AS url"]
    for c in COLS:
        cols.append(f"CASE WHEN b.url IS NOT NULL AND u.url IS NOT NULL THEN {matched[c]} "
                    f"WHEN b.url IS NOT NULL THEN b.{c} ELSE {_ins[c]} END AS {c}")
    cols.append("CASE WHEN b.url IS NOT NULL AND u.url IS NOT NULL THEN 'matched' "
                "WHEN b.url IS NOT NULL THEN 'kept' ELSE 'inserted' END AS change")
    return (f"WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({BASE}), mu AS ({MAP_UPDATES}), "
            f"ml AS ({reduced}) SELECT * FROM (SELECT {', '.join(cols)} "
            f"FROM b0 b FULL OUTER JOIN ml u ON b.url = u.url) WHERE website IS NOT NULL")


_fill_matched = {c: f"b.{c}" for c in COLS}
_fill_matched["active"] = f"CASE WHEN b.active = 'Unknown' THEN {_ins['active']} ELSE b.active END"

_cond_matched = {c: f"CASE WHEN b.active = 'Unknown' THEN {_ins[c]} ELSE b.{c} END" for c in COLS}
_cond_matched["active"] = _ins["active"]
_cond_matched["website"] = f"coalesce(CASE WHEN b.active = 'Unknown' THEN {_ins['website']} END, b.website)"

_upsert_cols = ", ".join(
    [f"coalesce(u.url, b.url) AS url"]
    + [f"CASE WHEN u.url IS NOT NULL THEN coalesce(u.{c}, 'No data') ELSE b.{c} END AS {c}" for c in COLS])

_present = lambda c: (f"NOT ({c} IS NULL OR trim({c}) = '' OR {c} IN ('Unknown', 'Not found', 'No data') "  # noqa: E731
                      f"OR starts_with({c}, 'Unknown exception at '))")

_OVN = f"WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), ovn AS (SELECT *, {strict_number('price')} AS price_numeric FROM ov)"


def _boxplot(src: str, g: str, x: str) -> str:
    return f"""
, v AS (SELECT {g} AS g, {x} AS x FROM {src} WHERE {x} IS NOT NULL),
q AS (SELECT g, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM v GROUP BY g),
w AS (SELECT v.g,
             min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1)) AS lower_whisker,
             max(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1)) AS upper_whisker,
             count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1)) AS n_outliers_low,
             count(*) FILTER (WHERE x > q3 + 1.5 * (q3 - q1)) AS n_outliers_high
      FROM v JOIN q ON v.g = q.g GROUP BY v.g)
SELECT q.g AS {g}, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(q3 - q1, 4) AS iqr, round(lower_whisker, 4) AS lower_whisker,
       round(upper_whisker, 4) AS upper_whisker, n_outliers_low, n_outliers_high
FROM q JOIN w ON q.g = w.g"""


# M1 after both rounds, as common table expressions that end in `done`.
_DONE = f"""WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({BASE}), ru AS ({RECORD_UPDATES}),
rl AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq DESC) AS rn FROM ru) WHERE rn = 1),
done AS (SELECT {_upsert_cols} FROM b0 b FULL OUTER JOIN rl u ON b.url = u.url)"""
_COUNTED = ("category", "offer_id", "price", "offer_title", "location", "active")

_TITLE = """CASE p_partkey % 5 WHEN 0 THEN p_name || ' {' || p_size || '}' WHEN 1 THEN '"' || p_name || '", "x": {'
    WHEN 2 THEN p_name || ' ' || chr(92) || '} ' || chr(92) WHEN 3 THEN p_name || chr(10) || '}{' ELSE p_name END"""

ORACLE: dict[str, str] = {
    "links_extracted": f"SELECT page_id, href FROM ({ANCHORS})",
    "links_absolute": LINKS_ABSOLUTE,
    "links_distinct": f"SELECT DISTINCT link AS url FROM ({LINKS_ABSOLUTE})",
    "links_reconcile": f"""
WITH l AS (SELECT DISTINCT link AS k FROM ({LINKS_ABSOLUTE})), p AS (SELECT DISTINCT url AS k FROM pages)
SELECT count(l.k) AS n_links, count(p.k) AS n_keys,
       count(*) FILTER (WHERE p.k IS NULL) AS links_without_key,
       count(*) FILTER (WHERE l.k IS NULL) AS keys_without_link
FROM l FULL OUTER JOIN p ON l.k = p.k""",
    "links_tagged": f"WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}) SELECT DISTINCT url, category FROM ({SLICE_LINKS})",
    "links_overlay": f"WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}) "
                     f"SELECT url, arg_max(category, ord) AS category FROM ({SLICE_LINKS}) GROUP BY url",
    "band_requests": f"""
WITH {REQUESTS_CTE},
bs AS (SELECT DISTINCT regexp_extract(url, {lit('^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)')}, 1) || '/' AS base FROM pages)
SELECT base, ord, category, base || suffix AS request_url FROM bs CROSS JOIN reqs""",
    "page_website": f"SELECT page_id, url, {website('url', PAGE_RULES.tld_token)} AS website FROM pages",
    "page_heading": f"SELECT page_id, {select_text(clean('html'), Selector('h1'))} AS heading FROM pages",
    "page_status": f"""
SELECT page_id, url, title, is_expired, is_dead,
       CASE WHEN is_dead THEN 'dead' WHEN is_expired THEN 'expired' ELSE 'live' END AS status
FROM (SELECT page_id, url, title, is_expired, ({_dead}) AS is_dead FROM (
  SELECT page_id, url, {select_text('cl', Selector('title'))} AS title,
         {select_found('cl', PAGE_RULES.expired)} AS is_expired
  FROM (SELECT page_id, url, {clean('html')} AS cl FROM pages)))""",
    "page_offers": f"WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}) {PAGE_OFFERS}",
    "band_counts": f"""
WITH {BANDS_CTE}
SELECT b.label AS category, count(*) AS n FROM part p JOIN bands b ON {band_match('p.p_size * 5')}
GROUP BY b.label""",
    "band_last_wins": f"WITH {BANDS_CTE} SELECT p_partkey, {last_label('p_size * 5')} AS category FROM part",
    "range_assign_table": """
WITH bands AS (SELECT CAST(p_partkey AS BIGINT) AS ord, CAST(p_partkey AS VARCHAR) AS label,
                      CAST(floor(p_retailprice * 100) AS BIGINT) - p_size AS lo,
                      CAST(floor(p_retailprice * 100) AS BIGINT) + p_size AS hi FROM part),
     items AS (SELECT l_orderkey, l_linenumber, row_number() OVER () AS line,
                      CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) AS v FROM lineitem)
SELECT any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber,
       count(b.ord) AS n_bands, arg_max(b.label, b.ord) AS category
FROM items LEFT JOIN bands b ON v >= b.lo AND v <= b.hi GROUP BY line""",
    "route_table": """
SELECT page_id, any_value(url) AS url, arg_min(c_name, (-c_acctbal, c_custkey)) AS site
FROM pages LEFT JOIN customer ON contains(url, '/' || CAST(c_custkey AS VARCHAR)) GROUP BY page_id""",
    "band_price_order": f"""{_OVN}
SELECT url, category, price_numeric,
       row_number() OVER (PARTITION BY category ORDER BY price_numeric ASC NULLS LAST, url) AS rank_in_band
FROM ovn""",
    "upsert_overwrite": f"""
WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({BASE}), ru AS ({RECORD_UPDATES}),
rl AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq DESC) AS rn FROM ru) WHERE rn = 1)
SELECT {_upsert_cols} FROM b0 b FULL OUTER JOIN rl u ON b.url = u.url""",
    "merge_fill_unknown": _merge_sql(_fill_matched, MAP_FIRST),
    "merge_conditional": _merge_sql(_cond_matched, MAP_FIRST_LAST),
    "merge_rejects": f"""
WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({BASE}), mu AS ({MAP_UPDATES}), ml AS ({MAP_FIRST})
SELECT url, 'no www. in url' AS reason FROM ml
WHERE url NOT IN (SELECT url FROM b0) AND {website('url', '.pl')} IS NULL""",
    "status_update": f"""
WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({WHOLE_BASE}),
su AS (SELECT url, max(status) AS status FROM ({STATUS_UPDATES}) GROUP BY url)
SELECT b.url, b.category, b.website, b.offer_id, b.price, b.offer_title, b.location,
       CASE WHEN su.status IS NOT NULL THEN su.status ELSE b.active END AS active,
       su.status IS NOT NULL AS updated
FROM b0 b LEFT JOIN su ON b.url = su.url""",
    "status_unmatched": f"""
WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({WHOLE_BASE})
SELECT DISTINCT url FROM ({STATUS_UPDATES}) WHERE url NOT IN (SELECT url FROM b0)""",
    "key_lookup": f"""
WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({WHOLE_BASE})
SELECT * FROM b0 WHERE url IN (SELECT {_url('l_partkey')} FROM lineitem)""",
    "bool_codec": """
SELECT doc_id, quality, toxic, coalesce(quality <> 0, TRUE) AS quality_flag,
       coalesce(toxic <> 0, TRUE) AS toxic_flag,
       CASE WHEN coalesce(quality <> 0, TRUE) THEN 1 ELSE 0 END AS quality_code
FROM labels""",
    "latest_per_key": """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
    "category_counts": f"WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}) "
                       f"SELECT category, count(*) AS n_offers FROM ov WHERE category IS NOT NULL GROUP BY category",
    "website_counts": f"WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}) "
                      f"SELECT website, count(*) AS n_offers FROM ov WHERE website IS NOT NULL GROUP BY website",
    "price_numeric": f"{_OVN} SELECT url, price, price_numeric FROM ovn",
    "price_boxplot": _OVN + _boxplot("ovn", "category", "price_numeric"),
    "price_gate": f"""{_OVN}
, s AS (SELECT category, count(*) AS n FROM ovn WHERE price_numeric IS NOT NULL GROUP BY category)
SELECT count(*) AS n_groups, min(n) AS min_group_size, coalesce(min(n) > 1, FALSE) AS enough_data FROM s""",
    "event_value_boxplot": "WITH e AS (SELECT * FROM events)" + _boxplot("e", "event_type", "value"),
    "event_value_outliers": """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM events WHERE value IS NOT NULL GROUP BY event_type)
SELECT e.event_type, e.event_id, e.value,
       CASE WHEN e.value < q.q1 - 1.5 * (q.q3 - q.q1) THEN 'low' ELSE 'high' END AS side
FROM events e JOIN q ON e.event_type IS NOT DISTINCT FROM q.event_type
WHERE e.value < q.q1 - 1.5 * (q.q3 - q.q1) OR e.value > q.q3 + 1.5 * (q.q3 - q.q1)""",
    "completeness": f"""
WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW})
SELECT website, count(*) AS n_offers,
       {', '.join(f"round(avg(CASE WHEN {_present(c)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS {c}_complete"
                  for c in ('category', 'offer_id', 'price', 'offer_title', 'location', 'active'))}
FROM ov GROUP BY ROLLUP (website)""",
    "snapshot_roundtrip": f"WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}) SELECT {', '.join(ALL_COLS)} FROM ov",
    "link_list_roundtrip": f"SELECT DISTINCT link AS url FROM ({LINKS_ABSOLUTE})",
    "offer_map_roundtrip": f"WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}) "
                           f"SELECT url, arg_max(category, ord) AS category FROM ({SLICE_LINKS}) GROUP BY url",
    "parse_counts": f"""WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}), po AS ({PAGE_OFFERS})
SELECT count(*) AS pages, count(*) FILTER (WHERE reason IS NULL) AS offers,
       count(*) FILTER (WHERE status = 'live') AS live, count(*) FILTER (WHERE status = 'dead') AS dead,
       count(*) FILTER (WHERE status = 'expired') AS expired,
       count(*) FILTER (WHERE reason IS NOT NULL) AS quarantined
FROM po""",
    "offers_from_map": f"""WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}), po AS ({PAGE_OFFERS}),
pl AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id DESC) AS rn FROM po) WHERE rn = 1),
lm AS (SELECT url, arg_max(category, ord) AS category FROM (
  SELECT url, slice AS category, slice_ord AS ord FROM sp
  UNION ALL SELECT url, category, ord FROM ({SLICE_LINKS})) GROUP BY url)
SELECT pl.page_id, lm.url,
       CASE WHEN pl.page_id IS NOT NULL AND pl.reason IS NULL THEN coalesce(lm.category, 'Unknown') END AS category,
       {', '.join(f"CASE WHEN pl.page_id IS NOT NULL THEN pl.{c} END AS {c}"
                  for c in ('website', 'offer_id', 'price', 'offer_title', 'location', 'active'))},
       CASE WHEN pl.page_id IS NULL THEN 'quarantine' ELSE pl.status END AS status,
       CASE WHEN pl.page_id IS NULL THEN 'page missing' ELSE pl.reason END AS reason
FROM lm LEFT JOIN pl ON lm.url = pl.url""",
    "event_minute_stamps": "SELECT strftime(ts, '%Y%m%d%H%M') AS stamp, count(*) AS n FROM events GROUP BY 1",
    "offer_map_load": f"""WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}),
m AS (SELECT url, arg_max(category, ord) AS category FROM ({SLICE_LINKS}) GROUP BY url)
SELECT url, category, {website('url', _R.tld_token)} AS website, 'Unknown' AS offer_id, 'Unknown' AS price,
       'Unknown' AS offer_title, 'Unknown' AS location, '1' AS active, NULL AS reason
FROM m WHERE {website('url', _R.tld_token)} IS NOT NULL
UNION ALL
SELECT url, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no www. in url'
FROM m WHERE {website('url', _R.tld_token)} IS NULL""",
    "upsert_incremental": f"{_DONE} SELECT * FROM done",
    "counts_incremental": f"""{_DONE}
SELECT 'category' AS measure, category AS value, count(*) AS n FROM done GROUP BY category
UNION ALL SELECT 'website', website, count(*) FROM done GROUP BY website
""" + "".join(f"""UNION ALL SELECT '{c}_present', website, count(*) FROM done WHERE {_present(c)} GROUP BY website
""" for c in _COUNTED),
    "price_quartiles_sketch": f"""{_DONE}, priced AS (SELECT category, {strict_number('price')} AS p FROM done)
SELECT category, count(*) AS n, TRUE AS q1_near, TRUE AS median_near, TRUE AS q3_near FROM priced WHERE p IS NOT NULL GROUP BY category""",
    "unique_keys": f"""
WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({BASE}), ru AS ({RECORD_UPDATES}),
u AS (SELECT url FROM b0 UNION ALL SELECT url FROM ru)
SELECT count(*) AS n_rows, count(*) - count(DISTINCT url) AS n_repeated,
       (SELECT min(url) FROM (SELECT url FROM u GROUP BY url HAVING count(*) > 1)) AS first_repeated FROM u""",
    "key_lookup_pruned": f"""
WITH {BANDS_CTE}, ov AS ({OFFERS_VIEW}), b0 AS ({WHOLE_BASE})
SELECT * FROM b0 WHERE url IN (SELECT {_url('l_partkey')} FROM lineitem)""",
    "offer_map_object": f"""
SELECT {_url('p_partkey')} AS url, CAST(p_size * 5 AS VARCHAR) AS category, {_TITLE} AS offer_title, NULL AS raw
FROM part WHERE p_partkey % 23 <> 0
UNION ALL SELECT NULL, NULL, NULL, '"' || {_url('p_partkey')} || '": 17' FROM part WHERE p_partkey % 23 = 0
UNION ALL SELECT NULL, NULL, NULL, '"https://www.cut.pl/d/x": {{"size_category": "a' || chr(10) || '}}'
FROM (SELECT DISTINCT p_brand FROM part WHERE p_size % 8 = 3)""",
    "stream_counts": f"""WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}), po AS ({PAGE_OFFERS})
SELECT count(*) AS pages, count(*) FILTER (WHERE reason IS NULL) AS offers,
       count(*) FILTER (WHERE status = 'live') AS live, count(*) FILTER (WHERE status = 'dead') AS dead,
       count(*) FILTER (WHERE status = 'expired') AS expired,
       count(*) FILTER (WHERE reason IS NOT NULL) AS quarantined
FROM po""",
    "listing_offers": LISTING_OFFERS,
    "listing_links": LISTING_LINKS,
    "extract_job": f"""
SELECT url, CASE WHEN reason IS NULL THEN size_class END AS category, website, offer_id, price,
       offer_title, location, active, reason
FROM (SELECT l.*, 'c' || (page_id % 3) AS size_class FROM ({LISTING_OFFERS}) l)
UNION ALL
SELECT 'https://www.olx.pl/d/gone/' || p_partkey || '.html', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'page missing'
FROM part""",
    "stream_quarantine": f"""WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}), po AS ({PAGE_OFFERS})
SELECT page_id, url, reason FROM po WHERE reason IS NOT NULL""",
    "stream_offers": f"""WITH {BANDS_CTE}, sp AS ({SLICED_PAGES}), po AS ({PAGE_OFFERS})
SELECT {', '.join(ALL_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id DESC) AS rn FROM po WHERE reason IS NULL)
WHERE rn = 1""",
}
