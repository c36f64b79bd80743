"""Site rules as data.

Every site-specific choice (hosts, selectors, dead-page markers, link
filters, size bands) is a value here, compiled to column expressions by the
operators.  `REFERENCE_*` are the values of the original listing tool;
`SYNTHETIC_*` fit the driver's generated `pages` table, which carries no
listing markup, so tests and oracle queries can exercise every rule shape.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from .functions.html import Selector


@dataclass(frozen=True)
class FieldRule:
    """One extracted field: selector, then an optional literal split."""

    name: str
    selector: Selector
    post_split: str | None = None


@dataclass(frozen=True)
class SiteProfile:
    site: str
    url_contains: str
    fields: tuple[FieldRule, ...]
    active_text: str = "True"


@dataclass(frozen=True)
class PageRules:
    """Router order matters: the first profile whose token is in the URL wins."""

    profiles: tuple[SiteProfile, ...]
    dead_title_markers: tuple[str, ...]
    expired: Selector
    tld_token: str = ".pl"


@dataclass(frozen=True)
class LinkRules:
    """Which hrefs become offer links.

    suffix            keep hrefs ending with it
    base              prefix for relative (`/...`) hrefs; None -> the page's
                      own `scheme://host`
    allowed_prefixes  absolute hrefs kept only when they start with one of
                      these; every other absolute href is dropped
    """

    suffix: str = "html"
    base: str | None = None
    allowed_prefixes: tuple[str, ...] = field(default_factory=tuple)


@dataclass(frozen=True)
class Band:
    ord: int
    label: str
    lo: int | None
    hi: int | None


# --- fixed values: the original tool's rules --------------------------------
REFERENCE_BANDS = (
    Band(0, "-25", None, 25),
    Band(1, "25-40", 25, 40),
    Band(2, "40-50", 40, 50),
    Band(3, "50-60", 50, 60),
    Band(4, "60-70", 60, 70),
    Band(5, "70-80", 70, 80),
    Band(6, "80-100", 80, 100),
    Band(7, "100-120", 100, 120),
    Band(8, "120-150", 120, 150),
    Band(9, "150-", 150, None),
)

REFERENCE_SEARCH_BASE = "https://www.olx.pl/nieruchomosci/mieszkania/sprzedaz/warszawa/"
REFERENCE_SEARCH_ORDER = "search%5Border%5D=filter_float_price:asc"
REFERENCE_AREA_FROM = "search%5Bfilter_float_m:from%5D="
REFERENCE_AREA_TO = "search%5Bfilter_float_m:to%5D="

REFERENCE_LINK_RULES = LinkRules(
    suffix="html",
    base="https://www.olx.pl",
    allowed_prefixes=("https://www.otodom.pl",),
)

REFERENCE_DEAD_MARKERS = ("404", "Ups, mamy problem", "Archiwalne:")
REFERENCE_EXPIRED = Selector("div", (("data-testid", "ad-inactive-msg"),), child="h4")

REFERENCE_PARTNER = SiteProfile(
    site="otodom",
    url_contains="https://www.otodom.pl",
    fields=(
        FieldRule("offer_id", Selector("p", text_prefix="ID"), post_split="ID: "),
        FieldRule("price", Selector("strong", (("aria-label", "Cena"),))),
        FieldRule("offer_title", Selector("h1", (("data-cy", "adPageAdTitle"),))),
        FieldRule("location", Selector("*", (("id", "map"),), path=(("div", 1),))),
    ),
)
REFERENCE_BASE = SiteProfile(
    site="olx",
    url_contains="https://www.olx.pl",
    fields=(
        FieldRule("offer_id",
                  Selector("div", (("data-testid", "ad-footer-bar-section"),), path=(("span", 1),)),
                  post_split="ID: "),
        FieldRule("price", Selector("div", (("data-testid", "ad-price-container"),), path=(("h3", None),))),
        FieldRule("offer_title", Selector("div", (("data-cy", "ad_title"),), path=(("h4", None),))),
        FieldRule("location", Selector("*", (("id", "mainContent"),), path=(
            ("div", None), ("div", 2), ("div", 3), ("div", 2), ("div", 2), ("div", None), ("section", None), ("div", 1), ("div", None),
            ("p", 1)))),
    ),
)
REFERENCE_PAGE_RULES = PageRules(
    profiles=(REFERENCE_PARTNER, REFERENCE_BASE),
    dead_title_markers=REFERENCE_DEAD_MARKERS,
    expired=REFERENCE_EXPIRED,
    tld_token=".pl",
)
# ---------------------------------------------------------------------------


def band_request_suffix(band: Band) -> str:
    """Query string of one size slice: price order, then the area bounds."""
    parts = [REFERENCE_SEARCH_ORDER]
    if band.lo is not None:
        parts.append(f"{REFERENCE_AREA_FROM}{band.lo}")
    if band.hi is not None:
        parts.append(f"{REFERENCE_AREA_TO}{band.hi}")
    return "?" + "&".join(parts)


# Rules fitted to the driver's synthetic pages (no listing markup there).
SYNTHETIC_LINK_RULES = LinkRules(suffix="e", base=None, allowed_prefixes=("https://www.",))

SYNTHETIC_PAGE_RULES = PageRules(
    profiles=(
        SiteProfile(
            site="secure",
            url_contains="https://www.",
            fields=(
                FieldRule("offer_id", Selector("nav", child="a", nth=2)),
                FieldRule("price", Selector("div", (("class", "ad"),))),
                FieldRule("offer_title", Selector("article", child="h1")),
                FieldRule("location", Selector("footer"), post_split="· "),
            ),
        ),
        SiteProfile(
            site="plain",
            url_contains="http://www.",
            fields=(
                FieldRule("offer_id", Selector("footer"), post_split="© "),
                FieldRule("price", Selector("nav", child="li")),
                FieldRule("offer_title", Selector("h1")),
                FieldRule("location", Selector("div", (("class", "ad"),))),
            ),
        ),
    ),
    dead_title_markers=("Eriner", "thanedble", "attion"),
    expired=Selector("html", (("lang", "de"),), child="h1"),
    tld_token=".example",
)
