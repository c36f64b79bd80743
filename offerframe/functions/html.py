"""HTML as text: cleaning, element text and selector regexes.

Stored pages are not well-formed XML, so the DOM is approximated with
regular expressions that run inside the JVM (`regexp_replace`,
`regexp_extract`), keeping every step in whole-stage codegen.  Patterns stay
inside the subset shared by Java regex and RE2 (no look-around, no
back-references) so the same text also runs in an SQL oracle.

Selectors of the site rules are answered from a page's elements
(`operators.elements`).  The one-pattern form here (`select_inner`) serves where a
tag name alone is asked for; its limits (tested in tests/test_html.py):
* the body ends at the first closing tag of the same name, so a nested element
  of that name cuts it short, and a `>` inside an attribute value ends the tag;
* an unclosed `<script>` / `<style>` is kept as text;
* text is the markup's text, not the browser's rendered text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Script, style and comment bodies never carry visible text; removing them
# first stops markers such as "</p>" inside a script from matching.
CLEAN_PATTERN = (
    r"(?is)<(?:script(?:[ \t\r\n/][^>]*)?>.*?</script[ \t\r\n]*>"
    r"|style(?:[ \t\r\n/][^>]*)?>.*?</style[ \t\r\n]*>"
    r"|!--.*?-->)"
)
# (One leading `<` outside the alternation: the scan tests a single
# character per position instead of three -- about 2x faster in Java.)

# Tags that break a line when rendered: replaced by a space, other tags by ''.
BLOCK_TAG_PATTERN = (
    r"(?i)</?(?:br|p|div|li|ul|ol|h[1-6]|tr|td|th|table|section|article"
    r"|header|footer|nav|main|aside|dd|dt|dl|blockquote|pre|form)(?:[ \t\r\n/][^>]*)?>"
)
ANY_TAG_PATTERN = r"<[^>]*>"
SPACE_RUN_PATTERN = r"[ \t\r\n\f]+"

# --- fixed values: entity decoding, `&amp;` last ----------------------------
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&oacute;", "ó"),
    ("&Oacute;", "Ó"),
    ("&euro;", "€"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&hellip;", "…"),
    ("&amp;", "&"),
]
# ---------------------------------------------------------------------------

_META = set("\\.^$|?*+()[]{}")


def regex_escape(text: str) -> str:
    """Escape regex metacharacters; valid in both Java regex and RE2."""
    return "".join("\\" + ch if ch in _META else ch for ch in text)


def clean_html(html: Column) -> Column:
    return F.regexp_replace(html, F.lit(CLEAN_PATTERN), F.lit(""))


def _numeric(text: Column) -> Column:
    """Decimal and hexadecimal character references decoded (valid code points only)."""
    mark = "&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
    found = F.regexp_extract_all(text, F.lit(mark), F.lit(1))

    def char(ref: Column) -> Column:
        number = F.when(F.lower(ref).startswith("x"), F.conv(F.substring(ref, 2, 6), 16, 10)).otherwise(ref).cast("long")
        fits = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number < 0x110000))
        return F.when(fits, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))

    return F.array_join(F.transform(F.split(text, mark), lambda piece, i: F.concat(
        piece, F.coalesce(F.get(F.transform(found, char), i), F.lit("")))), "")


def unescape(text: Column) -> Column:
    """Character references decoded, `&amp;` last, so nothing is decoded twice; texts without any are left alone."""
    out = F.when(text.contains("&#"), _numeric(text)).otherwise(text)
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(text.contains("&"), out).otherwise(text)


def element_text(fragment: Column) -> Column:
    """Markup fragment -> text: tags out, entities decoded, spaces squeezed.

    Empty text becomes NULL so callers can tell "no text" from a value.
    """
    t = F.regexp_replace(fragment, F.lit(BLOCK_TAG_PATTERN), F.lit(" "))
    t = F.regexp_replace(t, F.lit(ANY_TAG_PATTERN), F.lit(""))
    t = unescape(t)
    t = F.trim(F.regexp_replace(t, F.lit(SPACE_RUN_PATTERN), F.lit(" ")))
    return F.nullif(t, F.lit(""))


@dataclass(frozen=True)
class Selector:
    """The selector shapes the site rules need.

    tag         element name, `*` for any
    attrs       attribute equalities on the element, in markup order
    child       optional child tag whose text is wanted
    nth         1-based position of `child` (or of the element)
    text_prefix element text must start with this (tags may split it)
    path        steps (tag, position) from the element down to the one wanted, each to
                the n-th child element of that name, or to any (position None)

    `child` is any descendant; a single step of `path` is a child of the element.
    """

    tag: str
    attrs: tuple[tuple[str, str], ...] = field(default_factory=tuple)
    child: str | None = None
    nth: int = 1
    text_prefix: str | None = None
    path: tuple[tuple[str, int | None], ...] = field(default_factory=tuple)


def _open_tag(tag: str, attrs=()) -> str:
    name = "[a-zA-Z][a-zA-Z0-9]*" if tag == "*" else regex_escape(tag)
    parts = [f"<{name}"]
    for attr, value in attrs:
        parts.append(f"[^>]*[ \\t\\r\\n]{regex_escape(attr)}=[\"']{regex_escape(value)}[\"']")
    if attrs:
        parts.append("[^>]*>")
    else:
        parts.append("(?:[ \\t\\r\\n/][^>]*)?>")
    return "".join(parts)


def _close_tag(tag: str) -> str:
    name = "[a-zA-Z][a-zA-Z0-9]*" if tag == "*" else regex_escape(tag)
    return f"</{name}[ \\t\\r\\n]*>"


def element_pattern(sel: Selector) -> str:
    """Regex whose group 1 is the inner markup of an element without child or path."""
    skip = ""
    if sel.nth > 1:
        skip = f"(?:{_open_tag(sel.tag, sel.attrs)}.*?{_close_tag(sel.tag)}.*?){{{sel.nth - 1}}}"
    return f"(?is){skip}{_open_tag(sel.tag, sel.attrs)}(.*?){_close_tag(sel.tag)}"


# --- fixed values: elements that have no closing tag --------------------------
VOID_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def select_inner(clean: Column, sel: Selector) -> Column:
    """Inner markup of the first element with the selector's tag and attributes ('' if none).

    One scan of the (large) cleaned page.  Keep the result in its own
    column before deriving text from it: `element_text` refers to its input
    twice, and a column reference is what stops the scan being repeated.
    """
    return F.regexp_extract(clean, element_pattern(sel), 1)


def select_text(clean: Column, sel: Selector) -> Column:
    """Text of the first selected element, NULL when absent or empty.

    Convenient for small inputs; on page-sized text use `with_texts`,
    which stages the scan so it runs once.
    """
    return element_text(select_inner(clean, sel))


def with_texts(df: DataFrame, clean_col: str, selectors: dict[str, Selector]) -> DataFrame:
    """Add one text column per selector: one regex scan each, then the
    cheap text clean-up on the (small) extracted piece."""
    raw = {name: f"_raw_{name}" for name in selectors}
    staged = df.select("*", *[select_inner(F.col(clean_col), sel).alias(raw[name])
                              for name, sel in selectors.items()])
    return staged.select(*df.columns, *[element_text(F.col(raw[name])).alias(name)
                                        for name in selectors])


def title_text(clean: Column) -> Column:
    return select_text(clean, Selector("title"))
