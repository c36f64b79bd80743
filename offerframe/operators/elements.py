"""A page's elements as a table, and selectors answered from it.

One pass over a page's tags numbers its elements: name, attributes, parent,
position among the parent's children of that name, and the interval of text
between its tags.  An element lies inside another one exactly if its interval
lies inside the other's, and it is a child if its parent is the other.  So every
selector of every rule is a filter over that one array, and none of them walks
the page again: attribute, child or descendant, n-th child, a path of steps, a
beginning of the text, and the first element in page order that any of them fits.

The numbering is the only step in Python (one scan of the tags, Arrow batches); the
selectors are column expressions.

Defined results: attribute values may be quoted, unquoted or hold `>`; a later
attribute of the same name does not hide an earlier one; comments, scripts and
styles have no elements inside; void elements and `<x/>` are empty; an element
whose closing tag is missing ends with its parent, or where a sibling of its kind
(`p`, `li`, `td`, ...) begins; closing tags without an element are ignored.  NULL and
empty pages have no elements.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.html import VOID_ELEMENTS, Selector, clean_html, element_text
from ..session import ship_code

ELEMENTS = "_els"
ELEMENT = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                        T.StructField("attrs", T.StringType()), T.StructField("parent", T.IntegerType()),
                        T.StructField("nth", T.IntegerType()), T.StructField("begin", T.IntegerType()),
                        T.StructField("end", T.IntegerType())])

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_VOID = frozenset(VOID_ELEMENTS)
# --- fixed values: elements whose content is text, and those that a sibling of their kind ends ---
_TEXT_ONLY = {n: re.compile(rf"</{n}[\s>/]", re.I) for n in ("script", "style", "title", "textarea")}
_ENDED_BY_SIBLING = frozenset(("p", "li", "td", "th", "tr", "dt", "dd", "option"))


def attribute_text(name: str, value: str) -> str:
    """How an attribute stands in `attrs`: ` name="value"`."""
    return f' {name.lower()}="{value.replace(chr(34), "&quot;")}"'


def number_elements(html: str) -> list[list]:
    """[name, attrs, parent, nth, begin, end] of every element, in page order; the place is the number."""
    out, open_, names = [], [], {}    # open_: numbers of the elements not ended yet; names: how many of each name
    seen: list[dict] = [{}]           # children per name, of the page and of each open element
    at = 0

    def end(to: int) -> None:
        k = open_.pop()
        out[k][5] = to
        names[out[k][0]] -= 1
        seen.pop()

    while (m := _TAG.search(html, at)) is not None:
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if names.get(name):
                while out[open_[-1]][0] != name:
                    end(m.start())
                end(m.start())
            continue
        if name in _ENDED_BY_SIBLING and open_ and out[open_[-1]][0] == name:
            end(m.start())
        raw = m[3]
        attrs = "".join([attribute_text(a[0], a[1] or a[2] or a[3]) for a in _ATTRIBUTE.findall(raw)]) if len(raw) > 2 else ""
        nth = seen[-1][name] = seen[-1].get(name, 0) + 1
        out.append([name, attrs, open_[-1] if open_ else -1, nth, at, at])
        if name in _VOID or raw.endswith("/"):
            continue
        if name in _TEXT_ONLY:
            close = _TEXT_ONLY[name].search(html, at)
            if close is not None:
                out[-1][5] = at = close.start()
                at = html.find(">", at) + 1 or len(html)
                continue
        open_.append(len(out) - 1)
        names[name] = names.get(name, 0) + 1
        seen.append({})
    while open_:
        end(len(html))
    return out


_CHUNK_BYTES = 1 << 20  # pages numbered at a time: their elements are Python objects, many times as large


def chunks(batch: pa.RecordBatch, html_col: str, limit: int = _CHUNK_BYTES):
    """`batch` in slices of at most `limit` bytes of html; a longer page is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(html_col)), 0).to_numpy(zero_copy_only=False))
    at, before = 0, 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at, before = to, int(ends[to - 1])


def _numbered(html_col: str, out_type: pa.DataType):
    def run(batches):
        for batch in (part for whole in batches for part in chunks(whole, html_col)):
            flat, sizes = [], []
            for html in batch.column(html_col).to_pylist():
                found = number_elements(html) if html else []
                flat += found
                sizes.append(len(found))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = np.arange(len(flat), dtype=np.int32) - np.repeat(offsets[:-1], sizes)
            name, attrs, parent, nth, begin, end = zip(*flat) if flat else [()] * 6
            values = pa.StructArray.from_arrays(
                [pa.array(ids, pa.int32()), pa.array(name, pa.string()), pa.array(attrs, pa.string()), pa.array(parent, pa.int32()),
                 pa.array(nth, pa.int32()), pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
                names=[f.name for f in ELEMENT.fields])
            column = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, column.cast(out_type)], names=[*batch.schema.names, ELEMENTS])

    return run


def with_elements(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """`pages` with their elements as an array column.  Select the columns that are needed first."""
    from pyspark.sql.pandas.types import to_arrow_type

    ship_code(pages.sparkSession)
    kind = T.ArrayType(ELEMENT)
    schema = T.StructType([*pages.schema.fields, T.StructField(ELEMENTS, kind)])
    return pages.mapInArrow(_numbered(html_col, to_arrow_type(kind)), schema)


def element_table(pages: DataFrame, keep: tuple[str, ...] = ("page_id",), html_col: str = "html") -> DataFrame:
    """One row per element of every page: keep..., id, name, attrs, parent, nth, begin, end."""
    own = with_elements(pages.select(*keep, html_col), html_col)
    return own.select(*keep, F.explode(ELEMENTS).alias("e")).select(*keep, "e.*")


# --- selectors ----------------------------------------------------------------------------

def _is(e: Column, tag: str, attrs=()) -> Column:
    cond = F.lit(True) if tag == "*" else e["name"] == F.lit(tag.lower())
    for name, value in attrs:
        cond = cond & e["attrs"].contains(attribute_text(name, value))
    return cond


def inner(html: Column, e: Column) -> Column:
    """The markup inside an element."""
    return html.substr(e["begin"] + 1, e["end"] - e["begin"])


def _bound(value: Column, use) -> Column:
    """`use(value)` with `value` computed once: inside a lambda it would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _children(els: Column, parents: Column, tag: str, nth: int | None) -> Column:
    """The children of some elements: all of a name, or the n-th of it."""
    def fits(over):
        return lambda e: _is(e, tag) & (F.lit(True) if nth is None else e["nth"] == nth) & F.array_contains(over, e["parent"])

    return _bound(F.transform(parents, lambda a: a["id"]), lambda over: F.filter(els, fits(over)))


def selected(els: Column, html: Column, sel: Selector) -> Column:
    """The elements that a selector fits, in page order."""
    now = F.filter(els, lambda e: _is(e, sel.tag, sel.attrs))
    if sel.child is not None:
        now = _bound(now, lambda anchors: F.filter(els, lambda e: _is(e, sel.child) & F.exists(
            anchors, lambda a: (a["begin"] <= e["begin"]) & (e["end"] <= a["end"]) & (a["id"] < e["id"]))))
    for tag, nth in sel.path:
        now = _children(els, now, tag, nth)
    if sel.text_prefix is not None:
        now = F.filter(now, lambda e: F.coalesce(element_text(clean_html(inner(html, e))), F.lit("")).startswith(sel.text_prefix))
    return now


def select_element(els: Column, html: Column, sel: Selector) -> Column:
    """The selector's element (a struct; NULL: none): the first one, or the `nth` where no path says which."""
    return F.get(selected(els, html, sel), F.lit(0 if sel.path else sel.nth - 1))


def has_element(els: Column, html: Column, sel: Selector) -> Column:
    return F.size(selected(els, html, sel)) >= (1 if sel.path else sel.nth)


def fragment_text(html: Column, e: Column) -> Column:
    """Text of an element, NULL when it is absent or has none."""
    return element_text(clean_html(inner(html, e)))
