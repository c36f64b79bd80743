"""Cleaning, element text and selector shapes (hand-made pages)."""

from pyspark.sql import functions as F

from offerframe.functions.html import Selector, clean_html, element_text, select_text, unescape
from offerframe.operators import elements as EL


def one(spark, html, expr_fn):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(expr_fn(F.col("html")).alias("v")).first()["v"]


def found(spark, html, sel):
    """(whether the selector fits anything, the text it gives)."""
    own = EL.with_elements(spark.createDataFrame([(html,)], "html string"))
    els, page = F.col(EL.ELEMENTS), F.col("html")
    own = own.select(EL.has_element(els, page, sel).alias("has"), EL.select_element(els, page, sel).alias("e"), "html")
    r = own.select("has", EL.fragment_text(page, F.col("e")).alias("text")).first()
    return r.has, r.text


def test_clean_drops_script_style_comment(spark):
    html = '<p>a</p><script>var t="</p>";</script><style>p{}</style><!-- x <p>b</p> --><p>c</p>'
    assert one(spark, html, clean_html) == "<p>a</p><p>c</p>"


def test_element_text_entities_tags_spaces(spark):
    frag = "  O&#39;Hara&nbsp;<b>&amp;</b> Sons\n<br>Ltd &lt;x&gt; &quot;q&quot; "
    assert one(spark, frag, element_text) == "O'Hara & Sons Ltd <x> \"q\""


def test_element_text_blank_is_null(spark):
    assert one(spark, "<b> </b>", element_text) is None


def test_apostrophe_and_nested_inline_tags_kept_whole(spark):
    html = "<h1>Flat at O'<i>Neil</i>&#39;s &amp; co</h1>"
    assert one(spark, html, lambda c: select_text(clean_html(c), Selector("h1"))) == "Flat at O'Neil's & co"


def test_attribute_anchored_child(spark):
    html = ('<div data-testid="ad-price-container"><span>x</span><h3>450 000 zł</h3></div>'
            '<h3>other</h3>')
    sel = Selector("div", (("data-testid", "ad-price-container"),), child="h3")
    assert found(spark, html, sel) == (True, "450 000 zł")


def test_nth_child(spark):
    html = '<div data-testid="bar"><span>first</span><span>ID: 42</span></div>'
    assert found(spark, html, Selector("div", (("data-testid", "bar"),), child="span", nth=2))[1] == "ID: 42"
    assert found(spark, html, Selector("div", (("data-testid", "bar"),), path=(("span", 2),)))[1] == "ID: 42"
    assert found(spark, html, Selector("div", (("data-testid", "bar"),), path=(("span", 3),))) == (False, None)


def test_text_prefix_split_over_tags_and_comments(spark):
    sel = Selector("p", text_prefix="ID")
    assert found(spark, "<p>Other</p><p><span>ID</span><!-- c -->: 777</p>", sel)[1] == "ID: 777"
    assert found(spark, "<p>Other</p><p>ID: 777</p>", sel)[1] == "ID: 777"
    assert found(spark, "<p>none</p>", sel) == (False, None)


def test_marker_only_in_script_is_not_found(spark):
    html = '<script>document.write("<h4>gone</h4>")</script><!-- <h4>x</h4> --><div data-testid="x">a</div>'
    assert found(spark, html, Selector("h4")) == (False, None)


def test_child_step_and_descendant_differ(spark):
    html = '<div id="a"><div><h3>old</h3></div><h3>new</h3></div>'
    anchor = (("id", "a"),)
    assert found(spark, html, Selector("div", anchor, child="h3"))[1] == "old"
    assert found(spark, html, Selector("div", anchor, path=(("h3", None),)))[1] == "new"
    assert found(spark, '<div id="a"><div><h3>old</h3></div></div>', Selector("div", anchor, path=(("h3", None),))) == (False, None)


def test_first_match_in_any_anchor(spark):
    html = '<div id="a"><b>x</b></div><div id="a"><h3>second</h3></div>'
    assert found(spark, html, Selector("div", (("id", "a"),), path=(("h3", 1),)))[1] == "second"
    assert found(spark, html, Selector("div", (("id", "a"),), child="h3"))[1] == "second"


def test_attributes_unquoted_with_brackets_and_repeated(spark):
    sel = Selector("div", (("data-x", "v"),))
    for tag in ("<div data-x=v>", "<DIV Data-X='v'>", '<div title="a > b" data-x="v">', "<div data-x = v class=q>", '<div a\ndata-x="v"\n>'):
        assert found(spark, f"<p>0</p>{tag}yes</div>", sel) == (True, "yes"), tag
    for tag in ('<div data-x="v2">', '<div data-x2="v">', '<div title="data-x=v">', '<div title=" data-x=&quot;v&quot;">'):
        assert found(spark, f"{tag}no</div>", sel) == (False, None), tag


def test_numbering_of_elements():
    rows = EL.number_elements('<div>1<div>2</div><br><img src=x/>3</div></p><ul><li>a<li>b</ul><title>a<b></title><p>x<p>y')
    names = [(r[0], r[2], r[3]) for r in rows]
    assert names == [("div", -1, 1), ("div", 0, 1), ("br", 0, 1), ("img", 0, 1), ("ul", -1, 1), ("li", 4, 1), ("li", 4, 2),
                     ("title", -1, 1), ("p", -1, 1), ("p", -1, 2)]
    html = '<section id="a"><section>1</section>2</section>3'
    r = EL.number_elements(html)[0]
    assert html[r[4]:r[5]] == "<section>1</section>2"
    assert EL.number_elements("") == [] and EL.number_elements("a < b <3 </x>") == []
    deep = EL.number_elements("<div>" * 3000 + "x" + "</div>" * 3000)
    assert len(deep) == 3000 and deep[2999][2] == 2998


def test_intervals_nest(spark):
    page = '<main id="m"><div a="1"><p>x</p></div><div>y</div></main>'
    rows = EL.element_table(spark.createDataFrame([(7, page), (8, None), (9, "")], "page_id long, html string")).collect()
    assert {r.page_id for r in rows} == {7} and [r.name for r in rows] == ["main", "div", "p", "div"]
    for r in rows:
        if r.parent >= 0:
            up = rows[r.parent]
            assert up.begin <= r.begin <= r.end <= up.end
    assert rows[1].attrs == ' a="1"' and rows[3].nth == 2


def test_nested_same_name_is_cut_short(spark):
    # documented limit: the body ends at the first closing tag of that name
    html = "<div id=\"a\">outer <div>inner</div> tail</div>"
    assert one(spark, html, lambda c: select_text(c, Selector("div", (("id", "a"),)))) == "outer inner"


def test_unclosed_script_kept_as_text(spark):
    html = "<p>a</p><script>var x = 1;"
    assert one(spark, html, clean_html) == html


def test_missing_element_is_null(spark):
    assert one(spark, "<p>x</p>", lambda c: select_text(c, Selector("h1"))) is None


def test_prefix_selector_survives_huge_whitespace_runs(spark):
    # A repeated regex group would recurse once per space and overflow.
    sel = Selector("p", text_prefix="ID")
    assert found(spark, "<p>x</p><p>" + " " * 50000 + "ID: 7</p>", sel)[1] == "ID: 7"
    assert found(spark, "<p>x</p><p>" + "<br>" * 20000 + "ID: 8</p>", sel)[1] == "ID: 8"


def test_prefix_selector_under_an_anchor(spark):
    html = '<div id="a"><span>no</span><span>ID: 1</span></div><span>ID: 2</span>'
    assert found(spark, html, Selector("div", (("id", "a"),), child="span", text_prefix="ID"))[1] == "ID: 1"


def _one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column(F.col("html")).alias("x")).first().x


def test_positional_path(spark):
    sel = Selector("*", (("id", "m"),), path=(("div", 2), ("p", 1)))
    html = '<main id="m"><section><div><p>no</p></div></section><div>1<br></div><div><span><p>no</p></span><p>yes</p></div></main>'
    assert found(spark, html, sel)[1] == "yes"
    assert found(spark, html.replace("<p>yes</p>", ""), sel) == (False, None)
    assert found(spark, "<div>x</div>", sel) == (False, None)


def test_child_is_searched_inside_its_element_only(spark):
    sel = Selector("div", (("id", "a"),), child="h3")
    assert found(spark, '<div id="a"><b>x</b></div><h3>elsewhere</h3>', sel) == (False, None)
    assert found(spark, '<div id="a"><div>n</div><h3>in</h3></div>', sel)[1] == "in"


def test_character_references(spark):
    text = "&#243;&#xF3;&oacute; &#128512; &amp;#243; &#160;x &#0; &#xD800;&#9999999;"
    assert _one(spark, text, unescape) == "óóó 😀 &#243; \xa0x \ufffd \ufffd\ufffd"
