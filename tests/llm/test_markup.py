import re
import time
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR

from contrail.llm import markup
from contrail.llm.markup import render


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain & simple &lt;b&gt; &eacute; &#x41; &bogus;", "plain & simple <b> é A &bogus;"),
        ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
        ("<h1>Head</h1>text <b>bo</b>ld<div>next</div>after", "Head\n\ntext bold\nnext\nafter"),
        ("a  \n b <span> c</span> <i> d</i>", "a b c d"),
        ("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "- a\n  - b\n  - c\n- d"),
        ("<ol start=9><li>a<li>b<li value=20>c</ol>", "9. a\n10. b\n20. c"),
        ("<ol type=a><li>x<li>y</ol><ol type=I reversed><li>p<li>q</ol>", "a. x\nb. y\n\nII. p\nI. q"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
        (
            "<table><caption>C</caption><tr><th>Name<th>Qty<tr><td>Apple pie<td>2<tr><td colspan=2>all of it</table>",
            "C\nName       Qty\nApple pie  2\nall of it",
        ),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>long one<td>d</table>", "a         b\n          c\nlong one  d"),
        ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
        ("<pre>\n  two\n    four\n</pre>after", "  two\n    four\n\nafter".strip()),
        ("x<script>if (a<b) '</p>'</script>y<style>p{}</style><!-- c --><template>t</template>z", "xyz"),
        ("<head><title>T</title></head><body>b", "b"),
        ("<title>T</title><p>shown", "shown"),
        ("<p hidden>no<p style='display: NONE'>no<p style=visibility:hidden>no <b style=visibility:visible>yes</b>", "yes"),
        ("<style>.x, #y {display:none} em{visibility:hidden}</style><p class='a x'>no<p id=y>no<em>no</em><p>yes", "yes"),
        ("<style>@media print{.x{display:none}}</style><p class=x>yes", "yes"),
        ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
        ("<select><option>a<option>b</select>", "a\nb"),
        ("<textarea>a\n <b></textarea><input type=submit value=Go>", "a\n <b>Go"),
        ("<p title='a>b' data-x=\"</p>\">t</p></div></br>u", "t\n\nu"),
        ("a < b and c<3 <!doctype x><?pi?></ >d", "a < b and c<3 d"),
        ("<b unclosed='x", ""),
        ("<li>alone", "- alone"),
        ("a&nbsp;&nbsp;b", "a  b"),
    ],
)
def test_render(html, text):
    assert render(html).strip() == text.strip()


@pytest.mark.parametrize("group", ["thead", "tbody", "tfoot"])
def test_text_in_row_groups_stands_before_the_table(group):
    html = f"<table><{group}><tr><td>a</td></tr>visible text</{group}></table>"
    assert render(html).split("\n") == ["visible text", "a"]
    assert render(html.replace("<table>", '<table style="visibility: hidden">')) == ""


def test_text_of_drawings():
    drawing = "<title>tip</title><defs/><style/><path d='M0'/><g><text>one <tspan>two</tspan></text></g>bare<text>three</text>"
    assert render(f"<p>a <svg>{drawing}</svg> b").split() == ["a", "one", "two", "three", "b"]
    used = '<defs><text id="t">used</text></defs><symbol id="s"><text>icon</text></symbol><use href="#t"/><use xlink:href="#s"/>'
    assert render(f"<svg>{used}<text display=none>no</text></svg>after").split() == ["used", "icon", "after"]
    assert render("<svg><foreignObject><p>html</p></foreignObject><text visibility=hidden>no</text><p>out").split() == ["html", "out"]
    assert render('<svg><g id="x"><use href="#x"/><text>once</text></g></svg>').split() == ["once", "once"]


def test_visibility_is_inherited():
    style = "<style>.h {visibility: hidden} .v {visibility: visible} #i {visibility: hidden}</style>"
    assert render(f"{style}<div class=h>no <b class=v>yes</b> no <b style='visibility: visible'>too</b></div>").split() == ["yes", "too"]
    assert render(f"{style}<div class='h v'>later</div><p id=i class=v>no</p>") == "later"
    assert render(f"{style}<ul><li class=h>no<p class=v>yes</p></ul>").split() == ["yes"]
    assert render(f"{style}<table><tr class=h><td>no<td class=v>yes</table>").split() == ["yes"]
    assert render("<style>.h {visibility: hidden !important}</style><p class=h style='visibility: visible'>no</p>") == ""


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<style>p{display:none} p{display:block}</style><p>v", "v"),
        ("<style>p{display:block} p{display:none}</style><p>no", ""),
        ("<style>p{display:none}</style><p style='display:block'>v", "v"),
        ("<style>p{display:none!important}</style><p style='display:block'>no", ""),
        ("<style>.a{display:none} p{display:block}</style><p class=a>no<p>v", "v"),
        ("<style>p{display:none} #i{display:flex}</style><p id=i>v<p>no", "v"),
        ("<style>p{display:none;display:bogus}</style><p>no", ""),
        ("<style>/* p{display:none} */ b{content:'}';display:none}</style><p>v<b>no</b>", "v"),
        ("<style>@import 'x'; @media print{p{display:none}} b{display:none}</style><p>v<b>no", "v"),
        ("<style>b{display:none</style><p>v<b>no", "v"),
        ('<div style="x-display:none">v', "v"),
        ("<div style=\"font-family:'display:none'\">v", "v"),
        ("<p hidden style='display:block'>v<dialog style='display:block'>w", "v\nw"),
        ("<plaintext>a<b>c", "a<b>c"),
        ("<input value=typed><input type=hidden value=no><input type=password value=no>", "typed"),
        ("a<progress>no</progress><meter>no</meter>b", "ab"),
    ],
)
def test_display_follows_the_cascade(html, text):
    assert re.sub(r"\n+", "\n", render(html).strip()) == text


def test_cells_over_rows_and_columns():
    html = "<table><tr><td rowspan=3>a<td colspan=2>b<td rowspan=2>c<tr><td>d<td>e<td>f<tr><td>g<td>h<td>i</table>"
    assert [line.split() for line in render(html).split("\n")] == [["a", "b", "c"], ["d", "e", "f"], ["g", "h", "i"]]
    rows = [line.index(line.strip()[0]) for line in render(html).split("\n")]
    assert rows[0] == 0 and rows[1] == rows[2] == 3


@pytest.mark.parametrize(
    "html",
    [
        "<table>" + "<tr><td rowspan=1000 colspan=1000>x" * 3000,
        "<style>" + "a" * 300_000 + "</style>x",
        "<style>" + "@" * 300_000 + "</style>x",
        "<style>" + "a;" * 150_000 + "</style>x",
        "<style>" + "{" * 300_000 + "</style>x",
        "<style>" + "/*" * 150_000 + "</style>x",
        "<style>" + "p{display:none}" * 20_000 + "p{display:block}</style><p>x",
        "<p style='" + "display:none;" * 20_000 + "display:block'>x",
    ],
)
def test_time_grows_with_the_page(html):
    begin = time.process_time()
    assert "x" in render(html)
    assert time.process_time() - begin < 8  # with the square of the page these take minutes


def test_nothing_is_cut():
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000 + "after"
    assert render(deep).split() == ["deep", "after"]
    assert render("<ul><li>" * 400 + "x").split()[-1] == "x"
    wide = "w" * 100_000
    assert render(f"<table><tr><td>{wide}<td>b<tr><td>a<td>c</table>") == f"{wide}  b\na  c"
    long = "<p>word</p>" * 50_000
    assert render(long).split() == ["word"] * 50_000
    assert render("<a '" * 20_000) == ""


class Words(HTMLParser):
    """All words outside scripts, styles and heads, by the standard library's parser."""

    INLINE = {"a", "b", "i", "em", "strong", "span"}

    def __init__(self):
        super().__init__()
        self.unseen, self.found = 0, []

    def handle_starttag(self, tag, attributes):
        self.unseen += tag in ("script", "style", "head")
        self.found.append("" if tag in self.INLINE else " ")

    def handle_endtag(self, tag):
        self.unseen -= tag in ("script", "style", "head")
        self.found.append("" if tag in self.INLINE else " ")

    def handle_data(self, data):
        if not self.unseen:
            self.found.append(data)


def test_given_pages_keep_all_visible_words(spark):
    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()}
    found = {r["page_id"]: r["text"] for r in markup.op4_html(spark, SF_DIR).collect()}
    assert found.keys() == pages.keys()
    for page, html in pages.items():
        words = Words()
        words.feed(html)
        bare = re.sub(r"(?m)^ *- ", "", found[page])
        assert bare.split() == "".join(words.found).split()


def test_rows_keep_their_columns(spark):
    rows = [(1, None, "x"), (None, "<p>a", "y"), (2, "", "z"), (2, "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = markup.rendered(pages).collect()
    assert sorted((str(r["row"]["page_id"]), str(r["text"]), r["row"]["text"]) for r in found) == [
        ("1", "None", "x"), ("2", "", "z"), ("2", "", "z"), ("None", "a", "y"),
    ]
    assert markup.rendered(pages.limit(0)).count() == 0
