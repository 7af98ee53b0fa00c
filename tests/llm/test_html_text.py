"""Rendered pages on small examples."""

import pytest

from freightloom.llm.html_text import DEEPEST, aligned, extract, render

PAGES = [
    ("", ""),
    ("plain &amp; text", "plain & text"),
    ("<p>One<p>Two  words\n here", "One\n\nTwo words here"),
    ("<div>a</div><div>b<span>c</span> d</div>", "a\nbc d"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>", "- a\n- b\n  3. c\n  4. d\n- e"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<head><title>t</title><style>p{}</style></head><body>x<script>if (a<b) '</p>'</script>y", "xy"),
    ("<p hidden>no<p style='color:red; display : none'>no<p style='x:none'>yes", "yes"),
    ("<title>t<p>in title</title>shown<input type=hidden value=no><input type=submit value=Go>", "shownGo"),
    ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"),
    ("<table><tr><th>name<th>n<tr><td>long one<td>7</table>after", "name     | n\nlong one | 7\n\nafter"),
    ("<table><td>a<td colspan=2>b<td>c<tr><td>dd<td>e<td>f<td>g</table>", "a  | b |   | c\ndd | e | f | g"),
    ("<table><tr><td><ul><li>x<li>y</ul><td><table><tr><td>i<td>j</table></table>", "- x - y | i | j"),
    ("<h1>T</h1>t<h2>U<h3>V", "T\n\nt\n\nU\n\nV"),
    ("a<!-- <p>no --> b<!-- open", "a b"),
    ("1 < 2 <3 </> <b>x</b", "1 < 2 <3 x"),
    ("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "k\n  v\nl\n  w"),
    ("<a href='x>y'>link</a> <img alt=no src=z> &lt;b&gt; &#233;&nbsp;&nbsp;z", "link <b> é\xa0\xa0z"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("</p></td></table>x", "x"),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_pages(html, text):
    assert render(html) == text


def test_deep_and_long_pages():
    assert render("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    assert render("<b>" * (DEEPEST + 5) + "y<p>z").split() == ["y", "z"]
    for piece in ("<", "<a ", "<a b='", "<!--", "</", "<p", "<table><tr><td>", "<li>", "&", "<ul>", "<script>", "<a b=c>"):
        render(piece * 20_000)
    wide = aligned([["x" * 5000, "a"]] + [["b", "c"]] * 3)
    assert max(map(len, wide[1:])) < 50


DRAWN = [
    ("so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds", "so x=12 holds"),
    ("<math><semantics><mi>y</mi><annotation encoding=TeX>\\no</annotation><annotation-xml><ci>no</ci><p>no</annotation-xml></semantics></math>z", "yz"),
    ("a<math display=block><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr><mtr><mtd/><mtd>3</mtd></mtr></mtable></math>b", "a\n1 2 3\nb"),
    ("<svg>no<title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><g><text x=1>A <tspan>1</tspan></text><text>B</text>no</g></svg>z", "A 1\nB\nz"),
    ("<svg><title/><defs/><path d='M0'/><style>no{}</style><text hidden>no</text><text display='none'>no</text><text>C&amp;D</text></svg>z", "C&D\nz"),
    ("<svg><text><![CDATA[p < q]]></text><foreignObject><p>html<table><td>c<td>d</table></foreignObject></svg>z", "p < q\n\nhtml\n\nc | d\n\nz"),
    ("<svg hidden><text>no</text></svg><svg><g><p>out<b/>side", "outside"),
    ("<svg/>a<desc>b</desc><metadata>c</metadata><text>d</text><i/>e", "abcde"),
]


@pytest.mark.parametrize("html, text", DRAWN)
def test_formulas_and_drawings(html, text):
    assert render(html) == text


def test_drawings_below_any_depth():
    assert render("<b>" * 3 * DEEPEST + "<svg><defs><text>no</text></defs>" + "<g>" * 3 * DEEPEST + "<text>A</text></svg><math><mi>x") == "A\nx"
    for piece in ("<svg>", "<math>", "<svg><text>", "<svg><p>", "<math><mi>", "<svg><foreignobject>", "<svg/>", "<svg><![CDATA["):
        render(piece * 20_000)


@pytest.mark.parametrize("tag", ["font", "b", "span", "div"])
def test_nothing_changes_below_any_depth(tag):
    """What is hidden stays hidden, and tables, lists and end tags work, below elements that nobody closes."""
    deep = f"<{tag}>" * 3 * DEEPEST
    inner = (
        "a<script>no()</script><style>no{}</style><i hidden>no</i><u style='display:none'>no<u>no</u></u>z"
        "<table><tr><th>name<th>n<tr><td>long one<td>7</table><ol><li>c<li>d</ol><p>e"
    )
    assert render(deep + inner) == "az\n\nname     | n\nlong one | 7\n\n1. c\n2. d\n\ne"
    assert render(f"x<div hidden>{deep}no<em>no</em><ul><li>no</ul>{f'</{tag}>' * 3 * DEEPEST}no</div>y") == "xy"
    assert render(f"<p hidden>{'<b>' * 600}<i>no</i><b><i>no</i></b>no{'</b>' * 601}no<p>yes") == "yes"


def test_depth_costs_no_more_than_length():
    n = 200_000
    assert render("<b>" * n + "<i>x</i></u>" * n + "</b>" * n) == "x" * n
    assert render("<p hidden>" + "<b>" * n + "no" + "</b>" * n + "<p>y") == "y"
    lines = render("<ul><li>x" * 5_000).split("\n")
    assert len(lines) == 5_000 and lines[9] == "  " * 9 + "- x" and all(line.endswith("- x") for line in lines)


def test_rows(spark):
    rows = [(1, "<p>x", "t"), (2, None, "t"), (3, "", "t"), (1, "<p>x", "t"), (None, "<i>y", "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert sorted(map(tuple, extract(pages).collect()), key=repr) == sorted([(1, "x"), (2, ""), (3, ""), (1, "x"), (None, "y")], key=repr)
    assert extract(pages.limit(0)).count() == 0
