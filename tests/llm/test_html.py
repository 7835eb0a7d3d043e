"""Operator 4 against expected layouts."""

import random
import re
import time

import pytest

from adloom.llm.html import DEEPEST, Tags, extract, render
from adloom.llm.queries import op4_html
from tests.conftest import SF


@pytest.mark.parametrize(("page", "text"), [
    ("<p>a<p>b", "a\n\nb"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("a<br>b", "a\nb"),
    ("<ul><li>x<ul><li>y<li>z</ul><li>w</ul>", "- x\n  - y\n  - z\n- w"),
    ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<table><tr><th>Name<th>N<tr><td>Bartholomew<td>1<br>2</table>", "Name         N\nBartholomew  1\n             2"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a        b\n\nin  ner"),
    ("<table><tr><td colspan=2>wide cell here<td>c<tr><td>1<td>2<td>3</table>", "wide cell here  c\n1  2            3"),
    ("<table><tr><td rowspan=2>r<td>s<td>t<tr><td>u<td>v<tr><td>w</table>", "r  s  t\n   u  v\nw"),
    ("<table><tr><td rowspan=0>r<td>s<tr><td>u<tr><td>v<tbody><tr><td>w</table>", "r  s\n   u\n   v\nw"),
    ("<table><tr><td colspan=1000>a<td>b<tr><td colspan=x>c<td rowspan=-1>d</table>", "a     b\nc  d"),
    (f"<table><tr><td>{'l' * 300}<td>a<tr><td>b<td>c</table>", f"{'l' * 300}  a\nb  c"),
    ("<pre><code><span><span>a\n  b\nc</pre>", "a\n  b\nc"),
    ("<svg><title>no</title><defs><text>no</text></defs><text>A</text><text>B</text></svg><math><mi>x</mi><mo>=</mo></math>", "A Bx="),
    ("a <b 'c <i>d</i>", "a <b 'c d"),
    ("x<!-- never closed <p>y", "x"),
    ("&#" + "1" * 5000 + ";", "\ufffd"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote>q<p>r</blockquote>s", "> q\n>\n> r\n\ns"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
    ("<p>one\n  two <b> three</b> four</p>", "one two three four"),
    ("<head><title>no</title></head><body>yes", "yes"),
    ("<script>if (a < b) {'</p>'}</script>x<style>p{}</style><template>t</template><!-- c -->y", "xy"),
    ("<p hidden>a</p><p style='DISPLAY : none'>b</p><p style=\"visibility:hidden\">c</p><input type=hidden value=v><p>d", "d"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("&lt;ok&gt; &eacute;&#x41; &unknown;", "<ok> éA &unknown;"),
    ("<a title='>'>link</a> <img alt='pic'>", "link pic"),
    ("a</p></div><b>c</i>d", "acd"),
    ("<h1>t</h1>x<hr>y", "t\n\nx\n\n---\n\ny"),
    ("<p>&nbsp;</p>", "\xa0"),
    ("<body hidden>a", ""),
    ("", ""), (None, ""),
])
def test_layout(page, text):
    assert render(page) == text


@pytest.mark.parametrize("page", ["<", "<a", "</", "<!--", "<script>x", "<div " * 2000, "<div>" * 5000 + "x", "<ul><li>" * 1000 + "x", "<table><tr><td>" * 800 + "x", "<p>" * 20000, "<<>><></>"])
def test_broken_and_deep_markup_never_fails(page):
    out = render(page)
    assert out.count("x") == page.count("x") - page.count("<script>x")
    assert DEEPEST < 1000


# The same tags by one expression without memory: exact, but quadratic where tags never close.
PLAIN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)


def test_tags_equal_a_plain_expression():
    rng = random.Random(3)
    for _ in range(20_000):
        page = "".join(rng.choices(["<", ">", "'", '"', "a", "/", " ", "<b", "<!--", "-->", "="], k=rng.randint(1, 25)))
        tags, at, found = Tags(page), 0, []
        while (at := page.find("<", at)) >= 0:
            tag = tags.at(at)
            if tag:
                found.append((at, *tag))
            at = tag[0] if tag else at + 1
        want = [(m.start(), m.end(), (m[2] or "").lower(), m[3] or "", bool(m[1])) for m in PLAIN.finditer(page)]
        assert found == want, page


@pytest.mark.parametrize("page", ["<a '" * 250_000, "<a" * 500_000, "<!" * 500_000, "<a x='>" * 150_000 + "'", "<script></script " * 60_000,
    "<td colspan=1000>" * 60_000, "<table><tr>" + "<td rowspan=60000>x" * 20_000 + "<tr><td>y" * 50_000, "<table><tr><td>" + "w" * 500_000 + "<td>a" + "<tr><td>b<td>c" * 30_000])
def test_long_broken_pages_end(page):
    begin = time.perf_counter()
    assert len(render(page)) <= len(page)
    assert time.perf_counter() - begin < 15


def test_every_page(spark):
    out = op4_html(spark, SF)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert out.columns == ["page_id", "url", "text"] and out.count() == pages.count()
    assert out.where("text like '%<p>%' or text like '%track(%'").count() == 0


def test_odd_rows(spark):
    rows = [(1, None, "old"), (2, "", "old"), (2, "", "old"), (None, "<p>" + "word " * 200_000, "old"), (3, "<p>x", None)]
    out = extract(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert sorted(len(r.text) for r in out) == [0, 0, 0, 1, 999_999]
    assert extract(spark.createDataFrame([], "page_id long, html string, text string")).count() == 0
