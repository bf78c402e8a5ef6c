import re
from html import unescape

import pytest

from keyrelay.llm.html_text import extract_text, text_of

CASES = [
    ("<p>One<p>Two <b>bold</b> a<br>b", "One\n\nTwo bold a\nb"),
    ("<ul><li>x<li>y<ol start=3><li>z</ol><li>w</ul>end", "  - x\n  - y\n     3. z\n  - w\n\nend"),
    ("<table><tr><th>Name<th>N<tr><td>a &amp; b<td>1<tr><td>longer cell<td>22</table>t",
     "Name         N\na & b        1\nlonger cell  22\n\nt"),
    ("<table><td>a<td><table><tr><td>in<td>ner</table><tr><td>long one<td>c</table>", "a         in  ner\nlong one  c"),
    ("<pre>\n a  b\n   c</pre>x", " a  b\n   c\n\nx"),
    ("a <span style='display: none'>no</span><i hidden>no</i><!-- no --><script>if (a<b) '</p>'</script><style>no</style>b", "a b"),
    ("<head><title>no</title></head><body>yes <noscript>no</noscript><textarea hidden>no</textarea>", "yes"),
    ("a<b>b</b>c  d\n\te", "abc d e"), ("<dl><dt>t<dd>d</dl>", "t\n    d"), ("x<hr>y", "x\n\n---\n\ny"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"), ("<a href='x>y'>l</a> &lt;b&gt; &nbsp;", "l <b> \xa0"), ("1 < 2 <3 a<", "1 < 2 <3 a<"),
    ("</p></div>stray</x>", "stray"), ("<p>open <em>never closed", "open never closed"), ("", ""), (None, ""), ("plain", "plain"),
    ("<ol><li>a<li>b</ol><ol><li>c</ol>", " 1. a\n 2. b\n\n 1. c"), ("<a title=\"unclosed>text", "text"),
    ("<select><option>a<option>b</select>", "a\nb"), ("<h1>T</h1>\n<p> x </p>\n", "T\n\nx"), ("<td>cell outside", "cell outside")]


@pytest.mark.parametrize("html,text", CASES)
def test_layout(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize("html", ["<ul>" * 3000 + "x", "<div>" * 20000 + "x" + '<a href="' * 2000, "<table><tr><td>" * 300 + "x", "<script>" * 50,
                                  "<" * 5000, "<!--" * 3000, "<p" * 5000, "&" * 5000, "<td>" * 3000, "<li>x</b>" * 5000])
def test_hostile_markup(html):
    assert len(text_of(html)) < 10**7


def test_no_visible_word_is_lost(spark):
    """Every word of a page outside its head, scripts and comments is in the text, in order."""
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        body = re.sub(r"(?s)<head>.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", r.html)
        words = unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert [w for w in text_of(r.html).split() if w != "-"] == [w for w in words if w != "-"]


def test_documents(spark):
    df = spark.createDataFrame([(k, h, "z") for k, (h, _) in enumerate(CASES)], "page_id long, html string, text string")
    assert {r.page_id: r.text for r in extract_text(df).collect()} == {k: t for k, (_, t) in enumerate(CASES)}
    assert extract_text(df.limit(0)).collect() == []


@pytest.mark.parametrize("html,text", [
    ("<html><head><title>t</title><p>All the text<p>goes on", "All the text\n\ngoes on"),
    ("<head><meta charset=utf-8><link rel=x><style>p {}</style><script>s</script>\n <title>t</title>\n shown <b>too</b>", "shown too"),
    ("<head><title>t</title><header>top</header><body>text", "top\ntext"), ("<head>\n<!-- no --><noscript><img>no</noscript></head>a", "a"),
    ("<head><title>t</title>&nbsp;a</head>b", "\xa0ab"), ("<head><template><p>no</p></template><div>a</div><title>no</title>b", "a\nb"),
    ("a <svg><title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><text>Jan</text><text>Feb</text></svg> b",
     "a\nJan\nFeb\nb"),
    ("<svg><title/><style/><path d='M 0'/><g><text x=1>1 &lt; <![CDATA[a<b &amp;]]></text></g></svg>b", "1 < a<b &amp;\nb"),
    ("<svg><text display=none>no</text><text><tspan x=0>one</tspan><tspan x=0>two</tspan></text></svg>", "one\ntwo"),
    ("<svg><foreignObject><p>one<p>two</foreignObject></svg>", "one\n\ntwo"), ("<svg><defs><p>shown", "shown"),
    ("so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation></semantics></math>.", "so x=2."),
    ("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr><mtr><mtd>3</mtd><mtd>4</mtd></mtr></mtable></math>", "1 2\n3 4")])
def test_implied_head_end_and_drawn_text(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize("html", ["<svg>" * 3000 + "<p>x", "<svg><g>" * 3000 + "x<p>", "<math><mi>" * 3000 + "<p>x" * 100, "<svg>" + "<![CDATA[" * 3000,
                                  "<head>" * 5000 + "x", "<svg>" + "<g>" * 50000 + "<path/>" * 50000 + "<p>x"])
def test_hostile_foreign_markup(html):
    assert len(text_of(html)) < 10**7


@pytest.mark.parametrize("html,text", [
    ("<p style='backface-visibility: hidden'>shown</p>", "shown"), ("<p style='x-display:none'>shown</p>", "shown"),
    ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>", "yes"),
    ("<div style='VISIBILITY:Collapse'>no<div>no<span style='visibility:visible'>a<i style='visibility:hidden'>no</i>b</span></div></div>c", "ab\nc"),
    ("<div style='display:none'>no<b style='visibility:visible;display:block'>no</b></div>a", "a"),
    ("<p style='display:none;display:block'>yes</p>", "yes"), ("<p style='display:none!important;display:block'>no</p>a", "a"),
    ("<p style='/* display:none */ color: red'>yes</p>", "yes"), ("<p style=\"background:url('a;display:none')\">yes</p>", "yes"),
    ("<p hidden style='display:block'>yes</p>", "yes"), ("<p hidden=until-found>no</p>a", "a"),
    ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "  - yes"),
    ("<svg><g visibility=hidden><text>no</text><text visibility=visible>yes</text></g></svg>", "yes"),
    ("<p visibility=hidden display=none>yes</p>", "yes"), ("<hr style='visibility:hidden'>a", "a")])
def test_visibility_by_property(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize("html,text", [
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<table><tr><td>a<td rowspan=3>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  b  c\nd     e\nf     g"),
    ("<table><tr><td colspan=2>a wide heading<td>x<tr><td>1<td>2<td>3</table>", "a wide heading  x\n1  2  3"),
    ("<table><tr><td><ul><li>one<li>two</ul><td>b<tr><td>c<td>d</table>", "- one  b\n- two\nc      d"),
    ("<table><tr><td>a<td><p>x<p>y<td>z</table>", "a  x  z\n   y"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
    ("<table><tr><td>" + "w" * 70 + "<td>b<tr><td>c<td>d</table>", "w" * 70 + "  b\nc  d")])
def test_spans_and_lines_of_cells(html, text):
    assert text_of(html) == text


def test_large_tables_in_proportion():
    """Text and time grow as the page, whatever its cells: wide ones, tall ones, empty ones, spanning ones, nested ones."""
    import time
    makers = [lambda n: "<table>" + "".join(f"<tr><td>x<td>{'w' * (n if k == 0 else 1)}<td>y" for k in range(n // 20)) + "</table>",
              lambda n: "<table><tr>" + "<td>a" * (n // 10) + "<td>" + "x<br>" * (n // 10) + "</table>",
              lambda n: "<table>" + ("<tr>" + "<td>" * 40 + "x") * (n // 170) + "</table>",
              lambda n: "<table>" + "<tr><td rowspan=60000 colspan=1000>x" * (n // 40) + "</table>",
              lambda n: "<table><tr><td>x" * (n // 20), lambda n: "<b><table>" * (n // 30) + "</b>" * (n // 30),
              lambda n: "<div>" * (n // 10) + "<td></div>" * (n // 20), lambda n: "<table><tr><td>" + "<p>x</b></i>" * (n // 20)]
    for make in makers:
        sizes, times = [], []
        for n in (125_000, 1_000_000):
            page = make(n)
            t = time.process_time()
            sizes.append(len(text_of(page)) / max(1, len(page)))
            times.append(time.process_time() - t)
        assert sizes[1] <= 20 and sizes[1] <= 1.5 * sizes[0] + 0.1
        assert times[1] < 30 and times[1] < 24 * times[0] + 2


def random_page(rng, depth=0, visible=True, displayed=True):
    """A well-formed random tree as markup, with the words that are to be seen, in any order."""
    tags = ["div", "p", "span", "b", "ul", "ol", "table", "section", "h2", "blockquote", "i", "em"]
    html, words = [], []
    for _ in range(rng.randint(1, 4)):
        word = f"w{rng.randrange(10**9)}"
        html.append(f" {word} ")
        words += [word] * (visible and displayed)
        if depth > 5 or rng.random() < 0.3:
            continue
        tag = rng.choice(tags)
        look, seen, there = rng.choice([("", None, True)] * 6 + [
            (" style='visibility:hidden'", False, True), (" style='color:red; visibility: visible'", True, True),
            (" style='display:none'", None, False), (" hidden", None, False), (" style='backface-visibility:hidden'", None, True),
            (" style='DISPLAY : block ; visibility:inherit'", None, True)])
        v, d = visible if seen is None else seen, displayed and there
        if tag in ("ul", "ol", "table"):
            parts = []
            for _ in range(rng.randint(1, 3)):
                if tag == "table":
                    cells = [random_page(rng, depth + 2, v, d) for _ in range(rng.randint(1, 3))]
                    spans = [rng.choice(["", " rowspan=2", " colspan=3", " rowspan=0"]) for _ in cells]
                    parts.append("<tr>" + "".join(f"<td{s}>{h}</td>" for s, (h, _) in zip(spans, cells)) + "</tr>")
                else:
                    cells = [random_page(rng, depth + 1, v, d)]
                    parts.append(f"<li>{cells[0][0]}</li>")
                words += [w for _, ws in cells for w in ws]
            inner = "".join(parts)
        else:
            inner, ws = random_page(rng, depth + 1, v, d)
            if tag in ("p", "h2"):                  # may not hold blocks: their words only
                inner, ws = f"w{rng.randrange(10**9)}", []
                ws = [inner] * (v and d)
            words += ws
        html.append(f"<{tag}{look}>{inner}</{tag}>")
    return "".join(html), words


def test_visible_text_of_random_trees():
    """The words that a generated page is known to show, without any parser: all of them and no others."""
    import random
    rng = random.Random(17)
    for _ in range(400):
        html, words = random_page(rng)
        assert sorted(w for w in text_of(html).split() if w.startswith("w")) == sorted(words), html
