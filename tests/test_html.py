import random
import subprocess
import sys
import time
import tracemalloc
from html.parser import HTMLParser
from pathlib import Path

import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from pagemill.functions import html as html_module
from pagemill.functions.html import CATEGORY_MARK, CONTENT, parse_html, parse_page
from pagemill.operators import extract


def parse(html, content=CONTENT):
    return parse_page(html, *content, CATEGORY_MARK)


@pytest.mark.parametrize(
    "html, title",
    [
        ("<h1> A <b>B</b></h1>", "AB"),
        ("<h1></h1><h1>x</h1>", ""),
        ("<p>no heading</p>", ""),
        ("<h1>a &amp; b&nbsp;</h1>", "a & b"),
        ("<h1>a<!-- c -->b</h1>", "ab"),
        ("<h1>a < b</h1>", "a < b"),
        ("<h1>open<p>text", "open"),
        ("<H1 class=x>caps</H1>", "caps"),
        ("<h1>a<script>no</script>b<style>no</style></h1>", "ab"),
        ("<script>'<h1>no</h1>'</script><h1>yes</h1>", "yes"),
        ("<!-- <h1>no</h1> --><h1>yes</h1>", "yes"),
    ],
)
def test_title(html, title):
    assert parse(html)["title"] == title


@pytest.mark.parametrize(
    "html, text",
    [
        ('<div class="textual">x</div>', None),
        ('<div class="story text">a <b> b</b>\xa0<i> </i>c</div>d', "a\nb\nc"),
        ('<div class="text">a<div>b</div>c</div>d<div class="text">e</div>', "a\nb\nc"),
        ('<div class="Text">x</div>', None),
        ('<span class="text">x</span>', None),
        ('<div class="text">a<b>b<p>c<br>d</div>e', "a\nb\nc\nd"),
        ('<div class="text">a<!-- x -->b</div>', "a\nb"),
        ('<div class="text">a<script>var t="</div>";</script>b</div>', "a\nb"),
        ('<div class="text">open <p>end', "open\nend"),
        ('<div class="text"></div>', ""),
        ('<div class="text"/>after', ""),
        ('<div class="text">x &lt;b&gt; &aring; &#228;</div>', "x <b> å ä"),
        ('<div class="text">a<template><p>t</p></template>b</div>', "a\nb"),
        ('<div class="text"><ruby>k<rt>r</rt></ruby>b</div>', "k\nb"),
        ("<div class='a\ntext\tb'>x</div>", "x"),
    ],
)
def test_text(html, text):
    assert parse(html)["text"] == text


@pytest.mark.parametrize(
    "html, categories",
    [
        ('<p><strong>Kategori:</strong> <a href="/c">A</a></p>', ["A"]),
        ("<p><strong>KATEGORIER</strong><a>A <i>b</i></a> och <a>B</a><a> </a><a>A</a></p>", ["Ab", "B", "A"]),
        ("<p><strong>X</strong><strong>Kategori</strong><a>c</a></p>", []),
        ("<p><strong>Kategori</strong></p><p><strong>Kategori</strong><a>c</a></p>", []),
        ("<p><a>before</a><em><strong>Kate<i>gori</i></strong></em><a>after</a></p><a>out</a>", ["before", "after"]),
        ("<p><strong>x</strong><a>a</a><p><strong>Kategori</strong><a>b</a><p><a>c</a>", ["b"]),
        ("<p><strong>Kategori</strong><a>a<a>b</a></div><a>c</a>", ["a", "b"]),
        ("<div><strong>Kategori</strong><a>a</a></div>", []),
        ("<p>x</p><strong>Kategori</strong><a>a</a>", []),
    ],
)
def test_categories(html, categories):
    assert parse(html)["categories"] == categories


def test_hrefs_in_document_order():
    html = (
        '<a href="/1">x</a><a name=n>y</a><a href>z</a><!-- <a href="/no"> --><script>"<a href=/no>"</script>'
        "<A HREF='/2?a=1&amp;b=2'>q<area href=/no><a href=/1>"
    )
    assert parse(html)["hrefs"] == ["/1", "", "/2?a=1&b=2", "/1"]


@pytest.mark.parametrize(
    "value, href",
    [
        ('"/a?x=1&copy=2&amp;y=3"', "/a?x=1&copy=2&y=3"),
        ('"/a&copy;&copy"', "/a\u00a9\u00a9"),
        ('"/&#97;&#x62;&nosuch;"', "/ab&nosuch;"),
        ("/bare/", "/bare/"),
        ("'/it\"s'", '/it"s'),
        ('"/first" href="/second"', "/first"),
        (' =  "/spaced" ', "/spaced"),
        ('"/a>b"', "/a>b"),
    ],
)
def test_href_values(value, href):
    equals = "" if value.lstrip().startswith("=") else "="
    assert parse(f"<a id=x href{equals}{value}>")["hrefs"] == [href]


class Plain(HTMLParser):
    """Independent reading of what parse_page reports, for well-formed pages."""

    def __init__(self):
        super().__init__()
        self.hrefs, self.nodes, self.open = [], [], []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and "href" in dict(attrs):
            self.hrefs.append(dict(attrs)["href"] or "")
        if tag not in ("br", "img"):
            self.open.append("text" if dict(attrs).get("class") == "text" else tag)

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if "text" in self.open and "script" not in self.open and data.strip():
            self.nodes.append(data.strip())


def random_block(rnd, depth=0):
    leaves = ["word ", "a &lt; b", "&eacute; ", "<br>", "<br/>", "<img alt='a>b'>", "<!-- <p>no -->", '<script>"<a href=/no>"</script>']
    if depth == 4 or rnd.random() < 0.3:
        return rnd.choice(leaves)
    tag = rnd.choice(["div", "b", "span", "section", "a href='/x?a=1&amp;b=2'", "a", "DIV id=q"])
    inner = "".join(random_block(rnd, depth + 1) for _ in range(rnd.randint(0, 3)))
    return f"<{tag}>{inner}</{tag.split()[0]}>"


def test_well_formed_pages_agree_with_the_standard_parser():
    rnd = random.Random(3)
    for _ in range(2000):
        body = "".join(random_block(rnd) for _ in range(5))
        html = f'<html><a href=/top>t</a><div class="text">{body}</div><p>after</p></html>'
        plain = Plain()
        plain.feed(html)
        plain.close()
        got = parse(html)
        assert (got["hrefs"], got["text"]) == (plain.hrefs, "\n".join(plain.nodes)), html


@pytest.mark.parametrize("piece", ['<a href="', "<", "<!--", "<a ", "<a b=\"c", "<a b='", "<script>", "</", "<a x=y/", "&", "<p>", "<div class=text>"])
def test_hostile_pages_take_linear_time(piece):
    start = time.process_time()
    parse(piece * (1_000_000 // len(piece)))
    assert time.process_time() - start < 10


def test_ends_of_elements_that_are_not_open_take_linear_time():
    start = time.process_time()
    parse("<template>" * 50_000 + "</script>" * 50_000 + "</template>" * 50_000 + "<rt>" * 50_000 + "</ruby>" * 50_000)
    assert time.process_time() - start < 10


PAGES = [
    ("https://h/a/1/ok", "<h1>T</h1><div class=text>" + "x" * 50 + "</div>", None),
    ("https://h/a/2/short", "<h1>T</h1><div class=text> " + "x" * 49 + " </div>", "short_text"),
    ("https://h/a/3/no", "<h1>T</h1>", "no_content"),
    ("https://h/a/4/empty", "<h1></h1><h1>x</h1>", "no_title"),
    ("https://h/list", "<h1>T</h1><a href=/a/1/ok>l</a>", "no_content"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([p[:2] for p in PAGES], "url string, html string")


def test_reject_reasons(pages):
    got = {r.url: r.reject for r in extract.extract_pages(pages).collect()}
    assert got == {url: reject for url, _, reject in PAGES}
    assert extract.page_records(extract.extract_pages(pages)).columns == ["url", "title", "text", "categories"]


def test_outcomes(spark, pages):
    got = {r.url: r.outcome for r in extract.page_outcomes(pages).collect()}
    assert got == {
        "https://h/a/1/ok": "OK", "https://h/a/2/short": "SKIP", "https://h/a/3/no": "SKIP",
        "https://h/a/4/empty": "SKIP", "https://h/list": "CRAWL",
    }
    html = PAGES[0][1]
    fetched = spark.createDataFrame(
        [("https://h/a/1/x", html, 200, "text/html"), ("https://h/a/2/x", html, 404, "text/html"),
         ("https://h/a/3/x", html, 200, "Text/HTML"), ("https://h/a/4/x", html, 200, None),
         ("https://h/a/5/x", html, None, "text/html"), ("https://h/a/6/x", html, 302, "a; text/html")],
        "url string, html string, status int, content_type string",
    )
    got = [(r.outcome, r.title_preview) for r in extract.page_outcomes(fetched).orderBy("url").collect()]
    assert got == [("OK", "T"), ("ERROR", None), ("NON_HTML", None), ("NON_HTML", None), ("ERROR", None), ("OK", "T")]
    source = sorted(r.url for r in extract.page_source(fetched).collect())
    assert source == ["https://h/a/1/x", "https://h/a/6/x"]


def test_null_page_is_null(spark):
    row = spark.createDataFrame([(None,)], "html string").select(parse_html(F.col("html")).alias("p")).first()
    assert row.p is None


def test_links_of_pages(pages):
    links = extract.extract_links(pages).collect()
    assert [tuple(r) for r in links] == [("https://h/list", 0, "https://h/a/1/ok")]
    assert extract.extract_links(pages, base_domain="other").count() == 0


def test_pages_are_parsed_once_and_after_the_path_test(pages, plan):
    for df in (
        extract.page_records(extract.extract_pages(pages)),
        extract.page_outcomes(pages).filter(F.col("outcome") == "OK"),
        extract.extract_links(pages).filter(F.col("pos") > 0),
    ):
        assert plan(df).count("ArrowEvalPython") == 1
        assert "Exchange" not in plan(df)


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Python workers started elsewhere cannot import the package by its path."""
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from __spark_entry__ import queries
from pagemill.session import build_session
spark = build_session("elsewhere", "local[2]")
assert queries()["html_title"](spark, "/root/testdata/sf0.001").collect()
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_batch_is_parsed_in_portions():
    """Python objects are those of a portion, however many pages a batch holds; wide characters take four bytes each."""
    pages = [f"<h1>{i}</h1><div class=text>{'x' * 20_000}\U0001f600</div><a href={i}>a</a>" for i in range(1000)]
    pages[7], pages[8] = None, ""
    batch, n = pa.array(pages), []
    tracemalloc.start()
    for some in html_module.parsed_batches(iter([batch, batch[:0]]), *CONTENT, CATEGORY_MARK):
        n.append(len(some))
        if len(n) == 1:
            assert some.to_pylist()[:9] == [parse(page) for page in pages[:9]]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sum(n) == 1000 and n[-1] == 0 and max(n) < 110
    assert peak < 30e6 < 4 * sum(len(page or "") for page in pages)


@pytest.mark.parametrize("portion", [1, 150])
def test_portions_keep_rows_together(spark, monkeypatch, portion):
    monkeypatch.setattr(html_module, "PORTION", portion)
    pages = [(i, [None, "", f"<h1>{i}</h1>", "<a href=x>" * i][i % 4]) for i in range(50)]
    rows = spark.createDataFrame(pages, "id int, html string").coalesce(1).select("id", "html", parse_html(F.col("html")).alias("p")).collect()
    assert [(r.id, r.html, r.p and r.p.asDict()) for r in rows] == [(i, page, parse(page)) for i, page in pages]


def test_a_batch_goes_before_the_next_is_read():
    """Arrow's memory, which does not grow with the number of batches."""
    page, held, start = f"<div class=text>{'x' * 100_000}</div>", [], pa.total_allocated_bytes()

    def batches():
        for _ in range(6):
            held.append(pa.total_allocated_bytes() - start)
            yield pa.array([page] * 200)

    assert sum(len(some) for some in html_module.parsed_batches(batches(), *CONTENT, CATEGORY_MARK)) == 1200
    assert max(held) < 10e6 < 200 * len(page)
