"""Main text of pages: a plain reading of the test pages, and blocks without containers."""

import re
import time
from html import unescape

import pytest
from pyspark.sql import functions as F

from pagemill.llm.html_blocks import blocks_of, counts_of, first_pass, main_text, main_text_of
from pagemill.llm.queries import QUERIES

LONG = ("This is a block of the main text and it has many of the words that are in every text of this kind, "
        "so that it is taken for what it is by the rules for long blocks with stop words in them.")


def test_query_against_plain_reading(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    rows = QUERIES["op2_html"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S).group(1)
        want = " ".join(unescape(re.sub(r"<[^>]+>", " ", article)).split())
        assert (r.text, r.n_chars) == (want, len(want))


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("plain", ""),
    (f"<p>{LONG}</p>", LONG),
    (f"<nav>{LONG}</nav><p>{LONG}</p><footer>{LONG}</footer>", LONG),
    (f"<div class='top ad'>{LONG}</div><p>{LONG}", LONG),
    (f"<p>{LONG}</p><p>One more.</p><p>{LONG}</p>", f"{LONG} One more. {LONG}"),
    (f"<p>{LONG}</p><p><a href=x>Read more of it here</a></p><p>{LONG}</p>", f"{LONG} {LONG}"),
    (f"<article><header><h1>T&eacute;t</h1></header><p>a<b>b</b>c&nbsp; d</p><p>e<br>f</p><aside>no</aside></article>", "Tét abc d e f"),
    ("<header>Site</header><main><p>und | x</p></main><div id=comments><article>Nice post</article></div>", "und | x"),
    ("<article>one<!-- no --><script>var a='</p>';</script><style>p{}</style> two<form>no</form></article>", "one two"),
    ("<article>a<script>never closed</article>", "a"), ("<article>a<!-- never closed</article>", "a"),
    ("<article>a < b &amp; c &lt; d</article>", "a < b & c < d"),
    ("<article>a<p title=\"x > y\">b</p></article>", "a b"),
    ("<div class=cookie-notice><p>We use it</p></div><article>x</article><div class='comments'><p>Hm</p></div>", "x"),
    ("<ARTICLE><P HIDDEN>no</P>yes</ARTICLE>", "yes"),
    (f"<div style='overflow: hidden' data-x='an ad'><p>{LONG}</p></div>", LONG),
    ("<div class='page with-sidebar'><article class='post comments-open'>x</article></div>", "x"),
    ("<main id=content><p>x</p><article class=comment>no</article><section class='comments'><p>no</p></section></main>", "x"),
])
def test_cases(html, want):
    assert main_text_of(html) == want


DUTCH = ("Het onderzoek naar dijken toont aan hoe het water elk jaar hoger tegen onze kust staat, waardoor bewoners langs rivieren "
         "steeds vaker moeten nadenken wat zij met hun huizen willen doen, zegt hoogleraar Jansen vandaag tijdens haar lezing.")
RUSSIAN = ("Учёные рассказали, что уровень воды в реке поднимается каждый год, и жители прибрежных районов всё чаще думают о том, "
           "как им защитить свои дома, сады и дороги от весенних паводков, которые стали заметно сильнее, чем раньше.")
CHINESE = "研究人员表示，河流的水位每年都在上升，沿岸的居民越来越多地考虑如何保护自己的房屋、花园和道路，以免受到春季洪水的影响，因为洪水比过去更加猛烈。"


@pytest.mark.parametrize("html, want", [
    # Names count whole; ids of parts of an article say what the part is about.
    (f"<article><p>{LONG}</p><section id='related-work'><h2 id=search>Work</h2><p>{LONG}</p></section></article>", f"{LONG} Work {LONG}"),
    (f"<main><div id='notice-periods'><p>{LONG}</p></div></main>", LONG),
    (f"<div class='has-sidebar'><p>{LONG}</p></div>", LONG),
    (f"<div class='layout no-ads'><p>{LONG}</p></div><div class='related-posts'>{LONG}</div><div class='adSlot'>{LONG}</div>", LONG),
    (f"<article><p>{LONG}</p><section id=comments><p>{LONG}</p></section></article>", LONG),
    # Length and links where no list of stop words fits.
    *[(f"<ul><li><a href=/>{text[:20]}</a></li></ul><h1>{text[:9]}</h1><p>{text}</p><p>{text}</p><p><a href=x>{text}</a></p>",
       " ".join([text, text])) for text in (DUTCH, RUSSIAN, CHINESE)],
    (f"<h1>Вода</h1><div><p>{RUSSIAN}</p><p>Да.</p><p>{RUSSIAN}</p></div>", f"{RUSSIAN} Да. {RUSSIAN}"),
    # No article, nothing long.
    ("<nav>Home of all</nav><h1>Closed today</h1><p>We open again on Monday.</p>", "Closed today We open again on Monday."),
    ("<nav>Home of all the things that we have</nav><p>Hm</p>", ""),
    # Links inside an article: lists of them go, text with some stays, short blocks follow their neighbours.
    (f"<article><h1>T</h1><p>{LONG}</p><ul><li><a href=a>Other news</a></li><li><a href=b>More news</a></li></ul><p>{LONG}</p></article>", f"T {LONG} {LONG}"),
    (f"<article><p>{LONG}</p><p>See <a href=x>this report</a>.</p><p>{LONG}</p></article>", f"{LONG} See this report. {LONG}"),
    (f"<article><p>{LONG}</p><p><a href=a>Buy now</a></p><p>Sale!</p><p><a href=b>Go</a></p></article>", LONG),
    ("<nav>Home</nav><article><h1>T</h1><p>Short.</p></article><footer>F</footer>", "T Short."),
])
def test_density_length_and_links_decide(html, want):
    assert main_text_of(html) == want


def test_blocks_of_the_test_pages_are_decided_by_both_passes(spark):
    html = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    first = opened = 0
    for page in html:
        blocks = [b for b in blocks_of(page) if not b.outside]
        decided = [first_pass(b, counts_of(b), True) for b in blocks]
        first, opened = first + sum(d is not None for d in decided), opened + sum(d is None for d in decided)
    assert first and opened


def test_hostile_pages_take_linear_time():
    n = 20_000
    for part, close in (('<p title="', ""), ("<div>", "</p>"), ("<template>", "</script>"), ("<b>", "</i>"), ("<!--", ""),
                        ("<a href='", ""), ("<p ", ""), ("<", ""), ("<li>x", ""), ("<script>", ""), ("&amp", ";")):
        start = time.time()
        main_text_of(part * n + close * n)
        assert time.time() - start < 3, part


def test_rows(spark):
    df = spark.createDataFrame([(1, "<article>x</article>", "c"), (1, "<article>x</article>", "c"), (None, None, None)], "page_id int, html string, text string")
    assert sorted(r[0] for r in df.select(main_text(F.col("html"))).collect()) == ["", "x", "x"]
    assert df.limit(0).select(main_text(F.col("html"))).collect() == []
