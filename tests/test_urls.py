import random
import re
from urllib.parse import urljoin, urlparse

import pyspark.sql.functions as F

from pagemill.functions import urls as ur
from pagemill.operators.extract import page_links

BASES = [
    "http://h.example/a/b/c?x=1#f", "https://h.example", "http://h.example/", "http://u:p@H.example:80/a/",
    "http://h.example/a//b/../c;p=1?q", "HTTP://h.example/a/./b",
]
PIECES = [
    "a", "b", "..", ".", "", "c;x=1", "å b", "..a", ".b", "x?y=1", "z#f", "?q", "#g", "/", "//", "//o.example",
    "http:", "https://o.example/p", "http://h.example", "ftp://h.example/x", "JAVASCRIPT:x", "mailto:a@b", ":x",
    "1:2", "a:b", "?", "??", "#?", "\t/x", "  /y", "z ", "//[::1/x", "//[::1]/y", "\n", "http:foo", "http:/foo",
    "http:///foo", "///foo",
]


def _joined(base, href):
    try:
        return urljoin(base, href).split("#")[0]
    except ValueError:
        return None


def test_resolver_equals_urljoin(spark):
    rnd = random.Random(7)
    cases = {(b, p) for b in BASES for p in PIECES}
    for base in BASES:
        for _ in range(400):
            parts = [rnd.choice(PIECES) for _ in range(rnd.randint(1, 5))]
            cases.add((base, rnd.choice(["", "/", ""]) + "/".join(parts)))
    rows = spark.createDataFrame(sorted(cases), "b string, h string")
    one = ur.resolve_url(F.col("b"), F.col("h"))
    many = ur.resolve_all(ur.base_parts(F.col("b")), F.array("h", "h"))
    for row in rows.select("b", "h", one.alias("one"), many.alias("many")).collect():
        expected = _joined(row.b, row.h)
        assert row.one == expected, (row.b, row.h)
        assert row.many == [expected, expected], (row.b, row.h)


def test_url_parts_equal_urlparse(spark):
    urls = BASES + ["http://h/a;p/b;q", "//h/x", "h/x", "", "http://[::1]:8/x", "  HTTP://h/\tx", "http://h?q", "http://h#f"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(
        "u", ur.url_scheme(F.col("u")), ur.url_netloc(F.col("u")), ur.url_path(F.col("u"))
    )
    for url, *parts in rows.collect():
        parsed = urlparse(url)
        assert parts == [parsed.scheme, parsed.netloc, parsed.path], url


def test_slug(spark):
    cases = {
        "https://h/A/123/Första-sidan/?q=1": "a-123-f-rsta-sidan",
        "https://h/": "index",
        "https://h": "index",
        "https://h//a.html/": "a-html",
        "https://h/å": "-",
    }
    rows = spark.createDataFrame([(u,) for u in cases], "u string").select("u", ur.url_slug(F.col("u")).alias("s"))
    assert {r.u: r.s for r in rows.collect()} == cases


def test_path_pattern_has_unicode_classes_and_python_line_ends(spark):
    urls = ["https://h/a/1/x", "https://h/å/1/x/", "https://h/a/1/", "https://h/a/x/1/x", "https://h/a/٣/x",
            "https://h/a/1/x\u0085", "https://h/a/1/x y", "https://h/b/a/1/x"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string")
    for pattern in (ur.DEFAULT_PATH_PATTERN, r"/\w+/\d+", r"^/a|b"):
        for row in rows.select("u", ur.path_matches(F.col("u"), pattern).alias("m")).collect():
            assert row.m == bool(re.match(pattern, urlparse(row.u).path)), (pattern, row.u)


def test_page_links(spark):
    hrefs = ["/a#x", "#top", "javascript:x", "mailto:a@b", "tel:1", "JAVASCRIPT:x", "/a", "b", "https://other/x",
             "ftp://H.example/f", "http://h.example/case", "", "//[broken", "/a?q"]
    rows = spark.createDataFrame([("http://H.example/d/e", hrefs)], "url string, hrefs array<string>")
    base = ur.base_parts(F.col("url"))
    links = rows.select(page_links(base, F.col("hrefs"), ur.url_netloc(F.col("url")))).first()[0]
    assert links == [
        "http://H.example/a", "http://H.example/d/b", "ftp://H.example/f", "http://H.example/d/e", "http://H.example/a?q"
    ]
