import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators.frontier import crawl_reachable
from pagemill.plans import site as site_module
from pagemill.plans.site import crawl_batch, crawl_site, crawl_site_batch, load_progress, load_site_crawl, store_site, write_dataset
from pagemill.sources import clustered, seen
from pagemill.sources.jsonl import read_jsonl
from pagemill.sources.progress import CrawlProgress

TEXT = "<div class=text>" + "x" * 60 + "</div>"
PAGES = [
    ("https://h/", '<a href="/a/1/x">1</a><a href="a/2/y#z">2</a><a href="https://other/">o</a><a href="/gone">g</a>', 200, "text/html"),
    ("https://h/a/1/x", f"<h1>One</h1>{TEXT}<a href='/'>home</a><a href='../3/z'>3</a>", 200, "text/html"),
    ("https://h/a/2/y", f"<h1></h1>{TEXT}<a href='/a/4/w'>4</a>", 200, "text/html"),
    ("https://h/a/3/z", "<a href='/never'>n</a>", 200, "application/pdf"),
    ("https://h/a/4/w", f"<h1>Four</h1>{TEXT}", 503, "text/html"),
    ("https://other/", "<a href='/x'>x</a>", 200, "text/html"),
]


def crawl(spark, cap=0):
    pages = spark.createDataFrame(PAGES, "url string, html string, status int, content_type string")
    rows = crawl_site(pages, "https://h/", cap).orderBy("visit_rank").collect()
    return [(r.url.removeprefix("https://h/"), r.depth, r.outcome, r.title) for r in rows]


def test_site(spark):
    assert crawl(spark) == [
        ("", 0, "CRAWL", None),
        ("a/1/x", 1, "OK", "One"),
        ("a/2/y", 1, "SKIP", None),
        ("gone", 1, "ERROR", None),
        ("a/3/z", 2, "NON_HTML", None),
        ("a/4/w", 2, "ERROR", None),
    ]


def test_capped_site_keeps_its_queue(spark):
    assert crawl(spark, 2) == [
        ("", 0, "CRAWL", None),
        ("a/1/x", 1, "OK", "One"),
        ("a/2/y", 1, "QUEUED", None),
        ("gone", 1, "QUEUED", None),
        ("a/3/z", 2, "QUEUED", None),
    ]


@pytest.mark.parametrize("n", [1, 7])
def test_batches_equal_one_crawl(spark, tmp_path, n):
    rnd = random.Random(5)
    rows = [(str(i), pos, str(rnd.randrange(30))) for i in range(30) for pos in range(rnd.randint(0, 3))]
    links = spark.createDataFrame(rows, "src_url string, pos int, url string")
    path = str(tmp_path / "state")
    for batch in range(1, 4):
        counts = crawl_batch(links, path, "0", n)
        capped = crawl_reachable(links, "0", max_pages=batch * n).collect()  # visits fewer if done
        visited, queue = load_progress(spark, path)
        assert {r.url for r in visited.collect()} == {r.url for r in capped if r.visited}
        waiting = sorted((r for r in capped if not r.visited), key=lambda r: r.visit_rank)
        assert [r.url for r in queue.orderBy("depth", "src_ord", "pos").collect()] == [r.url for r in waiting]
        assert counts == {"visited": sum(r.visited for r in capped), "queued": len(waiting)}


def test_fresh_batch_forgets_what_was_saved(spark, tmp_path):
    links = spark.createDataFrame([("a", 0, "b"), ("b", 0, "c"), ("x", 0, "y")], "src_url string, pos int, url string")
    path = str(tmp_path / "state")
    assert crawl_batch(links, path, "a", 2) == {"visited": 2, "queued": 1}
    assert crawl_batch(links, path, "x", 1, fresh=True) == {"visited": 1, "queued": 1}
    assert crawl_batch(links, path, "x", 5) == {"visited": 2, "queued": 0}
    assert crawl_batch(links, path, "x", 5) == {"visited": 2, "queued": 0}


def test_a_page_stored_twice_counts_once(spark):
    again = [("https://h/", "<a href='/zzz'>z</a>", 500, "text/html"), ("https://h/a/1/x", PAGES[1][1], 200, "text/html")]
    pages = spark.createDataFrame([*again, *PAGES], "url string, html string, status int, content_type string")
    rows = crawl_site(pages, "https://h/").orderBy("visit_rank").collect()
    assert [(r.url.removeprefix("https://h/"), r.depth, r.outcome, r.title) for r in rows] == crawl(spark)


def test_long_chain(spark, monkeypatch):
    monkeypatch.setattr("pagemill.operators.frontier.FOLD", 3)
    links = [(str(i), p, str(j)) for i in range(12) for p, j in enumerate((i + 1, max(i - 3, 0)))]
    rows = crawl_reachable(spark.createDataFrame(links, "src_url string, pos int, url string"), "0").collect()
    assert sorted((r.visit_rank, r.depth, r.url) for r in rows) == [(i + 1, i, str(i)) for i in range(13)]


def many_pages(spark, n=60, seed=7):
    rnd = random.Random(seed)
    rows = [
        (f"https://h/a/{i}/x", f"<h1>T{i}</h1>{TEXT}" + "".join(f"<a href='/a/{rnd.randrange(n + 5)}/x'>l</a>" for _ in range(3)) + "<a href='/a/0/x'>hot</a>",
         500 if i % 9 == 8 else 200, "text/html")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "url string, html string, status int, content_type string")


@pytest.fixture
def small_tables(monkeypatch):
    """Tables so small that they are cut into folders and folded all the time."""
    monkeypatch.setattr(clustered, "BUCKET_ROWS", 4)
    for name, value in (("SEGMENT_URLS", 8), ("BUCKET_URLS", 16), ("FOLD", 2)):
        monkeypatch.setattr(seen, name, value)


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_batches_of_pages_equal_one_crawl(spark, tmp_path, monkeypatch, small_tables):
    """Until nothing is queued, with rounds that die before and after their records and links are stored."""
    pages, path, start = many_pages(spark), str(tmp_path / "c"), "https://h/a/3/x"
    whole = crawl_site(pages, start)
    counts, batch = {"queued": 1}, 0
    while counts["queued"]:
        if batch in (1, 2):
            owner, name = [(site_module, "page_links"), (CrawlProgress, "_commit")][batch - 1]
            kept = getattr(owner, name)
            monkeypatch.setattr(owner, name, lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
            before = CrawlProgress(spark, path).state()
            with pytest.raises(RuntimeError):
                crawl_site_batch(pages, start, path, 17)
            monkeypatch.setattr(owner, name, kept)
            assert CrawlProgress(spark, path).state() == before
        counts = crawl_site_batch(pages, start, path, 17)
        batch += 1
        if batch == 2:
            capped = crawl_site(pages, start, max_pages=34)
            assert rows_of(load_site_crawl(spark, path)) == rows_of(capped)
    assert counts["visited"] == whole.count() and batch == -(-counts["visited"] // 17)
    assert rows_of(load_site_crawl(spark, path)) == rows_of(whole)
    write_dataset(spark, path, str(tmp_path / "dataset"))
    records = read_jsonl(spark, str(tmp_path / "dataset"), glob="*.json")
    assert rows_of(records.select("url", "title")) == rows_of(whole.filter("outcome = 'OK'").select("url", "title"))


def test_fresh_crawl_of_pages_and_missing_state(spark, tmp_path):
    pages, path = spark.createDataFrame(PAGES, "url string, html string, status int, content_type string"), str(tmp_path / "c")
    with pytest.raises(ValueError):
        load_site_crawl(spark, path)
    assert crawl_site_batch(pages, "https://h/", path, 2) == {"visited": 2, "queued": 3}
    assert crawl_site_batch(pages, "https://h/", path, 1, fresh=True) == {"visited": 1, "queued": 3}
    assert crawl_site_batch(pages.limit(0), "https://h/", path, 9) == {"visited": 6, "queued": 0}
    assert rows_of(load_site_crawl(spark, path)) == rows_of(crawl_site(pages, "https://h/"))


def test_a_round_reads_the_folders_of_its_pages(spark, tmp_path, small_tables):
    pages, start = many_pages(spark, 200), "https://h/a/3/x"
    site = store_site(pages, start, str(tmp_path / "pages"))
    asked = spark.createDataFrame([(f"https://h/a/{i}/x",) for i in (3, 50, 51)], "url string")
    read = site.near(asked, "url").select(F.input_file_name().alias("f")).distinct().collect()
    folders = {r.f.rsplit("/", 2)[-2] for r in read}
    assert 1 <= len(folders) <= 3 and len(list((tmp_path / "pages/rows").iterdir())) > 20
    assert sorted(r.url for r in site.lookup(asked).collect()) == sorted(r.url for r in asked.collect())
    assert crawl_site_batch(site, start, str(tmp_path / "c"), 5)["visited"] == 5


def test_many_urls_of_a_round_do_not_go_through_the_driver(spark, tmp_path, monkeypatch, plan):
    pages, start = many_pages(spark, 200), "https://h/a/3/x"
    site = store_site(pages, start, str(tmp_path / "pages"))
    spark.createDataFrame([(f"https://h/a/{i}/x", i) for i in range(0, 220, 2)], "url string, place int").write.parquet(str(tmp_path / "asked"))
    asked = spark.read.parquet(str(tmp_path / "asked"))
    plain = rows_of(site.near(asked, "url").join(asked, "url"))
    monkeypatch.setattr(seen, "FEW", 20)
    monkeypatch.setattr(seen, "SEGMENT_URLS", 8)
    for sent in (seen.SENT_SEGMENTS, 0):
        monkeypatch.setattr(seen, "SENT_SEGMENTS", sent)
        found = site.beside(asked, 110)
        assert rows_of(found) == plain and len(plain) == 100
        last = plan(found).split("Join", 1)
        assert last[0].rstrip().endswith("SortMerge")


def test_a_crawl_of_large_rounds_equals_one_crawl(spark, tmp_path, monkeypatch, small_tables):
    monkeypatch.setattr(seen, "FEW", 1)
    pages, start, path = many_pages(spark), "https://h/a/3/x", str(tmp_path / "c")
    while crawl_site_batch(pages, start, path, 30)["queued"]:
        pass
    assert rows_of(load_site_crawl(spark, path)) == rows_of(crawl_site(pages, start))


def test_folders_of_a_stored_table_are_listed_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clustered, "BUCKET_ROWS", 4)
    site = store_site(many_pages(spark, 400), "https://h/a/3/x", str(tmp_path / "pages"))
    assert len(list((tmp_path / "pages/rows").iterdir())) > 32  # more than Spark lists without a job
    asked = spark.createDataFrame([("https://h/a/3/x",)], "url string")
    jobs = []
    for i in range(2):
        spark.sparkContext.setJobGroup(f"near{i}", "")
        site.near(asked, "url")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"near{i}")))
    assert jobs[1] < jobs[0]
    # What is stored anew, also by another, is listed anew.
    store_site(many_pages(spark, 8), "https://h/a/3/x", str(tmp_path / "pages"))
    assert site.near(asked, "url").count() < 9
