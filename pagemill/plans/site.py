"""Crawl of one site over stored pages: what a crawler would visit, in its order, with the
outcome and the record of every visited page, whole or batch by batch."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.html import CATEGORY_MARK, CONTENT, parse_html
from pagemill.functions.urls import DEFAULT_PATH_PATTERN, base_parts, url_netloc
from pagemill.operators.curate import first_per_key
from pagemill.operators.extract import (
    MIN_PAGE_CHARS,
    explode_links,
    fetch_state,
    page_links,
    record_outcome,
    with_text,
)
from pagemill.operators.frontier import crawl_reachable
from pagemill.schemas import PAGE
from pagemill.session import materialize, scratch_path
from pagemill.sources.clustered import Clustered
from pagemill.sources.jsonl import write_jsonl
from pagemill.sources.progress import CrawlProgress

RECORD = "url string, depth int, place bigint, outcome string, title string, text string, categories array<string>, links array<string>"


def one_page_per_url(pages: DataFrame) -> DataFrame:
    """One row per URL: a response that holds a page before one that does not, then the
    smallest digest of the html.

    Only the URLs are read to find those stored more than once; the html of the others is
    not moved.
    """
    repeated = pages.groupBy("url").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("url")
    repeated = materialize(repeated, "repeated")
    if repeated.isEmpty():
        return pages
    some = pages.join(repeated, "url", "left_semi")
    order = [fetch_state(some).asc_nulls_first(), F.md5(F.coalesce("html", F.lit("")))]
    chosen = first_per_key(some, F.col("url"), order).select(*pages.columns)
    return pages.join(repeated, "url", "left_anti").select(*pages.columns).unionByName(chosen)


def crawl_site(
    pages: DataFrame,
    start_url: str,
    max_pages: int = 0,
    pattern: str = DEFAULT_PATH_PATTERN,
    content: tuple[str, str | None] = CONTENT,
    mark: str = CATEGORY_MARK,
    min_chars: int = MIN_PAGE_CHARS,
) -> DataFrame:
    """One row per URL reached from `start_url`: url, depth, visit_rank, outcome, title, text
    and categories, the last three for outcome OK only.

    Outcomes are those of `page_outcomes`, plus ERROR for a URL that has no stored page and
    QUEUED for one that `max_pages` left unvisited. Of several pages stored under one URL one
    counts, see `one_page_per_url`.

    Pages of other hosts are dropped before the parser sees them, and a page is parsed once:
    links and record come from the same stored result. With `max_pages` the crawl is the
    first batch of one that could go on, see `crawl_site_batch`: pages are looked up and only the visited ones parsed.
    """
    if max_pages:
        path = scratch_path(pages.sparkSession, "crawl")
        crawl_site_batch(pages, start_url, path, max_pages, pattern, content, mark, min_chars)
        return load_site_crawl(pages.sparkSession, path)
    domain = urlparse(start_url).netloc
    site = one_page_per_url(pages.filter(url_netloc(F.col("url")) == domain))

    def parse(some: DataFrame) -> DataFrame:
        flagged = some.select("url", "html", fetch_state(some).alias("state"))
        fetched = F.when(F.col("state").isNull(), F.col("html"))
        page = parse_html(fetched, content, mark).alias("page")
        return materialize(flagged.select("url", "state", page), "parsed")

    def links_in(parsed: DataFrame) -> DataFrame:
        return explode_links(parsed.filter(F.col("state").isNull()), domain)

    parsed = parse(site)
    reached = crawl_reachable(links_in(parsed), start_url, unique=True)
    stored = with_text(parsed).select(
        "url",
        F.coalesce("state", record_outcome(pattern, min_chars)).alias("found"),
        "page.title",
        "text",
        "page.categories",
    )
    outcome = F.when(~F.col("visited"), F.lit("QUEUED")).otherwise(
        F.coalesce("found", F.lit("ERROR"))
    )
    joined = reached.join(stored, "url", "left").withColumn("outcome", outcome)
    saved = {
        name: F.when(F.col("outcome") == "OK", F.col(name)) for name in ("title", "text", "categories")
    }
    return joined.withColumns(saved).select(
        "url", "depth", "visit_rank", "outcome", "title", "text", "categories"
    )


def store_site(pages: DataFrame, start_url: str, path: str) -> Clustered:
    """The pages of the start URL's host, one a URL, stored so that crawls can look them up."""
    domain = urlparse(start_url).netloc
    site = one_page_per_url(pages.filter(url_netloc(F.col("url")) == domain))
    flagged = site.select("url", "html", fetch_state(site).alias("state"))
    return Clustered(pages.sparkSession, path).store(flagged)


def crawl_site_batch(
    pages: DataFrame | Clustered,
    start_url: str,
    path: str,
    n: int,
    pattern: str = DEFAULT_PATH_PATTERN,
    content: tuple[str, str | None] = CONTENT,
    mark: str = CATEGORY_MARK,
    min_chars: int = MIN_PAGE_CHARS,
    fresh: bool = False,
) -> dict[str, int]:
    """Visit `n` more URLs of a site, oldest first, store their records, and save progress below `path`; call again to go
    on from there, until nothing is queued. Returns the numbers visited and queued so far.

    `pages` are stored by URL with the first batch, and again with `fresh`; later batches may pass them, or what
    `store_site` returned. A round reads the folders that its URLs hash to, parses their pages
    once, and asks about the links found; nothing that earlier rounds read or wrote is read again. See
    `load_site_crawl` for the rows and `write_dataset` for the records.
    """
    spark = pages.spark if isinstance(pages, Clustered) else pages.sparkSession
    domain = urlparse(start_url).netloc
    site = pages if isinstance(pages, Clustered) else Clustered(spark, f"{path}/pages")
    if not isinstance(pages, Clustered) and (fresh or not site.is_stored()):
        store_site(pages, start_url, site.path)
    progress = CrawlProgress(spark, path)
    # Built once: the expressions are the same in every round.
    page = parse_html(F.when(F.col("state").isNull(), F.col("html")), content, mark).alias("page")
    outcome = F.coalesce("state", record_outcome(pattern, min_chars))
    saved = [F.when(F.col("outcome") == "OK", F.col(c)).alias(n) for n, c in (("title", "page.title"), ("text", "text"), ("categories", "page.categories"))]
    links = page_links(base_parts(F.col("url")), F.col("page.hrefs"), F.lit(domain))
    links = F.when(F.col("state").isNull(), links).alias("links")

    def visit(batch: DataFrame, size: int, version: int) -> DataFrame:
        # The html is on the side that stays where it is as long as the batch is small. URLs without a page
        # have no record; `load_site_crawl` tells them by that.
        known = site.beside(batch, size)
        parsed = with_text(known.select("url", "depth", "place", "state", page)).withColumn("outcome", outcome)
        folder = progress.log.folder(f"records-{version:012d}")
        parsed.select("url", "depth", "place", "outcome", *saved, links).write.mode("overwrite").parquet(folder)
        rows = spark.read.schema(RECORD).parquet(folder)
        return rows.select((F.col("depth") + 1).alias("depth"), F.col("place").alias("src_ord"), F.posexplode("links").alias("pos", "url"))

    return _counts(progress.advance(visit, start_url, n, fresh, records=True))


def _counts(state: dict) -> dict[str, int]:
    return {"visited": state["head"] - state["first"], "queued": state["tail"] - state["head"]}


def load_site_crawl(spark: SparkSession, path: str) -> DataFrame:
    """What a batched crawl has come to, one row for each URL found, as `crawl_site` returns it."""
    progress = CrawlProgress(spark, path)
    state = progress.state()
    if state is None:
        raise ValueError(f"no crawl is saved at {path}")
    rank = (F.col("place") - state["first"] + 1).alias("visit_rank")
    found = progress.places(state, state["first"], state["tail"]).select("url", "depth", "place")
    rows = spark.createDataFrame([], RECORD)
    if state["records"]:
        rows = spark.read.schema(RECORD).parquet(*map(progress.log.folder, state["records"]))
    outcome = F.when(F.col("place") >= state["head"], F.lit("QUEUED")).otherwise(F.coalesce("outcome", F.lit("ERROR")))
    rows = found.join(rows.select("place", "outcome", *PAGE.names[1:]), "place", "left")
    return rows.select("url", "depth", rank, outcome.alias("outcome"), *PAGE.names[1:])


def write_dataset(spark: SparkSession, path: str, out: str) -> None:
    """The records of all pages visited so far, in one JSON Lines folder that replaces an earlier one."""
    records = load_site_crawl(spark, path).filter("outcome = 'OK'").select(*PAGE.names)
    write_jsonl(records, out, mode="overwrite")


def crawl_batch(
    links: DataFrame, state_path: str, seed: str, n: int, fresh: bool = False
) -> dict[str, int]:
    """Visit `n` more URLs of a table of links (src_url, pos, url), oldest first, and save progress; call
    again to go on from there.

    The links are stored by source with the first batch, and again with `fresh`, so that a round reads
    those of its own URLs. Visited URLs and queue (`load_progress`) are at any time those of a crawl
    that takes one URL after the other. Returns the numbers visited and queued.
    """
    spark = links.sparkSession
    stored = Clustered(spark, f"{state_path}/links", "src_url")
    if fresh or not stored.is_stored():
        stored.store(links.select("src_url", "pos", "url"))

    def visit(batch: DataFrame, size: int, version: int) -> DataFrame:
        parents = batch.select(F.col("url").alias("src_url"), (F.col("depth") + 1).alias("depth"), F.col("place").alias("src_ord"))
        return stored.beside(parents, size).select("url", "depth", "src_ord", "pos")

    return _counts(CrawlProgress(spark, state_path).advance(visit, seed, n, fresh))


def load_progress(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(visited, queue) of a batched crawl; the queue has the frontier's columns."""
    progress = CrawlProgress(spark, path)
    state = progress.state()
    if state is None:
        raise ValueError(f"no crawl is saved at {path}")
    return progress.visited(state).select("url"), progress.queue(state).select("url", "depth", "src_ord", "pos")
