"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import prompts as pr
from pagemill.functions import text as tx
from pagemill.functions import urls as ur
from pagemill.functions.html import parse_html
from pagemill.operators import curate, extract, frontier, report, split
from pagemill.plans import inputs, site
from pagemill.plans.inputs import FIXTURE_CONTENT, FIXTURE_PATTERN, table
from pagemill.plans.prepare import prepare_data
from pagemill.plans.prepare import training_text as training_text_of
from pagemill.schemas import PAGE
from pagemill.session import materialize, scratch_path
from pagemill.sources import jsonl
from pagemill.sources.growing import GrowingSplit
from pagemill.sources.pages import load_pages, save_pages
from pagemill.sources.state import load_state, save_state
from pagemill.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First record per URL, then only long texts."""
    return curate.curated_entries(inputs.entries(spark, sf_dir))


def flat(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Records with the category list as one string."""
    return df.select(
        *columns, "title", "text", F.array_join("categories", "|").alias("categories")
    )


# --- text -----------------------------------------------------------------------------


@query
def strip_text(spark, sf_dir):
    padded = F.concat(F.lit(" \x1c \t"), F.col("text"), F.lit("\u3000\n\x85"))
    stripped = tx.strip(padded)
    return table(spark, sf_dir, "documents").select(
        "doc_id", stripped.alias("text"), F.length(stripped).cast("bigint").alias("chars")
    )


@query
def collapse_newlines(spark, sf_dir):
    spread = F.replace(F.col("text"), F.lit(". "), F.lit("\n\n\n\n"))
    return table(spark, sf_dir, "documents", heavy=True).select(
        "doc_id", tx.collapse_newlines(spread).alias("text")
    )


@query
def token_cap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", heavy=True).select("doc_id", "text")
    capped = curate.cap_tokens(docs)
    return capped.select("doc_id", "text", F.col("n_tokens").cast("bigint").alias("n_tokens"))


# --- curation and pairs ---------------------------------------------------------------


@query
def dedup_first_wins(spark, sf_dir):
    return flat(curated(spark, sf_dir), "url", "ord")


@query
def min_length(spark, sf_dir):
    return curate.min_length(inputs.entries(spark, sf_dir)).select("ord", "url", "text")


@query
def category_label(spark, sf_dir):
    return inputs.entries(spark, sf_dir).select(
        "ord", pr.category_label(F.col("categories")).alias("category")
    )


@query
def training_pairs(spark, sf_dir):
    return curate.training_pairs(curated(spark, sf_dir), "url")


@query
def generation_prompts(spark, sf_dir):
    asked = inputs.entries(spark, sf_dir).select(
        "ord", pr.category_label(F.col("categories")).alias("category"), "title"
    )
    return curate.generation_prompts(asked, "ord")


@query
def chat_render(spark, sf_dir):
    return curate.chat_render(curate.training_pairs(curated(spark, sf_dir)))


@query
def chat_messages(spark, sf_dir):
    chats = curate.chat_messages(
        table(spark, sf_dir, "conversations"), F.col("role"), F.col("text")
    )
    message = F.get("messages", F.lit(0))
    return chats.select(
        "conv_id",
        "turn",
        F.size("messages").cast("bigint").alias("n_messages"),
        message["role"].alias("role"),
        message["content"].alias("content"),
        "rendered",
    )


# --- order and split ------------------------------------------------------------------


@query
def seeded_order(spark, sf_dir):
    pairs = curate.training_pairs(curated(spark, sf_dir), "url")
    return split.seeded_order(pairs, "url").select("url", "position", "prompt")


@query
def train_val_split(spark, sf_dir):
    pairs = curate.training_pairs(curated(spark, sf_dir), "url")
    return split.train_val_split(pairs, "url")


@query
def split_growing(spark, sf_dir):
    """The same pairs arriving in three batches, split anew with each."""
    pairs = materialize(curate.training_pairs(curated(spark, sf_dir), "url"), "pairs")
    store = GrowingSplit(spark, scratch_path(spark, "growing"), pairs.schema)
    for batch in range(3):
        store.append(pairs.filter(F.crc32("url") % 3 == batch), batch)
    return store.labelled()


@query
def sample_pair(spark, sf_dir):
    return split.sample_pair(train_val_split(spark, sf_dir), "url").select(
        "prompt", "completion", "split"
    )


@query
def prep_summary(spark, sf_dir):
    read = table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit(".jsonl")).alias("file_name")
    )
    kept = curated(spark, sf_dir).select("url")
    return report.prep_summary(read, split.train_val_split(kept, "url"))


# --- JSON Lines -----------------------------------------------------------------------


def _in_order(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Sorted into several partitions, so that written file names follow `column`."""
    order = F.col(column).desc() if descending else F.col(column).asc()
    parts = df.sparkSession.sparkContext.defaultParallelism
    return df.repartitionByRange(parts, order).sortWithinPartitions(order)


def _write_records(spark: SparkSession, df: DataFrame, label: str, descending: bool = False) -> str:
    """Write records as several JSONL files whose names follow `ord`."""
    path = scratch_path(spark, label)
    jsonl.write_jsonl(_in_order(df, "ord", descending).select(*PAGE.names), path)
    return path


@query
def jsonl_scan(spark, sf_dir):
    """Files hold the records in falling `ord`, so the last record of a URL comes first."""
    path = _write_records(spark, inputs.entries(spark, sf_dir), "scan", descending=True)
    records = jsonl.read_jsonl(spark, path, glob="*.json")
    return flat(curate.curated_entries(records, order=jsonl.SOURCE_ORDER), "url")


@query
def jsonl_rejects(spark, sf_dir):
    """Every tenth line is broken off, every tenth has more after its object."""
    path = scratch_path(spark, "rejects")
    record = F.to_json(F.struct(*PAGE.names), {"ignoreNullFields": "false"})
    broken = F.concat(F.lit('{"url": '), F.col("ord").cast("string"))
    lines = inputs.entries(spark, sf_dir).select(
        F.when(F.col("ord") % 10 == 3, broken)
        .when(F.col("ord") % 10 == 7, F.concat(F.lit("{}"), F.when(F.col("ord") % 20 == 7, F.lit(",")).otherwise(F.lit(" ")), F.lit("{}"), F.col("ord").cast("string")))
        .otherwise(record)
        .alias("value")
    )
    lines.write.text(path)
    good, bad = jsonl.split_rejects(
        jsonl.read_jsonl(spark, path, mode="PERMISSIVE", glob="*.txt")
    )
    return good.select(F.lit("good").alias("kind"), F.col("text").alias("value")).unionByName(
        bad.select(F.lit("bad").alias("kind"), F.col("line").alias("value"))
    )


@query
def dataset_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "dataset")
    jsonl.write_jsonl(inputs.entries(spark, sf_dir).select(*PAGE.names), path)
    return flat(jsonl.read_jsonl(spark, path, glob="*.json"), "url")


@query
def pairs_read(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    jsonl.write_jsonl(curate.training_pairs(curated(spark, sf_dir)), path)
    return jsonl.read_pairs(spark, path)


@query
def split_sink(spark, sf_dir):
    path = scratch_path(spark, "split")
    jsonl.write_split(train_val_split(spark, sf_dir), path)
    train = jsonl.read_pairs(spark, f"{path}/split=train")
    val = jsonl.read_pairs(spark, f"{path}/split=val", optional=True)
    return train.withColumn("split", F.lit("train")).unionByName(
        val.withColumn("split", F.lit("val"))
    )


@query
def prepared_files(spark, sf_dir):
    """Record files to training files in one call; `position` follows file name and line."""
    source = _write_records(spark, inputs.entries(spark, sf_dir), "records")
    path = scratch_path(spark, "prepared")
    prepare_data(spark, source, path, glob="*.json")
    rows = jsonl.read_prepared(spark, path)
    placed = split.numbered(rows, "position", "split", *jsonl.SOURCE_ORDER)
    return placed.select("position", "split", "prompt", "completion")


@query
def training_text(spark, sf_dir):
    """Training files to capped chat text. The written validation part is read in one case
    and really absent in another; the files hold blank lines."""
    path = scratch_path(spark, "text")
    jsonl.write_split(train_val_split(spark, sf_dir), path, key="url")
    spark.createDataFrame([("",), (" \t",)], "value string").write.mode("append").text(f"{path}/split=train")
    both = training_text_of(spark, f"{path}/split=train", f"{path}/split=val", limit=120)
    alone = training_text_of(spark, f"{path}/split=val", f"{path}/none", limit=120)
    rows = both.withColumn("case", F.lit("both")).unionByName(alone.withColumn("case", F.lit("alone")))
    return rows.select("case", "split", "text", F.col("n_tokens").cast("bigint").alias("n_tokens"))


# --- URLs -----------------------------------------------------------------------------


@query
def url_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        ur.url_scheme(url).alias("scheme"),
        ur.url_netloc(url).alias("netloc"),
        ur.url_path(url).alias("path"),
    )


@query
def url_defrag(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", ur.url_defrag(F.col("url")).alias("url"))


@query
def path_pattern(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        ur.path_matches(url, FIXTURE_PATTERN).alias("matches"),
        ur.path_matches(url).alias("matches_default"),
    )


@query
def url_slug(spark, sf_dir):
    """Slugs of the page URLs and of their hosts' front pages."""
    url = F.col("url")
    front = F.concat(ur.url_scheme(url), F.lit("://"), ur.url_netloc(url))
    urls = table(spark, sf_dir, "pages").select(
        "page_id", F.explode(F.array(url, front)).alias("url")
    )
    return urls.select("page_id", "url", ur.url_slug(F.col("url")).alias("slug"))


def _page_hrefs(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """(page_id, src_url, pos, href) for all hrefs of `pages` and any extra ones."""
    page = parse_html(F.col("html"), FIXTURE_CONTENT)
    parsed = table(spark, sf_dir, "pages", heavy=True).select(
        "page_id",
        F.col("url").alias("src_url"),
        page["hrefs"].alias("hrefs"),
        F.array(*extra).cast("array<string>").alias("extra"),
    )
    hrefs = F.concat("hrefs", "extra")
    return parsed.select("page_id", "src_url", F.posexplode(hrefs).alias("pos", "href"))


@query
def href_filter(spark, sf_dir):
    extra = ("#top", "javascript:x", "mailto:a@b.c", "tel:1", "JAVASCRIPT:x", "/ok")
    hrefs = _page_hrefs(spark, sf_dir, *map(F.lit, extra))
    kept = hrefs.filter(ur.href_followable(F.col("href")))
    return kept.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query
def resolve_links(spark, sf_dir):
    return _page_hrefs(spark, sf_dir).select(
        "page_id",
        F.col("pos").cast("bigint").alias("pos"),
        ur.resolve_url(F.col("src_url"), F.col("href")).alias("url"),
    )


@query
def resolve_relative(spark, sf_dir):
    """Every page's URL as the base of one href of each kind."""
    kinds = ("", "#x", "?q=1", "next", "./next", "../up/", "../../../top", "//cdn.example.org/a/../b",
             "https://other.example/x#y", "/r/./s/../t")
    pages = table(spark, sf_dir, "pages", heavy=True).select(
        "page_id", "url", F.explode(F.array(*map(F.lit, kinds))).alias("href")
    )
    return pages.select("page_id", "href", ur.resolve_url(F.col("url"), F.col("href")).alias("url"))


@query
def same_domain(spark, sf_dir):
    """Links of each page, one to another host and one to its own host by another scheme."""
    own = F.concat(F.lit("ftp://"), ur.url_netloc(F.col("url")), F.lit("/x"))
    hrefs = _page_hrefs(spark, sf_dir, F.lit("https://other.example/x"), own)
    resolved = hrefs.withColumn("url", ur.resolve_url(F.col("src_url"), F.col("href")))
    kept = resolved.filter(ur.url_netloc(F.col("url")) == ur.url_netloc(F.col("src_url")))
    return kept.select("page_id", F.col("pos").cast("bigint").alias("pos"), "url")


# --- pages ----------------------------------------------------------------------------


@query
def page_source(spark, sf_dir):
    return extract.page_source(inputs.fetched_pages(spark, sf_dir))


@query
def html_title(spark, sf_dir):
    page = parse_html(F.col("html"), FIXTURE_CONTENT)
    return table(spark, sf_dir, "pages", heavy=True).select("page_id", page["title"].alias("title"))


@query
def html_text(spark, sf_dir):
    page = parse_html(F.col("html"), FIXTURE_CONTENT)
    return table(spark, sf_dir, "pages", heavy=True).select("page_id", page["text"].alias("text"))


@query
def html_categories(spark, sf_dir):
    page = parse_html(F.col("html"))
    docs = inputs.doc_html(spark, sf_dir).select("doc_id", page["categories"].alias("c"))
    return docs.select(
        "doc_id", F.array_join("c", "|").alias("categories"), F.size("c").cast("bigint").alias("n")
    )


@query
def html_roundtrip(spark, sf_dir):
    return flat(extract.page_records(extract.extract_pages(inputs.doc_html(spark, sf_dir))), "doc_id")


@query
def extract_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", heavy=True)
    extracted = extract.extract_pages(pages, content=FIXTURE_CONTENT)
    return flat(extract.page_records(extracted), "page_id", "url")


@query
def extract_reject(spark, sf_dir):
    extracted = extract.extract_pages(inputs.doc_html(spark, sf_dir, faults=True))
    return extracted.select("doc_id", F.coalesce("reject", F.lit("kept")).alias("reject"))


@query
def extract_links(spark, sf_dir):
    links = extract.extract_links(table(spark, sf_dir, "pages", heavy=True), content=FIXTURE_CONTENT)
    return links.select("src_url", F.col("pos").cast("bigint").alias("pos"), "url")


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.page_outcomes(
        inputs.fetched_pages(spark, sf_dir),
        pattern=r"^/\w+/\d+/?$",
        content=FIXTURE_CONTENT,
        min_chars=1500,
    )


@query
def page_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@query
def outcome_counts(spark, sf_dir):
    return extract.outcome_counts(_outcomes(spark, sf_dir))


@query
def page_upsert(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.length("html").alias("chars"))
    last = curate.upsert_pages(pages, by="slug", seq=("page_id",))
    return last.select("host", "slug", "page_id", "url", F.col("chars").cast("bigint").alias("chars"))


@query
def page_store(spark, sf_dir):
    """Pages saved in two batches as if of one host, so that many share a slug; saved in several more first,
    which the last two overwrite and which are folded."""
    path = scratch_path(spark, "store")
    pages = table(spark, sf_dir, "pages")
    one_host = F.concat(F.lit("https://example.com"), ur.url_path(F.col("url")))
    records = pages.select(
        one_host.alias("url"), F.col("page_id").alias("seq"), F.md5("html").alias("digest")
    )
    late = F.col("seq") % 3 == 0
    for early in range(4):
        save_pages(records.withColumn("digest", F.lit("old")), path, early - 4)
    save_pages(records.filter(~late), path, 0)
    save_pages(records.filter(late), path, 1)
    stored = load_pages(spark, path, records.schema, by="slug")
    return stored.select("slug", "url", "seq", "batch", "digest")


# --- visited set, queue, reachability -------------------------------------------------


def _as_queue(df: DataFrame) -> DataFrame:
    return df.select("url", *(F.col(c).cast("bigint").alias(c) for c in frontier.QUEUE_ORDER))


@query
def visit_gate(spark, sf_dir):
    wanted = inputs.queued_pages(spark, sf_dir).unionByName(inputs.queued_links(spark, sf_dir))
    return frontier.visit_gate(wanted, inputs.visited_pages(spark, sf_dir))


@query
def frontier_next(spark, sf_dir):
    visited = inputs.visited_pages(spark, sf_dir)
    queued = inputs.queued_pages(spark, sf_dir).join(visited, "url", "left_anti")
    links = inputs.queued_links(spark, sf_dir)
    # Every page also links to every page's own address, found one level down.
    again = inputs.queued_pages(spark, sf_dir).withColumn("depth", F.lit(1))
    return _as_queue(frontier.frontier_next(links.unionByName(again), visited, queued))


@query
def resume_frontier(spark, sf_dir):
    return _as_queue(
        frontier.resume_frontier(
            inputs.queued_pages(spark, sf_dir),
            inputs.visited_pages(spark, sf_dir),
            "https://example.com/",
        )
    )


@query
def resume_counts(spark, sf_dir):
    visited = inputs.visited_pages(spark, sf_dir)
    queue = frontier.resume_frontier(
        inputs.queued_pages(spark, sf_dir), visited, "https://example.com/"
    )
    return frontier.resume_counts(queue, visited)


@query
def crawl_state(spark, sf_dir):
    """Progress saved twice and loaded: all visited URLs and the latest queue."""
    path = scratch_path(spark, "state")
    queue, visited = inputs.queued_pages(spark, sf_dir), inputs.visited_pages(spark, sf_dir)
    save_state(visited, queue, path)
    rest = queue.join(visited, "url", "left_anti")
    save_state(rest.select("url"), inputs.queued_links(spark, sf_dir), path)
    seen, waiting = load_state(spark, path)
    return seen.select(F.lit("visited").alias("kind"), "url").unionByName(
        waiting.select(F.lit("queued").alias("kind"), "url")
    )


@query
def crawl_resumed(spark, sf_dir):
    """A crawl of stored pages in batches of a third of them, each going on from the saved progress
    of the one before, until nothing is queued."""
    path = scratch_path(spark, "resumed")
    pages = inputs.site_pages(spark, sf_dir)
    n = -(-pages.count() // 3)
    while site.crawl_site_batch(pages, "https://example.com/d/3/x", path, n)["queued"]:
        pass
    return _site_rows(site.load_site_crawl(spark, path))


@query
def frontier_batch(spark, sf_dir):
    return _as_queue(frontier.frontier_batch(inputs.queued_links(spark, sf_dir), 40))


@query
def crawl_reachable(spark, sf_dir):
    reached = frontier.crawl_reachable(inputs.page_graph(spark, sf_dir), "3")
    return reached.select("url", F.col("depth").cast("bigint").alias("depth"), "visit_rank")


@query
def crawl_capped(spark, sf_dir):
    reached = frontier.crawl_reachable(inputs.page_graph(spark, sf_dir), "3", max_pages=40)
    return reached.select(
        "url", F.col("depth").cast("bigint").alias("depth"), "visit_rank", "visited"
    )


def _site_rows(crawled: DataFrame) -> DataFrame:
    return flat(crawled, "url", F.col("depth").cast("bigint").alias("depth"), "visit_rank", "outcome")


@query
def crawl_site(spark, sf_dir):
    """Some pages are stored a second time, with a failed status."""
    pages = inputs.site_pages(spark, sf_dir)
    again = pages.filter(F.xxhash64("url") % 4 == 0).withColumns({"html": F.lit("<a href='/d/0/x'>x</a>"), "status": F.lit(500)})
    return _site_rows(site.crawl_site(pages.unionByName(again), "https://example.com/d/3/x"))


@query
def crawl_links_resumed(spark, sf_dir):
    """A crawl over links in batches of a fourth of the pages: what two of them have visited and queued."""
    path = scratch_path(spark, "resumed")
    links = inputs.page_graph(spark, sf_dir)
    n = table(spark, sf_dir, "pages").count() // 4
    for _ in range(2):
        site.crawl_batch(links, path, "3", n)
    visited, queue = site.load_progress(spark, path)
    return visited.select("url", F.lit(None).cast("bigint").alias("depth")).unionByName(
        queue.select("url", F.col("depth").cast("bigint").alias("depth"))
    )


@query
def crawl_site_capped(spark, sf_dir):
    pages = inputs.site_pages(spark, sf_dir)
    return _site_rows(site.crawl_site(pages, "https://example.com/d/3/x", max_pages=100))


# --- streaming ------------------------------------------------------------------------


def _two_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Entries in two deliveries: URLs found in the first only, the second only, or both."""
    records = inputs.entries(spark, sf_dir)
    early = F.col("ord") % 5 < 3
    return [records.filter(early), records.filter(~early)]


def _deliver(df: DataFrame, in_dir: str) -> None:
    """Add a delivery's files to the watched folder."""
    jsonl.write_jsonl(_in_order(df, "ord").select(*PAGE.names), in_dir, mode="append")


@query
def stream_ingest(spark, sf_dir):
    in_dir, out_dir = scratch_path(spark, "arrivals"), scratch_path(spark, "ingested")
    for delivery in _two_arrivals(spark, sf_dir):
        _deliver(delivery, in_dir)
        ingest.stream_ingest(spark, in_dir, out_dir, glob="*.json").awaitTermination()
    stored = ingest.read_batches(spark, out_dir, PAGE)
    return flat(curate.min_length(stored), "url")


@query
def stream_resume(spark, sf_dir):
    """Records with the run that stored them: two deliveries, and a rerun without a new one."""
    in_dir, out_dir = scratch_path(spark, "arrivals"), scratch_path(spark, "ingested")
    for delivery in [*_two_arrivals(spark, sf_dir), None]:
        if delivery is not None:
            _deliver(delivery, in_dir)
        ingest.stream_ingest(spark, in_dir, out_dir, glob="*.json").awaitTermination()
    stored = ingest.read_batches(spark, out_dir, PAGE)
    return flat(stored, "url", (F.col("batch") + 1).alias("run"))


def _crawled_stream(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a crawl that has taken in two deliveries."""
    in_dir, out_dir = scratch_path(spark, "fetched"), scratch_path(spark, "crawled")
    pages = inputs.fetched_pages(spark, sf_dir).withColumn("url", ur.url_defrag(F.col("url")))
    early = F.col("page_id") % 3 < 2
    for part in (pages.filter(early), pages.filter(~early)):
        _in_order(part, "page_id").select(*ingest.FETCHED.names).write.mode("append").parquet(in_dir)
        ingest.stream_crawl(
            spark, in_dir, out_dir, pattern=r"^/\w+/\d+/?$", content=FIXTURE_CONTENT
        ).awaitTermination()
    return out_dir


@query
def stream_report(spark, sf_dir):
    """Pages by outcome, and URLs visited and queued, after each of two runs."""
    report = ingest.crawl_report(spark, _crawled_stream(spark, sf_dir))
    return report.select((F.col("batch") + 1).alias("run"), *[F.col(n).alias(n.lower()) for n in ingest.REPORT.names])


@query
def stream_crawl(spark, sf_dir):
    """Pages with their outcome, and the queue, after taking in two deliveries."""
    out_dir = _crawled_stream(spark, sf_dir)
    stored = ingest.read_batches(spark, f"{out_dir}/pages", ingest.CRAWLED)
    queue = ingest.crawl_frontier(spark, out_dir)
    none = F.lit(None).cast("string")
    return stored.select(
        "url", "outcome", "title", F.md5("text").alias("digest"), F.array_join("categories", "|").alias("categories")
    ).unionByName(
        queue.select("url", F.lit("QUEUED").alias("outcome"), *[none.alias(c) for c in ("title", "digest", "categories")])
    )
