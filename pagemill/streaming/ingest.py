"""Incremental ingestion with Structured Streaming.

Each micro-batch goes to its own `batch=<id>` partition of the output. What has been seen, and the
crawl queue, are kept beside the output in versions of their own, one a batch: a batch asks
them about its own URLs and does not reread what earlier ones wrote. They follow the output
within the batch, so a batch that dies half-way is replayed as a whole; a replayed batch
overwrites its partition and starts from the versions before it, so replay changes
nothing. The checkpoint holds the progress: starting again continues where the last
run stopped, whether it ended or was killed.

A run takes in all files that have arrived as one batch, so the record that wins a URL does not
depend on how many files a batch may hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pagemill.functions.html import CATEGORY_MARK, CONTENT, parse_html
from pagemill.functions.urls import DEFAULT_PATH_PATTERN
from pagemill.operators.curate import first_per_key
from pagemill.operators.extract import MIN_PAGE_CHARS, explode_links, fetch_state, record_outcome, with_text
from pagemill.schemas import PAGE
from pagemill.sources.jsonl import SOURCE_ORDER, not_blank, number_rows, parse_lines, with_place
from pagemill.sources.paths import exists
from pagemill.sources.queue import CrawlQueue
from pagemill.sources.seen import SeenUrls

_BATCH = T.StructField("batch", T.LongType())
LINKS = T.StructType([
    T.StructField("src_ord", T.LongType()),
    T.StructField("src_url", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("url", T.StringType()),
])


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches written so far, with their `batch` number."""
    return spark.read.schema(T.StructType([*schema.fields, _BATCH])).parquet(path)


def _start(
    stream: DataFrame,
    checkpoint: str,
    every: str | None,
    handle: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def _seen_before(
    spark: SparkSession, path: str, schema: T.StructType, batch_id: int
) -> SeenUrls:
    """The URLs that the batches at `path` have stored.

    Later batches can only come from another checkpoint: going on would overwrite them.
    Output that was written without the set is read once to make it.
    """
    seen = SeenUrls(spark, f"{path}/_seen")
    last = seen.last()
    if last is None and exists(spark, path):
        written = read_batches(spark, path, schema)
        last = written.agg(F.max("batch")).first()[0]
        earlier = written.filter(F.col("batch") < batch_id).select("url")
        if last is not None and last <= batch_id and not earlier.isEmpty():
            seen.add(earlier.distinct(), batch_id - 1)
    if last is not None and last > batch_id:
        raise ValueError(f"{path} holds batches after {batch_id}: it belongs to another checkpoint")
    return seen


def _stored(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/batch={batch_id}")


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def stream_ingest(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str | None = None,
    schema: T.StructType = PAGE,
    glob: str = "*.jsonl",
    every: str | None = None,
) -> StreamingQuery:
    """Take in JSONL files as they arrive; the first record of every URL is kept.

    Within a batch first means file name, then line; an earlier batch comes before a later
    one. Short records are stored too, because they also use up their URL: apply
    `min_length` when reading. Processes what is there, then stops; with `every`, such as
    "1 minute", keeps looking for new files.
    """
    lines = spark.readStream.option("pathGlobFilter", glob).text(in_dir)

    def keep_new(batch: DataFrame, batch_id: int) -> None:
        records = parse_lines(not_blank(number_rows(batch)), schema).withColumn(
            "url", F.coalesce(F.col("url"), F.lit(""))
        )
        order = [F.col(c) for c in SOURCE_ORDER]
        session = batch.sparkSession
        seen = _seen_before(session, out_dir, schema, batch_id)
        first = first_per_key(records, F.col("url"), order).select(*schema.names).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _write_batch(seen.unseen(first, before=batch_id), out_dir, batch_id)
        finally:
            first.unpersist()
        seen.add(_stored(session, out_dir, schema, batch_id).select("url"), batch_id)

    place = checkpoint or f"{out_dir}/_checkpoint"
    return _start(with_place(lines, "value"), place, every, keep_new)


FETCHED = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
])
CRAWLED = T.StructType([*PAGE.fields, T.StructField("outcome", T.StringType())])
OUTCOMES = ("OK", "SKIP", "CRAWL", "ERROR", "NON_HTML")
REPORT = T.StructType([T.StructField(name, T.LongType()) for name in (*OUTCOMES, "visited", "queued")])


def stream_crawl(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str | None = None,
    base_domain: str | None = None,
    pattern: str = DEFAULT_PATH_PATTERN,
    content: tuple[str, str | None] = CONTENT,
    mark: str = CATEGORY_MARK,
    min_chars: int = MIN_PAGE_CHARS,
    every: str | None = None,
) -> StreamingQuery:
    """Take in Parquet files of fetched pages (url, html[, status, content_type]) as they arrive.
    A missing status or type is taken as fine. Responses that hold no page get the outcome
    ERROR or NON_HTML and are not parsed.

    Writes `pages` (each URL once with its outcome, and its record if that is OK), `links` and `reports`.
    The queue follows with every batch, see `CrawlQueue`; `crawl_frontier` reads it.
    """
    fetched = spark.readStream.schema(FETCHED).parquet(in_dir)

    def keep_new(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        order = [F.col(c) for c in SOURCE_ORDER]
        queue = CrawlQueue(session, f"{out_dir}/_crawl")
        seen = _seen_before(session, f"{out_dir}/pages", CRAWLED, batch_id)
        # Only the URLs are read to find the pages that came before; the others' html is not moved for it.
        again = seen.hits(batch.select("url").distinct(), before=batch_id)
        rows = number_rows(batch).join(again, "url", "left_anti")
        new = first_per_key(rows, F.col("url"), order)
        new = new.fillna({"status": 200, "content_type": "text/html"})
        flagged = new.withColumn("state", fetch_state(new))
        # Parsed once, used for both tables.
        parsed = flagged.select(
            F.col("line_id").alias("src_ord"),
            "url",
            "state",
            parse_html(F.when(F.col("state").isNull(), F.col("html")), content, mark).alias("page"),
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            links = explode_links(parsed.drop("state"), base_domain, "src_ord")
            _write_batch(links, f"{out_dir}/links", batch_id)
            outcome = F.coalesce("state", record_outcome(pattern, min_chars))
            judged = with_text(parsed).select(
                "url", "page.title", "text", "page.categories", outcome.alias("outcome")
            )
            record = ("title", "text", "categories")
            pages = judged.withColumns(
                {name: F.when(F.col("outcome") == "OK", F.col(name)) for name in record}
            )
            # Counted while they are written, not by another pass.
            tally = Observation()
            pages = pages.observe(tally, *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
            _write_batch(pages, f"{out_dir}/pages", batch_id)
        finally:
            parsed.unpersist()
        stored = _stored(session, f"{out_dir}/pages", CRAWLED, batch_id).select("url")
        seen.add(stored, batch_id)
        links = _stored(session, f"{out_dir}/links", LINKS, batch_id)
        queued = queue.take_in(links.withColumn("depth", F.lit(batch_id)), stored, seen, batch_id)
        counts = [tally.get[o] for o in OUTCOMES]
        report = session.createDataFrame([(*counts, seen.size(), queued)], REPORT).coalesce(1)
        _write_batch(report, f"{out_dir}/reports", batch_id)

    place = checkpoint or f"{out_dir}/_checkpoint"
    return _start(with_place(fetched, *FETCHED.names), place, every, keep_new)


def crawl_frontier(spark: SparkSession, out_dir: str) -> DataFrame:
    """URLs that the pages taken in so far link to and that are not among them. Depth is
    the batch that found the URL first, `src_ord` the page's place in that batch. Reads the
    queue as the last batch left it, not the links and pages of all batches."""
    return CrawlQueue(spark, f"{out_dir}/_crawl").now()


def crawl_report(spark: SparkSession, out_dir: str) -> DataFrame:
    """A row for each batch: its pages by outcome, and the URLs visited and queued after it. The counts were
    taken while the batch was written; neither pages nor links are read for them."""
    return read_batches(spark, f"{out_dir}/reports", REPORT)
