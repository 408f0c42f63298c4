"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.html import parse_html
from pagemill.functions.urls import url_defrag
from pagemill.operators.extract import explode_links
from pagemill.sources.tables import read_table

FIXTURE_CONTENT = ("article", None)
FIXTURE_PATTERN = r"^/\w+/\d+"


def table(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", heavy)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records from `documents`: every URL twice, some titles empty, some categories
    null or empty; `ord` is the source order."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(
            F.lit("https://example.com/d/"), F.expr("doc_id div 2").cast("string")
        ).alias("url"),
        F.when(doc % 6 == 0, F.lit(""))
        .otherwise(F.concat("source", F.lit(" "), doc.cast("string")))
        .alias("title"),
        F.col("text"),
        F.when(doc % 7 == 0, F.lit(None))
        .when(doc % 5 == 0, F.array().cast("array<string>"))
        .otherwise(F.array("lang", "source"))
        .alias("categories"),
        doc.alias("ord"),
    )


def _escape(c: Column) -> Column:
    return F.replace(
        F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"),
        F.lit("&gt;"),
    )


def doc_html(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """`documents` wrapped into HTML whose extraction is known. With `faults` every tenth
    page has no heading and every tenth none of the content class."""
    doc = F.col("doc_id")
    heading = F.concat(
        F.lit("<h1> "), _escape(F.col("source")), F.lit(" <b>"), _escape(F.col("lang")), F.lit("</b></h1>")
    )
    css = F.lit("story text")
    if faults:
        heading = F.when(doc % 10 == 1, F.lit("")).otherwise(heading)
        css = F.when(doc % 10 == 2, F.lit("textual")).otherwise(css)
    html = F.concat(
        F.lit('<html><body><div class="ad">x</div>'),
        heading,
        F.lit('<div class="'),
        css,
        F.lit('"><p>'),
        _escape(F.col("text")),
        F.lit("</p><div>tail</div></div><p><strong>Kategori:</strong> <a href=\"/c\">"),
        _escape(F.col("lang")),
        F.lit("</a> och <a>"),
        _escape(F.col("source")),
        F.lit("</a><p>z</body></html>"),
    )
    return table(spark, sf_dir, "documents", heavy=True).select(
        "doc_id", F.concat(F.lit("https://example.com/d/"), doc.cast("string")).alias("url"), html.alias("html")
    )


def _site_path(number: Column) -> Column:
    """Every fourth page is a list page, whose path the default pattern does not match."""
    text = number.cast("string")
    return F.when(number % 4 == 0, F.concat(F.lit("/list/"), text)).otherwise(
        F.concat(F.lit("/d/"), text, F.lit("/x"))
    )


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site made of `documents`: page i links to 2i+1, 2i+2 and i div 3, to another site
    and to itself. Some links lead to pages that do not exist."""
    doc = F.col("doc_id")
    html = F.concat(
        F.lit('<a href="#top">top</a><a href="mailto:a@example.com">mail</a><a href="'),
        _site_path(2 * doc + 1),
        F.lit('#part">a</a><a href="https://example.com'),
        _site_path(2 * doc + 2),
        F.lit('">b</a><a href="https://other.example/d/1/x">c</a><a href="../.././'),
        F.substr(_site_path(F.expr("doc_id div 3")), F.lit(2)),
        F.lit('">d</a><a href="">self</a><h1>'),
        F.col("source"),
        F.lit('</h1><div class="text">'),
        _escape(F.col("text")),
        F.lit("</div><p><strong>Kategori</strong><a>"),
        F.col("lang"),
        F.lit("</a>"),
    )
    return table(spark, sf_dir, "documents", heavy=True).select(
        F.concat(F.lit("https://example.com"), _site_path(doc)).alias("url"),
        html.alias("html"),
        F.when(doc % 9 == 8, 500).otherwise(200).alias("status"),
    )


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pages` with a status and a content type: some failed, some not HTML."""
    return table(spark, sf_dir, "pages", heavy=True).select(
        "page_id",
        "url",
        "html",
        F.when(F.col("page_id") % 11 == 3, 404).otherwise(200).alias("status"),
        F.when(F.col("page_id") % 13 == 5, F.lit("application/pdf"))
        .otherwise(F.lit("text/html; charset=utf-8"))
        .alias("content_type"),
    )


def page_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links i -> 2i+1, 2i+2, i div 3 between the ids of `pages`."""
    ids = table(spark, sf_dir, "pages").select("page_id")
    i = F.col("page_id")
    targets = F.array(2 * i + 1, 2 * i + 2, F.expr("page_id div 3"))
    return (
        ids.select(i.alias("src"), F.posexplode(targets).alias("pos", "dst"))
        .join(ids.withColumnRenamed("page_id", "dst"), "dst", "left_semi")
        .select(
            F.col("src").cast("string").alias("src_url"), "pos", F.col("dst").cast("string").alias("url")
        )
    )


def visited_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of the first half of `pages`."""
    half = F.expr("(max(page_id) + 1) div 2")
    pages = table(spark, sf_dir, "pages")
    limit = pages.agg(half.alias("half")).first()["half"]
    return pages.filter(F.col("page_id") < limit).select(
        url_defrag(F.col("url")).alias("url")
    )


def queued_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page URLs as a queue in page order."""
    return table(spark, sf_dir, "pages").select(
        url_defrag(F.col("url")).alias("url"),
        F.lit(0).alias("depth"),
        F.col("page_id").alias("src_ord"),
        F.lit(0).alias("pos"),
    )


def queued_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of `pages` in queue form, one level below the pages."""
    parsed = table(spark, sf_dir, "pages", heavy=True).select(
        F.col("page_id").alias("src_ord"),
        "url",
        parse_html(F.col("html"), FIXTURE_CONTENT).alias("page"),
    )
    return explode_links(parsed, None, "src_ord").select(
        "url", F.lit(1).alias("depth"), "src_ord", "pos"
    )
