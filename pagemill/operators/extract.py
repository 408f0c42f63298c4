"""Pages to page records, links and outcomes. Every operator here is a narrow map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.html import CATEGORY_MARK, CONTENT, parse_html
from pagemill.functions.text import collapse_newlines
from pagemill.functions.urls import (
    DEFAULT_PATH_PATTERN,
    base_parts,
    href_followable,
    path_matches,
    resolve_all,
    url_netloc,
)

MIN_PAGE_CHARS = 50  # fixed value: shortest main text worth keeping
# The type of a page, and the length of a title's preview.
HTML_TYPE, PREVIEW_CHARS = "text/html", 60


def parse_pages(
    pages: DataFrame,
    content: tuple[str, str | None] = CONTENT,
    mark: str = CATEGORY_MARK,
    html: Column | None = None,
) -> DataFrame:
    """Replace the html column by the parsed struct `page` and the tidied main text `text`."""
    parsed = parse_html(F.col("html") if html is None else html, content, mark)
    return with_text(pages.withColumn("page", parsed).drop("html"))


def with_text(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("text", collapse_newlines(F.col("page.text")))


def reject_reason(min_chars: int = MIN_PAGE_CHARS) -> Column:
    """Why a parsed page gives no record; null when it does. First reason wins."""
    return (
        F.when(F.col("page.title") == "", F.lit("no_title"))
        .when(F.col("page.text").isNull(), F.lit("no_content"))
        .when(F.length("text") < min_chars, F.lit("short_text"))
    )


def extract_pages(
    pages: DataFrame,
    content: tuple[str, str | None] = CONTENT,
    mark: str = CATEGORY_MARK,
    min_chars: int = MIN_PAGE_CHARS,
) -> DataFrame:
    """Title, text and categories of each page plus `reject`, null for a good record."""
    keep = [c for c in pages.columns if c != "html"]
    return parse_pages(pages, content, mark).select(
        *keep,
        "page.title",
        "text",
        "page.categories",
        reject_reason(min_chars).alias("reject"),
    )


def page_records(extracted: DataFrame) -> DataFrame:
    """The accepted pages of `extract_pages`."""
    return extracted.filter(F.col("reject").isNull()).drop("reject")


def page_links(base: Column, hrefs: Column, domain: Column) -> Column:
    """Links of one page worth following: resolved, on `domain`, without fragment, distinct,
    in order of first occurrence. array_distinct keeps the first of equals, so no shuffle
    is needed to make links unique within their page."""
    resolved = resolve_all(base, F.filter(hrefs, href_followable))
    return F.array_distinct(F.filter(resolved, lambda u: url_netloc(u) == domain))


def extract_links(
    pages: DataFrame,
    base_domain: str | None = None,
    content: tuple[str, str | None] = CONTENT,
) -> DataFrame:
    """(src_url, pos, url): one row per distinct link of a page. Without `base_domain` each
    page counts links on its own host."""
    parsed = pages.select("url", parse_html(F.col("html"), content).alias("page"))
    return explode_links(parsed, base_domain)


def explode_links(parsed: DataFrame, base_domain: str | None = None, *keep: str) -> DataFrame:
    """Links of parsed pages (url, page), after any columns named in `keep`."""
    domain = url_netloc(F.col("src_url")) if base_domain is None else F.lit(base_domain)
    based = parsed.select(
        *keep,
        F.col("url").alias("src_url"),
        F.col("page.hrefs").alias("_hrefs"),
    ).withColumns({"_base": base_parts(F.col("src_url")), "_domain": domain})
    links = page_links(F.col("_base"), F.col("_hrefs"), F.col("_domain"))
    return based.select(*keep, "src_url", F.posexplode(links).alias("pos", "url"))


def page_source(pages: DataFrame) -> DataFrame:
    """Responses that hold a page: status OK and an HTML content type. Columns that the
    table does not have are taken as fine."""
    return pages.filter(_fetched(pages) & _is_html(pages)).select("url", "html")


def _fetched(pages: DataFrame) -> Column:
    if "status" not in pages.columns:
        return F.lit(True)
    return F.coalesce(F.col("status") < 400, F.lit(False))


def _is_html(pages: DataFrame) -> Column:
    if "content_type" not in pages.columns:
        return F.lit(True)
    return F.contains(F.coalesce(F.col("content_type"), F.lit("")), F.lit(HTML_TYPE))


def fetch_state(pages: DataFrame) -> Column:
    """ERROR or NON_HTML for a response that holds no page, null for one that does."""
    return F.when(~_fetched(pages), F.lit("ERROR")).when(~_is_html(pages), F.lit("NON_HTML"))


def record_outcome(pattern: str, min_chars: int) -> Column:
    """CRAWL, SKIP or OK for a parsed page with the columns `url`, `page` and `text`."""
    return (
        F.when(~path_matches(F.col("url"), pattern), F.lit("CRAWL"))
        .when(reject_reason(min_chars).isNotNull(), F.lit("SKIP"))
        .otherwise(F.lit("OK"))
    )


def page_outcomes(
    pages: DataFrame,
    pattern: str = DEFAULT_PATH_PATTERN,
    content: tuple[str, str | None] = CONTENT,
    mark: str = CATEGORY_MARK,
    min_chars: int = MIN_PAGE_CHARS,
) -> DataFrame:
    """(url, outcome, title_preview) with outcome ERROR, NON_HTML, CRAWL (links only), SKIP
    (no record) or OK. Only pages that can become OK or SKIP are sent to the parser."""
    state = F.coalesce(
        fetch_state(pages), F.when(~path_matches(F.col("url"), pattern), F.lit("CRAWL"))
    )
    flagged = pages.select("url", "html", state.alias("state"))
    wanted = F.when(F.col("state").isNull(), F.col("html"))
    parsed = parse_pages(flagged, content, mark, html=wanted)
    outcome = F.coalesce(
        F.col("state"),
        F.when(reject_reason(min_chars).isNotNull(), F.lit("SKIP")).otherwise(F.lit("OK")),
    )
    return parsed.withColumn("outcome", outcome).select(
        "url",
        "outcome",
        F.when(F.col("outcome") == "OK", F.substring("page.title", 1, PREVIEW_CHARS)).alias("title_preview"),
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("pages"))
