"""Choosing one record per key, dropping short text, forming pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.prompts import (
    category_label,
    chat_text,
    generation_prompt,
    open_chat_text,
    training_completion,
    training_prompt,
)
from pagemill.functions.text import stripped_length, TOKEN_LIMIT, token_cap
from pagemill.functions.urls import url_netloc, url_slug

MIN_TEXT_CHARS = 100  # fixed value: shortest text worth training on


def first_per_key(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of every key.

    A rank filter of this shape is cut before the shuffle: each map task passes on at most
    one row per key, so a key that holds a third of the table reaches its reducer as one
    row per task, not as a third of the table.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dedup_first_wins(
    df: DataFrame, key: str = "url", order: tuple[str, ...] = ("ord",)
) -> DataFrame:
    """First record per URL in source order; records without a URL count as one key.

    Runs before `min_length`: a short first record also removes a longer later one.
    """
    return first_per_key(df, F.coalesce(F.col(key), F.lit("")), [F.col(c) for c in order])


def min_length(df: DataFrame, col: str = "text", n: int = MIN_TEXT_CHARS) -> DataFrame:
    """Rows with at least `n` code points after stripping; the text itself stays as it is."""
    return df.filter(stripped_length(F.col(col)) >= n)


def curated_entries(
    df: DataFrame, key: str = "url", order: tuple[str, ...] = ("ord",), n: int = MIN_TEXT_CHARS
) -> DataFrame:
    """`dedup_first_wins`, then `min_length`.

    The length is taken ahead of the shuffle, so whoever needs only the keys of the result
    does not drag the texts through it.
    """
    measured = df.withColumn("_chars", stripped_length(F.col("text")))
    return dedup_first_wins(measured, key, order).filter(F.col("_chars") >= n).drop("_chars")


def upsert_pages(
    pages: DataFrame, by: str = "url", seq: tuple[str, ...] = ("seq",)
) -> DataFrame:
    """Last write wins. By URL no page is lost; `by='slug'` does what a store with a folder
    per host and a file per slug does, where pages of equal slug replace each other."""
    url, latest = F.col("url"), [F.col(c).desc() for c in seq]
    if by == "url":
        return first_per_key(pages, url, latest)
    keyed = pages.withColumns({"host": url_netloc(url), "slug": url_slug(url)})
    return first_per_key(keyed, F.struct("host", "slug"), latest)


def training_pairs(entries: DataFrame, *keep: str) -> DataFrame:
    """(prompt, completion), after any columns named in `keep`."""
    return entries.select(
        *keep,
        training_prompt(category_label(F.col("categories")), F.col("title")).alias("prompt"),
        training_completion(F.col("text")).alias("completion"),
    )


def generation_prompts(df: DataFrame, *keep: str) -> DataFrame:
    """(prompt) from `category` and `title`."""
    return df.select(
        *keep, generation_prompt(F.col("category"), F.col("title")).alias("prompt")
    )


def chat_render(pairs: DataFrame) -> DataFrame:
    """Only the rendered exchange is kept."""
    return pairs.select(chat_text(F.col("prompt"), F.col("completion")).alias("text"))


def chat_messages(df: DataFrame, role: Column, content: Column) -> DataFrame:
    """A one-message chat per row: the message list and its text up to the open assistant
    header. Rows are independent; turns of one conversation are not gathered."""
    message = F.struct(role.alias("role"), content.alias("content"))
    return df.withColumn("messages", F.array(message)).withColumn(
        "rendered", open_chat_text(role, content)
    )


def cap_tokens(df: DataFrame, col: str = "text", n: int = TOKEN_LIMIT, tokenizer=None) -> DataFrame:
    """Cut `col` to its first `n` tokens and add `n_tokens`, the count before the cut."""
    text, count = token_cap(F.col(col), n, tokenizer)
    return df.withColumns({"n_tokens": count, col: text})
