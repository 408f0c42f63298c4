"""Prompt, completion and chat text as native string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.text import strip

# Prompt wording and chat markers.
DEFAULT_LABEL = "Allmänt"
CATEGORY_LINE = "Kategori: "
TITLE_LINE = "\nTitel: "
WRITE_LINE = "\n\nSkriv text:"
TEXT_START = "<|begin_of_text|>"
ROLE_OPEN = "<|start_header_id|>"
ROLE_CLOSE = "<|end_header_id|>\n\n"
TURN_END = "<|eot_id|>"


def category_label(categories: Column, default: str = DEFAULT_LABEL) -> Column:
    """Categories joined with ', '; null or empty gives the default label.

    A null inside the list counts as an empty name instead of vanishing."""
    names = F.transform(categories, lambda c: F.coalesce(c, F.lit("")))
    return F.when(F.coalesce(F.size(categories), F.lit(0)) > 0, F.array_join(names, ", ")).otherwise(
        F.lit(default)
    )


def training_prompt(label: Column, title: Column) -> Column:
    """The title line is present even when the title is empty."""
    return F.concat(
        F.lit(CATEGORY_LINE), label, F.lit(TITLE_LINE), F.coalesce(title, F.lit("")), F.lit(WRITE_LINE)
    )


def training_completion(text: Column) -> Column:
    """One blank, then the text as it is, not stripped."""
    return F.concat(F.lit(" "), F.coalesce(text, F.lit("")))


def generation_prompt(label: Column, title: Column) -> Column:
    """Unlike in training, an empty title leaves the title line out."""
    line = F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit(TITLE_LINE), title))
    return F.concat(F.lit(CATEGORY_LINE), label, F.coalesce(line, F.lit("")), F.lit(WRITE_LINE))


def role_header(role: Column) -> Column:
    return F.concat(F.lit(ROLE_OPEN), role, F.lit(ROLE_CLOSE))


def chat_text(prompt: Column, completion: Column) -> Column:
    """A finished user/assistant exchange; only the completion is stripped."""
    return F.concat(
        F.lit(TEXT_START),
        role_header(F.lit("user")),
        prompt,
        F.lit(TURN_END),
        role_header(F.lit("assistant")),
        strip(completion),
        F.lit(TURN_END),
    )


def open_chat_text(role: Column, content: Column) -> Column:
    """One message followed by an open assistant header, ready for generation."""
    return F.concat(
        F.lit(TEXT_START),
        role_header(role),
        content,
        F.lit(TURN_END),
        role_header(F.lit("assistant")),
    )
