"""Text cleaning on string columns, all in native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.strip() removes. Spark's one-argument
# trim() removes U+0020 only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
TOKEN_LIMIT = 512  # fixed value: tokens of a training text
NEWLINE_RUN = r"\n{3,}"  # fixed value


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace. A character-set trim is linear in
    the text, where an anchored regexp would retry at every inner run of blanks."""
    return F.trim(c, F.lit(WHITESPACE))


def stripped_length(c: Column) -> Column:
    """Code points left after `strip`; null counts as empty text."""
    return F.length(strip(F.coalesce(c, F.lit(""))))


def collapse_newlines(c: Column) -> Column:
    """Three or more line feeds in a row become two, then the ends are stripped.

    Few texts have any; a plain search spares the others the pattern matching."""
    runs = F.contains(c, F.lit("\n\n\n"))
    return strip(F.when(runs, F.regexp_replace(c, NEWLINE_RUN, "\n\n")).otherwise(c))


# Blanks as a pattern are Unicode's White_Space plus the four separators it leaves out.
# A token with the blanks after it, the first also with those before it.
_TOKEN_PIECE = r"(?U)(?:\A[\s\x1c-\x1f]++)?[^\s\x1c-\x1f]++[\s\x1c-\x1f]*+"


def whitespace_pieces(c: Column) -> Column:
    """Blank-separated tokens, each with the blanks beside it; text of blanks has none."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(_TOKEN_PIECE), F.lit(0))


def token_cap(
    c: Column, limit: int = TOKEN_LIMIT, tokenizer: Callable[[Column], Column] | None = None
) -> tuple[Column, Column]:
    """(text cut after `limit` tokens, number of tokens before the cut).

    A text within the limit stays as it is, a longer one loses the blanks at its new end.
    `tokenizer` maps a text column to an array of pieces that joined give the text back; it
    may wrap an Arrow UDF around a subword tokenizer. The default splits on whitespace.
    """
    pieces = (tokenizer or whitespace_pieces)(c)
    cut = F.rtrim(F.array_join(F.slice(pieces, 1, limit), ""), F.lit(WHITESPACE))
    return F.when(F.size(pieces) > limit, cut).otherwise(F.coalesce(c, F.lit(""))), F.size(pieces)
