import itertools
import sys

import pyspark.sql.functions as F

from pagemill.functions import text as tx
from pagemill.operators.curate import cap_tokens, min_length


def test_whitespace_is_what_python_strips():
    assert set(tx.WHITESPACE) == {chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()}


def test_strip_equals_python(spark):
    texts = [f"{w}a{w}b{w}" for w in tx.WHITESPACE] + [
        "", " ", "\x1c\xa0", "​x​", "x", "\n\n å😀 　", "a ", "﻿a"
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.strip(F.col("t")).alias("s"))
    for row in rows.collect():
        assert row.s == row.t.strip()


def test_whitespace_run_splits_like_python(spark):
    texts = ["a" + "b".join(pair) + "c" for pair in itertools.product(tx.WHITESPACE + "\u200b\ufeff_x", repeat=2)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.whitespace_pieces(F.col("t")).alias("s"))
    for row in rows.collect():
        assert [piece.strip() for piece in row.s] == row.t.split() and "".join(row.s) == row.t


def test_collapse_newlines(spark):
    cases = {"a\n\nb": "a\n\nb", "a\n\n\nb": "a\n\nb", "\n\n\n\na\n\n\n\n\nb\n\n\n": "a\n\nb", "\n": ""}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", tx.collapse_newlines(F.col("t")).alias("s"))
    assert {r.t: r.s for r in rows.collect()} == cases


def test_min_length_counts_code_points_and_keeps_the_text(spark):
    rows = [("a" * 99,), ("a" * 100,), (" " + "😀" * 100 + "\xa0",), ("a" * 99 + "\xa0\x1c",), (None,)]
    kept = min_length(spark.createDataFrame(rows, "text string")).collect()
    assert {r.text for r in kept} == {"a" * 100, " " + "😀" * 100 + "\xa0"}


def test_token_cap(spark):
    long = " ".join(f"w{i}" for i in range(600))
    rows = spark.createDataFrame([(0, long), (1, " a　b \n"), (2, " "), (3, None)], "id int, text string")
    got = {r.id: (r.text, r.n_tokens) for r in cap_tokens(rows).collect()}
    assert got == {0: (" ".join(long.split()[:512]), 600), 1: (" a　b \n", 2), 2: (" ", 0), 3: ("", 0)}


def test_token_cap_leaves_blanks_alone(spark):
    rows = spark.createDataFrame([(" a  b\n\nc\x1c d ",)], "text string")
    cut = {n: cap_tokens(rows, n=n).first()[:] for n in (0, 1, 2, 3, 4)}
    assert cut == {0: (("", 4)), 1: (" a", 4), 2: (" a  b", 4), 3: (" a  b\n\nc", 4), 4: (" a  b\n\nc\x1c d ", 4)}


def test_token_cap_with_another_tokenizer(spark):
    rows = spark.createDataFrame([("abcd",)], "text string")
    got = cap_tokens(rows, n=2, tokenizer=lambda c: F.split(c, "")).first()
    assert (got.text, got.n_tokens) == ("ab", 4)
