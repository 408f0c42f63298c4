"""Piece tables against plain string work, exact round trips, and odd rows."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.llm.fim import FillInMiddle, Piece, view
from pagemill.llm.queries import QUERIES


def plain_fim(key, text, marks=("<P>", "<S>", "<M>"), rate=100, spm=50, seed=7):
    """(n, form, prefix, middle, output) by strings."""
    p, s, m = marks
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(x in text for x in marks) or h3 % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < spm:
        return len(lines), "spm", prefix, middle, s + suffix + p + prefix + m + middle
    return len(lines), "psm", prefix, middle, p + prefix + s + suffix + m + middle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(row, key, text, **options):
    n, form, prefix, middle, output = plain_fim(key, text, **options)
    assert (row["n"], row["form"], row["output_sha256"], row["restored_sha256"]) == (n, form, sha(output), sha(text))
    assert (row["prefix_chars"], row["middle_chars"]) == ((None, None) if prefix is None else (len(prefix), len(middle)))


def test_query_equals_plain_strings(spark, texts):
    rows = QUERIES["op11_fim"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        check(row, row.doc_id, texts[row.doc_id])
    assert {r.form for r in rows} >= {"psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(st.sampled_from("a\n<PSM>é𝄞\r "), max_size=40), st.integers(0, 100), st.integers(0, 100))
def test_any_text(key, text, rate, spm):
    of, data = FillInMiddle(rate=rate, spm=spm), memoryview(text.encode())
    check(of._row(key, data), key, text, rate=rate, spm=spm)
    folded = of.fold(key, data)
    output = b"".join(view(folded.pieces, of.buffers(data)))
    back = of.unfold(output, folded.form)
    assert b"".join(view(back, of.buffers(memoryview(output)))) == text.encode()
    # The pieces of the text buffer are a cut of the document: each byte once.
    covered = sorted((p.start, p.length) for p in folded.pieces if p.buffer == 0)
    assert sum(n for _, n in covered) == len(data) and all(a + n == b for (a, n), (b, _) in zip(covered, covered[1:]))


def test_edges_render_and_restore(spark, documents, cluttered):
    texts = [None, "", "no break", "\n", "\n\n\n", "a <P> b\n", "é\n" * 200_000, "x" * 300_000, "same\ntext\n", "same\ntext\n", "ends\nopen"]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 8, None]
    df = cluttered(documents(texts, ids), "pieces", "form", "n", "F")
    of = FillInMiddle()
    folded = df.select("doc_id", "text", of.apply(F.col("doc_id"), F.col("text")).alias("f"))
    rows = folded.withColumn("out", of.render(F.col("text"), F.col("f.pieces")))
    rows = rows.withColumn("back", of.restore(F.col("out"), F.col("f.form"))).collect()
    assert len(rows) == len(texts)
    for row, key, text in zip(rows, ids, texts):
        check(row.f, key, text or "")
        assert row.out == plain_fim(key, text or "")[4] and row.back == (text or "")
    assert df.limit(0).select(of.apply(F.col("doc_id"), F.col("text"))).collect() == []


def test_other_sentinels():
    marks = ("<|prefix|>", "<|suffix|>", "<|middle|>")
    of = FillInMiddle(marks, rate=50, seed=3)
    for key in range(200):
        text = f"<P>{key}\nline two\n<|prefix\nend"
        check(of._row(key, memoryview(text.encode())), key, text, marks=marks, rate=50, seed=3)
    for bad in (("a", "a", "b"), ("<P>", "<P>x", "<M>"), ("ab", "bc", "x"), ("aba", "x", "y"), ("", "x", "y")):
        with pytest.raises(ValueError):
            FillInMiddle(bad)
    assert Piece(0, 1, 2)._asdict() == {"buffer": 0, "start": 1, "length": 2}
