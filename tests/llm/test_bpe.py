"""Token ids against the tokenizers library, decoding against its decode."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagemill.llm.bpe import Bpe, codec
from pagemill.llm.queries import QUERIES, vocabulary

PARTS = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "　", "\x85", "\x1c", "\xa0", "'s", "'re", "'", "<|endoftext|>", "<|",
         "1", "٣", "²", "中", "😀", "the", "ing", " -", "aaaa", "----", "​", "́", "!", "0", "﻿", "\x7f", "\0"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(vocabulary())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def mine():
    with open(vocabulary(), "rb") as file:
        return codec(file.read())


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_whole_table(texts, library, mine):
    for text in texts.values():
        ids = ids_of(library, text)
        assert mine.encode(text) == ids
        assert mine.decode(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False)


def test_mixed_text(library, mine):
    rnd = random.Random(1)
    for _ in range(4000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30)))
        assert mine.encode(text) == ids_of(library, text), text


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(library, mine, text):
    ids = ids_of(library, text)
    assert mine.encode(text) == ids
    assert mine.decode(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False)


def test_long_pieces(library, mine):
    for text in ("ab" * 30000, "-" * 50000, "thequickbrown" * 5000, " " * 30000 + "x"):
        assert mine.encode(text) == ids_of(library, text)


def test_broken_and_unknown_ids(library, mine):
    rnd = random.Random(3)
    for _ in range(500):
        ids = [rnd.randrange(50257) for _ in range(6)]
        assert mine.decode(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False)
    assert mine.decode(np.array([-1, 10**6, 64])) == library.decode([64])


def test_columns(spark, documents):
    of = Bpe(spark, vocabulary())
    df = documents([None, "", "one two", "one two"], [None, 1, 2, 2]).withColumn("ids", F.lit("clash"))
    rows = df.select("doc_id", of.encode(F.col("text")).alias("t")).withColumn("back", of.decode(F.col("t"))).collect()
    assert [list(r.t) for r in rows] == [[], [], rows[2].t, rows[2].t] and [r.back for r in rows] == ["", "", "one two", "one two"]
    assert documents([]).select(of.encode(F.col("text"))).collect() == []
    nulls = spark.sql("SELECT array(cast(null AS int), 64) AS t UNION ALL SELECT null")
    assert sorted(r[0] for r in nulls.select(of.decode(F.col("t"))).collect()) == ["", "a"]


def test_query(spark, texts, library):
    rows = QUERIES["op1_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_transcode_odd_tables(spark, documents, cluttered, library, monkeypatch):
    """Null and repeated rows, clashing names, no rows; caches and portions so small that they change all the time."""
    from pagemill.llm import bpe

    monkeypatch.setattr(bpe, "HELD", 64)
    texts = [None, "", "same text", "same text", "é 中 <|endoftext|> x", "long word " * 3000, "x" * 20_000]
    df = cluttered(documents(texts, [0, 1, 2, 2, None, 5, 6]), "ids", "decoded", "n")
    rows = Bpe(spark, vocabulary()).transcode(df).collect()
    assert len(rows) == len(texts)
    for row, text in zip(rows, texts):
        assert row.text == text and row.ids == ids_of(library, text or "") and row.decoded == (text or "")
    assert Bpe(spark, vocabulary()).transcode(df.limit(0), keep=["doc_id"]).collect() == []


def test_small_caches(library, monkeypatch):
    from pagemill.llm import bpe

    monkeypatch.setattr(bpe, "CACHED_BYTES", 2000)
    monkeypatch.setattr(bpe, "CACHED_PAIR_BYTES", 2000)
    monkeypatch.setattr(bpe, "GATHERED", 3)
    with open(vocabulary(), "rb") as file:
        source = file.read()
    small, alone = bpe.BytePairCodec(source), bpe.decoder(source)
    text = "Every word here is another one, and some come again: every word. 中文 é" * 3
    assert small.encode(text) == ids_of(library, text)
    ids = np.array([-1, *small.encode(text), 10**6])
    assert small.decode(ids) == alone.decode(ids) == text
    assert alone.decode(np.array([], int)) == ""
