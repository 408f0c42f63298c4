"""Counts after edits against encoding the edited text anew."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagemill.llm import edit_counts
from pagemill.llm.bpe import codec
from pagemill.llm.queries import QUERIES, vocabulary

PARTS = ["a", "b", " ", "  ", "\n", "é", "'s", "'re", "'", "1", "the", "ing", "-", "aaaa", "!", "中", " the", " of", "x" * 50, " " * 40]


@pytest.fixture(scope="module")
def of():
    with open(vocabulary(), "rb") as file:
        return codec(file.read())


def put(text, place, length, new):
    place = min(max(place, 0), len(text))
    return text[:place] + new + text[place + min(max(length, 0), len(text) - place) :]


@pytest.mark.parametrize("fan", [2, 32])
def test_random_edits(of, monkeypatch, fan):
    monkeypatch.setattr(edit_counts, "FAN", fan)
    rnd = random.Random(fan)
    for _ in range(600):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 3, 30, 300])))
        counted = edit_counts.CountedText(of, text)
        for _ in range(5):
            edit = rnd.randint(-2, len(text) + 2), rnd.choice([0, 0, 1, 3, 20, 400]), "".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 1, 3, 20])))
            text = put(text, *edit)
            counted.edit(*edit)
            assert counted.text == text
            assert counted.n_tokens == sum(len(of.pieces[p]) // 4 for p in of.split(text))


def test_an_edit_reads_little(of):
    counted = edit_counts.CountedText(of, " the quick fox" * 20_000)
    before = counted.encoded
    counted.edit(140_000, 5, "slow")
    assert counted.encoded - before < 60


def test_query(spark, texts):
    library = Tokenizer.from_file(vocabulary())
    library.encode_special_tokens = True
    meta = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op8_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id]
        n = len(text)
        new = put(put(put(text, n // 2, 0, " " + meta[r.doc_id].source), n // 8, 24, ""), n + 64, 0, f"\n{meta[r.doc_id].lang}.")
        assert r.text_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert r.n_tokens_edited == len(library.encode(new, add_special_tokens=False).ids)


def test_edges(spark):
    rows = [(1, None, None), (1, "", [(0, 0, "ab")]), (2, "one two", [(None, None, None), None, (4, 3, "")]), (None, "x", []), (4, "y" * 100_000, [(50_000, 1, " ")])]
    df = spark.createDataFrame(rows, "doc_id int, text string, edits array<struct<place:int,length:int,new:string>>")
    counts = edit_counts.TokenCounts(spark, vocabulary())
    got = [r.c for r in df.select(counts.after_edits(F.col("text"), F.col("edits")).alias("c")).collect()]
    assert [c.text for c in got[:4]] == ["", "ab", "one ", "x"] and len(got[4].text) == 100_000
    assert df.limit(0).select(counts.after_edits(F.col("text"), F.col("edits"))).collect() == []
