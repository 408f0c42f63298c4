"""The word pair model against a plain one, probabilities that sum to one, and odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import kneser_ney as kn
from pagemill.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = "\n"


def words_of(text):
    text = (text or "").translate(LOWER)
    for blank in "\t\n\v\f\r":
        text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


class Plain:
    """The model by dictionaries."""

    def __init__(self, texts):
        lines = [[END, *words_of(t), END] for t in texts]
        self.c = Counter(w for line in lines for w in line[1:])
        self.pairs = Counter(p for line in lines for p in zip(line, line[1:]))
        self.after = Counter(b for _, b in self.pairs)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.d, self.low = self._discounts(self.pairs), self._discounts(self.after)
        self.seen = {}
        for (a, _), n in self.pairs.items():
            self.seen.setdefault(a, Counter())[min(n, 3)] += 1
        self.free = sum(self.low[min(n, 3)] for n in self.after.values()) / len(self.pairs) if self.pairs else 1.0

    @staticmethod
    def _discounts(counts):
        n = Counter(counts.values())
        if not all(n[i] for i in (1, 2, 3, 4)):
            return [0, 0.5, 1.0, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0), i) for i in (1, 2, 3)]

    def word(self, w):
        t = self.after[w]
        return (max(t - self.low[min(t, 3)], 0) / len(self.pairs) if t else 0) + self.free / (self.v + 1)

    def pair(self, a, b):
        if not self.c[a]:
            return self.word(b)
        n = self.pairs[a, b]
        g = sum(self.d[i] * k for i, k in self.seen[a].items()) / self.c[a]
        return max(n - self.d[min(n, 3)], 0) / self.c[a] + g * self.word(b)

    def row(self, text):
        line = [END, *words_of(text), END]
        base = sum(math.log10((self.c[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in line[1:])
        own = sum(math.log10(self.pair(a, b)) for a, b in zip(line, line[1:]))
        return len(line) - 1, sum(self.c[w] > 0 for w in line[1:]), self.n, base, own


def same(got, wanted):
    assert tuple(got[:3]) == wanted[:3]
    assert got[3:] == pytest.approx(wanted[3:], rel=1e-9, abs=1e-9)


def rows_of(df, *keys):
    return [([r[k] for k in keys], [r[c] for c in kn.SCORED]) for r in df.collect()]


def test_query_equals_plain(spark, texts):
    held_out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    plain = Plain([t for i, t in texts.items() if not held_out[i]])
    got = rows_of(QUERIES["op13_lm"](spark, "/root/testdata/sf0.001"), "doc_id", "held_out")
    assert sorted(k[0] for k, _ in got) == sorted(texts)
    for (key, held), row in got:
        assert held == held_out[key]
        same(row, plain.row(texts[key]))


def test_many_files(spark, texts, monkeypatch):
    """Word and pair tables of many files, hot words cut between several, several rounds a task."""
    monkeypatch.setattr(kn, "WORDS_A_FILE", 100)
    monkeypatch.setattr(kn, "SHARE", 500)
    monkeypatch.setattr(kn, "AT_ONCE", 2_000)
    some = [t for _, t in sorted(texts.items())[:60]] + ["the of the and " * 2_000] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id bigint, text string").repartition(3)
    model, plain = kn.fit(df), Plain(some)
    assert len(model.words.sizes) > 4 and len(model.shares) > 50
    asked = [*some, "the the unknownword of THE\tand", "of", None]
    scored = kn.score(spark.createDataFrame(list(enumerate(asked)), "doc_id bigint, text string"), model)
    for (key,), row in rows_of(scored, "doc_id"):
        same(row, plain.row(asked[key]))


def test_probabilities_sum_to_one(spark):
    corpus = ["a b a c a b d", "b a", "c c c a", "d", "", "a b a b e f g h h"] * 2 + ["z y x w", "q a b"]
    model = kn.fit(spark.createDataFrame([(t,) for t in corpus], "text string"))
    plain = Plain(corpus)
    for a in [*plain.c, "never"]:
        assert sum(plain.pair(a, b) for b in [*plain.c, "unknown"]) == pytest.approx(1)
    assert (model.tokens, model.distinct, model.pairs) == (plain.n, plain.v, len(plain.pairs))
    assert np.allclose(model.discount, plain.d) and np.allclose(model.lower, plain.low) and model.free == pytest.approx(plain.free)


def test_held_out_beats_single_words(spark):
    rows = QUERIES["op13_lm"](spark, "/root/testdata/sf0.01").filter("held_out")
    base, own, n = rows.agg(F.sum("base_score"), F.sum("score"), F.count("*")).first()
    assert n > 100 and own > base


def test_edges(spark, documents, cluttered):
    texts = [None, "", " \t\r\n\v\f ", "A a\x1cb \x85", "é É", "same text here", "same text here", "long " * 80_000, "x" * 200_000]
    ids = [0, 1, 2, 3, 4, 5, 5, 6, None]
    df = cluttered(documents(texts, ids), "score", "n_tokens", "held_out", "key", "n", "file")
    plain = Plain(texts)
    got = kn.score(df, kn.fit(df))
    assert "held_out" in got.columns and len(got.columns) == len(set(got.columns))
    found = sorted((r for _, r in rows_of(got, "doc_id")), key=repr)
    for row, wanted in zip(found, sorted((plain.row(t) for t in texts), key=lambda r: repr(list(r)))):
        same(row, wanted)
    nothing = kn.fit(df.limit(0))
    assert [r for _, r in rows_of(kn.score(documents(["a b", None]), nothing), "doc_id")] == [[3, 0, 0, 0.0, 0.0], [1, 0, 0, 0.0, 0.0]]
    assert kn.score(df.limit(0), kn.fit(df)).collect() == []
    assert kn.discounts(1, 0, 0, 0).tolist() == [0.0, *kn.FALLBACK]
