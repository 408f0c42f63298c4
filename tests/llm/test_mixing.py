"""Rates against a plain projected gradient over single documents; classes against labels."""

import math

import pytest
from pyspark.sql import functions as F

from pagemill.llm import mixing
from pagemill.llm.queries import DOMAIN, QUERIES, WEIGHTS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def mixed(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return mixing.mix(docs, labels, F.expr(DOMAIN), WEIGHTS, keep=["doc_id"]).collect()


def targets(rows, weights):
    """(posteriors, tokens, tokens by domain, wanted tokens)."""
    p = [tuple(r[f"p_{d}"] for d in weights) for r in rows]
    n = [r.n_tokens for r in rows]
    have = [sum(x * q[k] for x, q in zip(n, p)) for k in range(len(weights))]
    share, tokens = max(zip(weights.values(), have))
    return p, n, have, [tokens / share * w for w in weights.values()]


def totals(n, rates, p):
    return [sum(x * r * q[k] for x, r, q in zip(n, rates, p)) for k in range(len(p[0]))]


def assert_least_squares(rows, weights, near, highest=math.inf):
    """The conditions of the one minimum, over single documents: where a rate lies between its bounds its own derivative
    is zero, else it points out of them."""
    p, n, _, want = targets(rows, weights)
    got = totals(n, [r.rate for r in rows], p)
    pull = [(w - g) / w for w, g in zip(want, got)]
    for r, q in zip(rows, p):
        slope = near * (r.rate - 1) - sum(a * b for a, b in zip(q, pull))
        assert 0 <= r.rate <= highest and (r.rate == 0 or slope < 1e-7) and (r.rate == highest or slope > -1e-7)
    for r, name, w, g in zip(rows, weights, want, got):
        assert r[f"missed_{name}"] == pytest.approx(g / w - 1, abs=1e-8)


def test_rates_are_the_least_squares_ones_and_meet_the_targets(mixed):
    assert_least_squares(mixed, WEIGHTS, mixing.NEAR)
    p, n, _, want = targets(mixed, WEIGHTS)
    assert totals(n, [r.rate for r in mixed], p) == pytest.approx(want, rel=0.001)
    assert all(abs(r[f"missed_{d}"]) < 0.001 for r in mixed for d in WEIGHTS)
    assert all(abs(sum(q) - 1) < 1e-9 for q in p)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in mixed)


@pytest.mark.parametrize("weights, near, highest", [
    ({"clean": 0.999, "low": 0.0005, "toxic": 0.0005}, 1e-3, math.inf), ({"clean": 0.5, "low": 0.3, "toxic": 0.2}, 0.05, 2.0),
])
def test_targets_out_of_reach_are_reported(spark, weights, near, highest):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = mixing.mix(docs, labels, F.expr(DOMAIN), weights, keep=["doc_id"], near=near, highest=highest).collect()
    assert_least_squares(rows, weights, near, highest)


def test_plain_descent_ends_at_the_same_rates(spark, documents):
    texts = ["alpha beta gamma " * (i % 7 + 1) if i % 4 else "delta epsilon zeta " * (i % 5 + 1) for i in range(200)]
    labels = spark.createDataFrame([(i, "b" if i % 4 == 0 else "a") for i in range(0, 200, 3)], "doc_id bigint, d string")
    weights, near = {"a": 0.3, "b": 0.7}, 0.05
    rows = mixing.mix(documents(texts), labels, F.col("d"), weights, near=near).collect()
    p, n, _, want = targets(rows, weights)
    rates = [1.0] * len(n)
    for _ in range(6000):
        pull = [(w - g) / w for w, g in zip(want, totals(n, rates, p))]
        rates = [max(0.0, r + 0.2 * (sum(a * b for a, b in zip(q, pull)) - near * (r - 1))) for r, q in zip(rates, p)]
    assert max(abs(r.rate - x) for r, x in zip(rows, rates)) < 1e-4


def test_a_scarce_domain_does_not_shrink_the_rest(documents, spark):
    texts = ["alpha beta gamma " * (i % 7 + 1) if i else "delta epsilon zeta" for i in range(200)]
    labels = spark.createDataFrame([(i, "a" if i else "b") for i in range(200)], "doc_id bigint, d string")
    rows = mixing.mix(documents(texts), labels, F.col("d"), {"a": 0.9, "b": 0.1}).collect()
    rates = [r.rate for r in rows if r.doc_id]
    assert 0.7 < sum(rates) / len(rates) < 1.6
    assert all(abs(r.missed_a) < 0.01 and abs(r.missed_b) < 0.01 for r in rows)


def test_memberships_follow_the_labels(spark, mixed):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    sure = [(labels[r.doc_id], r) for r in mixed if r.doc_id in labels]
    clean = [r.p_clean for y, r in sure if y == (1, 0)]
    rest = [r.p_clean for y, r in sure if y != (1, 0)]
    assert sum(clean) / len(clean) > 0.9 and sum(rest) / len(rest) < 0.3


def test_targets_of_two_made_up_domains(spark, documents):
    texts = ["alpha beta gamma " * (i % 7 + 1) if i % 4 else "delta epsilon zeta " * (i % 5 + 1) for i in range(400)]
    labels = spark.createDataFrame([(i, "b" if i % 4 == 0 else "a") for i in range(0, 400, 3)], "doc_id bigint, d string")
    rows = mixing.mix(documents(texts), labels, F.col("d"), {"a": 1, "b": 1}, total=3000.0).collect()
    for name in ("p_a", "p_b"):
        assert sum(r.n_tokens * r.rate * r[name] for r in rows) == pytest.approx(1500, rel=0.01)


def test_edges(spark, documents, cluttered, plan):
    labels = spark.createDataFrame([(0, "a"), (0, "a"), (1, "b"), (None, "a"), (2, None), (3, "?")], "doc_id bigint, d string")
    texts = [None, "", "one two", "one two", "x" * 100_000, "w " * 50_000]
    df = cluttered(documents(texts, [0, 1, 2, 2, None, 5]), "RATE", "_size", "_words", "p_a", "extra")
    out = mixing.mix(df, labels, F.col("d"), {"a": 3, "b": 1})
    rows = out.collect()
    assert len(rows) == 6 and "extra" in out.columns and len({c.lower() for c in out.columns}) == len(out.columns)
    assert "Python" not in plan(out)
    twice = [r for r in rows if r.doc_id == 2]
    assert twice[0].copies == twice[1].copies and all(r.rate >= 0 for r in rows)
    assert mixing.mix(documents([]), labels, F.col("d"), {"a": 1, "b": 1}).collect() == []
    bare = mixing.mix(documents(["a b"]), labels.limit(0), F.col("d"), {"a": 1, "b": 1}).collect()
    assert (bare[0].p_a, bare[0].p_b, bare[0].rate) == (0.5, 0.5, pytest.approx(1.0))
    kept = mixing.sample(spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "doc_id int, copies int"), ["doc_id"])
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 3]


def test_query(spark, plan):
    df = QUERIES["op7_mixing"](spark, "/root/testdata/sf0.001")
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert "Python" not in plan(df)
