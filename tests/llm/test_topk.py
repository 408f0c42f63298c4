"""Exact search against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import topk
from pagemill.llm.queries import QUERIES


def brute(rows, k):
    out = []
    for q, vq in rows:
        if q % 100 == 0:
            scored = sorted((-sum(int(a) * int(b) for a, b in zip(vq, v)), i) for i, v in rows if i != q and len(v) == len(vq))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("case", ["even", "long tail", "hot vector", "negative", "zeros"])
def test_small_blocks(spark, monkeypatch, case):
    for name, value in (("BUCKETS", 8), ("BLOCK", 32), ("GROUP", 2), ("FIRST", 30)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(len(case))
    v = rng.integers(-40, 40, (600, 6)).astype(float)
    if case == "long tail":
        v = np.floor(v * np.exp(rng.normal(0, 1.5, (600, 1))))
    if case == "hot vector":
        v[rng.permutation(600)[:250]] = v[0]
    if case == "negative":
        v = -np.abs(v)
    if case == "zeros":
        v[::3] = 0
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, F.col("id") % 100 == 0, 7).collect())) == brute(rows, 7)


def test_survivors_hold_all_that_reach():
    rng = np.random.default_rng(5)
    for _ in range(200):
        rows = rng.normal(size=(50, 4)) * rng.choice([1, 3])
        query = rng.normal(size=4)
        scores = rows @ query
        reach = np.sort(scores)[-5]
        norms = np.sqrt((rows * rows).sum(1))
        kept = set(topk.survivors(rows / norms[:, None], norms, query, reach).tolist())
        assert set(np.flatnonzero(scores >= reach).tolist()) <= kept


def test_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    rows = [(r.vec_id, [math.floor(1024 * float(x)) for x in r.embedding]) for r in table]
    assert sorted(map(tuple, QUERIES["op10_top_k"](spark, "/root/testdata/sf0.01").collect())) == brute(rows, 10)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (None, [9.0, 9.0]), (7, [1.0, 2.0, 3.0]), (100, []), (101, []), (200, [2.0**60, 0.0]), (201, [2.0**60, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1)).withColumn("norm", F.lit(1))
    found = sorted(map(tuple, topk.top_k(df, F.col("id") % 100 == 0, 2).collect()))
    assert found == [(0, 1, 200, 2**60), (0, 2, 201, 2**60), (100, 1, 101, 0), (200, 1, 201, 2**63 - 1), (200, 2, 1, 3 * 2**60)]
    assert topk.top_k(df.limit(0), F.col("id") % 100 == 0).collect() == []
    assert topk.top_k(df.filter("vec_id = 0"), F.col("id") % 100 == 0).collect() == []


def test_rows_that_share_an_id(spark, monkeypatch):
    """Every row but the query's own is a candidate, whatever its id."""
    for name, value in (("BUCKETS", 4), ("BLOCK", 8), ("GROUP", 2), ("FIRST", 10)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(9)
    rows = [(int(i) * 50, [float(x) for x in rng.integers(-9, 9, 3)]) for i in rng.integers(0, 5, 60)] + [(7, [5.0, 5.0, 0.0]), (7, [1.0, 1.0, 0.0])]
    want = []
    for a, (q, vq) in enumerate(rows):
        if q % 100 == 0:
            scored = sorted((-sum(int(x) * int(y) for x, y in zip(vq, v)), i) for b, (i, v) in enumerate(rows) if a != b)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:4])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, F.col("id") % 100 == 0, 4).collect())) == sorted(want)
