"""Held-out accuracy, and the model against plain moments and densities."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import quality_model as qm
from pagemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_quality_model"](spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    unseen = [(y, rows[i].predicted) for i, y in labels.items() if rows[i].held_out]
    assert sum(y == p for y, p in unseen) > 0.97 * len(unseen)
    assert sum(p for y, p in unseen if y == 0) < 0.1 * sum(y == 0 for y, _ in unseen)


def test_against_plain_densities(spark):
    rng = np.random.default_rng(1)
    d = len(qm.STATISTICS)
    x = np.concatenate([rng.normal(size=(200, d)), rng.normal(1, 2, size=(100, d))])
    y = [1] * 200 + [0] * 100
    df = spark.createDataFrame([(i, [float(v) for v in row], c) for i, (row, c) in enumerate(zip(x, y))], "i int, x array<double>, y int")
    got = [r.score for r in qm.score(df, qm.fit(df)).orderBy("i").collect()]
    groups = {c: x[np.array(y) == c] for c in (0, 1)}
    pooled = sum(len(g) * g.var(0) for g in groups.values()) / len(x)
    logs = {}
    for c, g in groups.items():
        cov = 0.9 * np.cov(g.T, bias=True) + np.diag(0.1 * pooled + qm.FLOOR)
        gap = x - g.mean(0)
        logs[c] = np.log(len(g) / len(x)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)
    assert np.allclose(got, 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-9)


def test_edges(spark, documents, cluttered):
    df = cluttered(documents([None, "", "a", "a", "x" * 100_000, "é \n" * 20_000], [0, 1, 2, 2, 3, None]), "score", "held_out", "x")
    rows = df.select("doc_id", qm.statistics(F.col("text")).alias("x"))
    assert [len(r.x) for r in rows.collect()] == [len(qm.STATISTICS)] * 6
    none = rows.withColumn("y", F.lit(None).cast("int"))
    assert qm.fit(none).share == 0.5 and {r.score for r in qm.score(none, qm.fit(none)).collect()} == {0.5}
    one = rows.withColumn("y", F.lit(1))
    assert {r.score for r in qm.score(one, qm.fit(one)).collect()} == {1.0}
    both = rows.withColumn("y", (F.coalesce("doc_id", F.lit(9)) < 2).cast("int"))
    assert all(0 <= r.score <= 1 for r in qm.score(both, qm.fit(both)).collect())
    assert qm.score(rows.limit(0), qm.fit(both)).collect() == []
    assert qm.statistics_of(None) == qm.statistics_of(b"")
