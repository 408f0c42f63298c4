"""Quality scores by regularised quadratic discriminant analysis of document statistics.

Each class is a Gaussian over transformed statistics of the whole text. Counts, sums and
cross products of the labelled documents are aggregated by Spark; the driver sees one row
of them per class. A covariance is shrunk towards the diagonal of the pooled one, and its
Cholesky factor is kept, so that a score is two triangular solves: the difference of the
two log densities plus that of the log priors, through the logistic function.

Defined results: null texts count as empty, and an empty text has a score like any other; a
label row that is null or not 0 or 1 teaches nothing, repeated label rows teach once; if a
class has fewer than two labelled documents, every score is the share of label 1 among the
labelled, 0.5 if there are none; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.worker import travels

travels(__name__)

STATISTICS = (
    "words", "word_bytes", "capitals", "symbols", "exclamations", "digits", "stops",
    "distinct_words", "echoed_words", "short_words", "echoed_lines", "line_words",
)
#: Share of the pooled diagonal in each covariance.
SHRINKAGE = 0.1
#: Least variance; a statistic may be constant within a class.
FLOOR = 1e-3

_CLASSES = np.zeros((6, 256), np.int64)
for _row, _members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"#*$%&|<>~^_=+{}[]\\@", b"!?", b"0123456789", b".,;:")):
    _CLASSES[_row, list(_members)] = 1


def statistics_of(text: bytes | None) -> list[float]:
    """The transformed statistics of a whole text: logarithms of sizes, square roots of shares."""
    text = text or b""
    words = text.split()
    n = max(len(words), 1)
    size = sum(map(len, words))
    upper, lower, symbols, exclaimed, digits, stops = (_CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)).tolist()
    lines = [line for line in text.split(b"\n") if line.strip()]
    shares = (
        upper / max(upper + lower, 1),
        symbols / max(size, 1),
        exclaimed / max(size, 1),
        digits / max(size, 1),
        stops / n,
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(len(w) < 4 for w in words) / n,
        1 - len(set(lines)) / max(len(lines), 1),
    )
    return [np.log1p(len(words)), np.log1p(size / n), *np.sqrt(shares), np.log1p(n / max(len(lines), 1))]


def statistics(text: Column) -> Column:
    """array<double>: the statistics of every text, null counting as empty."""

    @F.arrow_udf(returnType="array<double>")
    def rows(texts: pa.Array) -> pa.Array:
        flat = np.array([statistics_of(t.as_py()) for t in texts.cast(pa.binary())], np.float64).reshape(-1)
        ends = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return rows(text)


class Gaussian(NamedTuple):
    """A class: log prior, mean, lower Cholesky factor of the covariance."""

    log_prior: float
    mean: np.ndarray
    factor: np.ndarray

    def log_density(self, rows: np.ndarray) -> np.ndarray:
        distance = (np.linalg.solve(self.factor, (rows - self.mean).T) ** 2).sum(0)
        return self.log_prior - np.log(np.diag(self.factor)).sum() - distance / 2


class Discriminant(NamedTuple):
    share: float
    low: Gaussian | None
    high: Gaussian | None

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.low is None or self.high is None or not len(rows):
            return np.full(len(rows), self.share)
        odds = self.high.log_density(rows) - self.low.log_density(rows)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """The model of labelled rows (x array<double>, y 0 or 1), from their moments."""
    d = len(STATISTICS)
    x = [F.element_at("x", i + 1) for i in range(d)]
    sums = [F.sum(c) for c in x] + [F.sum(x[i] * x[j]) for i in range(d) for j in range(i + 1)]
    rows = labelled.filter("y in (0, 1)").groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("sums")).collect()
    moments = {}
    for row in rows:
        cross = np.zeros((d, d))
        cross[np.tril_indices(d)] = row["sums"][d:]
        mean = np.array(row["sums"][:d]) / row["n"]
        cross = (cross + np.tril(cross, -1).T) / row["n"] - np.outer(mean, mean)
        moments[row["y"]] = row["n"], mean, cross
    total = sum(m[0] for m in moments.values())
    share = moments[1][0] / total if 1 in moments else 0.0 if total else 0.5
    if len(moments) < 2 or min(m[0] for m in moments.values()) < 2:
        return Discriminant(share, None, None)
    pooled = sum(n * np.diag(cross) for n, _, cross in moments.values()) / total

    def gaussian(n: int, mean: np.ndarray, cross: np.ndarray) -> Gaussian:
        shrunk = (1 - shrinkage) * cross + np.diag(shrinkage * pooled + FLOOR)
        return Gaussian(float(np.log(n / total)), mean, np.linalg.cholesky(shrunk))

    return Discriminant(share, gaussian(*moments[0]), gaussian(*moments[1]))


def score(rows: DataFrame, model: Discriminant, column: str = "score") -> DataFrame:
    """`rows` with the score of their statistics `x`, which are dropped. The model is a few KB."""
    schema = rows.drop("x").schema.add(column, "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            yield batch.drop_columns(["x"]).append_column(column, pa.array(model.score(x), pa.float64()))

    return rows.mapInArrow(scored, schema)
