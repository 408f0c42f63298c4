"""Fits of made-up vote patterns: junk of one kind, rules that misfire, one frequent pattern."""

import random

import pytest
from pyspark.sql import functions as F

from pagemill.llm import quality_rules as qr

N = 8
VOTES = ", ".join(f"_vote{j} int" for j in range(N))
PAIRS = [(0, 1), (2, 3), (4, 5), (6, 7)]


def pattern(*bad, unsure=()):
    return tuple(0 if j in bad else None if j in unsure else 1 for j in range(N))


def posteriors(spark, counts, groups=None):
    patterns = spark.createDataFrame([(*v, n) for v, n in counts.items()], f"{VOTES}, n int")
    votes = patterns.withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).drop("i", "n")
    weights = qr.fit(votes, N, groups)
    columns = [f"_vote{j}" for j in range(N)]
    rows = votes.distinct().select(*columns, weights.posterior([votes[c] for c in columns]).alias("q")).collect()
    got = {tuple(r)[:N]: r.q for r in rows}
    assert all(abs(got[v] - weights.of_pattern(v)[0]) < 1e-9 for v in got)
    return got


@pytest.mark.parametrize("share", [0, 100, 330])
def test_documents_without_a_bad_vote_stay(spark, share):
    """Junk of five kinds that share no votes, and one bad vote on up to a third of the rows."""
    counts = {pattern(j, unsure=(3,)): 20 for j in (1, 2, 4, 5, 6)}
    counts |= {pattern(): 630 - share, pattern(unsure=(3,)): 270}
    if share:
        counts[pattern(7, unsure=(3,))] = share
    got = posteriors(spark, counts)
    assert got[pattern()] >= 0.5 and got[pattern(unsure=(3,))] >= 0.5
    if share == 330:
        assert got[pattern(7, unsure=(3,))] >= 0.5
    assert all(got[pattern(j, unsure=(3,))] < 0.5 for j in (1, 2, 4, 5, 6))


@pytest.mark.parametrize("size", [1, 1000, 10**8])
@pytest.mark.parametrize("wrong", [0.05, 0.1, 0.3])
def test_a_rule_that_misfires_is_outvoted(size, wrong):
    """Rule 0 faults good documents, and sees its junk as rule 1 does; the verdicts are those at every size."""
    good, junk = 900 * size, 100 * size
    lone = round(wrong * good)
    counts = {pattern(): good - lone, pattern(0): lone, pattern(0, 1): junk * 8 // 10, pattern(1): junk // 10, pattern(2, 3): junk // 10}
    weights = qr.fit_patterns(list(counts.items()), PAIRS)
    q = {v: weights.of_pattern(v)[0] for v in counts}
    assert q[pattern()] > 0.9 and q[pattern(0)] > 0.5 and q[pattern(0, 1)] < 0.1 and q[pattern(2, 3)] < 0.5
    if size > 1:
        assert 0.4 * wrong < weights.chances[0][0] < 1.6 * wrong


@pytest.mark.parametrize("share", [0.02, 0.3, 0.6])
def test_one_frequent_pattern(share):
    """Many copies of a text with one bad vote take neither the other good documents nor the junk along."""
    counts = {pattern(): 100_000, pattern(0, 1): 3000, pattern(4, 5): 3000, pattern(6): round(share * 106_000 / (1 - share))}
    weights = qr.fit_patterns(list(counts.items()), PAIRS)
    q = {v: weights.of_pattern(v)[0] for v in counts}
    assert q[pattern()] > 0.9 and q[pattern(6)] > 0.5 and q[pattern(0, 1)] < 0.1 and q[pattern(4, 5)] < 0.1


def test_error_rates_are_estimated():
    """Drawn from known classes, the estimates are near the chances that drew them."""
    draw = random.Random(5)
    true = [(0.85, [0.04, 0.01, 0.03, 0.01, 0.02, 0.01, 0.02, 0.05])]
    true += [(0.0375, [{True: 0.8, False: 0.03}[j in g] for j in range(N)]) for g in PAIRS]
    counts = {}
    for _ in range(40_000):
        _, chances = draw.choices(true, [s for s, _ in true])[0]
        v = tuple(int(draw.random() >= p) for p in chances)
        counts[v] = counts.get(v, 0) + 1
    weights = qr.fit_patterns(sorted(counts.items()), PAIRS)
    assert weights.settled and abs(weights.shares[0] - 0.85) < 0.03
    assert max(abs(a - b) for a, b in zip(weights.chances[0], true[0][1])) < 0.015
    # Two rules a kind: what they see is known less well, since junk that only one sees looks like its misfires.
    assert all(abs(weights.chances[k][j] - 0.8) < 0.2 for k, g in enumerate(PAIRS, 1) for j in g)


def test_result_without_settling(monkeypatch):
    """The estimates of the last round are used, and say so."""
    counts = {pattern(): 800, pattern(4, 5, 6): 150, pattern(2): 50}
    assert qr.fit_patterns(list(counts.items()), PAIRS).settled
    monkeypatch.setattr(qr, "ROUNDS", 2)
    weights = qr.fit_patterns(list(counts.items()), PAIRS)
    assert not weights.settled and weights.of_pattern(pattern())[0] > 0.9 > 0.1 > weights.of_pattern(pattern(4, 5, 6))[0]


def test_no_patterns():
    weights = qr.fit_patterns([], PAIRS)
    assert weights.of_pattern(pattern())[0] > 0.9 and len(weights.shares) == 5
