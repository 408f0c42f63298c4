"""Quality by weak supervision: rules vote, expectation-maximisation weighs them.

Each rule votes good or bad on a document or abstains, and speaks of one kind of fault; rules of a kind
measure it in different ways. How often a rule is right is not set: a model of one hidden class of good
documents and one of bad ones for each kind, in which votes are independent given the class, is fitted
to the counts of vote patterns of the whole table. It estimates the share of every class and, in every class, how
often each rule votes bad, under priors that weigh as much as a few documents. A document is kept if its posterior
probability of being good is at least one half. So a rule that misfires is outvoted by
the others of its kind, and one that has no other is believed as far as the priors go.

Only DataFrame functions are used on rows. The patterns are a table of at most 3 ** rules rows, in practice
some hundred; the driver fits the model to their counts. Each round raises the likelihood, so the estimates of the last
round are the result also where it is reached before they settle; `Weights.settled` tells.

Defined results: null and empty texts have no words; every row gives a row, repeated ids
too; an empty table gives an empty result; other columns are kept, those of the same
name as a new one or a helper (a leading underscore) are replaced or left out. Windows of words are compared by a 64-bit hash.
"""

from __future__ import annotations

import functools
import math
import operator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.worker import beside
from pagemill.session import materialize

_BLANK = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Rounds of the fit at most, and the change of any estimate at which it ends.
ROUNDS, SETTLED = 1000, 1e-4
#: Where every fit starts: the share of bad documents, over all kinds; the chance that a rule sees a fault of its kind; and the
#: chance that it misfires, which grows by a share of the bad votes it casts.
BAD, SEEN, MISFIRE, MISFIRES = 0.2, 0.9, 0.01, 0.1
#: The prior of every share and chance weighs as much as this many documents, whatever the table holds.
PRIOR = 2.0


COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts", "n_stops", "n_lines", "n_marked", "n_distinct", "n_echoes",
]
_HELPERS = ["_words", "_lines", "_windows", "_order", "_starts"]


def _without(text: Column, pattern: str) -> Column:
    """How many characters the pattern takes."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def base_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts
    the rules need (all bigint).

    Each array is a column of its own and used at least twice, so that Spark computes it
    once a row, not once for every element of a lambda that reads it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, windows, order = F.col("_words"), F.col("_windows"), F.col("_order")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(*beside(docs.columns, [*COUNTS, *_HELPERS])).withColumns({
        "_words": F.array_remove(F.split(text, _BLANK), ""),
        "_lines": lines,
    })
    n = F.size(words)
    step = step.withColumns({
        "n_words": n.cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": _without(text, r"[#*$%&|<>]+").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_capitals": _without(text, r"\p{Lu}+").cast("bigint"),
        "n_shouts": _without(text, r"!+").cast("bigint"),
        "n_stops": _without(text, r"[.?]+").cast("bigint"),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_marked": F.size(F.filter(words, lambda w: w.rlike(r"[#*$%&|<>]"))).cast("bigint"),
        "n_distinct": F.size(F.array_distinct(words)).cast("bigint"),
        "n_echoes": F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).cast("bigint"),
        "_windows": F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), n - WINDOW),
                lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
            ),
        ),
    })
    # Only texts with a repeated window are sorted: pairs of window and place.
    step = step.withColumn("_order", F.when(
        F.size(windows) > F.size(F.array_distinct(windows)),
        F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
    ))
    step = step.withColumn("_starts", F.sort_array(F.transform(
        F.filter(order, lambda x, i: F.coalesce(F.get(order, i - 1)["w"] == x["w"], F.lit(False))
                 | F.coalesce(F.get(order, i + 1)["w"] == x["w"], F.lit(False))),
        lambda x: x["i"],
    )))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, x: F.struct(x.alias("last"), (s["n"] + F.least(F.lit(WINDOW), x - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop(*_HELPERS)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Votes good up to `good`, bad beyond `bad`, and abstains between; a null measure abstains."""

    kind: str
    measure: Column
    good: float
    bad: float

    def vote(self) -> Column:
        """1 good, 0 bad, null."""
        up = self.good < self.bad
        good = self.measure <= self.good if up else self.measure >= self.good
        bad = self.measure > self.bad if up else self.measure < self.bad
        return F.when(good, 1).when(bad, 0)


def rules() -> list[Rule]:
    """The rules of the base statistics."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    chars = F.when(F.col("word_chars") > 0, F.col("word_chars"))
    lines = F.when(F.col("n_lines") >= 5, F.col("n_lines"))
    long = F.when(F.col("n_words") >= 20, F.col("n_words"))
    return [
        Rule("short", F.col("n_words"), 20, 10),
        Rule("short", F.col("word_chars"), 60, 30),
        Rule("words", F.abs(chars / words - 6.0), 3.0, 4.0),
        Rule("symbols", F.col("n_symbols") / chars, 0.005, 0.02),
        Rule("symbols", F.col("n_marked") / words, 0.02, 0.1),
        Rule("repeats", F.col("n_dup_lines") / lines, 0.1, 0.3),
        Rule("repeats", F.col("n_repeat_words") / words, 0.05, 0.2),
        Rule("repeats", F.col("n_distinct") / long, 0.3, 0.1),
        Rule("repeats", F.col("n_echoes") / long, 0.05, 0.2),
        Rule("shouting", F.col("n_capitals") / chars, 0.1, 0.3),
        Rule("shouting", F.col("n_shouts") / words, 0.02, 0.1),
        Rule("run on", F.col("n_stops") / long, 0.02, 0.005),
        Rule("run on", words / F.when(F.col("n_lines") > 0, F.col("n_lines")), 100, 300),
    ]


def kinds(of: list[Rule]) -> list[tuple[int, ...]]:
    """The places of the rules of each kind of fault."""
    names = dict.fromkeys(rule.kind for rule in of)
    return [tuple(j for j, rule in enumerate(of) if rule.kind == name) for name in names]


@dataclass(frozen=True)
class Weights:
    """The classes, good documents first: the share of each, and in each the chance of a bad vote by every rule."""

    shares: tuple[float, ...]
    chances: tuple[tuple[float, ...], ...]
    settled: bool = False

    def of_pattern(self, votes: tuple[int | None, ...]) -> list[float]:
        """The posterior of every class for one pattern of votes."""
        heard = [(j, vote) for j, vote in enumerate(votes) if vote is not None]
        found = [s * math.prod(1 - p[j] if vote else p[j] for j, vote in heard) for s, p in zip(self.shares, self.chances)]
        total = math.fsum(found)
        return [x / total for x in found]

    def posterior(self, votes: list[Column]) -> Column:
        """Probability of being good."""

        def likelihood(share: float, chances: tuple[float, ...]) -> Column:
            out = F.lit(share)
            for vote, chance in zip(votes, chances):
                out = out * F.when(vote == 0, chance).when(vote == 1, 1 - chance).otherwise(1.0)
            return out

        good, *bad = [likelihood(share, chances) for share, chances in zip(self.shares, self.chances)]
        return good / functools.reduce(operator.add, bad, good)

    def distance(self, other: Weights) -> float:
        mine, yours = [[*w.shares, *(x for p in w.chances for x in p)] for w in (self, other)]
        return max(abs(a - b) for a, b in zip(mine, yours))


def _start(patterns: list[tuple[tuple, int]], groups: list[tuple[int, ...]]) -> Weights:
    """Every kind equally frequent; a rule sees what is of its kind, and elsewhere misfires in proportion to its bad votes."""
    rows, rules_ = sum(n for _, n in patterns), range(len(patterns[0][0]) if patterns else 0)
    misfires = [MISFIRE + MISFIRES * sum(n for votes, n in patterns if votes[j] == 0) / rows for j in rules_]
    faulty = [tuple(SEEN if j in group else misfires[j] for j in rules_) for group in groups]
    return Weights((1 - BAD, *[BAD / len(groups)] * len(groups)), (tuple(misfires), *faulty))


def _round(patterns: list[tuple[tuple, int]], now: Weights, start: Weights) -> Weights:
    """One round of the expectation-maximisation. The priors have the means that the fit starts from."""
    rated = [(votes, [n * q for q in now.of_pattern(votes)]) for votes, n in patterns]
    rows = sum(n for _, n in patterns)
    shares, chances = [], []
    for k, (share, first) in enumerate(zip(start.shares, start.chances)):
        shares.append((math.fsum(w[k] for _, w in rated) + PRIOR * share) / (rows + PRIOR))
        chances.append(tuple(
            (math.fsum(w[k] for votes, w in rated if votes[j] == 0) + PRIOR * p)
            / (math.fsum(w[k] for votes, w in rated if votes[j] is not None) + PRIOR)
            for j, p in enumerate(first)
        ))
    return Weights(tuple(shares), tuple(chances))


def fit(votes: DataFrame, n_rules: int, groups: list[tuple[int, ...]] | None = None) -> Weights:
    """The weights for the votes of a table. `groups` are the rules of each kind of fault, without it each rule has its own."""
    names = [f"_vote{j}" for j in range(n_rules)]
    # At most 3 ** n_rules rows, whatever the table holds; in fixed order they add up the same way every time.
    counted = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).sort(*names).collect()
    patterns = [(tuple(row[c] for c in names), row["n"]) for row in counted]
    return fit_patterns(patterns, groups or [(j,) for j in range(n_rules)])


def fit_patterns(patterns: list[tuple[tuple, int]], groups: list[tuple[int, ...]]) -> Weights:
    """The weights for counts of vote patterns; for none, those the fit starts from."""
    if not patterns:
        patterns = [((None,) * (1 + max(j for group in groups for j in group)), 1)]
    start = now = _start(patterns, groups)
    for _ in range(ROUNDS):
        before, now = now, _round(patterns, now, start)
        if now.distance(before) < SETTLED:
            return replace(now, settled=True)
    return now


def judge(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` (the columns `keep`, all without it) with the base statistics, base_failed,
    quality (the posterior) and kept.

    The statistics are written once, without the texts unless they are among `keep`.
    """
    voters = rules()
    votes = [rule.vote() for rule in voters]
    names = [f"_vote{j}" for j in range(len(votes))]
    keep = beside(keep or docs.columns, [*COUNTS, *_HELPERS, *names, "base_failed", "quality", "kept"])
    stats = base_statistics(docs, text_col).select(*keep, *COUNTS).withColumns(dict(zip(names, votes)))
    stats = materialize(stats, "statistics")
    weights = fit(stats, len(names), kinds(voters))
    quality = weights.posterior([F.col(c) for c in names])
    return stats.withColumns({"base_failed": base_failed(), "quality": quality}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    ).drop(*names)
