"""Documents sampled so that soft domains reach target shares of the tokens.

A document belongs to every domain to a degree: its posterior under a naive Bayes classifier
taught by a labelled table. Its features are bins of document statistics and of how many words of a
learned word list it has. Rates, at least zero, say how often each document is taken. They minimise the squared
distance between expected and wanted token totals of the domains, each over what is wanted, plus `near` times the squared
distance of the rates from one, weighted by tokens. The second
term chooses among rates that meet the targets, holds them to 1 + 1 / near where none do, and with a larger `near` keeps
documents that are not clearly of a domain in excess; `highest` bounds the rates if wanted. The minimum is reached by projected
gradient: a rate is one plus the document's posteriors times a multiplier for each domain, cut off at zero and `highest`, and a
step moves the multipliers along the gradient, scaled by the Gram matrix of the posteriors of the documents whose rate is
not cut off, and halved until it improves. It ends when the gradient is
zero to the precision of doubles, after some ten steps; what the totals still miss is returned for each domain.

Rates depend on the bins alone, so the sums over all documents are
aggregated once into a table with a row for each combination of bins (at most
6 * 6 * 6 * 4 ** domains), and a step is one aggregation over that. The driver sees one row a step, of as many
numbers as the square of the domains. A document's rate follows from its own row: no join, no shuffle of texts.
Only DataFrame functions are used.

Defined results: null and empty texts have no tokens and the bins of the smallest counts;
label rows that are null or unknown teach nothing, repeated ones teach once; without
labels all domains are equally likely; a domain without tokens is left as it is;
repeated documents count and are sampled alike; an empty table gives an empty result; other columns
are kept, those named like a new one or a helper (a leading underscore) are replaced or left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pagemill.llm.worker import beside
from pagemill.session import materialize

#: Labelled documents that teach the classifier at most, chosen by hash.
TAUGHT = 10_000
#: Words of a domain's list, and the least share of the domain's documents that have each.
LISTED, COMMON = 48, 0.003
#: Upper edges of the bins.
SIZE_EDGES = (20, 80, 200, 500, 1500)
VARIETY_EDGES = (0.1, 0.25, 0.4, 0.6, 0.8)
MARK_EDGES = (0.001, 0.005, 0.02, 0.1, 0.4)
HIT_EDGES = (0, 1, 2)
#: Weight of the distance of the rates from one, and the relative gradient at which the descent ends.
NEAR, CLOSE = 1e-5, 1e-10


def _bin(value: Column, edges: tuple[float, ...]) -> Column:
    return sum((F.when(value > e, 1).otherwise(0) for e in edges), F.lit(0))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def taught_rows(
    docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str], id_col: str, text_col: str, most: int
) -> DataFrame:
    """(text, domain number) of the labelled documents that teach.

    At most `most` labels are broadcast, so the texts stay where they are.
    """
    number = F.array_position(F.array(*[F.lit(d) for d in domains]), domain).cast("int") - 1
    known = labels.select(F.col(id_col).alias("_id"), number.alias("_k")).filter("_k >= 0 and _id is not null").distinct()
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "_k").limit(most)
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(chosen), "_id").select("_text", "_k")


def word_lists(taught: DataFrame, n_domains: int) -> list[list[str]]:
    """The words of each domain that mark it off most from the others, by document frequency."""
    sizes = {r["_k"]: r["n"] for r in taught.groupBy("_k").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return [[] for _ in range(n_domains)]
    total = sum(sizes.values())
    counts = taught.select("_k", F.explode(F.array_distinct(_words(F.col("_text")))).alias("word")).filter(F.length("word") <= 32)
    per_word = counts.groupBy("word").agg(*[F.count(F.when(F.col("_k") == k, 1)).alias(f"n{k}") for k in range(n_domains)])
    every = sum((F.col(f"n{k}") for k in range(n_domains)), F.lit(0))
    parts = []
    for k, size in sizes.items():
        here, there = (F.col(f"n{k}") + 0.5) / (size + 1), (every - F.col(f"n{k}") + 0.5) / (total - size + 1)
        parts.append(F.struct(F.lit(k).alias("k"), (F.col(f"n{k}") >= max(3, COMMON * size)).alias("common"), F.round(F.log(here / there), 6).alias("lift")))
    rated = per_word.select("word", F.explode(F.array(*parts)).alias("p")).select("word", "p.*").filter("common and lift > 1")
    best = rated.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("lift"), "word"))).filter(F.col("place") <= LISTED)
    lists: list[list[str]] = [[] for _ in range(n_domains)]
    for row in best.collect():  # LISTED rows a domain at most
        lists[row["k"]].append(row["word"])
    return [sorted(words) for words in lists]


def with_bins(docs: DataFrame, lists: list[list[str]], text_col: str) -> tuple[DataFrame, list[tuple[str, int]]]:
    """`docs` with n_tokens (words) and the bins; names and sizes of the bins."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.withColumn("_words", _words(text))
    step = step.withColumns({"n_tokens": F.size("_words").cast("bigint"), "_distinct": F.array_distinct("_words")})
    n = F.greatest("n_tokens", F.lit(1))
    marks = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>!]+", ""))
    bins = {
        "_size": _bin(F.col("n_tokens"), SIZE_EDGES),
        "_variety": _bin(F.size("_distinct") / n, VARIETY_EDGES),
        "_marks": _bin(marks / F.greatest(F.length(text), F.lit(1)), MARK_EDGES),
    }
    sizes = [("_size", len(SIZE_EDGES) + 1), ("_variety", len(VARIETY_EDGES) + 1), ("_marks", len(MARK_EDGES) + 1)]
    for k, words in enumerate(lists):
        if words:
            found = F.size(F.array_intersect("_distinct", F.array(*[F.lit(w) for w in words])))
            bins[f"_hits{k}"] = _bin(found, HIT_EDGES)
            sizes.append((f"_hits{k}", len(HIT_EDGES) + 1))
    return step.withColumns(bins).drop("_words", "_distinct"), sizes


@dataclass(frozen=True)
class Memberships:
    """Log priors by domain, and log chances by feature, bin and domain."""

    priors: list[float]
    chances: dict[str, list[list[float]]]

    def posteriors(self) -> list[Column]:
        k_all = range(len(self.priors))
        logs = []
        for k in k_all:
            total = F.lit(self.priors[k])
            for name, table in self.chances.items():
                total = total + F.element_at(F.array(*[F.lit(row[k]) for row in table]), F.col(name) + 1)
            logs.append(total)
        # exp of differences: the posterior of k is one over the sum of the odds against it.
        return [1 / sum((F.exp(logs[j] - logs[k]) for j in k_all if j != k), F.lit(1.0)) for k in k_all]


def learn(binned: DataFrame, sizes: list[tuple[str, int]], n_domains: int) -> Memberships:
    """Counts of bins by domain, each started at one."""
    stacked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("bin")) for name, _ in sizes]))
    counts = binned.select("_k", stacked.alias("f")).groupBy("_k", "f.name", "f.bin").agg(F.count(F.lit(1)).alias("n"))
    tables = {name: [[1.0] * n_domains for _ in range(size)] for name, size in sizes}
    for row in counts.collect():  # a row for each feature, bin and domain at most
        tables[row["name"]][row["bin"]][row["_k"]] += row["n"]
    first = tables[sizes[0][0]]
    seen = [sum(row[k] for row in first) for k in range(n_domains)]
    chances = {
        name: [[math.log(row[k] / sum(other[k] for other in table)) for k in range(n_domains)] for row in table]
        for name, table in tables.items()
    }
    return Memberships([math.log(s / sum(seen)) for s in seen], chances)


def _unbounded(posteriors: list[Column], multipliers: list[float]) -> Column:
    return sum((p * F.lit(m) for p, m in zip(posteriors, multipliers)), F.lit(1.0))


def _bounded(rate: Column, highest: float) -> Column:
    return F.least(F.lit(highest), F.greatest(F.lit(0.0), rate))


def solve(
    binned: DataFrame, names: list[str], member: Memberships, weights: list[float], total: float | None,
    near: float, highest: float,
) -> tuple[list[float], list[float]]:
    """(multipliers, missed): `missed` is the expected total of each domain over the wanted one, less one; if none is wanted,
    the share of its tokens that is left. Without `total`, the tokens wanted are as many as take the domain with the largest share once, of those that have tokens."""
    k_all = range(len(weights))
    cells = binned.groupBy(*names).agg(F.sum("n_tokens").cast("double").alias("n"))
    posteriors = [F.col(f"p{k}") for k in k_all]
    cells = cells.select("n", *[p.alias(f"p{k}") for k, p in enumerate(member.posteriors())])
    # A row for each combination of bins; one partition adds up the same way every time.
    cells = materialize(cells.coalesce(1).sortWithinPartitions("n", *[f"p{k}" for k in k_all]), "cells")

    def sums(multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected totals, Gram matrix of the documents that are not cut off, and what the rates cost in `gain`."""
        rated = cells.withColumn("u", _unbounded(posteriors, multipliers.tolist())).withColumn("r", _bounded(F.col("u"), highest))
        n, u, r = F.col("n"), F.col("u"), F.col("r")
        between = F.when(u == r, n).otherwise(0.0)
        row = rated.agg(
            *[F.sum(n * r * p) for p in posteriors],
            *[F.sum(between * p * q) for p in posteriors for q in posteriors],
            F.sum(n * r * (u - r / 2)),
        ).first()
        found = np.array([x or 0.0 for x in row], float)
        return found[: len(weights)], found[len(weights) : -1].reshape(len(weights), -1), found[-1]

    at = np.zeros(len(weights))
    have, gram, cost = sums(at)
    if total is None:
        weight, tokens = max(((w, h) for w, h in zip(weights, have) if h > 0), default=(1.0, 0.0))
        total = tokens / weight if weight > 0 else 0.0
    want, now = total * np.array(weights), have
    # A domain without tokens is left as it is; one of which none is wanted counts by what it has.
    some = np.flatnonzero(have > 0)
    scale = near * np.where(want > 0, want, have)[some]

    def gain(multipliers: np.ndarray, cost: float) -> float:
        """What the multipliers maximise: the dual of the rates' own objective."""
        m = multipliers[some]
        return float(want[some] @ m - cost - (scale * m * m).sum() / 2)

    best = gain(at, cost)
    while len(some):
        gradient = (want - now)[some] - scale * at[some]
        if np.abs(gradient / np.maximum(have, want)[some]).max() < CLOSE:
            break
        step = np.zeros(len(weights))
        step[some] = np.linalg.solve(gram[np.ix_(some, some)] + np.diag(scale), gradient)
        share, better = 1.0, False
        while not better and share > 1e-9:
            there = at + share * step
            found = sums(there)
            value = gain(there, found[2])
            better = value > best + 1e-4 * share * float(gradient @ step[some])
            share /= 2
        if not better:
            break  # no double nearer to the minimum
        at, best, (now, gram, cost) = there, value, found
    missed = [float(n / w - 1) if w > 0 else float(n / h) if h > 0 else 0.0 for n, w, h in zip(now, want, have)]
    return at.tolist(), missed


def mix(
    docs: DataFrame, labels: DataFrame, domain: Column, weights: dict[str, float], total: float | None = None,
    seed: int = 42, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, taught_most: int = TAUGHT,
    near: float = NEAR, highest: float = math.inf,
) -> DataFrame:
    """`docs` (the columns `keep`, all without it) with n_tokens, p_<domain>, rate, copies and, the same in every row,
    missed_<domain>: by what share the expected tokens of the domain lie above (or below, negative) the wanted ones.

    `domain` is computed from the labels; `weights` are the wanted shares of the tokens, in
    any unit. Copies are the rate rounded up or down by a hash of id and seed, so that their
    expectation is the rate. A document with no copies is still a row here. The classifier
    learns from `taught_most` labelled documents at most, chosen by hash; all else covers all rows.
    """
    domains, summed = list(weights), sum(weights.values())
    new = ["n_tokens", *[f"p_{d}" for d in domains], "rate", "copies", *[f"missed_{d}" for d in domains]]
    taught = materialize(taught_rows(docs, labels, domain, domains, id_col, text_col, taught_most), "taught")
    lists = word_lists(taught, len(domains))
    rows, sizes = with_bins(taught, lists, "_text")
    member = learn(rows, sizes, len(domains))
    names = [name for name, _ in sizes]
    keep = beside(keep or docs.columns, [*new, *names, "_words", "_distinct"])
    only = list(dict.fromkeys([*keep, id_col, text_col]))
    binned, _ = with_bins(docs.select(only), lists, text_col)
    # Written once, so that bins are computed once.
    binned = materialize(binned.select(*keep, "n_tokens", *names), "binned")
    multipliers, missed = solve(binned, names, member, [weights[d] / summed for d in domains], total, near, highest)
    out = binned.withColumns({f"p_{d}": p for d, p in zip(domains, member.posteriors())}).drop(*names)
    out = out.withColumn("rate", _bounded(_unbounded([F.col(f"p_{d}") for d in domains], multipliers), highest))
    chance = F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(1 << 53)) / float(1 << 53)
    out = out.withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))
    return out.withColumns({f"missed_{d}": F.lit(m) for d, m in zip(domains, missed)})


def sample(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The documents of a mix, each as often as it has copies."""
    taken = mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(columns)
