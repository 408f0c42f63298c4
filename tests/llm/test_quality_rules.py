"""Statistics against a plain count, the fit against a plain expectation-maximisation."""

import re
from collections import Counter

from pagemill.llm import quality_rules as qr
from pagemill.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)


def base_failed(stats):
    return stats[0] < 10 or 100 * stats[4] > 20 * stats[0]


def plain_posteriors(votes, groups):
    """votes: list of tuples of 1, 0, None; documents one by one, without patterns."""
    n, m = len(votes), len(votes[0])
    first = [qr.MISFIRE + qr.MISFIRES * sum(v[j] == 0 for v in votes) / n for j in range(m)]
    means = [first] + [[qr.SEEN if j in g else first[j] for j in range(m)] for g in groups]
    begin = [1 - qr.BAD] + [qr.BAD / len(groups)] * len(groups)
    shares, chances = begin, means

    def classes(v):
        found = list(shares)
        for k, chance in enumerate(chances):
            for x, p in zip(v, chance):
                found[k] *= 1 if x is None else p if x == 0 else 1 - p
        return [x / sum(found) for x in found]

    for _ in range(qr.ROUNDS):
        known = {v: classes(v) for v in set(votes)}
        q = [known[v] for v in votes]
        old = [*shares, *sum(chances, [])]
        shares = [(sum(x[k] for x in q) + qr.PRIOR * s) / (n + qr.PRIOR) for k, s in enumerate(begin)]
        chances = [
            [(sum(x[k] for x, v in zip(q, votes) if v[j] == 0) + qr.PRIOR * mean[j]) / (sum(x[k] for x, v in zip(q, votes) if v[j] is not None) + qr.PRIOR) for j in range(m)]
            for k, mean in enumerate(means)
        ]
        if max(abs(a - b) for a, b in zip(old, [*shares, *sum(chances, [])])) < qr.SETTLED:
            break
    known = {v: classes(v)[0] for v in set(votes)}
    return [known[v] for v in votes]


def test_query(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op5_quality_rules"](spark, "/root/testdata/sf0.001").collect()}
    assert set(rows) == set(texts)
    for i, text in texts.items():
        r, want = rows[i], plain_statistics(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == base_failed(want) and not (r.base_failed and r.kept)


def test_verdict_against_plain_fit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    votes = qr.base_statistics(docs).select("doc_id", *[r.vote().alias(f"v{j}") for j, r in enumerate(qr.rules())]).collect()
    want = dict(zip([r.doc_id for r in votes], plain_posteriors([tuple(r)[1:] for r in votes], qr.kinds(qr.rules()))))
    rows = qr.judge(docs, keep=["doc_id"]).collect()
    assert max(abs(r.quality - want[r.doc_id]) for r in rows) < 1e-9
    assert all(r.kept == (not r.base_failed and r.quality >= 0.5) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.kept, r.base_failed) for r in rows if r.doc_id in labels]
    assert sum(kept for y, kept, failed in judged if y and not failed) >= 0.99 * sum(y and not failed for y, _, failed in judged)
    assert sum(kept for y, kept, _ in judged if not y) <= 0.05 * sum(not y for y, _, _ in judged)


def test_edges(documents, cluttered):
    line = "one two three four five six seven eight nine ten"
    texts = [None, "", " \n\x0b", "a b c d", line, f"{line}\n{line}", f"x\n{line}\n y \n{line} ", "a " * 5000 + "\n", "é　ü a\x85b" * 3, "z" * 100_000]
    df = cluttered(documents([*texts, line], [*range(len(texts)), 4]), "n_words", "KEPT", "_words", "_vote0", "quality", "extra")
    rows = qr.judge(df)
    assert {"n_words", "kept", "quality", "extra", "lang"} <= set(rows.columns) and len(set(c.lower() for c in rows.columns)) == len(rows.columns)
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows.collect())
    assert got == sorted((i, *plain_statistics(t)) for i, t in [*enumerate(texts), (4, line)])
    assert qr.judge(documents([])).collect() == []


def test_native(spark, plan):
    assert "Python" not in plan(QUERIES["op5_quality_rules"](spark, "/root/testdata/sf0.001"))
