import random

import pytest

from pagemill.operators import frontier
from pagemill.schemas import FRONTIER, VISITED

LINKS = "src_url string, pos int, url string"


def queue(spark, rows):
    return spark.createDataFrame(rows, FRONTIER)


def seen(spark, *urls):
    return spark.createDataFrame([(u,) for u in urls], VISITED)


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


def test_visit_gate(spark):
    wanted = queue(spark, [("a", 0, 0, 0), ("b", 0, 1, 0), ("a", 1, 0, 0), ("c", 0, 2, 0)])
    assert tuples(frontier.visit_gate(wanted, seen(spark, "b", "x"))) == [("a",), ("c",)]


def test_frontier_next_keeps_queued_places_and_takes_the_earliest_new_one(spark):
    queued = queue(spark, [("q", 3, 9, 9)])
    links = queue(spark, [("q", 1, 0, 0), ("n", 4, 2, 0), ("n", 4, 1, 5), ("n", 4, 1, 7), ("v", 4, 0, 0)])
    assert tuples(frontier.frontier_next(links, seen(spark, "v"), queued)) == [("n", 4, 1, 5), ("q", 3, 9, 9)]


def test_resume(spark):
    queued = queue(spark, [("a", 1, 0, 0), ("b", 1, 0, 1), ("c", 2, 0, 0)])
    resumed = frontier.resume_frontier(queued, seen(spark, "b"), "s")
    assert [r.url for r in frontier.frontier_batch(resumed, 2).collect()] == ["s", "a"]
    assert tuples(frontier.resume_frontier(queued, seen(spark, "b", "s"), "s")) == [("a", 1, 0, 0), ("c", 2, 0, 0)]
    assert tuples(frontier.resume_frontier(queued, seen(spark), "a"))[0] == ("a", 1, 0, 0)
    assert tuple(frontier.resume_counts(resumed, seen(spark, "b")).first()) == (1, 3)


def crawl(links, seed, cap=0):
    """(url -> (depth, rank)) of what a first-in-first-out crawl visits, and its queue."""
    depth, order, line = {seed: 0}, [], [seed]
    while line and not (cap and len(order) >= cap):
        page = line.pop(0)
        order.append(page)
        for url in links.get(page, ()):
            if url not in depth:
                depth[url] = depth[page] + 1
                line.append(url)
    return {u: (depth[u], i) for i, u in enumerate(order, 1)}, line


@pytest.mark.parametrize("prune_from, growth", [(1_000_000, 4), (1, 1), (5, 2)])
@pytest.mark.parametrize("cap", [0, 2, 23, 1000])
def test_crawl_equals_a_queue(spark, monkeypatch, cap, prune_from, growth):
    monkeypatch.setattr(frontier, "PRUNE_FROM", prune_from)
    monkeypatch.setattr(frontier, "PRUNE_GROWTH", growth)
    rnd = random.Random(11)
    nodes = [f"n{i}" for i in range(60)]
    links = {n: rnd.sample(nodes, rnd.randint(0, 4)) for n in nodes}
    links["n0"] = nodes[1:20] + ["n0"]  # one page holds a third of all links
    rows = [(src, pos, url) for src, urls in links.items() for pos, url in enumerate(urls)]
    rows += rows[:10]  # repeated links
    got = frontier.crawl_reachable(spark.createDataFrame(rows, LINKS).repartition(5), "n0", cap).collect()
    visited, line = crawl(links, "n0", cap)
    assert {r.url: (r.depth, r.visit_rank) for r in got if r.visited} == visited
    waiting = sorted((r for r in got if not r.visited), key=lambda r: r.visit_rank)
    assert [r.url for r in waiting] == line
    assert len({r.url for r in got}) == len(got)


def test_crawl_depth_bound_and_lonely_seed(spark):
    chain = spark.createDataFrame([(str(i), 0, str(i + 1)) for i in range(5)], LINKS)
    assert tuples(frontier.crawl_reachable(chain, "0", max_depth=2).select("url", "depth")) == [("0", 0), ("1", 1), ("2", 2)]
    assert tuples(frontier.crawl_reachable(chain, "x")) == [("x", 0, 1, True)]
