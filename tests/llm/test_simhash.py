"""Fingerprints and groups against a plain count of bits and all pairs."""

import random
import re

import pytest
import xxhash

from pagemill.llm import simhash
from pagemill.llm.components import component_of
from pagemill.llm.queries import QUERIES


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_query(spark, texts):
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    groups = plain_groups(list(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    rows = QUERIES["op4_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", groups[i]) for i in texts}


@pytest.mark.parametrize("joined", [0, 2, 1000])
@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_of_crowded_keys(spark, joined, bits):
    rnd = random.Random(joined + bits)
    centres = [rnd.getrandbits(64) for _ in range(4)]
    prints = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([0, 1, 1, 2, 3, 5]))) for c in centres for _ in range(30)})
    nodes = dict(enumerate(prints))
    signed = [(n, f - (1 << 64) if f >> 63 else f) for n, f in nodes.items()]
    links = simhash.close_links(spark.createDataFrame(signed, "node bigint, fp bigint"), bits, joined)
    found = {n: n for n in nodes} | {r.node: r.component for r in component_of(links).collect()}
    assert found == plain_groups(list(nodes), lambda a, b: (nodes[a] ^ nodes[b]).bit_count() <= bits)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(3, 3), (None, 5), (9, 7)]
    rows = component_of(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert {r.node: r.component for r in rows} == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)}
    assert component_of(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def plain_rows(keys, texts, bits=2):
    """Smallest id of each row's group, over rows."""
    prints = [plain_fingerprint(t) for t in texts]
    groups = plain_groups(list(range(len(texts))), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= bits)
    names = {}
    for row, group in groups.items():
        names.setdefault(group, []).append(keys[row])
    least = {g: min((k for k in ks if k is not None), default=None) for g, ks in names.items()}
    return [(keys[i], prints[i], least[groups[i]]) for i in range(len(texts))]


def test_edges(documents, cluttered, monkeypatch):
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    texts = [None, "", "  \n", "A b", "a B", "one two three " * 40, "One Two three " * 40, "x" * 100_000, "a b", "lost", "found", "lost"]
    keys = [5, 6, 7, 8, 9, 10, 11, 12, 9, None, 9, None]
    df = cluttered(documents(texts, keys), "fp", "id", "component", "near")
    rows = simhash.near_duplicates(df, keep=["lang", "fp"]).collect()
    of = lambda found: sorted(found, key=repr)
    assert of((r.id, r.fp & (2**64 - 1), r.component) for r in rows) == of(plain_rows(keys, texts))
    assert all(r.lang == "en" for r in rows) and len({r.near for r in rows}) == 6
    assert simhash.near_duplicates(documents([])).collect() == []
    with pytest.raises(ValueError):
        simhash.near_duplicates(df, max_bits=5)


def test_rows_without_an_id_of_their_own(spark, documents):
    """Repeated and null ids lose no row and no link."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    base = [[rnd.choice(words) for _ in range(60)] for _ in range(25)]
    texts = [" ".join(b) for b in base for _ in range(3)] + [" ".join([*b[:-1], "other"]) for b in base]
    keys = [rnd.choice([None, 1, 1, 7, i]) for i in range(len(texts))]
    rows = simhash.near_duplicates(documents(texts, keys)).collect()
    of = lambda found: sorted(found, key=repr)
    assert of((r.id, r.fp & (2**64 - 1), r.component) for r in rows) == of(plain_rows(keys, texts))
