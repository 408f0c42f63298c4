"""Near-duplicates by SimHash: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint has 64 bits. Cut into `max_bits` + 2 blocks, two fingerprints that differ in
at most `max_bits` bits agree in two blocks at least, so they meet under one of the pairs
of blocks, a key of about 64 * 2 / (`max_bits` + 2) bits. Equal fingerprints are one node,
whatever the number of their documents. Fingerprints that share a key are joined on it and
their distance is checked in the join. A key shared by very many fingerprints is not joined
with itself: its members are linked exactly through the fingerprints near
them (see `_links_by_neighbours`), which for two bits costs 65 rows a member instead of a square.

Defined results: null and empty texts have no words and the fingerprint zero; every row is
linked and returned, whether its id is null, repeated or neither; a component's name is
its smallest id, null if none of its rows has one; an empty table gives an empty result;
kept columns named like a result are replaced, others are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.components import component_of
from pagemill.llm.worker import beside, travels
from pagemill.session import materialize

travels(__name__)

BITS = 64
#: Keys with more fingerprints than this are linked by neighbours instead of joined.
JOINED = 24
#: Shingles whose bits are counted at a time; bounds the memory for a very long text.
AT_ONCE = 1 << 16
#: Most differing bits; with more, the lists of near fingerprints become too long.
MOST_BITS = 4
_SEED = 42


def fingerprint_of(text: bytes | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number. A bit is set if over half the hashes have it."""
    words = (text or b"").lower().split()  # of bytes: A-Z only, and blanks of ASCII only
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    total, ones = max(len(words) - shingle + 1, 1), np.zeros(BITS, np.int64)
    for lo in range(0, total, AT_ONCE):
        hi = min(lo + AT_ONCE, total)
        hashes = np.array([hashed(b" ".join(words[i : i + shingle]), _SEED) for i in range(lo, hi)], "<u8")
        # Bytes of a number from the lowest, bits of a byte from the lowest.
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """bigint: the SimHash of the lower-cased word shingles of the whole text."""

    @F.arrow_udf(returnType="bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py(), shingle) for t in texts.cast(pa.binary())], pa.int64())

    return fingerprints(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _keys(max_bits: int) -> Column:
    """array<struct<n, part>>: the fingerprint under the mask of every pair of blocks."""
    blocks = max_bits + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for n, pair in enumerate(combinations(range(blocks), 2)):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in pair)
        masks.append(F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("bigint")).alias("part")))
    return F.array(*masks)


def _links_by_neighbours(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Links whose components are those of all pairs within `max_bits`, without pairs.

    Two fingerprints differ in at most r + s bits exactly if some fingerprint is at most r
    bits from one and s from the other. With s half of the bits, rounded up, every node is
    listed under all fingerprints within s bits, 65 for two bits, so that a list is no longer
    than that either. All of a list are linked with the smallest node within r bits, if there is one.
    """
    outer = (max_bits + 1) // 2
    flips = [c for n in range(outer + 1) for c in combinations(range(BITS), n)]
    near = F.array(*[
        F.struct(F.lit(len(c) <= max_bits - outer).alias("inner"), F.lit(_signed(sum(1 << i for i in c))).cast("bigint").alias("flip"))
        for c in flips
    ])
    listed = nodes.select("node", "fp", F.explode(near).alias("f")).select(
        "node", "f.inner", F.col("fp").bitwiseXOR(F.col("f.flip")).alias("w")
    )
    lists = listed.groupBy("w").agg(F.collect_list("node").alias("all"), F.min(F.when(F.col("inner"), F.col("node"))).alias("v"))
    return lists.filter("v is not null and size(all) > 1").select(F.explode("all").alias("u"), "v").filter("u <> v")


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def close_links(nodes: DataFrame, max_bits: int, joined: int = JOINED) -> DataFrame:
    """(u, v): links between nodes (node, fp), fp unique, that connect all within `max_bits`."""
    if not 0 <= max_bits <= MOST_BITS:
        raise ValueError(f"0 to {MOST_BITS} differing bits are supported")
    keyed = nodes.select("node", "fp", F.explode(_keys(max_bits)).alias("key")).select("node", "fp", "key.*")
    heavy = keyed.groupBy("n", "part").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > joined)
    heavy = materialize(heavy.select("n", "part"), "heavy-keys")
    if heavy.isEmpty():
        light, crowded = keyed, None
    else:
        light = keyed.join(heavy, ["n", "part"], "left_anti")
        crowded = keyed.join(heavy, ["n", "part"], "left_semi").select("node", "fp").distinct()
    left = light.select("n", "part", F.col("node").alias("u"), F.col("fp").alias("fu"))
    right = light.select("n", "part", F.col("node").alias("v"), F.col("fp").alias("fv"))
    pairs = left.join(right, ["n", "part"]).filter((F.col("u") > F.col("v")) & (_distance("fu", "fv") <= max_bits))
    links = pairs.select("u", "v")
    return links if crowded is None else links.union(_links_by_neighbours(crowded, max_bits))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    keep: list[str] | None = None,
) -> DataFrame:
    """(kept columns, id, fp, near, component): every row with its group of rows that are linked,
    directly or not: `near`, a fingerprint of the group, names it for all rows, `component`,
    its smallest id, for those whose group has one."""
    kept = beside(keep or [], ["id", "fp", "near", "component", "least"])
    prints = docs.select(*kept, F.col(id_col).cast("bigint").alias("id"), fingerprint(F.col(text_col), shingle).alias("fp"))
    prints = materialize(prints, "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    parts = component_of(close_links(nodes.select(F.col("fp").alias("node"), "fp"), max_bits))
    named = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    named = materialize(named.select("fp", "least", F.coalesce("component", "fp").alias("near")), "groups")
    first = named.groupBy("near").agg(F.min("least").alias("component"))
    of = named.join(first, "near").select("fp", "near", "component")
    return prints.join(of, "fp").select(*kept, "id", "fp", "near", "component")
