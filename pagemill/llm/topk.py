"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are bucketed by length; large buckets are dealt into blocks of bounded size, and
the queries into groups of bounded size. A first look at the longest vectors gives every
query a score its k-th result reaches at least. A bucket whose longest vector cannot reach it for
any query of a group is skipped. In each (block, group) the bound becomes a local cosine
threshold per query: a low one prunes by length alone, a high one also by the coordinates on which the
query is largest, outside whose feasible intervals no vector reaches the cosine. What is
left is verified by exact products; each (block, query) hands on at most k rows.

Defined results: vectors that are null or hold null or non-finite components, and rows with
a null id, take no part; rows that share an id are each a candidate, for one another
too, and each query row has results of its own; a pair of
vectors of different sizes has no product; equal scores go to the smaller id; products
beyond the range of a long are held at its limits; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pagemill.llm.worker import travels
from pagemill.session import materialize

travels(__name__)

#: Length buckets, vectors of a block, queries of a group (all about).
BUCKETS = 64
BLOCK = 4096
GROUP = 4096
#: The longest vectors that give the first bounds.
FIRST = 2048
#: Coordinates that prune, and the local threshold from which they do.
FOCUS = 3
BY_COORDINATE = 0.3
#: Room for rounding in the pruning bounds; the products themselves are exact.
SLACK = 1e-9
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [np.asarray(v.values, np.float64) if len(v.values) else np.empty(0) for v in column]


def _by_size(vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """size -> (positions, matrix)"""
    sizes = np.array([len(v) for v in vectors], np.int64)
    return {
        int(s): (at := np.flatnonzero(sizes == s), np.array([vectors[i] for i in at]).reshape(len(at), int(s)))
        for s in np.unique(sizes)
    }


def products(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact integer products as int64."""
    bound = np.abs(rows).max(initial=0) * np.abs(one).max(initial=0) * max(len(one), 1)
    if bound < _EXACT:
        return (rows @ one).astype(np.int64)
    ints = [int(x) for x in one]
    sums = [sum(int(a) * b for a, b in zip(row, ints)) for row in rows]
    return np.array([max(-_LONG - 1, min(_LONG, s)) for s in sums], np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= cut)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], ~scores[near]))][:k]  # ~ turns the order round without overflow


def survivors(unit: np.ndarray, norms: np.ndarray, query: np.ndarray, reach: float) -> np.ndarray:
    """Positions of the vectors whose product with the query may be `reach` or more."""
    length = float(np.sqrt(query @ query))
    longest = float(norms.max(initial=0))
    if not (reach > 0 and 0 < length < np.inf and longest < np.inf):
        return np.arange(len(norms))
    alive = norms * length >= reach * (1 - SLACK)
    local = reach * (1 - SLACK) / (length * longest) if longest else np.inf
    if local > 1:
        return np.empty(0, np.int64)
    if local >= BY_COORDINATE:
        direction = query / length
        apart = np.arccos(min(local, 1.0)) + SLACK
        for f in np.argsort(-np.abs(direction))[:FOCUS]:
            # Seen from the axis, a vector within `apart` of the query differs by that angle at most.
            angle = np.arccos(np.clip(direction[f], -1, 1))
            low, high = np.cos(min(angle + apart, np.pi)), np.cos(max(angle - apart, 0.0))
            alive &= (unit[:, f] >= low - SLACK) & (unit[:, f] <= high + SLACK)
    return np.flatnonzero(alive)


def _found(queries: pa.Table, block: pa.Table, k: int) -> pa.Table:
    asked, own = queries["id"].to_numpy(), queries["row"].to_numpy()
    ids, rows_of = block["id"].to_numpy(), block["row"].to_numpy()
    reach = queries["reach"].to_numpy()
    mine, theirs = _by_size(_matrix(queries["v"])), _by_size(_matrix(block["v"]))
    out: list[tuple[np.ndarray, ...]] = []
    for size, (at, rows) in theirs.items():
        norms = np.sqrt((rows * rows).sum(1))
        unit = np.divide(rows, norms[:, None], out=np.zeros_like(rows), where=(norms > 0)[:, None])
        for place, one in zip(*mine.get(size, ((), ()))):
            near = survivors(unit, norms, one, reach[place])
            near = near[rows_of[at[near]] != own[place]]
            if len(near):
                scores = products(rows[near], one)
                best = _best(ids[at[near]], scores, k)
                same = np.full(len(best), place)
                out.append((own[same], asked[same], ids[at[near[best]]], scores[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["row", "query_id", "vec_id", "score"])


def _reach(spark, queries: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Queries with the k-th best score among the first vectors, -inf if there are fewer.

    `first` has at most FIRST rows; they are broadcast.
    """
    rows = first.select("row", "v").collect()
    known = spark.sparkContext.broadcast(([r["row"] for r in rows], [r.v for r in rows]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.array(known.value[0], np.int64)
        seen = _by_size([np.array(v, np.float64) for v in known.value[1]])
        for batch in batches:
            reach = []
            for own, one in zip(batch["row"].to_pylist(), _matrix(batch["v"])):
                at, block = seen.get(len(one), (np.empty(0, np.int64), np.empty((0, len(one)))))
                scores = products(block, one)[first[at] != own] if len(at) else np.empty(0)
                reach.append(float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf)
            yield batch.append_column("reach", pa.array(reach, pa.float64()))

    return queries.mapInArrow(scored, "row bigint, id bigint, v array<double>, norm double, reach double")


def _cuts(df: DataFrame, value: Column, parts: int) -> list[float]:
    """Distinct values that cut the table into about equal parts."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(df.agg(F.percentile_approx(value, shares, 10_000)).first()[0] or []))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of every query vector.

    `vector_col` holds numbers without a fraction; `is_query` is a condition on `id`.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col)
    clean = vectors.filter(usable(v) & F.col(id_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), v.cast("array<double>").alias("v")
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    clean = materialize(clean.withColumn("norm", norm), "vectors")

    # Bounds between the length buckets: at most BUCKETS numbers, whatever the table.
    cuts = _cuts(clean, F.col("norm"), BUCKETS)
    bucket = sum((F.when(F.col("norm") < c, 1).otherwise(0) for c in cuts), F.lit(0))
    placed = clean.withColumn("bucket", bucket)
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"))
    blocks = sizes.select("bucket", "longest", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    placed = placed.join(F.broadcast(blocks), "bucket").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))

    first = clean.orderBy(F.desc("norm"), "id").limit(FIRST)
    queries = _reach(spark, clean.filter(is_query), first, k)
    queries = materialize(queries, "queries")
    groups = max(1, -(-queries.count() // GROUP))
    # Queries that need equally long vectors share a group.
    need = F.when((F.col("reach") > 0) & (F.col("norm") > 0), F.col("reach") / F.col("norm")).otherwise(0.0)
    edges = _cuts(queries, need, min(groups, BUCKETS))
    level = sum((F.when(need > e, 1).otherwise(0) for e in edges), F.lit(0))
    per_level = max(1, -(-groups // (len(edges) + 1)))
    queries = queries.withColumn("need", need).withColumn("team", level * per_level + F.pmod(F.xxhash64("row"), F.lit(per_level)).cast("int"))

    # Which team meets which bucket: one row for each, none where no product can reach.
    teams = queries.groupBy("team").agg(F.min("need").alias("need"))
    listed = blocks.collect()  # BUCKETS rows at most
    if not listed:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    options = F.array(*[F.struct(F.lit(b.bucket).alias("bucket"), F.lit(b.longest).alias("longest"), F.lit(b.parts).alias("parts")) for b in listed])
    meets = teams.select("team", "need", F.explode(options).alias("b")).filter(F.col("b.longest") * (1 + SLACK) >= F.col("need"))
    meets = materialize(meets.select("team", "b.bucket", "b.parts"), "meetings")

    left = queries.join(meets, "team").select(
        "team", "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "row", "id", "v", "reach"
    )
    right = placed.join(meets.select("team", "bucket"), "bucket").select("team", "bucket", "part", "row", "id", "v")
    keys = ["team", "bucket", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda asked, block: _found(asked, block, k), "row bigint, query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
