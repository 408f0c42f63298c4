"""Chat formatting: cumulative snapshots collapsed, what is left rendered.

A logged conversation is often stored again after every turn. A conversation whose turns
are the first turns of a longer one, or the same as those of one with a smaller id, is
dropped. Prefixes are compared by a rolling hash: the sums of two 64-bit hashes of every
turn with its number, role and text. A sum can be built up in pieces, so a
conversation of any length is hashed in chunks of turn numbers, and no task needs all of it.

Conversations of equal content are one candidate, whatever their number; the hashes of
proper prefixes are made unique before the anti join. A kept conversation is rendered in
segments of SEGMENT turn numbers, one for all but very long ones. Only DataFrame
functions are used.

Defined results: rows without a conversation id are left out, repeated rows count once;
several rows with one turn number are one step and are rendered in the order of role and
text; a null turn comes first; null role and text are empty, and differ from no turn;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pagemill.session import materialize

#: Turn numbers of a chunk and of a rendered segment.
SEGMENT = 256
# The marks around a turn.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _turn_hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "turn", F.length("role"), "role", "text")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(28,0)")


def turns_of(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with their chunk; a null turn comes before all others."""
    turn = F.coalesce(F.col("turn").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    return (
        rows.filter("conv_id is not null")
        .select("conv_id", turn.alias("turn"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
        .withColumns({"h1": _turn_hash(1), "h2": _turn_hash(2)})
        .withColumn("chunk", F.floor(F.col("turn") / SEGMENT))
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, steps, p1, p2): number and rolling hash of the steps up to each turn."""
    steps = (
        turns.groupBy("conv_id", "chunk", "turn", "h1", "h2").agg(F.lit(1).alias("one"))
        .groupBy("conv_id", "chunk", "turn")
        .agg(F.sum(_exact("h1")).alias("s1"), F.sum(_exact("h2")).alias("s2"))
    )
    within = Window.partitionBy("conv_id", "chunk").orderBy("turn")
    running = steps.select(
        "conv_id", "chunk", "turn",
        F.row_number().over(within).cast("bigint").alias("n"),
        F.sum("s1").over(within).alias("r1"), F.sum("s2").over(within).alias("r2"),
    )
    totals = steps.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "conv_id", "chunk",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b{c}") for c in ("n", "s1", "s2")],
    )
    return running.join(starts, ["conv_id", "chunk"]).select(
        "conv_id", "turn", (F.col("n") + F.col("bn")).alias("steps"),
        (F.col("r1") + F.col("bs1")).alias("p1"), (F.col("r2") + F.col("bs2")).alias("p2"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, copies): the conversations that no other one contains as a prefix; `copies` have the same content."""
    prefixes = materialize(prefix_hashes(turns), "prefixes")
    lengths = prefixes.groupBy("conv_id").agg(F.max("steps").alias("length"))
    marked = prefixes.join(lengths, "conv_id")
    whole = marked.filter("steps = length").groupBy("steps", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    inner = marked.filter("steps < length").select("steps", "p1", "p2").distinct()
    return whole.join(inner, ["steps", "p1", "p2"], "left_anti").select("conv_id", "copies")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, segment, n_turns, rendered): the turns of each segment in order, between fixed marks."""
    rows = turns.groupBy("conv_id", "chunk", "turn", "role", "text").agg(F.lit(1).alias("one"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    piece = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))
    return (
        rows.groupBy("conv_id", "chunk").agg(ordered.alias("all"))
        .select("conv_id", F.col("chunk").alias("segment"), F.size("all").cast("bigint").alias("n_turns"), F.array_join(F.transform("all", piece), "").alias("rendered"))
    )


def collapse_and_render(rows: DataFrame) -> DataFrame:
    """(conv_id, copies, segment, n_turns, rendered) of the maximal conversations."""
    turns = turns_of(rows)
    kept = materialize(maximal(turns.select("conv_id", "chunk", "turn", "h1", "h2")), "maximal")
    return render(turns.join(kept, "conv_id", "left_semi")).join(kept, "conv_id").select("conv_id", "copies", "segment", "n_turns", "rendered")
