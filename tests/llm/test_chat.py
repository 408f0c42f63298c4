"""Collapse and rendering against a plain comparison of turn lists."""

import random

from pagemill.llm import chat
from pagemill.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEAST = -(1 << 63)


def plain(rows):
    """(conv, copies, rendered)"""
    steps = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            steps.setdefault(conv, {}).setdefault(LEAST if turn is None else turn, set()).add((role or "", text or ""))
    lists = {c: [(t, frozenset(s)) for t, s in sorted(by.items())] for c, by in steps.items()}
    out = []
    for conv, turns in lists.items():
        same = [c for c, other in lists.items() if other == turns]
        if conv == min(same) and not any(len(o) > len(turns) and o[: len(turns)] == turns for o in lists.values()):
            text = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, step in turns for r, t in sorted(step))
            out.append((conv, len(same), text))
    return sorted(out)


def found(rows):
    parts = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.segment)):
        parts.setdefault((r.conv_id, r.copies), []).append(r.rendered)
    return sorted((c, n, "".join(p)) for (c, n), p in parts.items())


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op3_chat"](spark, "/root/testdata/sf0.001").collect()) == plain(rows)


def test_random_snapshots(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 3)
    rnd = random.Random(4)
    logs = [[(i, rnd.choice("ua"), rnd.choice("xyz")) for i in range(rnd.randint(1, 9))] for _ in range(12)]
    rows = []
    for conv in range(80):
        log = rnd.choice(logs)
        rows += [(conv, *turn) for turn in log[: rnd.randint(1, len(log))]]
    rows += rnd.sample(rows, 40)
    rows += [(90, None, "u", "x"), (90, 2, "u", None), (91, None, "u", "x"), (92, 0, None, None), (93, 0, "b", "x"), (93, 0, "a", "y"),
             (94, 0, "a", "y"), (94, 0, "b", "x"), (94, -5, "a", "z"), (None, 0, "u", "x"), (95, 0, "ab", "c"), (96, 0, "a", "bc"), (97, 0, "a", "b" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS chunk", "2 AS h1", "3 AS copies")
    assert found(chat.collapse_and_render(df).collect()) == plain(rows)


def test_long_conversation_comes_in_segments(spark):
    rows = [(1, i, "u", str(i)) for i in range(1000)] + [(2, i, "u", str(i)) for i in range(999)]
    got = chat.collapse_and_render(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.conv_id for r in got] == [1] * 4 and max(r.n_turns for r in got) == chat.SEGMENT
    assert found(got) == plain(rows)


def test_empty_and_native(spark, plan):
    empty = chat.collapse_and_render(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["conv_id", "copies", "segment", "n_turns", "rendered"]
    assert "Python" not in plan(QUERIES["op3_chat"](spark, "/root/testdata/sf0.001"))
