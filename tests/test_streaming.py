import json
import os

import pytest

from pagemill.schemas import PAGE
from pagemill.streaming import ingest

STAMP = iter(range(1_700_000_000, 1_800_000_000, 10))


def deliver(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("".join(json.dumps(dict(zip(PAGE.names, r))) + "\n" for r in records), encoding="utf-8")
    stamp = next(STAMP)
    os.utime(path, (stamp, stamp))


def record(url, title):
    return (url, title, "text", ["c"])


def run(spark, tmp_path, **more):
    ingest.stream_ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), **more).awaitTermination()


def stored(spark, tmp_path):
    rows = ingest.read_batches(spark, str(tmp_path / "out"), PAGE).collect()
    assert len({r.url for r in rows}) == len(rows)
    return {r.url: (r.title, r.batch) for r in rows}


def test_first_record_wins_across_batches_and_runs(spark, tmp_path):
    folder = tmp_path / "in"
    deliver(folder, "z.jsonl", record("a", "z1"), record("a", "z2"), record(None, "z3"))
    deliver(folder, "y.jsonl", record("a", "y"), record("b", "y"))
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == {"a": ("y", 0), "": ("z3", 0), "b": ("y", 0)}
    deliver(folder, "a.jsonl", record("b", "a"), record("", "a"), record("c", "a"))
    run(spark, tmp_path)
    expected = {"a": ("y", 0), "": ("z3", 0), "b": ("y", 0), "c": ("a", 1)}
    assert stored(spark, tmp_path) == expected
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == expected


def test_file_name_decides_within_a_batch(spark, tmp_path):
    deliver(tmp_path / "in", "b.jsonl", record("u", "b"))
    deliver(tmp_path / "in", "a.jsonl", record("u", "a"))
    deliver(tmp_path / "in", "ignored.txt", record("x", "x"))
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == {"u": ("a", 0)}


@pytest.mark.parametrize("fail_after_write", [False, True])
def test_killed_batch_is_replayed_without_trace(spark, tmp_path, monkeypatch, fail_after_write):
    deliver(tmp_path / "in", "1.jsonl", record("a", "1"))
    run(spark, tmp_path)
    deliver(tmp_path / "in", "2.jsonl", record("a", "2"), record("b", "2"))
    write = ingest._write_batch

    def dying(df, path, batch_id):
        if fail_after_write:
            write(df, path, batch_id)
        raise RuntimeError("killed")

    monkeypatch.setattr(ingest, "_write_batch", dying)
    with pytest.raises(Exception, match="killed"):
        run(spark, tmp_path)
    monkeypatch.setattr(ingest, "_write_batch", write)
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == {"a": ("1", 0), "b": ("2", 1)}


def test_output_of_another_checkpoint_is_not_overwritten(spark, tmp_path):
    for name in ("1", "2"):
        deliver(tmp_path / "in", f"{name}.jsonl", record(name, name))
        run(spark, tmp_path)
    before = stored(spark, tmp_path)
    with pytest.raises(Exception, match="another checkpoint"):
        run(spark, tmp_path, checkpoint=str(tmp_path / "new"))
    assert stored(spark, tmp_path) == before


def test_standing_query(spark, tmp_path):
    deliver(tmp_path / "in", "1.jsonl", record("a", "1"))
    query = ingest.stream_ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), every="1 second")
    query.processAllAvailable()
    deliver(tmp_path / "in", "2.jsonl", record("b", "2"))
    query.processAllAvailable()
    query.stop()
    assert stored(spark, tmp_path) == {"a": ("1", 0), "b": ("2", 1)}


def test_malformed_line_stops_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"url": \n')
    with pytest.raises(Exception):
        run(spark, tmp_path)


@pytest.mark.parametrize("line", ['{"url": "a"} {"url": "b"}', '{"url": "a"},{"url": "b"}', '{"url": "a"} x', '[{"url": "a"}]', "5", "null"])
def test_more_than_one_object_stops_the_stream(spark, tmp_path, line):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text(line + "\n")
    with pytest.raises(Exception):
        run(spark, tmp_path)


def test_many_files_against_name_order_are_one_batch(spark, tmp_path):
    for i in range(30, 0, -1):  # the oldest file has the last name
        deliver(tmp_path / "in", f"{i:02}.jsonl", record("u", str(i)), record(f"v{i // 2}", str(i)))
    run(spark, tmp_path)
    expected = {"u": ("1", 0)} | {f"v{i}": (str(max(2 * i, 1)), 0) for i in range(16)}
    assert stored(spark, tmp_path) == expected


def html(*links):
    body = "<h1>T</h1><div class=text>" + "x" * 60 + "</div>"
    return body + "".join(f"<a href='{link}'>l</a>" for link in links)


def test_crawl_stream(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def take_in(*rows):
        spark.createDataFrame(rows, "url string, html string").coalesce(1).write.mode("append").parquet(folder)
        ingest.stream_crawl(spark, folder, out, pattern=r"^/\d$").awaitTermination()
        return sorted(r.url for r in ingest.crawl_frontier(spark, out).collect())

    assert take_in(("http://h/1", html("/2", "/3", "http://other/x"))) == ["http://h/2", "http://h/3"]
    again = ("http://h/2", html("/1", "/4", "/3")), ("http://h/1", html("/9")), ("http://h/list", html("/2"))
    assert take_in(*again, ("http://h/5", "<h1>short</h1>")) == ["http://h/3", "http://h/4"]
    ingest.stream_crawl(spark, folder, out).awaitTermination()
    pages = ingest.read_batches(spark, f"{out}/pages", ingest.CRAWLED).collect()
    assert sorted((r.url, r.title or "", r.outcome, r.batch) for r in pages) == [
        ("http://h/1", "T", "OK", 0), ("http://h/2", "T", "OK", 1), ("http://h/5", "", "SKIP", 1),
        ("http://h/list", "", "CRAWL", 1),
    ]
    queue = ingest.crawl_frontier(spark, out).orderBy("depth", "src_ord", "pos").collect()
    assert [r.url for r in queue] == ["http://h/3", "http://h/4"]


def test_crawl_stream_judges_status_and_type(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("http://h/1", html("/5"), 200, "text/html; charset=utf-8"), ("http://h/2", html("/6"), 404, "text/html"),
            ("http://h/3", html("/7"), 200, "application/pdf"), ("http://h/4", html("/8"), None, None)]
    spark.createDataFrame(rows, ingest.FETCHED).write.parquet(folder)
    ingest.stream_crawl(spark, folder, out, pattern=r"^/\d$").awaitTermination()
    pages = ingest.read_batches(spark, f"{out}/pages", ingest.CRAWLED).collect()
    assert sorted((r.url, r.outcome, r.title) for r in pages) == [
        ("http://h/1", "OK", "T"), ("http://h/2", "ERROR", None), ("http://h/3", "NON_HTML", None), ("http://h/4", "OK", "T"),
    ]
    assert sorted(r.url for r in ingest.crawl_frontier(spark, out).collect()) == ["http://h/5", "http://h/8"]


def test_maintained_queue_equals_the_recomputed_one(spark, tmp_path, monkeypatch):
    """Many batches of random pages and links, some killed at some point and replayed."""
    import random

    from pyspark.sql import functions as F

    from pagemill.operators.frontier import frontier_next
    from pagemill.schemas import FRONTIER
    from pagemill.sources import queue, seen

    monkeypatch.setattr(queue, "FOLD", 2)
    folder, out, rnd = str(tmp_path / "in"), str(tmp_path / "out"), random.Random(2)
    killed = {1: (seen.SeenUrls, "add"), 2: (queue.CrawlQueue, "take_in"), 3: (queue.Snapshots, "commit")}
    for batch in range(5):
        rows = [(f"http://h/{i}", html("/hot", *(f"/{rnd.randrange(60)}" for _ in range(4)))) for i in rnd.sample(range(60), 8)]
        spark.createDataFrame(rows, "url string, html string").coalesce(2).write.mode("append").parquet(folder)
        if batch in killed:
            owner, name = killed[batch]

            def dying(*_):
                raise RuntimeError("killed")

            whole = getattr(owner, name)
            monkeypatch.setattr(owner, name, dying)
            with pytest.raises(Exception, match="killed"):
                ingest.stream_crawl(spark, folder, out).awaitTermination()
            monkeypatch.setattr(owner, name, whole)
        ingest.stream_crawl(spark, folder, out).awaitTermination()
        pages = ingest.read_batches(spark, f"{out}/pages", ingest.CRAWLED)
        assert pages.count() == pages.select("url").distinct().count()
        links = ingest.read_batches(spark, f"{out}/links", ingest.LINKS).withColumn("depth", F.col("batch").cast("int"))
        want = frontier_next(links, pages, spark.createDataFrame([], FRONTIER))
        got = ingest.crawl_frontier(spark, out)
        assert sorted(map(tuple, got.select(*FRONTIER.names).collect())) == sorted(map(tuple, want.select(*FRONTIER.names).collect()))


def test_output_without_a_seen_set_is_read_once(spark, tmp_path):
    """A folder that an earlier version of this library wrote."""
    import shutil

    deliver(tmp_path / "in", "1.jsonl", record("a", "1"))
    run(spark, tmp_path)
    shutil.copytree(tmp_path / "out", tmp_path / "old", ignore=shutil.ignore_patterns("_seen"))
    deliver(tmp_path / "in", "2.jsonl", record("a", "2"), record("b", "2"))
    ingest.stream_ingest(spark, str(tmp_path / "in"), str(tmp_path / "old")).awaitTermination()
    rows = ingest.read_batches(spark, str(tmp_path / "old"), PAGE).collect()
    assert {r.url: (r.title, r.batch) for r in rows} == {"a": ("1", 0), "b": ("2", 1)} and len(rows) == 2
