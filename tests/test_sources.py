import hashlib
import json
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException

from pagemill.operators import curate
from pagemill.operators.report import prep_summary
from pagemill.operators.split import train_val_split
from pagemill.plans.prepare import prepare_data
from pagemill.schemas import FRONTIER, PAGE, VISITED
from pagemill.session import scratch_path, scratch_root
from pagemill.sources import jsonl, state


def page(url, text="t", **more):
    return json.dumps({"url": url, "title": "", "text": text, "categories": [], **more}, ensure_ascii=False)


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_first_means_file_name_then_line(spark, tmp_path):
    write(tmp_path, "b.jsonl", page("u", "late"), page("only-b", "b"))
    write(tmp_path, "a.jsonl", page("x", "first"), page("x", "second"), page("u", "early"))
    write(tmp_path, "Z.jsonl", page("only-b", "Z"))  # upper case sorts first
    write(tmp_path, "c.txt", page("u", "not read"))
    write(tmp_path / "deeper", "0.jsonl", page("u", "not read"))
    first = curate.dedup_first_wins(jsonl.read_jsonl(spark, str(tmp_path)), order=jsonl.SOURCE_ORDER)
    assert {r.url: r.text for r in first.collect()} == {"u": "early", "x": "first", "only-b": "Z"}


def test_line_order_holds_when_files_are_split(spark, tmp_path):
    for name in ("a", "b", "c"):
        write(tmp_path, f"{name}.jsonl", *(page(f"u{i % 50}", f"{name}{i}" + "x" * 200) for i in range(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        records = jsonl.read_jsonl(spark, str(tmp_path))
        assert records.rdd.getNumPartitions() > 20
        first = curate.dedup_first_wins(records, order=jsonl.SOURCE_ORDER).collect()
        ordered = [r.text.rstrip("x") for r in records.orderBy(*jsonl.SOURCE_ORDER).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.url: r.text.rstrip("x") for r in first} == {f"u{i}": f"a{i}" for i in range(50)}
    assert ordered == [f"{name}{i}" for name in "abc" for i in range(400)]


def test_one_file_blank_lines_and_defaults(spark, tmp_path):
    write(tmp_path, "a.data", "", " \t", page("u", "å😀"), "\x1c", '{"title": null, "other": [1]}', "{}")
    records = jsonl.read_jsonl(spark, str(tmp_path / "a.data")).orderBy(*jsonl.SOURCE_ORDER).collect()
    assert [(r.url, r.text, r.categories) for r in records] == [("u", "å😀", []), (None, None, None), (None, None, None)]


def test_no_files_give_no_rows(spark, tmp_path):
    write(tmp_path, "a.txt", "x")
    assert jsonl.read_jsonl(spark, str(tmp_path)).count() == 0


def test_malformed_lines(spark, tmp_path):
    write(tmp_path, "a.jsonl", page("u"), '{"url": ', page("v"))
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read_jsonl(spark, str(tmp_path)).collect()
    good, bad = jsonl.split_rejects(jsonl.read_jsonl(spark, str(tmp_path), mode="PERMISSIVE"))
    assert sorted(r.url for r in good.collect()) == ["u", "v"]
    assert [(r.file_name, r.line) for r in bad.collect()] == [("a.jsonl", '{"url": ')]


def test_jsonl_out_keeps_nulls_and_unicode(spark, tmp_path):
    out = str(tmp_path / "out")
    jsonl.write_jsonl(spark.createDataFrame([("u", None, "å\n", ["ö"])], PAGE), out)
    (line,) = [line for f in (tmp_path / "out").glob("*.json") for line in f.read_text(encoding="utf-8").splitlines()]
    assert json.loads(line) == {"url": "u", "title": None, "text": "å\n", "categories": ["ö"]}
    assert "å" in line and "ö" in line


def test_pairs_and_split_files(spark, tmp_path):
    pairs = spark.range(20).selectExpr("cast(id as string) url", "concat('p', id) prompt", "concat(' c', id) completion")
    jsonl.write_split(train_val_split(pairs, "url"), str(tmp_path / "out"))
    assert jsonl.read_pairs(spark, str(tmp_path / "out/split=train")).count() == 18
    assert jsonl.read_pairs(spark, str(tmp_path / "out/split=val")).columns == ["prompt", "completion"]
    assert jsonl.read_pairs(spark, str(tmp_path / "none"), optional=True).count() == 0
    with pytest.raises(PySparkException):
        jsonl.read_pairs(spark, str(tmp_path / "none"))


def test_summary(spark, tmp_path):
    long = "x" * 120
    write(tmp_path, "a.jsonl", page("u", long), page("u", long), page("v", "short"))
    write(tmp_path, "b.jsonl", page("w", long))
    raw = jsonl.read_jsonl(spark, str(tmp_path))
    kept = curate.min_length(curate.dedup_first_wins(raw, order=jsonl.SOURCE_ORDER))
    got = prep_summary(raw, train_val_split(kept, "url")).first().asDict()
    assert got == {"files": 2, "records": 4, "train": 1, "val": 1, "entries": 2, "few_entries": True}


def test_state_round_trip(spark, tmp_path):
    path = str(tmp_path / "state")
    visited, frontier = state.load_state(spark, path)
    assert (visited.count(), frontier.count()) == (0, 0)

    def save(urls, queue):
        return state.save_state(spark.createDataFrame([(u,) for u in urls], VISITED), spark.createDataFrame(queue, FRONTIER), path)

    save(["a"], [("b", 1, 0, 0), ("c", 1, 0, 1)])
    save(["b"], [("c", 1, 0, 1)])
    visited, frontier = state.load_state(spark, path)
    assert sorted(r.url for r in visited.collect()) == ["a", "b"]
    assert [tuple(r) for r in frontier.collect()] == [("c", 1, 0, 1)]
    assert [t.count() for t in state.load_state(spark, path, fresh=True)] == [0, 0]


def test_unfinished_save_is_ignored_and_replaced(spark, tmp_path):
    path = str(tmp_path / "state")
    one = spark.createDataFrame([("a",)], VISITED)
    queue = spark.createDataFrame([("b", 1, 0, 0)], FRONTIER)
    state.save_state(one, queue, path)
    spark.createDataFrame([("lost",)], VISITED).write.parquet(f"{path}/visited/generation=1")
    assert [r.url for r in state.load_state(spark, path)[0].collect()] == ["a"]
    state.save_state(spark.createDataFrame([("c",)], VISITED), queue, path)
    assert sorted(r.url for r in state.load_state(spark, path)[0].collect()) == ["a", "c"]


def test_unreadable_state_is_not_taken_for_a_fresh_start(spark, tmp_path):
    (tmp_path / "state/commits").mkdir(parents=True)
    (tmp_path / "state/commits/part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        state.load_state(spark, str(tmp_path / "state"))
    assert state.load_state(spark, str(tmp_path / "state"), fresh=True)[0].count() == 0


def test_scratch_is_the_checkpoint_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_without_a_setting():
    def session(master):
        conf = SimpleNamespace(get=lambda key, default: default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app-1"))

    assert scratch_root(session("local[4]")) == scratch_root(session("local[4]"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(session(master))


def test_prepare_data(spark, tmp_path):
    long = "x" * 120
    write(tmp_path / "in", "a.jsonl", *(page(f"u{i}", long + str(i)) for i in range(12)), page("u1", long), page("v", "short"))
    totals = prepare_data(spark, str(tmp_path / "in"), str(tmp_path / "out"), val_ratio=0.25, seed=7)
    sample = totals.pop("sample")
    assert totals == {"files": 1, "entries": 12, "train": 9, "val": 3, "few_entries": False}
    lines = [line for part in ("train", "val") for file in sorted((tmp_path / f"out/split={part}").glob("*.json")) for line in file.read_text().splitlines()]
    order = sorted((f"u{i}" for i in range(12)), key=lambda u: hashlib.md5(f"7:{u}".encode()).hexdigest())
    assert [json.loads(line)["completion"] for line in lines] == [f" {long}{u[1:]}" for u in order]
    assert sample == json.loads(lines[0])
    train = jsonl.read_pairs(spark, str(tmp_path / "out/split=train"))
    val = jsonl.read_pairs(spark, str(tmp_path / "out/split=val"))
    assert (train.count(), val.count()) == (9, 3)
    assert {r.completion for r in train.unionByName(val).collect()} == {f" {long}{i}" for i in range(12)}


@pytest.mark.parametrize("n", [0, 1])
def test_both_parts_are_always_there(spark, tmp_path, n):
    write(tmp_path / "in", "a.jsonl", *(page(f"u{i}", "x" * 120) for i in range(n)))
    totals = prepare_data(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert (totals["train"], totals["val"], bool(totals["sample"])) == (0, n, bool(n))
    assert [jsonl.read_pairs(spark, str(tmp_path / f"out/split={part}")).count() for part in ("train", "val")] == [0, n]


def test_lines_with_more_than_one_object(spark, tmp_path):
    bad = [page("a") + " " + page("b"), page("a") + "," + page("b"), page("a") + "x", "[" + page("a") + "]", "null", "7"]
    write(tmp_path, "a.jsonl", page("good"), *bad)
    good, rejected = jsonl.split_rejects(jsonl.read_jsonl(spark, str(tmp_path), mode="PERMISSIVE"))
    assert [r.url for r in good.collect()] == ["good"] and sorted(r.line for r in rejected.collect()) == sorted(bad)
    for line in bad:
        (tmp_path / "one").write_text(line)
        with pytest.raises(Exception, match="(?i)malformed|not one JSON object"):
            jsonl.read_jsonl(spark, str(tmp_path / "one")).collect()


def test_hidden_files_are_an_error(spark, tmp_path):
    write(tmp_path, "a.jsonl", page("a"))
    write(tmp_path, "_SUCCESS", "")
    assert jsonl.read_jsonl(spark, str(tmp_path)).count() == 1
    write(tmp_path, "_b.jsonl", page("b"))
    with pytest.raises(ValueError):
        jsonl.read_jsonl(spark, str(tmp_path))


def test_many_saves_are_read_from_few_folders(spark, tmp_path):
    path = str(tmp_path / "state")
    for i in range(30):
        visited = spark.createDataFrame([(f"u{i}",)], VISITED)
        state.save_state(visited, spark.createDataFrame([(f"q{i}", 1, 0, 0)], FRONTIER), path)
    visited, queue = state.load_state(spark, path)
    assert sorted(r.url for r in visited.collect()) == sorted(f"u{i}" for i in range(30))
    assert [r.url for r in queue.collect()] == ["q29"]
    assert len({f.rsplit("/", 2)[-2] for f in visited.inputFiles()}) <= 2 * state.FOLD
    assert len(list((tmp_path / "state/frontier").iterdir())) <= 3
    state.save_state(spark.createDataFrame([("n",)], VISITED), queue, path, fresh=True)
    assert [r.url for r in state.load_state(spark, path)[0].collect()] == ["n"]


def test_state_of_the_earlier_layout(spark, tmp_path):
    path = str(tmp_path / "state")
    for g, url in enumerate("ab"):
        spark.createDataFrame([(url,)], VISITED).write.parquet(f"{path}/visited/generation={g}")
        spark.createDataFrame([("q" + url, 1, 0, 0)], FRONTIER).write.parquet(f"{path}/frontier/generation={g}")
        spark.createDataFrame([(g, 0)], "generation bigint, start bigint").write.mode("append").parquet(f"{path}/commits")
    state.save_state(spark.createDataFrame([("c",)], VISITED), spark.createDataFrame([("qc", 1, 0, 0)], FRONTIER), path)
    visited, queue = state.load_state(spark, path)
    assert sorted(r.url for r in visited.collect()) == ["a", "b", "c"] and [r.url for r in queue.collect()] == ["qc"]


SAVED = "url string, seq bigint, text string"


def test_page_store_over_many_batches(spark, tmp_path, monkeypatch):
    """The latest record of a URL and of a slug, few folders, a save that dies, a reader at an old version."""
    import random

    from pagemill.sources import pages
    from pagemill.sources.snapshots import Snapshots

    path, rnd, latest = str(tmp_path / "store"), random.Random(3), {}

    def stored(by="url"):
        rows = pages.load_pages(spark, path, spark.createDataFrame([], SAVED).schema, by).collect()
        return {r.url: r.text for r in rows}

    assert stored() == {}
    for batch in range(8):
        rows = [(f"https://h/{rnd.randrange(20)}", i, f"{batch}-{i}") for i in range(9)]
        if batch in (4, 6):  # dies between its data and its version file
            before, kept = stored(), Snapshots.commit
            monkeypatch.setattr(Snapshots, "commit", lambda *_: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(OSError):
                pages.save_pages(spark.createDataFrame([(u, s, "lost") for u, s, _ in rows], SAVED), path, batch, buckets=2)
            monkeypatch.setattr(Snapshots, "commit", kept)
            assert stored() == before
        old = pages.load_pages(spark, path, spark.createDataFrame([], SAVED).schema)
        pages.save_pages(spark.createDataFrame(rows, SAVED), path, batch, buckets=2)
        assert {r.url: r.text for r in old.collect()} == latest
        latest.update({u: t for u, _, t in rows})
        assert stored() == latest and stored("slug") == latest
        assert len(Snapshots(spark, path).latest()[1]["folders"]) <= 2 * pages.FOLD
    with pytest.raises(ValueError):
        pages.save_pages(spark.createDataFrame([], SAVED), path, 0)
    pages.save_pages(spark.createDataFrame([("https://h/new", 0, "x")], SAVED), path, 8)
    pages.save_pages(spark.createDataFrame([("https://h/newer", 0, "y")], SAVED), path, 8)
    assert stored() == latest | {"https://h/newer": "y"}


def test_published_parts_are_seen_as_a_whole(spark, tmp_path, monkeypatch):
    from pagemill.plans import prepare
    from pagemill.sources.published import publish, published

    path, source = str(tmp_path / "out"), tmp_path / "in"
    source.mkdir()
    assert published(spark, path) is None

    def run(n):
        lines = [json.dumps({"url": f"u{i}", "title": "t", "text": "word " * 30, "categories": []}) for i in range(n)]
        (source / "a.jsonl").write_text("\n".join(lines))
        return prepare.prepare_data(spark, str(source), path, as_version=True)

    assert run(20)["entries"] == 20
    first = published(spark, path)
    whole = prepare.write_split

    def dying(df, folder, **more):
        whole(df.filter("split = 'train'"), folder, **more)
        raise OSError("killed")

    monkeypatch.setattr(prepare, "write_split", dying)
    with pytest.raises(OSError):
        run(30)
    assert published(spark, path) == first and jsonl.read_prepared(spark, first).count() == 20
    monkeypatch.setattr(prepare, "write_split", whole)
    run(30)
    second = published(spark, path)
    assert second != first and jsonl.read_prepared(spark, second).count() == 30 and jsonl.read_prepared(spark, first).count() == 20
    parts = [lambda f: jsonl.write_jsonl(spark.range(3), f"{f}/a"), lambda f: jsonl.write_jsonl(spark.range(4), f"{f}/b")]
    assert spark.read.json(publish(spark, path, *parts) + "/b").count() == 4
