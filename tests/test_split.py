import hashlib

import pyspark.sql.functions as F
import pytest

from pagemill.operators import split


def expected_order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def keys_df(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))


@pytest.mark.parametrize("n, ratio", [(n, 0.1) for n in (0, 1, 2, 9, 10, 30, 49)] + [(20, r) for r in (0.0, 0.25, 0.29, 1.0)])
def test_sizes_are_exact(spark, n, ratio):
    got = split.train_val_split(keys_df(spark, n), "key", ratio).collect()
    order = expected_order(r.key for r in got)
    n_train = int(n * (1 - ratio))
    assert len(got) == n
    assert {r.key for r in got if r.split == "train"} == set(order[:n_train])
    assert {r.key for r in got if r.split == "val"} == set(order[n_train:])


def test_split_depends_on_keys_alone(spark):
    one = split.train_val_split(keys_df(spark, 300, 1), "key").collect()
    other = split.train_val_split(keys_df(spark, 300, 7).orderBy(F.rand(1)), "key").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))
    reseeded = split.train_val_split(keys_df(spark, 300), "key", seed=43).collect()
    assert sorted(map(tuple, one)) != sorted(map(tuple, reseeded))


def test_labelling_moves_no_rows(spark, plan):
    assert "Exchange" not in plan(split.train_val_split(keys_df(spark, 100), "key"))


def test_positions(spark):
    got = split.seeded_order(keys_df(spark, 200), "key").collect()
    order = expected_order(r.key for r in got)
    assert {r.key: r.position for r in got} == {key: i for i, key in enumerate(order)}


def test_repeated_keys(spark):
    df = keys_df(spark, 20).unionAll(keys_df(spark, 20))
    assert split.train_val_split(df, "key", 0.5).filter("split = 'train'").count() == 20
    assert split.train_val_split(df, "key", 0.52).filter("split = 'train'").count() == 19  # cuts a pair of equal keys


def test_hot_key_is_cut_exactly_and_repeatably(spark):
    rows = spark.range(0, 300, 1, 5).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) AS key", "cast(id div 30 AS int) AS v")
    for ratio in (0.1, 0.5, 0.9):
        one, other = (
            split.train_val_split(df, "key", ratio).groupBy("key", "v", "split").count().collect()
            for df in (rows, rows.repartition(3).orderBy(F.rand(2)))
        )
        assert sorted(map(tuple, one)) == sorted(map(tuple, other))
        assert sum(r["count"] for r in one if r.split == "train") == int(300 * (1 - ratio))
    placed = split.seeded_order(rows, "key").orderBy("position").collect()
    assert [r.position for r in placed] == list(range(300))
    assert [r.key for r in placed] == expected_order(r.key for r in placed)


def test_missing_key_counts_as_empty(spark):
    df = keys_df(spark, 9).unionAll(spark.createDataFrame([(None,)], "key string"))
    got = split.train_val_split(df, "key", 0.3).collect()
    assert sum(r.split == "train" for r in got) == 7


def test_sample(spark):
    df = split.train_val_split(keys_df(spark, 30), "key")
    assert split.sample_pair(df, "key").first().key == expected_order(r.key for r in df.collect())[0]
    only_val = split.train_val_split(keys_df(spark, 5), "key", 1.0)
    assert split.sample_pair(only_val, "key").first().split == "val"
    assert split.sample_pair(split.train_val_split(keys_df(spark, 0), "key"), "key").count() == 0


def test_large_buckets_are_counted_by_further_digits(spark, monkeypatch):
    df = keys_df(spark, 500)
    expected = split.split_cut(df, "key", 0.3, 42)
    for digits, ranked in ((1, 3), (4, 0), (2, 1)):
        monkeypatch.setattr(split, "PREFIX", digits)
        monkeypatch.setattr(split, "RANKED", ranked)
        assert split.split_cut(df, "key", 0.3, 42) == expected
    hot = df.unionAll(spark.range(600).select(F.lit("hot").alias("key")))
    order = expected_order([r.key for r in hot.collect()])
    n_train = order.index("hot") - 1  # just before the hot key
    assert split.split_cut(hot, "key", 1 - (n_train + 0.5) / 1100, 42)[1:] == (order[n_train - 1], 1, 1)
    assert split.split_cut(hot, "key", 1 - (n_train + 100.5) / 1100, 42)[1:] == ("hot", 99, 600)


@pytest.mark.parametrize("repeated", [False, True])
def test_growing_split_equals_the_split_of_all_rows(spark, tmp_path, repeated):
    """Exact sizes after every batch, a repeated batch too; rows that changed sides are counted."""
    from pagemill.sources.growing import GrowingSplit

    schema = spark.createDataFrame([], "url string, text string").schema
    store = GrowingSplit(spark, str(tmp_path / "g"), schema, val_ratio=0.3)
    assert store.labelled().collect() == []
    rows, before = [], {}
    for batch, size in enumerate([0, 1, 40, 7, 60]):
        new = [((f"u{i}" if i % 5 else "same") if repeated else f"u{batch}-{i}", f"t{batch}-{i}") for i in range(size)]
        for _ in range(2 if batch == 3 else 1):
            counts = store.append(spark.createDataFrame(new, schema), batch)
        rows += new
        got = {r.text: r.split for r in store.labelled().collect()}
        want = {r.text: r.split for r in split.train_val_split(spark.createDataFrame(rows, schema), "url", 0.3).collect()}
        assert got == want and sum(v == "train" for v in got.values()) == int(len(rows) * (1 - 0.3))
        assert (counts["rows"], counts["train"]) == (len(rows), int(len(rows) * (1 - 0.3)))
        if not repeated:  # of rows with equal keys at the cut, others may take the place of those before
            assert counts["moved"] == sum(before[t] != got[t] for t in before)
        before = got
