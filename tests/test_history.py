"""As-of join, the log of batches and the view of latest records."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetlens.operators.asof import asof_join
from fleetlens.plans import feature_log, feature_table


@pytest.fixture(params=["true", "false"])
def ranges(spark, request):
    """With and without small ranges being put together."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield spark
    spark.conf.set(name, before)


def brute(left, right, within=None):
    out = []
    for k, t, x in left:
        found = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        best = max(found, key=lambda r: (r[1], r[2], (r[3] is not None, r[3])), default=None)
        if best is not None and within is not None and t - best[1] > within:
            best = None
        out.append((k, t, x, *(best[1:] if best else (None, None, None))))
    return sorted(out, key=str)


def frames(spark, left, right):
    return (spark.createDataFrame(left, "k string, t long, x int").repartition(3),
            spark.createDataFrame(right, "k string, at long, rank int, v string").repartition(2))


@pytest.mark.parametrize("within", [None, 3])
def test_as_of_equals_brute_force(ranges, within):
    r = random.Random(1)
    left = [(r.choice("aaaab") if r.random() < 0.95 else None, r.randrange(60) if r.random() < 0.95 else None, r.randrange(3)) for _ in range(400)]
    left += [("hot", 7, 1)] * 300 + [("none", 5, 0)]
    right = [(r.choice("aabc"), r.randrange(60) if r.random() < 0.9 else None, r.randrange(3), r.choice(["u", "v", None])) for _ in range(60)]
    right += [("hot", 2, 0, "early"), ("hot", 7, 0, "now"), ("hot", 7, 1, "tie"), ("hot", 8, 9, "later"), (None, 1, 1, "x")]
    got = asof_join(*frames(ranges, left, right), ["k"], "t", "at", ["rank"], within).select("k", "t", "x", "at", "rank", "v").collect()
    assert sorted(map(tuple, got), key=str) == brute(left, right, within)


def test_records_carried_over_many_ranges(ranges):
    left = [("a", 10 * k, k) for k in range(2000)]
    right = [("a", 5, 0, "first"), ("a", 15000, 0, "second")]
    got = asof_join(*frames(ranges, left, right), ["k"], "t", "at", ["rank"]).groupBy("v").count().collect()
    assert dict(map(tuple, got)) == {None: 1, "first": 1499, "second": 500}


def test_as_of_without_rows_columns_or_with_clashes(spark):
    left, right = frames(spark, [("a", 1, 1)], [])
    assert [tuple(r) for r in asof_join(left, right, ["k"], "t", "at").collect()] == [("a", 1, 1, None, None, None)]
    assert asof_join(left.limit(0), right, ["k"], "t", "at").count() == 0
    only = right.sparkSession.createDataFrame([("a", 0), ("a", 0)], "k string, at long")
    assert [tuple(r) for r in asof_join(left, only, ["k"], "t", "at").collect()] == [("a", 1, 1, 0)]
    with pytest.raises(ValueError, match="x"):
        asof_join(left, right.withColumnRenamed("v", "x"), ["k"], "t", "at")
    assert "r_x" in asof_join(left, right.withColumnRenamed("v", "x"), ["k"], "t", "at", prefix="r_").columns


def test_features_as_of_event_time(spark):
    history = spark.createDataFrame([(1, 7, 100.5), (1, 8, 200.0)], "machineID long, age int, event_time double")
    spine = spark.createDataFrame([(1, datetime(1970, 1, 1, 0, 1, 40)), (1, datetime(1970, 1, 1, 0, 1, 41)), (1, datetime(1970, 1, 1, 0, 3, 20))], "machineID long, ts timestamp")
    got = feature_table.features_as_of(spine, history, "machineID", "ts").orderBy("ts").collect()
    assert [r.age for r in got] == [None, 7, 8] and got[0].asDict().keys() == {"machineID", "ts", "event_time", "age"}


def test_appends_of_one_batch_count_once(spark, tmp_path):
    path = str(tmp_path / "history")
    df = spark.createDataFrame([(1, "x")], "id int, a string")
    assert feature_log.append_batch(df, path, "one", "2024-01-01") is True
    assert feature_log.append_batch(df, path, "one", "2024-01-01") is False
    assert feature_log.append_batch(df.withColumn("b", F.lit(2.5)), path, "two", "2024-01-02") is True
    rows = feature_log.read_history(spark, path).orderBy("batch").collect()
    assert [(r.id, r.a, r.b, r.batch) for r in rows] == [(1, "x", None, "one"), (1, "x", 2.5, "two")]
    # a run that failed before its commit leaves a folder that is not read, and that the next run replaces
    df.write.parquet(f"{path}/records/batch=three")
    assert feature_log.read_history(spark, path).count() == 2
    more = df.withColumn("b", F.lit(1.0)).unionByName(df.withColumn("b", F.lit(2.0)))
    assert feature_log.append_batch(more, path, "three", "2024-01-03")
    assert feature_log.read_history(spark, path).filter("batch = 'three'").count() == 2


def test_changed_columns(spark, tmp_path):
    path = str(tmp_path / "history")
    first = spark.createDataFrame([(1, 1.5, "x")], "id int, v float, a string")
    feature_log.append_batch(first, path, "1")
    for bad, words in ((first.drop("a"), "lacks a"), (first.withColumn("v", F.lit("1")), "v was float"), (first.withColumn("id", F.lit(True)), "id was int")):
        with pytest.raises(ValueError, match=words):
            feature_log.append_batch(bad, path, "2")
    assert feature_log.append_batch(first.withColumn("id", F.lit(1 << 40)).withColumn("v", F.lit(0.1)), path, "2")
    assert feature_log.append_batch(first, path, "3")  # a narrower type is read as the wider one
    got = feature_log.read_history(spark, path).orderBy("batch")
    assert got.schema["id"].dataType.simpleString() == "bigint" and [(r.id, r.v) for r in got.collect()] == [(1, 1.5), (1 << 40, 0.1), (1, 1.5)]
    with pytest.raises(ValueError, match="folder"):
        feature_log.append_batch(first, path, "a/b")
    with pytest.raises(ValueError, match="no history"):
        feature_log.read_history(spark, str(tmp_path / "nothing"))


def test_plain_appends_keep_later_columns(spark, tmp_path):
    path = str(tmp_path / "plain")
    df = spark.createDataFrame([(1, "x")], "id int, a string")
    feature_table.append_offline(df, path, "2024-01-01 00:00:00")
    feature_table.append_offline(df.withColumn("b", F.lit(2)), path, "2024-01-02 00:00:00")
    assert sorted((r.a, r.b) for r in feature_table.read_offline(spark, path).na.fill(0).collect()) == [("x", 0), ("x", 2)]


def test_latest_view_equals_whole_history(spark, tmp_path):
    path, r = str(tmp_path / "view"), random.Random(3)
    start = datetime(2024, 1, 1)
    batches = [[(r.randrange(60), start + timedelta(hours=r.randrange(200)), r.randrange(5), b) for _ in range(150)] for b in range(4)]
    schema = "id long, at timestamp, n int, b int"
    for rows in batches:
        df = spark.createDataFrame(rows, schema)
        feature_log.update_latest(df, path, "id", "at", "n", "b", buckets=8)
        feature_log.update_latest(df, path, "id", "at", "n", "b", buckets=8)
    whole = feature_table.latest_records(spark.createDataFrame([x for b in batches for x in b], schema), "id", "at", "n", "b")
    assert sorted(map(tuple, feature_log.read_latest(spark, path).select("id", "at", "n", "b").collect())) == sorted(map(tuple, whole.collect()))
    files = lambda: {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    before = files()
    feature_log.update_latest(spark.createDataFrame([(5, start + timedelta(days=99), 1, 9)], schema), path, "id", "at", "n", "b", buckets=8)
    folders = {Path(p).parent.name for p in set(before.items()) ^ set(files().items()) for p in [p[0]]}
    assert len(folders) == 1 and len({Path(p).parent.name for p in before}) == 8
    one = feature_log.read_latest(spark, path, "id", 5, buckets=8).collect()
    assert [(x.id, x.b) for x in one] == [(5, 9)]
