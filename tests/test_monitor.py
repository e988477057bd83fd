"""Profiles, violations, bias and streams."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens.plans import monitor
from fleetlens.plans.bias import in_group_d, pretraining_bias
from fleetlens.streaming import jobs


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)


def test_profile_and_buckets(spark):
    df = frame(spark, [0.0, 0.5, 5.0, 10.0, None])
    row = monitor.baseline_statistics(df, ["x"]).first()
    assert (row.present, row.missing, row.low, row.high, row.mean) == (4, 1, 0.0, 10.0, 3.875)
    assert [row[b] for b in monitor.BUCKET_COLUMNS] == [2, 0, 0, 0, 0, 1, 0, 0, 0, 1]
    constraint = monitor.baseline_constraints(monitor.baseline_statistics(df, ["x"])).first()
    assert (constraint.completeness, constraint.non_negative, constraint.inferred_type) == (0.8, True, "Fractional")


def test_constant_column_has_one_bucket(spark):
    row = monitor.baseline_statistics(frame(spark, [3.0, 3.0]), ["x"]).first()
    assert row.bucket0 == 2


def test_violations(spark):
    base = frame(spark, [float(i) for i in range(100)])
    assert monitor.drift_violations(base, base, ["x"]).count() == 0
    shifted = frame(spark, [float(i) - 40 for i in range(100)] + [None])
    found = {r.check: r for r in monitor.drift_violations(base, shifted, ["x"]).collect()}
    assert set(found) == {"completeness_check", "non_negative_check", "baseline_drift_check"}
    # 40 of 100 values fall below the baseline's range and count in its first bucket
    assert found["baseline_drift_check"].observed == pytest.approx(0.4)
    assert found["non_negative_check"].observed == -40.0


def test_changed_type(spark):
    base = frame(spark, [1.0, 2.0])
    whole = spark.createDataFrame([(1,), (2,)], "x long")
    assert [r.check for r in monitor.drift_violations(base, whole, ["x"]).collect()] == ["data_type_check"]


def test_unknown_feature(spark):
    base = monitor.baseline_statistics(frame(spark, [1.0, 2.0]), ["x"])
    batch = base.withColumn("feature", F.lit("y"))
    assert sorted(r.check for r in monitor.violations(batch, base).collect()) == ["extra_column_check", "missing_column_check"]


def test_bias_by_hand(spark):
    rows = [("a", 1)] * 30 + [("a", 0)] * 10 + [("d", 1)] * 5 + [("d", 0)] * 15
    df = spark.createDataFrame(rows, "facet string, label int").coalesce(1)
    out = {r.metric: r.value for r in pretraining_bias(df, "label", [1], "facet", facet_values=["d"], group="facet").collect()}
    assert out["CI"] == pytest.approx(20 / 60)
    assert out["DPL"] == pytest.approx(0.5) and out["TVD"] == pytest.approx(0.5) and out["KS"] == pytest.approx(0.5)
    assert out["LP"] == pytest.approx(math.sqrt(0.5))
    assert out["KL"] == pytest.approx(0.75 * math.log(3) + 0.25 * math.log(1 / 3))
    assert out["CDDL"] == pytest.approx(0.0)


def test_bias_without_a_share(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (5, "x")], "age int, label string").coalesce(1)
    out = {r.metric: r.value for r in pretraining_bias(df, "label", ["x"], "age", facet_threshold=3).collect()}
    assert out["KL"] is None and out["KS"] == pytest.approx(0.5)
    with pytest.raises(ValueError):
        in_group_d("age")


def _events(start, minutes):
    return [(start + timedelta(minutes=m), float(m)) for m in minutes]


def test_hourly_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    schema, start = "ts timestamp, value double", datetime(2024, 1, 1)
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    bounds = {"value": (0.0, 300.0)}

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.hourly_stream(stream, ["value"], bounds, out, check).awaitTermination()

    first = _events(start, range(0, 150, 7))
    run(first)
    batch = monitor.hourly_profile(spark.createDataFrame(first, schema), ["value"], bounds)
    columns = ["hour", "feature", "present", "mean", "low", "high", *monitor.BUCKET_COLUMNS]
    assert sorted(map(tuple, jobs.read_hourly(spark, out).select(*columns).collect())) == sorted(
        map(tuple, batch.select(*columns).collect()))
    run(_events(start, (5, 149)))  # the first hour is closed by now, the third is open
    present = {r.hour.hour: r.present for r in jobs.read_hourly(spark, out).collect()}
    assert present == {0: 9, 1: 9, 2: 5}


def test_requests_as_json_and_csv(spark):
    lines = spark.createDataFrame([("[[1,2],[3,4]]",), ("5,6",), ("[]",)], "value string").coalesce(1)
    out = jobs.parse_requests(lines, ["a", "b"]).orderBy("a").collect()
    assert [(r.a, r.b) for r in out if r.problem is None] == [(1, 2), (3, 4), (5, 6)]
    assert [r.value for r in out if r.problem] == ["[]"]
