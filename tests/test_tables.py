"""Sources, capture records, summaries and the feature table."""

import json
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions import clean, records, scalar
from fleetlens.operators import joins, ordering, summary
from fleetlens.plans import feature_table
from fleetlens.schemas import CAPTURE, HEADERLESS_MATRIX, MODEL_MATRIX
from fleetlens.sources import capture, files


def test_work_dir_is_the_configured_folder(spark):
    from fleetlens.session import work_dir

    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or work_dir(spark).startswith(shared)


def test_headerless_matrix(spark, tmp_path):
    rows = [",".join(str(i + j) for j in range(30)) for i in range(3)]
    (tmp_path / "m.csv").write_text("\n".join(rows))
    df = files.read_matrix(spark, str(tmp_path / "m.csv"))
    assert df.schema == HEADERLESS_MATRIX and len(MODEL_MATRIX) == 30
    assert [tuple(r) for r in df.orderBy("c0").collect()] == [tuple(float(i + j) for j in range(30)) for i in range(3)]


def test_csv_keeps_times(spark, tmp_path):
    schema = T.StructType([T.StructField("datetime", T.TimestampType()), T.StructField("x", T.DoubleType())])
    rows = [(datetime(2015, 1, 1, 6), 0.1), (datetime(2015, 1, 2), None)]
    files.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "c"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "c"), schema).collect())) == rows


def record(key, request, response='["none"]', hour=1):
    return json.dumps({
        "captureData": {"endpointInput": {"data": request, "mode": "INPUT"}, "endpointOutput": {"data": response}},
        "eventMetadata": {"eventId": key or "x", "inferenceTime": f"2024-01-01T0{hour}:00:00Z"} | ({"inferenceId": key} if key else {}),
    })


def test_capture_records(spark, tmp_path):
    """Two records in a request, none, a short one; records without an inference id are left out."""
    lines = [record("a", "[[1,2],[3,4]]"), record("b", "[]"), record("c", "[[5]]"), record(None, "[[9,9]]")]
    for hour in (1, 2):
        folder = tmp_path / f"hour=2024-01-01-0{hour}"
        folder.mkdir()
        (folder / "p.json").write_text("\n".join(lines if hour == 1 else [record("d", "[[7,8]]", hour=2)]))
    read = capture.read_capture(spark, str(tmp_path))
    rows = capture.capture_features(read, 2).orderBy("inferenceId", "record").collect()
    assert rows[0].__fields__ == ["inferenceId", "record", "feature0000000000", "feature0000000001", "prediction0", "more", "problem"]
    assert [tuple(r)[:4] for r in rows] == [("a", 0, 1, 2), ("a", 1, 3, 4), ("c", 0, 5, None), ("d", 0, 7, 8)]
    newest = capture.read_capture(spark, str(tmp_path), newest_hour_only=True)
    assert [r.eventMetadata.inferenceId for r in newest.collect()] == ["d"]


def test_python_handler_gives_the_same_features(spark):
    df = spark.createDataFrame([("a", "[[1,2],[3,4]]", "x"), ("b", "[]", "y")], "inferenceId string, request string, response string")
    schema = "inferenceId string, feature0000000000 double, feature0000000001 double"
    out = records.apply_handler(df, records.positional_features, spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, out.collect())) == [("a", 1.0, 2.0), ("a", 3.0, 4.0)]


def test_sample_is_repeatable_and_near_its_share(spark):
    df = spark.range(5000).withColumnRenamed("id", "event_id")
    kept = {r.event_id for r in capture.sample_capture(df, "event_id", 20).collect()}
    assert kept == {r.event_id for r in capture.sample_capture(df.repartition(7), "event_id", 20).collect()}
    assert 850 < len(kept) < 1150
    assert capture.sample_capture(df, "event_id", 100).count() == 5000


def test_flatten_report(spark):
    element = spark.createDataFrame([], "name string, numbers struct<mean: double, n: long>").schema
    body = json.dumps({"features": [{"name": "volt", "numbers": {"mean": 1.5, "n": 3}}, {"name": "age", "numbers": {"mean": None, "n": 0}}]})
    out = capture.flatten_report(spark.createDataFrame([(body,)], "body string"), "body", "features", element)
    assert out.columns == ["name", "numbers.mean", "numbers.n"]
    assert sorted(map(tuple, out.collect())) == [("age", None, 0), ("volt", 1.5, 3)]


def test_exact_quantiles_with_narrow_brackets_and_a_hot_value(spark):
    values = [float((i * 7919) % 3001) for i in range(3001)] + [1500.0] * 1500
    df = spark.createDataFrame([(v, -v, None if v < 100 else v) for v in values], "a double, b double, c double")
    out = {(r.column, r.probability): r.value for r in summary.exact_quantiles(df, ["a", "b", "c"], (0.25, 0.5, 0.75)).collect()}
    for name, column in (("a", values), ("b", [-v for v in values]), ("c", [v for v in values if v >= 100])):
        for p, wanted in zip((0.25, 0.5, 0.75), statistics.quantiles(column, n=4, method="inclusive")):
            assert out[name, p] == pytest.approx(wanted), (name, p)


def test_describe_column_info_and_counts(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0), (4, 8.0)], "k long, v double")
    row = summary.describe(df, ["v"]).first()
    assert (row["count"], row["min"], row.q25, row.q50, row.q75, row["max"]) == (3, 2.0, 3.0, 4.0, 6.0, 8.0)
    assert {tuple(r) for r in summary.column_info(df).collect()} == {("k", 4, "bigint"), ("v", 3, "double")}
    assert {tuple(r) for r in summary.row_counts({"a": df, "none": df.filter("k > 9")}).collect()} >= {("a", 4)}


def test_row_counts_of_an_empty_table(spark):
    df = spark.range(0)
    assert [tuple(r) for r in summary.row_counts({"none": df}).collect()] == [("none", 0)]


def test_clean(spark):
    df = spark.createDataFrame([("2015-01-01 06:00:00", "a", float("nan")), ("01/02/2015", "z", 1.0)], "datetime string, code string, x double")
    out = clean.with_category(clean.nan_to_null(clean.parse_datetime(df), ["x"]), "code", ["b", "a"]).collect()
    assert [r.datetime for r in out] == [datetime(2015, 1, 1, 6), None]
    assert [(r.code_code, r.code_known, r.x) for r in out] == [(1, True, None), (None, False, 1.0)]
    hot = df.select(*clean.one_hot("code", ["a", "b"], "code_")).collect()
    assert [tuple(r) for r in hot] == [(1, 0), (0, 0)]


def test_days_and_requests(spark):
    df = spark.createDataFrame([(datetime(2015, 1, 3, 12), datetime(2015, 1, 1), 1.5, 2.0)], "a timestamp, b timestamp, x double, y double")
    row = df.select(scalar.days_between(F.col("a"), F.col("b")), scalar.json_request(["x", "y"]), scalar.csv_request(["x", "y"])).first()
    assert tuple(row) == (2.5, "[[1.5,2.0]]", "1.5,2.0")


def test_ordering(spark):
    df = spark.range(300).repartition(5)
    assert [r.id for r in ordering.row_range(df, ["id"], 100, 103).collect()] == [100, 101, 102]
    one = {r.id for r in ordering.sample_rows(df, "id", 10, seed=1).collect()}
    assert one == {r.id for r in ordering.sample_rows(df.repartition(2), "id", 10, seed=1).collect()}
    assert one != {r.id for r in ordering.sample_rows(df, "id", 10, seed=2).collect()}


def test_full_spine_join_keeps_repeats_and_lone_rows(spark):
    spine = spark.createDataFrame([(1, datetime(2015, 1, 1))] * 3 + [(2, datetime(2015, 1, 1))], "machineID long, datetime timestamp")
    counts = spark.createDataFrame([(1, datetime(2015, 1, 1), 1.0, 0.0, 0.0, 0.0), (3, datetime(2015, 1, 1), 0.0, 1.0, 0.0, 0.0)],
                                   "machineID long, datetime timestamp, comp1 double, comp2 double, comp3 double, comp4 double")
    out = joins.join_spine_maint(spine, counts).orderBy("machineID").collect()
    assert [(r.machineID, r.comp1, r.comp2) for r in out] == [(1, 1, 0)] * 3 + [(2, 0, 0), (3, 0, 1)]


def test_feature_table(spark, tmp_path):
    path = str(tmp_path / "fs")
    machines = spark.createDataFrame([(1, "model1", 3), (2, "model2", 4)], "machineID long, model string, age long")
    definitions = feature_table.feature_definitions(machines)
    assert definitions == [("machineID", "Integral"), ("model", "String"), ("age", "Integral")]
    feature_table.append_offline(machines, path, "2024-01-01 00:00:00", definitions)
    feature_table.append_offline(machines.filter("machineID = 1").withColumn("age", F.lit(9).cast("long")), path, "2024-02-01 00:00:00", definitions)
    history = feature_table.read_offline(spark, path)
    assert history.count() == 3
    latest = feature_table.latest_records(history, "machineID", "event_time")
    assert {(r.machineID, r.age) for r in latest.collect()} == {(1, 9), (2, 4)}
    assert feature_table.distinct_features(history, "machineID", "model").count() == 2
    with pytest.raises(ValueError):
        feature_table.append_offline(machines.drop("age"), path, "2024-03-01 00:00:00", definitions)


def test_declared_schema():
    schema = feature_table.schema_from({"machineID": int, "model": str, "volt": float})
    assert [(f.name, f.dataType.typeName()) for f in schema.fields] == [("machineID", "long"), ("model", "string"), ("volt", "double")]


def test_capture_schema_reads_what_is_written(spark, tmp_path):
    df = spark.createDataFrame([("1", datetime(2024, 1, 1, 5, 30))], "event_id string, ts timestamp")
    rec = df.select(*capture.capture_record(F.col("event_id"), F.col("event_id"), F.col("ts"), F.lit("[[1.0]]"), F.lit('["x"]')))
    assert rec.schema.simpleString() == CAPTURE.simpleString()
    capture.write_capture(rec, str(tmp_path / "cap"))
    back = capture.read_capture(spark, str(tmp_path / "cap")).first()
    assert back.hour == "2024-01-01-05" and back.captureData.endpointInput.data == "[[1.0]]"


def test_csv_is_read_by_name_with_rejects(spark, tmp_path):
    from pyspark.sql import types as T

    from fleetlens.sources.files import csv_rejects, read_csv

    (tmp_path / "x.csv").write_text("volt,machineID,datetime,more\nNaN,1,2015-01-01 06:00:00,z\n2.5,two,2015-01-01 07:00:00,z\n3.5,3,soon,z\n")
    schema = T.StructType([T.StructField("datetime", T.TimestampType()), T.StructField("machineID", T.LongType()), T.StructField("volt", T.DoubleType())])
    rows = read_csv(spark, f"{tmp_path}/x.csv", schema).collect()
    assert [(r.machineID, r.volt, r.datetime is None) for r in rows] == [(1, None, False), (None, 2.5, False), (3, 3.5, True)]
    assert [r.bad_columns for r in csv_rejects(spark, f"{tmp_path}/x.csv", schema).collect()] == [["machineID"], ["datetime"]]


def test_requests_are_whole_and_none_is_lost(spark):
    from pyspark.sql import functions as F

    from fleetlens.functions.scalar import csv_request
    from fleetlens.sources.capture import with_records
    from fleetlens.streaming.jobs import parse_requests

    lines = spark.createDataFrame([(x,) for x in ("[[1,2],[3,null]]", "[4,5]", "6,", ",7", "[[1,2", "1,x", "[[1,2,3]]", "8", "[]", "")], "value string")
    got = {(r.value, r.a, r.b, r.problem) for r in parse_requests(lines, ["a", "b"]).collect()}
    assert {(v, a, b) for v, a, b, p in got if p is None} == {
        ("[[1,2],[3,null]]", 1, 2), ("[[1,2],[3,null]]", 3, None), ("[4,5]", 4, 5), ("6,", 6, None), (",7", None, 7)}
    assert {v for v, _, _, p in got if p} == {"[[1,2", "1,x", "[[1,2,3]]", "8", "[]", ""}
    row = spark.createDataFrame([(1.0, None, 3.0)], "a double, b double, c double")
    assert row.select(csv_request(["a", "b", "c"])).first()[0] == "1.0,,3.0"
    found = {r.value: r.found for r in with_records(lines, F.col("value"), "found").collect()}
    assert found["[4,5]"] == [[4.0, 5.0]] and found["[]"] == [] and found["[[1,2"] is None and found["[[1,2,3]]"] == [[1.0, 2.0, 3.0]]
    odd = spark.createDataFrame([(x,) for x in ("[[1]]]", "[[1],[2]", "[1,[2]]", "[[1],2]", "[[[1]]]", None)], "value string")
    assert {r.found is None for r in with_records(odd, F.col("value"), "found").collect()} == {True}


def test_missing_column_is_a_violation(spark):
    from fleetlens.plans.monitor import drift_violations

    base = spark.createDataFrame([(float(i), float(i)) for i in range(20)], "x double, y double")
    from fleetlens.plans import monitor

    bounds = monitor.value_bounds(base, ["x", "y"])
    found = monitor.violations(monitor.baseline_statistics(base, ["x"], bounds), monitor.baseline_statistics(base, ["x", "y"], bounds)).collect()
    assert [(r.feature, r.check) for r in found] == [("y", "missing_column_check")]
    assert drift_violations(base, base, ["x", "y"]).count() == 0


def test_csv_rows_of_other_widths_and_line_breaks(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("note", T.StringType())])
    path = str(tmp_path / "x.csv")
    (tmp_path / "x.csv").write_text('id,v,note\n1,2,x,9\n3\n4,5,"a ""b"", c"\n6,7,"two\nlines"\n8,z,ok\n')
    rows = files.read_csv(spark, path, schema, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, 2.0, "x"), (3, None, None), (4, 5.0, 'a "b", c'), (6, 7.0, "two\nlines"), (8, None, "ok")]
    rejects = files.csv_rejects(spark, path, schema, multi_line=True).collect()
    assert [(r.id, r.bad_columns, r.record) for r in rejects] == [("1", [], "1,2,x,9"), ("3", [], "3"), ("8", ["v"], None)]
    broken = {r.id for r in files.csv_rejects(spark, path, schema).collect()}
    assert {"1", "3", 'lines"', "8"} <= broken  # without multi_line the second half of the row shows it
    files.write_csv(files.read_csv(spark, path, schema, multi_line=True), str(tmp_path / "again"))
    again = files.read_csv(spark, str(tmp_path / "again"), schema, multi_line=True)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, rows), key=str)
