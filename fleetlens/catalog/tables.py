"""Sources, sinks and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import adapters
from fleetlens.catalog.features import labeled
from fleetlens.catalog.registry import query
from fleetlens.catalog.sql import compose, rnd, rnds
from fleetlens.functions.scalar import json_request
from fleetlens.operators.asof import asof_join
from fleetlens.operators.sequence import machine_order
from fleetlens.operators.summary import row_counts
from fleetlens.plans import feature_log, feature_table
from fleetlens.plans import features as plans
from fleetlens.plans.monitor import (
    PROFILE_SCHEMA,
    baseline_statistics,
    statistics_report,
)
from fleetlens.plans.splits import model_matrix
from fleetlens.schemas import CAPTURE, COMPONENTS, MEASURES, MODEL_MATRIX, TELEMETRY
from fleetlens.session import new_path
from fleetlens.sources import capture, files

SAMPLE_PERCENT = 20
FEATURE_TIMES = ("2024-01-01 00:00:00", "2024-01-02 12:30:00")


def capture_records(spark, sf_dir):
    """Capture records from events: the request holds the value and a property, one record or two;
    sign-ups carry no inference id."""
    events = adapters.read_table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("double")
    )
    one = F.array(F.col("value"), F.col("k"))
    request = F.when(F.col("event_type") == "view", F.to_json(F.array(one, F.array(F.col("k"), F.col("value")))))
    request = request.otherwise(json_request(["value", "k"]))
    key = F.col("event_id").cast("string")
    inference = F.when(F.col("event_type") != "signup", F.concat(F.lit("inf-"), key))
    response = F.to_json(F.array("event_type"))
    return events.select(*capture.capture_record(key, inference, F.col("ts"), request, response), "event_id")


CAPTURED = """captured AS (SELECT event_id, event_type, ts,
  CASE WHEN event_type <> 'signup' THEN 'inf-' || CAST(event_id AS VARCHAR) END AS inferenceId,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS inferenceTime, strftime(ts, '%Y-%m-%d-%H') AS hour,
  value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events),
requests AS (SELECT *, CAST(CASE WHEN event_type = 'view' THEN to_json([[value, k], [k, value]])
  ELSE to_json([[value, k]]) END AS VARCHAR) AS request, CAST(to_json([event_type]) AS VARCHAR) AS response FROM captured)"""


@query("src_csv_roundtrip", compose(
    f"SELECT datetime, machineID, {rnds(MEASURES)} FROM telemetry", "telemetry"))
def src_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "telemetry-csv")
    files.write_csv(adapters.inputs(spark, sf_dir).telemetry, path)
    return files.read_csv(spark, path, TELEMETRY)


_POSITION = {c: f"c{i}" for i, c in enumerate(MODEL_MATRIX)}


@query("src_headerless_matrix", compose("SELECT " + ", ".join(
    rnd(f"CAST({c} AS DOUBLE)", p) for c, p in _POSITION.items()) + " FROM matrix_keyed", "matrix_keyed"))
def src_headerless_matrix(spark, sf_dir):
    path = new_path(spark, "matrix-csv")
    files.write_csv(model_matrix(labeled(spark, sf_dir, "keyed")).drop("failure"), path, header=False)
    return files.read_matrix(spark, path)


@query("src_capture_json", f"""WITH {CAPTURED}
SELECT inferenceId, inferenceTime, hour, request, response FROM requests WHERE inferenceId IS NOT NULL""")
def src_capture_json(spark, sf_dir):
    path = new_path(spark, "capture")
    capture.write_capture(capture_records(spark, sf_dir).drop("event_id"), path)
    return capture.read_capture(spark, path).select(
        "eventMetadata.inferenceId", "eventMetadata.inferenceTime", "hour",
        F.col("captureData.endpointInput.data").alias("request"),
        F.col("captureData.endpointOutput.data").alias("response"),
    )


@query("src_capture_newest", f"""WITH {CAPTURED}
SELECT inferenceId, hour, request FROM requests
WHERE inferenceId IS NOT NULL AND hour = (SELECT max(hour) FROM requests)""")
def src_capture_newest(spark, sf_dir):
    path = new_path(spark, "capture")
    capture.write_capture(capture_records(spark, sf_dir).drop("event_id"), path)
    return capture.read_capture(spark, path, newest_hour_only=True).select(
        "eventMetadata.inferenceId", "hour", F.col("captureData.endpointInput.data").alias("request"))


@query("capture_sample", f"""WITH {CAPTURED}
SELECT CAST(event_id AS VARCHAR) AS eventId, hour, request, response FROM requests
WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < {SAMPLE_PERCENT}""")
def capture_sample(spark, sf_dir):
    path = new_path(spark, "capture")
    sampled = capture.sample_capture(capture_records(spark, sf_dir), "event_id", SAMPLE_PERCENT).drop("event_id")
    capture.write_capture(sampled, path)
    written = spark.read.schema(T.StructType([*CAPTURE.fields, T.StructField("hour", T.StringType())])).json(path)
    return written.select(
        "eventMetadata.eventId", "hour", F.col("captureData.endpointInput.data").alias("request"),
        F.col("captureData.endpointOutput.data").alias("response"),
    )


@query("report_flatten", "\nUNION ALL ".join(
    f"""SELECT '{m}' AS feature, 'Fractional' AS inferred_type, count(c) AS "numerical_statistics.present",
  count(*) - count(c) AS "numerical_statistics.missing", {rnd('avg(c)', '"numerical_statistics.mean"')},
  {rnd('min(c)', '"numerical_statistics.low"')}, {rnd('max(c)', '"numerical_statistics.high"')} FROM (SELECT {e} AS c FROM lineitem)"""
    for m, e in zip(MEASURES, ("l_quantity", "l_extendedprice", "l_discount * 100", "l_tax * 100"))))
def report_flatten(spark, sf_dir):
    statistics = baseline_statistics(adapters.inputs(spark, sf_dir).telemetry, MEASURES)
    return capture.flatten_report(statistics_report(statistics), "body", "features", PROFILE_SCHEMA)


@query("stage_outputs", compose("""SELECT 'telemetry' AS stage, count(*) AS rows FROM tele_flat
UNION ALL SELECT 'errors', count(*) FROM err_flat UNION ALL SELECT 'maint', count(*) FROM maint_flat
UNION ALL SELECT 'failures', count(*) FROM failures UNION ALL SELECT 'machines', count(*) FROM machines
UNION ALL SELECT 'preprocessed', count(*) FROM labeled_flat""", "tele_flat", "err_flat", "maint_flat", "labeled_flat"))
def stage_outputs(spark, sf_dir):
    """The six stage tables, each written once; the last is joined from the written ones."""
    data, spec, out = adapters.inputs(spark, sf_dir), adapters.spec(), new_path(spark, "stages")
    order = machine_order(data.telemetry, data.maint)
    paths = files.write_stages({
        "telemetry": plans.telemetry_features(data.telemetry, spec, order),
        "errors": plans.error_features(data.errors, data.telemetry, spec, order),
        "maint": plans.maintenance_features(data.maint, data.telemetry, spec, order),
        "failures": plans.failure_features(data.failures),
        "machines": data.machines,
    }, out)
    stages = {name: spark.read.parquet(path) for name, path in paths.items()}
    final = plans.label_construct(stages["telemetry"], stages["errors"], stages["maint"], stages["machines"], stages["failures"], spec)
    paths |= files.write_stages({"preprocessed": final}, out)
    return row_counts({name: spark.read.parquet(path) for name, path in paths.items()}).withColumnRenamed("table", "stage")


def _history(spark, sf_dir):
    """Machine attributes appended at two times; later, half of the machines are a year older."""
    path = new_path(spark, "machine-features")
    machines = adapters.inputs(spark, sf_dir).machines
    definitions = feature_table.feature_definitions(machines)
    feature_table.append_offline(machines, path, FEATURE_TIMES[0], definitions)
    older = machines.withColumn("age", F.col("age") + F.col("machineID") % 2)
    feature_table.append_offline(older, path, FEATURE_TIMES[1], definitions)
    return feature_table.read_offline(spark, path)


_HISTORY = f"""history AS (
  SELECT machineID, model, age, epoch_us(TIMESTAMP '{FEATURE_TIMES[0]}') / 1e6 AS event_time,
    DATE '{FEATURE_TIMES[0][:10]}' AS event_date FROM machines
  UNION ALL SELECT machineID, model, age + machineID % 2, epoch_us(TIMESTAMP '{FEATURE_TIMES[1]}') / 1e6,
    DATE '{FEATURE_TIMES[1][:10]}' FROM machines)"""


def _with_history(body: str) -> str:
    return compose(f", {_HISTORY} {body}", "machines")


_DEFINITIONS = {"datetime": "String", "machineID": "Integral", **dict.fromkeys(COMPONENTS, "Fractional")}


@query("fs_definitions", compose("\nUNION ALL ".join(
    f"SELECT '{n}' AS name, '{kind}' AS type, count({n}) AS non_null FROM maint_flat" for n, kind in _DEFINITIONS.items()), "maint_flat"))
def fs_definitions(spark, sf_dir):
    """Names and types of the written maintenance features, with the number of values of each."""
    data, path = adapters.inputs(spark, sf_dir), new_path(spark, "maint-features")
    plans.maintenance_features(data.maint, data.telemetry, adapters.spec()).write.parquet(path)
    return feature_table.definition_rows(spark.read.parquet(path))


@query("fs_offline_append", _with_history(
    f"SELECT event_date, count(*) AS records, {rnd('min(event_time)', 'event_time')} FROM history GROUP BY event_date"))
def fs_offline_append(spark, sf_dir):
    return _history(spark, sf_dir).groupBy("event_date").agg(F.count("*").alias("records"), F.min("event_time").alias("event_time"))


@query("fs_online_latest", _with_history(f"""SELECT machineID, model, age, {rnd('event_time')}, event_date FROM
(SELECT *, row_number() OVER (PARTITION BY machineID ORDER BY event_time DESC) AS n FROM history) WHERE n = 1"""))
def fs_online_latest(spark, sf_dir):
    return feature_table.latest_records(_history(spark, sf_dir), "machineID", "event_time")


@query("fs_online_latest_events", """SELECT user_id, ts, event_id, event_type, value FROM
(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def fs_online_latest_events(spark, sf_dir):
    events = adapters.read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return feature_table.latest_records(events, "user_id", "ts", "event_id")


@query("fs_distinct", _with_history("SELECT DISTINCT machineID, model, age FROM history"))
def fs_distinct(spark, sf_dir):
    return feature_table.distinct_features(_history(spark, sf_dir), "machineID", "model", "age")


@query("fs_sql", _with_history("SELECT model, count(DISTINCT machineID) AS machines, max(age) AS oldest FROM history GROUP BY model"))
def fs_sql(spark, sf_dir):
    """The history queried as text."""
    history = _history(spark, sf_dir)
    return spark.sql(
        "SELECT model, count(DISTINCT machineID) AS machines, max(age) AS oldest FROM {history} GROUP BY model",
        history=history,
    )


_SPINE = "spine AS (SELECT event_id, user_id % (SELECT count(*) FROM supplier) + 1 AS machineID, ts FROM events WHERE event_type <> 'signup')"


def _spine(spark, sf_dir):
    """Events as rows that ask for a machine's features at their time."""
    machines = adapters.read_table(spark, sf_dir, "supplier").count()
    events = adapters.read_table(spark, sf_dir, "events").filter("event_type <> 'signup'")
    return events.select("event_id", (F.col("user_id") % machines + 1).alias("machineID"), "ts")


@query("fs_as_of", _with_history(f""", {_SPINE} SELECT s.event_id, s.machineID, s.ts, h.model, h.age, {rnd('h.event_time', 'event_time')}
FROM spine s ASOF LEFT JOIN history h ON s.machineID = h.machineID AND epoch_us(s.ts) / 1e6 >= h.event_time"""))
def fs_as_of(spark, sf_dir):
    """Machine attributes as they were known at each event; nothing before the first append."""
    history = _history(spark, sf_dir).drop("event_date")
    return feature_table.features_as_of(_spine(spark, sf_dir), history, "machineID", "ts")


@query("asof_maintenance", compose("""SELECT t.machineID, t.datetime, t.volt, r.comp, r.replaced FROM telemetry t
ASOF LEFT JOIN (SELECT machineID, datetime AS replaced, max(comp) AS comp FROM maint GROUP BY machineID, datetime) r
ON t.machineID = r.machineID AND t.datetime >= r.replaced""", "telemetry", "maint"))
def asof_maintenance(spark, sf_dir):
    """Each reading with the machine's last replacement; of several at one time the last component."""
    data = adapters.inputs(spark, sf_dir)
    maint = data.maint.withColumnRenamed("datetime", "replaced")
    return asof_join(data.telemetry.select("machineID", "datetime", "volt"), maint, ["machineID"], "datetime", "replaced", ["comp"])


@query("fs_log_appends", f"""SELECT user_id, event_id, event_type, {rnd('value')}, CASE WHEN event_id % 3 > 0 THEN event_id % 7 END AS grade,
CASE WHEN event_id % 3 = 2 THEN 'late' END AS note, 'day' || CAST(event_id % 3 AS VARCHAR) AS batch FROM events""")
def fs_log_appends(spark, sf_dir):
    """Events appended as three batches, the second with one more column, the third with another and a wider one, and two of them twice."""
    path = new_path(spark, "log")
    events = adapters.read_table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    grade, parts = F.col("event_id") % 7, [events.filter(F.col("event_id") % 3 == i) for i in range(3)]
    batches = [parts[0], parts[1].withColumn("grade", grade.cast("int")), parts[2].withColumn("grade", grade).withColumn("note", F.lit("late"))]
    for i in (0, 0, 1, 2, 1):
        feature_log.append_batch(batches[i], path, f"day{i}", FEATURE_TIMES[0])
    return feature_log.read_history(spark, path).drop("event_time", "event_date")


@query("fs_latest_view", """SELECT user_id, ts, event_id, event_type, value FROM
(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def fs_latest_view(spark, sf_dir):
    """The latest event per user from three batches merged one after the other, the newest first."""
    path = new_path(spark, "latest")
    events = adapters.read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    for i in (2, 0, 1):
        feature_log.update_latest(events.filter(F.col("event_id") % 3 == i), path, "user_id", "ts", "event_id", buckets=16)
    return feature_log.read_latest(spark, path)
