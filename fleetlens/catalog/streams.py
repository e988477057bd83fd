"""Streams of several batches, out of order, with stateful operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import adapters
from fleetlens.catalog.registry import query
from fleetlens.catalog.sql import SENSOR, compose, rnd, rnds
from fleetlens.plans import monitor
from fleetlens.schemas import TELEMETRY
from fleetlens.session import new_path
from fleetlens.streaming import pairs, state

BATCHES = 4


def incoming(df: DataFrame, batch: Column, name: str, batches: int = BATCHES) -> tuple[str, DataFrame]:
    """Write ``df`` as files, oldest batch first, and read it as a stream of a batch at a time.

    Every task writes its rows of a batch. A trigger takes a number of files, so batches of fewer files get empty ones.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    marked = df.withColumn("_batch", batch)
    files = marked.rdd.getNumPartitions()
    for i in range(batches):
        marked.filter(F.col("_batch") == i).drop("_batch").write.mode("append").parquet(path)
        written = len(spark.read.schema(df.schema).parquet(path).inputFiles())
        for _ in range(files * (i + 1) - written):
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
    return path, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


# a quarter of the time each; every tenth event comes one batch late, every 17th two
_QUARTER = "(epoch_us(ts) - lo) * {n} // (hi - lo + 1)".format(n=BATCHES)
_LATE_SQL = f"""WITH span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
dealt AS (SELECT ts, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, least({BATCHES - 1}, {_QUARTER}
  + CASE WHEN event_id % 10 = 0 THEN 1 WHEN event_id % 17 = 0 THEN 2 ELSE 0 END) AS batch FROM events, span),
marks AS (SELECT batch, max(max(epoch_ms(ts))) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000 AS mark
  FROM dealt GROUP BY batch),
placed AS (SELECT date_trunc('hour', ts) AS hour, value, k,
  coalesce(epoch_ms(date_trunc('hour', ts)) + 3600000 <= mark, FALSE) AS late FROM dealt JOIN marks USING (batch)),
long AS (SELECT hour, late, 'value' AS feature, value AS v FROM placed UNION ALL SELECT hour, late, 'k', k FROM placed)
SELECT hour, feature, count(v) FILTER (WHERE NOT late) AS present, count(*) FILTER (WHERE NOT late) - count(v) FILTER (WHERE NOT late) AS missing,
  {rnd('avg(v) FILTER (WHERE NOT late)', 'mean')}, {rnd('sum(v) FILTER (WHERE NOT late)', 'total')},
  {rnd('stddev_samp(v) FILTER (WHERE NOT late)', 'sd')}, {rnd('min(v) FILTER (WHERE NOT late)', 'low')},
  {rnd('max(v) FILTER (WHERE NOT late)', 'high')}, count(*) FILTER (WHERE late) AS late FROM long GROUP BY hour, feature"""


@query("stream_late_hours", _LATE_SQL)
def stream_late_hours(spark, sf_dir):
    """Events in four batches, some behind the watermark: profiles of hours from those in time, and how many came late."""
    events = adapters.read_table(spark, sf_dir, "events")
    us = F.unix_micros("ts")
    low, high = events.agg(F.min(us), F.max(us)).first()
    behind = F.when(F.col("event_id") % 10 == 0, 1).when(F.col("event_id") % 17 == 0, 2).otherwise(0)
    batch = F.least(F.lit(BATCHES - 1), F.expr(f"(unix_micros(ts) - {low}) * {BATCHES} div {high - low + 1}") + behind)
    numbered = events.select("ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k"), "event_id").withColumn("_b", batch)
    _, stream = incoming(numbered.select("ts", "value", "k", "_b"), F.col("_b"), "late-events")
    columns, out = ("value", "k"), new_path(spark, "late-hours")
    bounds = monitor.value_bounds(numbered, columns)
    state.late_stream(stream, columns, bounds, out, new_path(spark, "late-checkpoint")).awaitTermination()
    late = state.read_late(spark, out).groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("late"))
    hours = state.read_hours(spark, out).select("hour", "feature", "present", "missing", "mean", "total", "sd", "low", "high")
    names = late.select("hour", F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"), "late")
    return hours.join(names, ["hour", "feature"], "full").na.fill(0, ["present", "missing", "late"])


_PAIRS_SQL = """WITH asked AS (SELECT event_id, CASE WHEN event_type <> 'signup' THEN 'inf-' || CAST(event_id AS VARCHAR) END AS id, ts,
  CAST(value AS VARCHAR) AS request FROM events WHERE event_id % 11 <> 3),
answered AS (SELECT event_id, CASE WHEN event_type <> 'signup' THEN 'inf-' || CAST(event_id AS VARCHAR) END AS id,
  ts + INTERVAL 1 SECOND * (event_id % 90) AS ts, event_type AS response FROM events WHERE event_id % 7 <> 2),
joined AS (SELECT coalesce(a.id, b.id) AS inferenceId, request, response, b.ts - a.ts AS gap, CASE WHEN b.event_id IS NULL THEN 'request'
  WHEN a.event_id IS NULL THEN 'response' ELSE 'matched' END AS status FROM asked a FULL JOIN answered b ON a.id = b.id AND b.ts <= a.ts + INTERVAL 1 MINUTE)
SELECT inferenceId, response, CAST(epoch(gap) AS BIGINT) AS seconds, status FROM joined"""


@query("stream_pairs", _PAIRS_SQL)
def stream_pairs(spark, sf_dir):
    """Requests and responses of events, some missing, some more than a minute apart; a last row far ahead ends all waiting."""
    events = adapters.read_table(spark, sf_dir, "events")
    us = F.unix_micros("ts")
    low, high = events.agg(F.min(us), F.max(us)).first()
    name = F.when(F.col("event_type") != "signup", F.concat(F.lit("inf-"), F.col("event_id").cast("string"))).alias("inferenceId")
    batch = F.least(F.lit(BATCHES - 1), F.expr(f"(unix_micros(ts) - {low}) * {BATCHES} div {high - low + 1}"))
    later = F.col("ts") + F.expr("make_dt_interval(0, 0, 0, event_id % 90)")
    sides = {
        "requests": events.filter("event_id % 11 <> 3").select(name, "ts", F.col("value").cast("string").alias("data"), batch.alias("_b")),
        "responses": events.filter("event_id % 7 <> 2").select(name, later.alias("ts"), F.col("event_type").alias("data"), batch.alias("_b")),
    }
    streams = []
    for side, rows in sides.items():
        path, stream = incoming(rows, F.col("_b"), side)
        ahead = spark.range(1).select(
            F.lit("ahead").alias("inferenceId"), F.timestamp_micros(F.lit(high + 10 * 86_400_000_000)).alias("ts"),
            F.lit("").alias("data"), F.lit(0).cast(rows.schema["_b"].dataType).alias("_b"))
        ahead.write.mode("append").parquet(path)
        streams.append(stream.select("inferenceId", "ts", "data"))
    out = new_path(spark, "pairs")
    pairs.pair_stream(*streams, out, new_path(spark, "pairs-checkpoint"), wait="1 minute").awaitTermination()
    found = pairs.read_pairs(spark, out).withColumn("status", F.lit("matched")).unionByName(pairs.read_pairs(spark, out, matched=False))
    gap = (F.unix_micros("responseTime") - F.unix_micros("requestTime")) / 1e6
    return found.filter("inferenceId IS NULL OR inferenceId <> 'ahead'").select("inferenceId", "response", gap.cast("long").alias("seconds"), "status")


@query("stream_telemetry_features", compose(f"SELECT machineID, datetime, {rnds(SENSOR)} FROM tele_keyed", "tele_keyed"))
def stream_telemetry_features(spark, sf_dir):
    """Readings in four batches, every seventh a batch late, and a last reading far ahead that closes all bins."""
    readings = adapters.inputs(spark, sf_dir).telemetry.select(*TELEMETRY.names)
    low, high = readings.agg(F.min(F.unix_seconds("datetime")), F.max(F.unix_seconds("datetime"))).first()
    quarter = (high - low) // BATCHES + 1
    batch = F.expr(f"(unix_seconds(datetime) - {low}) div {quarter}") + F.when(F.xxhash64("datetime", "volt") % 7 == 0, 1).otherwise(0)
    path, stream = incoming(readings, F.least(batch, F.lit(BATCHES - 1)), "readings")
    ahead = spark.range(1).select(
        F.timestamp_seconds(F.lit(high + 10 * quarter)).alias("datetime"), F.lit(-1).cast("long").alias("machineID"),
        *[F.lit(0.0).alias(m) for m in TELEMETRY.names[2:]])
    ahead.write.mode("append").parquet(path)
    out = new_path(spark, "stream-features")
    state.features_stream(stream, adapters.spec("keyed"), out, new_path(spark, "features-checkpoint"), f"{quarter} seconds").awaitTermination()
    return state.read_features(spark, out)
