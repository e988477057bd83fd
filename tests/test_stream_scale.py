"""Streams: input written by many tasks a batch at a time, and machines that share a state."""

from pyspark.sql import functions as F

from fleetlens.catalog.registry import settled
from fleetlens.catalog.streams import incoming
from fleetlens.config import FeatureSpec
from fleetlens.schemas import TELEMETRY
from fleetlens.streaming import state


def test_every_task_writes_its_part_of_a_batch(spark, tmp_path):
    rows = spark.range(0, 1000, numPartitions=5).withColumn("b", F.when(F.col("id") < 150, 0).otherwise(F.col("id") % 2 + 1))
    path, stream = incoming(rows, F.col("b"), "spread", 3)
    assert len(spark.read.parquet(path).inputFiles()) == 15
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).foreachBatch(
        lambda batch, i: batch.write.parquet(str(tmp_path / f"out/batch={i}"))).start()
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).groupBy("batch").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.count("*").alias("n"))
    assert {(r.batch, r.low, r.high, r.n) for r in found.collect()} == {(0, 0, 0, 150), (1, 1, 1, 425), (2, 2, 2, 425)}


def test_machines_of_one_state_keep_to_themselves(spark, tmp_path):
    spec = FeatureSpec(mode="keyed", window_rows=3, bin_seconds=10800)
    start, ids = 1_420_070_400, spark.range(0, 40 * 12, numPartitions=2)
    machine, hour = F.col("id") % 12, F.floor(F.col("id") / 12)
    rows = ids.select(
        F.timestamp_seconds(F.lit(start) + hour * 3600).alias("datetime"),
        F.when(machine != 11, machine * (1 << 55)).alias("machineID"),  # large ids, and one that is missing
        *[(F.xxhash64("id", F.lit(m)) % 100).cast("double").alias(m) for m in TELEMETRY.names[2:]])
    path = str(tmp_path / "in")
    rows.filter(~((machine == 3) & (hour == 17))).write.parquet(path)
    late = rows.limit(1).select("*").withColumn("datetime", F.lit(None).cast("timestamp"))
    late.write.mode("append").parquet(path)
    ahead = rows.limit(1).withColumn("datetime", F.timestamp_seconds(F.lit(start + 10**8)))
    ahead.write.mode("append").parquet(path)
    found = []
    for shards in (1, 64):
        out = str(tmp_path / f"out{shards}")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
        found_rows = state.trailing_features(stream, spec, "60 hours", shards)
        state.started(found_rows, out, str(tmp_path / f"c{shards}"), {"availableNow": True}).awaitTermination()
        found.append(sorted(str(r) for r in settled(state.read_features(spark, out), 6).collect()))
        assert state.read_late_readings(spark, out).filter("datetime IS NULL").count() == 1
    assert found[0] == found[1] and len(found[0]) == 12 * (13 - 2) and sum("machineID=None" in r for r in found[0]) == 11
