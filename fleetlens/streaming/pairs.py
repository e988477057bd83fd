"""Requests and responses that are captured apart, put together as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.streaming.jobs import NOW, write_stream

_COLUMNS = ("inferenceId", "requestTime", "request", "responseTime", "response")


def paired(requests: DataFrame, responses: DataFrame, delay: str = "10 minutes", wait: str = "1 hour") -> DataFrame:
    """Streams (inferenceId, ts, data) of both sides as rows (inferenceId, requestTime, request, responseTime, response, status).

    A request meets a response of its id whose time is at most ``wait`` away, either way; several of one id meet each other
    all. Both sides have a watermark, ``delay`` behind their newest time, which bounds what is kept: a row waits until the
    slower side's watermark is ``wait`` past it and is then ``status`` "request" or "response" alone, else it is "matched".
    Rows without an id or a time are alone at once; they are not shuffled, however many they are. Rows behind the watermark
    when they arrive are dropped by Spark, which counts them in the progress of the query (numRowsDroppedByWatermark).
    """
    def side(df: DataFrame, time: str, data: str, key: str) -> DataFrame:
        return df.withWatermark("ts", delay).select(F.col("inferenceId").alias(key), F.col("ts").alias(time), F.col("data").alias(data))

    whole = F.col("inferenceId").isNotNull() & F.col("ts").isNotNull()
    left = side(requests.filter(whole), "requestTime", "request", "_left")
    right = side(responses.filter(whole), "responseTime", "response", "_right")
    near = F.expr(f"_left = _right AND responseTime >= requestTime - INTERVAL {wait} AND responseTime <= requestTime + INTERVAL {wait}")
    both = left.join(right, near, "full_outer").select(
        F.coalesce("_left", "_right").alias("inferenceId"), "requestTime", "request", "responseTime", "response",
        F.when(F.col("_right").isNull(), F.lit("request")).when(F.col("_left").isNull(), F.lit("response")).otherwise(F.lit("matched")).alias("status"))

    def alone(df: DataFrame, status: str) -> DataFrame:
        kinds = {"Time": ("ts", "timestamp"), "": ("data", "string")}
        cells = [(F.col(column) if name == status else F.lit(None)).cast(kind).alias(name + suffix)
                 for name in ("request", "response") for suffix, (column, kind) in kinds.items()]
        return df.filter(~whole).select("inferenceId", *cells, F.lit(status).alias("status"))

    return both.unionByName(alone(requests, "request")).unionByName(alone(responses, "response"))


def pair_stream(requests: DataFrame, responses: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes", wait: str = "1 hour", trigger=NOW) -> StreamingQuery:
    """Append pairs and rows that stayed alone to folders by status; a restart goes on without repeating any."""
    return write_stream(paired(requests, responses, delay, wait), path, checkpoint, partition_by=["status"], trigger=trigger)


def read_pairs(spark: SparkSession, path: str, matched: bool = True) -> DataFrame:
    """Matched pairs, or the rest: what stayed alone on either side."""
    rows = spark.read.parquet(path).select(*_COLUMNS, "status")
    return rows.filter(F.col("status") == "matched").drop("status") if matched else rows.filter(F.col("status") != "matched")
