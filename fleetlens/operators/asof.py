"""As-of join: to each row the last record at or before its time, without a range join.

Both sides are merged into one sequence ordered by key and time, which is dealt out by ranges, so a key of
any size spreads over as many tasks as it has rows for. Within a range a window carries the last record
forward. Only a key that runs on from one range into the next takes a record over from the ranges before;
there are at most two such places per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.session import materialize


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, tie_breaks: Sequence[str] = (),
    within: float | None = None, prefix: str = "",
) -> DataFrame:
    """Every row of ``left`` with the columns of the last record of ``right`` at or before its time.

    ``by`` names columns of both sides. Of several records of one key and time the one with the greatest
    ``tie_breaks`` counts, then the one with the greatest other columns in their order. The record's columns,
    its time among them, are named with ``prefix``; they are null where there is no record, where the last
    one is more than ``within`` (in units of a number, or seconds of a timestamp) older, and for rows whose
    key or time is null. Records with a null key or time are never found. Repeated rows of ``left`` stay.
    """
    values = [right_time, *tie_breaks, *[c for c in right.columns if c not in (*by, right_time, *tie_breaks)]]
    clash = {f"{prefix}{c}" for c in values} & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {', '.join(sorted(clash))}; give a prefix")
    complete = lambda *names: " AND ".join(f"`{c}` IS NOT NULL" for c in names)
    newest = right.filter(complete(*by, right_time)).groupBy(*by, F.col(right_time).alias("_at")).agg(
        F.max(F.struct(*values[1:])).alias("_value")) if values[1:] else right.filter(complete(*by, right_time)).select(
        *by, F.col(right_time).alias("_at"), F.struct().alias("_value")).distinct()
    records = newest.select(
        *by, "_at", F.lit(-1).cast("long").alias("_salt"),  # before all rows of its time
        F.struct(F.col("_at").alias(right_time), *[F.col("_value")[c].alias(c) for c in values[1:]]).alias("_record"))
    # the salt lets rows of one key and time go to several ranges
    rows = left.select(*by, F.col(left_time).alias("_at"), F.monotonically_increasing_id().alias("_salt"), F.struct(*left.columns).alias("_row"))
    both = rows.unionByName(records, allowMissingColumns=True)
    placed = materialize(both.repartitionByRange(*by, "_at", "_salt").withColumn("_part", F.spark_partition_id()), "merged")

    key = F.struct(*by)
    ends = placed.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    places = ends.select("_part", F.explode(F.array_distinct(F.array("low", "high"))).alias("_key")).withColumn(
        "_parts", F.count("*").over(W.partitionBy("_key"))).filter("_parts > 1").select("_part", "_key", *[F.col("_key")[c].alias(c) for c in by])
    last = placed.filter("_record IS NOT NULL").join(F.broadcast(places.select("_part", *by)), ["_part", *by]).groupBy("_part", *by).agg(
        F.max_by("_record", "_at").alias("_last"))
    earlier = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = places.join(last, ["_part", *by], "left").select("_part", *by, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))

    so_far = W.partitionBy("_part", *by).orderBy("_at", "_salt").rowsBetween(W.unboundedPreceding, 0)
    filled = placed.withColumn("_found", F.last("_record", ignorenulls=True).over(so_far)).filter("_row IS NOT NULL")
    joined = filled.join(F.broadcast(carried), ["_part", *by], "left").withColumn("_found", F.coalesce("_found", "_carried"))
    if within is not None:
        age = F.col("_at").cast("double") - F.col("_found")[right_time].cast("double")
        joined = joined.withColumn("_found", F.when(age <= within, F.col("_found")))
    known = F.when(F.expr(complete(*by, "_at")), F.col("_found"))
    return joined.withColumn("_found", known).select("_row.*", *[F.col("_found")[c].alias(f"{prefix}{c}") for c in values])
