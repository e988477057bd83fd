"""The five input tables, mapped from the TPC-H-like test tables.

``lineitem`` has four measures per supplier and date. Dates are coarsened to slots of ten days,
the mapped "hour", and binned by thirty days, so a bin has three slots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.config import FeatureSpec
from fleetlens.session import use_utc

SLOT_SECONDS = 10 * 86400
BIN_SECONDS = 30 * 86400
START_AFTER = "1995-01-01 00:00:00"
FOLDS = (
    ("1999-06-01 00:00:00", "1999-07-01 00:00:00"),
    ("2000-01-01 00:00:00", "2000-02-01 00:00:00"),
    ("2000-06-01 00:00:00", "2000-07-01 00:00:00"),
)


def spec(mode: str = "flat", **changes) -> FeatureSpec:
    return FeatureSpec(bin_seconds=BIN_SECONDS, start_after=START_AFTER, mode=mode, **changes)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its timestamps carry no zone and are taken as UTC."""
    use_utc(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def _slot(ts: str) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / SLOT_SECONDS) * SLOT_SECONDS)


@dataclass(frozen=True)
class Inputs:
    telemetry: DataFrame
    errors: DataFrame
    maint: DataFrame
    failures: DataFrame
    machines: DataFrame


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    lines = read_table(spark, sf_dir, "lineitem")
    machine = F.col("l_suppkey").alias("machineID")
    time = _slot("l_shipdate").alias("datetime")
    component = F.concat(F.lit("comp"), (F.col("l_partkey") % 4 + 1).cast("string"))
    telemetry = lines.select(
        time, machine,
        F.col("l_quantity").alias("volt"),
        F.col("l_extendedprice").alias("rotate"),
        (F.col("l_discount") * 100).alias("pressure"),
        (F.col("l_tax") * 100).alias("vibration"),
    )
    errors = lines.filter((F.col("l_quantity") <= 5) & (F.col("l_returnflag") == "R")).select(
        time, machine,
        F.concat(F.lit("error"), (F.col("l_partkey") % 5 + 1).cast("string")).alias("errorID"),
    )
    maint = lines.filter(F.col("l_discount") >= 0.10).select(time, machine, component.alias("comp"))
    failures = lines.filter((F.col("l_tax") >= 0.08) & (F.col("l_quantity") >= 40)).select(
        time, machine, component.alias("failure")
    )
    machines = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("machineID"),
        F.concat(F.lit("model"), (F.col("s_nationkey") % 4 + 1).cast("string")).alias("model"),
        (F.col("s_nationkey") % 21).cast("long").alias("age"),
    )
    return Inputs(telemetry, errors, maint, failures, machines)
