"""Slots, tumbling bins and the dense grid of bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import MEASURES

BLOCK_BINS = 4096  # bins generated at a time


def bin_index(ts: Column, seconds: int) -> Column:
    """Number of the bin ``[n * seconds, (n + 1) * seconds)`` since the epoch."""
    return F.floor(F.unix_seconds(ts) / seconds)


def bin_end(index: Column, seconds: int) -> Column:
    return F.timestamp_seconds((index + 1) * seconds)


def at_bin_edge(ts: Column, seconds: int) -> Column:
    return F.pmod(F.unix_micros(ts), F.lit(seconds * 1_000_000)) == 0


def first_in_time(value: str, ts: str = "datetime") -> Column:
    """Earliest non-null value; unlike ``first`` it does not depend on row order."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(ts)))


def dedupe_mean(telemetry: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """One row per machine and time; repeated readings are averaged."""
    return telemetry.groupBy("machineID", "datetime").agg(*[F.avg(m).alias(m) for m in measures])


def _tumbling(slots: DataFrame, seconds: int, aggregates: Sequence[Column]) -> DataFrame:
    bins = slots.groupBy("machineID", F.window("datetime", f"{seconds} seconds").alias("_bin"))
    return bins.agg(*aggregates).withColumn("datetime", F.col("_bin.end")).drop("_bin")


def tumbling_mean(slots: DataFrame, seconds: int, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Mean per machine and bin, labelled by the end of the bin."""
    return _tumbling(slots, seconds, [F.avg(m).alias(f"{m}mean_3h") for m in measures])


def tumbling_std(slots: DataFrame, seconds: int, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Sample standard deviation per machine and bin; null for a single reading."""
    return _tumbling(slots, seconds, [F.stddev_samp(m).alias(f"{m}sd_3h") for m in measures])


def tumbling_first(slots: DataFrame, seconds: int, measures: Sequence[str] = MEASURES) -> DataFrame:
    """First non-null reading per machine and bin in time order."""
    return _tumbling(slots, seconds, [first_in_time(m).alias(m) for m in measures])


def dense_grid(telemetry: DataFrame, seconds: int) -> DataFrame:
    """Every machine with every bin between the first and the last bin of the whole table.

    The table-wide bounds are one row, taken as scalar subqueries; the bins are generated per
    machine, in blocks, so nothing is joined and no array spans the whole time.
    """
    index = bin_index(F.col("datetime"), seconds)
    per_machine = telemetry.groupBy("machineID").agg(
        F.min(index).alias("low"), F.max(index).alias("high")
    )
    low = per_machine.agg(F.min("low")).scalar()
    high = per_machine.agg(F.max("high")).scalar()
    blocks = per_machine.select(
        "machineID", low.alias("low"), high.alias("high"),
        F.explode(F.sequence(F.floor(low / BLOCK_BINS), F.floor(high / BLOCK_BINS))).alias("block"))
    start = F.col("block") * BLOCK_BINS
    inside = F.sequence(F.greatest(F.col("low"), start), F.least(F.col("high"), start + BLOCK_BINS - 1))
    bins = blocks.select("machineID", F.explode(inside).alias("bin"))
    return bins.select("machineID", bin_end(F.col("bin"), seconds).alias("datetime"))
