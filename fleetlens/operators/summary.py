"""Counts, summaries and reshaping."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.selection import select_numbers


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows of each named table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), list(values), "variable", "value")


def column_info(df: DataFrame) -> DataFrame:
    """Type and number of non-null values of each column, in one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "non_null")
    kind = F.create_map(*[F.lit(x) for name, t in df.dtypes for x in (name, t)])
    return long.withColumn("type", kind[F.col("column")])


def code_pivot(events: DataFrame, keys: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Counts per key with one column per declared code."""
    return events.groupBy(*keys).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Interpolated quantiles of each column: (column, probability, value). Columns without values are left out.

    Values are counted by parts of their range when this is called; none are put in order.
    """

    def ranks(total: int) -> list[int]:
        return [f(p * (total - 1)) for p in probabilities for f in (math.floor, math.ceil)]

    rows = []
    for c, (total, found) in select_numbers(df, {c: F.col(c) for c in columns}, ranks).items():
        for p, low, high in zip(probabilities, found[::2], found[1::2]):
            rank = p * (total - 1)
            rows.append((c, float(p), low if low == high else low + (high - low) * (rank - math.floor(rank))))
    return df.sparkSession.createDataFrame(rows, "column string, probability double, value double")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample sd, minimum, quartiles and maximum of each column, one row per column."""
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    wide = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]
    )
    moments = df.agg(*[
        F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
        for c in columns
    ]).unpivot([], list(columns), "column", "m")
    joined = moments.join(F.broadcast(wide), "column", "left")
    return joined.select("column", "m.count", "m.mean", "m.std", "m.min", "q25", "q50", "q75", "m.max")


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows whose prediction equals the label, with the counts behind it."""
    right = F.col(label) == F.col(prediction)
    return df.agg(
        F.count("*").alias("rows"), F.count_if(right).alias("correct"),
        F.avg(right.cast("double")).alias("accuracy"),
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows (label, prediction, rows): how often each pair occurs, nulls included."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("rows"))


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows (class, actual, predicted, correct, precision, recall, f1) for each class that occurs as label or prediction.

    A row without a label or prediction counts for the other of the two. Shares of nothing are null.
    """
    cells = confusion(df, label, prediction)
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("rows").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0).alias("correct")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("rows").alias("predicted"),
                 F.lit(0).cast("long").alias("correct"))))).filter("class IS NOT NULL")
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "correct")])
    return sums.select(
        "*", F.try_divide("correct", "predicted").alias("precision"), F.try_divide("correct", "actual").alias("recall"),
        F.try_divide(2 * F.col("correct"), F.col("actual") + F.col("predicted")).alias("f1"))
