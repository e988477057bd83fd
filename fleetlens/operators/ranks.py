"""Ranks over a whole table without ordering it in one task.

Equal values are one row with its counts before anything is ordered. These rows are dealt out by ranges of
the value; a range is ordered in a task of its own, and the sums of the ranges before it are added. Only
one row per range meets the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.session import materialize


def running_totals(groups: DataFrame, by: Sequence[str], value: str, counts: Sequence[str]) -> DataFrame:
    """``groups`` with ``before_<count>``: the sum of each count over rows of the same ``by`` and a smaller value.

    (by, value) is unique in ``groups`` and not null.
    """
    parts = materialize(groups.repartitionByRange(*by, value).withColumn("_part", F.spark_partition_id()), "ranges")
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = W.partitionBy(*by, "_part").orderBy(value)
    local = parts.select("*", *[before(c, inside).alias(f"_in_{c}") for c in counts])
    whole = parts.groupBy(*by, "_part").agg(*[F.sum(c).alias(c) for c in counts])
    ranges = W.partitionBy(*by).orderBy("_part")
    offsets = whole.select(*by, "_part", *[before(c, ranges).alias(f"_to_{c}") for c in counts])
    joined = local.join(offsets, [*by, "_part"])
    return joined.select(*groups.columns, *[(F.col(f"_in_{c}") + F.col(f"_to_{c}")).alias(f"before_{c}") for c in counts])


def class_counts(df: DataFrame, by: Sequence[str], score: str, positive: Column) -> DataFrame:
    """Rows (by, score, positives, negatives): the tie groups of a score."""
    return df.filter(F.col(score).isNotNull() & positive.isNotNull()).groupBy(*by, score).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives"))


def area_under_curve(df: DataFrame, score: str, positive: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, positives, negatives, auc): the chance that a positive row scores above a negative one, ties counted half.

    Rows without a score or a class are left out. ``auc`` is null where one of the classes is empty.
    """
    ranked = running_totals(class_counts(df, by, score, positive), by, score, ["negatives"])
    above = F.col("positives") * (F.col("before_negatives") + F.col("negatives") / 2)
    sums = ranked.groupBy(*by).agg(
        F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"), F.sum(above).alias("_above"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(*by, "positives", "negatives", F.try_divide("_above", pairs).alias("auc"))


def label_areas(df: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """Rows (label, positives, negatives, auc): each label against all others, by the column of its score. Null labels are left out."""
    cells = [F.struct(F.lit(name).alias("label"), F.col(score).cast("double").alias("score"), (F.col(label) == name).alias("mine"))
             for name, score in scores.items()]
    return area_under_curve(df.select(F.inline(F.array(*cells))), "score", F.col("mine"), ["label"])


def kolmogorov_smirnov(left: DataFrame, right: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, distance): the exact largest difference of the two distributions of ``value``.

    Nulls are left out; null where a side has no value.
    """
    sides = left.select(*by, value, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        right.select(*by, value, F.lit(0).alias("a"), F.lit(1).alias("b"))).filter(F.col(value).isNotNull())
    groups = sides.groupBy(*by, value).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    ranked = running_totals(groups, by, value, ["a", "b"])
    sizes = groups.groupBy(*by).agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))
    upto = lambda c: F.try_divide(F.col(f"before_{c}") + F.col(c), F.col(f"n_{c}"))
    joined = ranked.withColumn("_one", F.lit(1)).join(sizes.withColumn("_one", F.lit(1)), [*by, "_one"])
    return joined.groupBy(*by).agg(F.max(F.abs(upto("a") - upto("b"))).alias("distance"))
