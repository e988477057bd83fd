"""Profiles that can be merged: quantiles, distinct values and commonest values as sketches of bounded size.

A sketch profile has one row per feature, and per value of ``by``, of some ten kilobytes however many
records it covers. Profiles of hours, days or sites merge into one of them all without reading a record
again, so a baseline can be kept up to date, and any two of them compare by the Kolmogorov-Smirnov distance
of their quantile sketches. Unlike a histogram between the smallest and the largest value, a quantile
sketch is not spoiled by a few values far out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.plans.monitor import CATEGORIES, TRACKED, inferred_types

#: Accuracy of quantile sketches, and how many quantiles are compared.
QUANTILE_K = 2000
POINTS = 500


def rank_error(k: int = QUANTILE_K) -> float:
    """Largest error of a quantile sketch's ranks, as a share of all values, with 99 % confidence."""
    return 2.296 / k**0.9021


def distance_error(k: int = QUANTILE_K, points: int = POINTS) -> float:
    """Largest error of ``ks_distances``: both sketches' rank errors and the steps between the compared quantiles."""
    return 2 * (rank_error(k) + 1 / points)


def sketch_profile(df: DataFrame, columns: Sequence[str], by: Sequence[Column | str] = (), k: int = QUANTILE_K, tracked: int = TRACKED) -> DataFrame:
    """Rows (by, feature, inferred_type, present, missing, low, high, quantiles, distinct, categories), from one pass.

    Numbers have ``quantiles``; text, dates and booleans have ``distinct`` and ``categories``. NaN is no number.
    """
    types, none = inferred_types(df, columns), F.lit(None)
    cells = [F.struct(
        F.lit(c).alias("feature"), F.lit(types[c]).alias("inferred_type"),
        (none if types[c] == "String" else F.nanvl(F.col(c).cast("double"), none)).cast("double").alias("value"),
        (F.col(c) if types[c] == "String" else none).cast("string").alias("text")) for c in columns]
    long = df.select(*by, F.inline(F.array(*cells)))
    keys = [c for c in long.columns if c not in ("feature", "inferred_type", "value", "text")]
    found = F.col("value").isNotNull() | F.col("text").isNotNull()
    return long.groupBy(*keys, "feature", "inferred_type").agg(
        F.count_if(found).alias("present"), F.count_if(~found).alias("missing"),
        F.min("value").alias("low"), F.max("value").alias("high"),
        F.kll_sketch_agg_double("value", k).alias("quantiles"),
        F.hll_sketch_agg("text").alias("distinct"),
        F.expr(f"approx_top_k_accumulate(text, {tracked}) FILTER (WHERE text IS NOT NULL)").alias("categories"))


def merge_profiles(profiles: DataFrame, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """One profile of all that ``profiles`` cover, per value of ``by``."""
    return profiles.groupBy(*by, "feature", "inferred_type").agg(
        F.sum("present").alias("present"), F.sum("missing").alias("missing"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
        F.expr(f"approx_top_k_combine(categories, {tracked})").alias("categories"))


def _if_numbers(found: Column) -> Column:
    return F.when((F.col("inferred_type") != "String") & (F.col("present") > 0), found)


def sketch_statistics(profiles: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What the sketches say: ``quantiles`` as an array of numbers, ``distinct`` as a number, ``categories`` as (item, count)."""
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    text = F.col("inferred_type") == "String"
    return profiles.withColumns({
        "quantiles": _if_numbers(F.kll_sketch_get_quantile_double("quantiles", ranks)),
        "distinct": F.when(text, F.hll_sketch_estimate("distinct")),
        "categories": F.when(text, F.expr(f"approx_top_k_estimate(categories, {CATEGORIES})"))})


def ks_distances(batch: DataFrame, baseline: DataFrame, by: Sequence[str] = (), points: int = POINTS) -> DataFrame:
    """Rows (by, feature, distance): two-sample Kolmogorov-Smirnov distance of each profile to the baseline's feature.

    Right within ``distance_error``. ``baseline`` has one row per feature. Features of text, without values
    or without a counterpart are left out.
    """
    ranks = F.array(*[F.lit((i + 1) / points) for i in range(points)])
    quantiles = _if_numbers(F.kll_sketch_get_quantile_double("quantiles", ranks))
    mine = batch.select(*by, "feature", quantiles.alias("_mine")).filter("_mine IS NOT NULL")
    base = baseline.select("feature", quantiles.alias("_base")).filter("_base IS NOT NULL")
    sides = mine.join(base, "feature").select(*by, "feature", F.explode(F.concat(
        F.transform("_mine", lambda x: F.struct(x.alias("value"), F.lit(1).alias("step"))),
        F.transform("_base", lambda x: F.struct(x.alias("value"), F.lit(-1).alias("step"))))).alias("_at"))
    steps = sides.groupBy(*by, "feature", F.col("_at.value").alias("value")).agg(F.sum("_at.step").alias("step"))
    upto = W.partitionBy(*by, "feature").orderBy("value").rowsBetween(W.unboundedPreceding, 0)  # twice ``points`` rows at most
    return steps.select(*by, "feature", F.abs(F.sum("step").over(upto)).alias("gap")).groupBy(*by, "feature").agg(
        (F.max("gap") / points).alias("distance"))


def ks_violations(batch: DataFrame, baseline: DataFrame, drift_limit: float = 0.1, by: Sequence[str] = (), points: int = POINTS) -> DataFrame:
    """Rows (by, feature, check, observed, allowed, description) where the distance is above the limit."""
    return ks_distances(batch, baseline, by, points).filter(F.col("distance") > drift_limit).select(
        *by, "feature", F.lit("baseline_drift_check").alias("check"), F.col("distance").alias("observed"),
        F.lit(drift_limit).alias("allowed"), F.lit("distance to the baseline distribution is above the limit").alias("description"))
