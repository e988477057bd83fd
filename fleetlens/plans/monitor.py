"""Feature profiles, constraints drawn from them, and checks of new data against a baseline.

A profile has one row per feature: counts, moments, range and a histogram of fixed width. The
histogram edges come from the baseline, so two profiles can be compared bucket by bucket. Features that
are no numbers (text, dates, booleans) have their commonest values instead, from a summary of bounded
size, and a number of distinct values; two of them are compared by the shares of their values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.plans.feature_table import feature_type

BUCKETS = 10
BUCKET_COLUMNS = tuple(f"bucket{i}" for i in range(BUCKETS))
MISSING = "feature of the baseline is missing"
#: Commonest values listed for a feature of text, and values its summary holds. Counts are exact up to so many
#: different values; beyond, they are too large by a few ten-thousandths of all values at most.
CATEGORIES = 100
TRACKED = 10_000
CATEGORY_COLUMNS = ("distinct", "categories")
Bounds = Mapping[str, tuple[float, float]]


def text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those columns that are profiled by their values, not as numbers."""
    return [c for c in columns if feature_type(df.schema[c].dataType) == "String"]


def value_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value of each feature that is a number: one row read by the driver."""
    texts = text_columns(df, columns)
    columns = [c for c in columns if c not in texts]
    if not columns:
        return {}
    row = df.agg(*[f(c).cast("double").alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("low", F.min), ("high", F.max))]).first()
    return {c: (row[f"low_{i}"], row[f"high_{i}"]) for i, c in enumerate(columns) if row[f"low_{i}"] is not None}


def _lookup(values: Mapping[str, float | str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("feature")]


def _bucket(bounds: Bounds) -> Column:
    if not bounds:
        return F.lit(None).cast("long")
    low = _lookup({c: b[0] for c, b in bounds.items()})
    high = _lookup({c: b[1] for c, b in bounds.items()})
    place = F.floor(F.try_divide((F.col("value") - low) * BUCKETS, high - low))
    return F.when(F.col("value").isNotNull(), F.least(F.lit(BUCKETS - 1), F.greatest(F.lit(0), F.coalesce(place, F.lit(0)))))


def long_features(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per record and feature. The rows are aggregated before they are shuffled.

    With a feature of text, the values of such features stand in a further column ``text``.
    """
    texts = text_columns(df, columns)
    if not texts:
        doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
        return doubles.unpivot(list(keep), list(columns), "feature", "value")
    none = F.lit(None)
    cells = [F.struct(
        F.lit(c).alias("feature"), (none if c in texts else F.col(c)).cast("double").alias("value"),
        (F.col(c) if c in texts else none).cast("string").alias("text")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


def profile(long: DataFrame, bounds: Bounds, by: Sequence[Column | str] = ()) -> DataFrame:
    """Statistics and histogram per feature, and per value of ``by`` if given."""
    placed = long.withColumn("_bucket", _bucket(bounds))
    found, categories = F.col("value").isNotNull(), []
    if "text" in long.columns:
        found |= F.col("text").isNotNull()
        some = F.count("text") > 0
        categories = [
            F.when(some, F.hll_sketch_estimate(F.hll_sketch_agg("text"))).alias("distinct"),
            F.when(some, F.expr(f"approx_top_k(text, {CATEGORIES}, {TRACKED}) FILTER (WHERE text IS NOT NULL)")).alias("categories"),
        ]
    return placed.groupBy(*by, "feature").agg(
        F.count_if(found).alias("present"),
        F.count_if(~found).alias("missing"),
        F.avg("value").alias("mean"),
        F.sum("value").alias("total"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        *[F.count_if(F.col("_bucket") == i).alias(name) for i, name in enumerate(BUCKET_COLUMNS)],
        *categories,
    )


def inferred_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    return {c: feature_type(df.schema[c].dataType) for c in columns}


def baseline_statistics(df: DataFrame, columns: Sequence[str], bounds: Bounds | None = None) -> DataFrame:
    """One row per feature, from one pass; of text too if ``columns`` has any, then with ``distinct`` and ``categories``."""
    bounds = value_bounds(df, columns) if bounds is None else bounds
    stats = profile(long_features(df, columns), bounds)
    return stats.select("feature", _lookup(inferred_types(df, columns)).alias("inferred_type"), *stats.columns[1:])


def baseline_constraints(statistics: DataFrame) -> DataFrame:
    """Suggested constraints: type, share of present values, whether all values are >= 0, and the domain.

    ``domain`` is there for statistics with categories: the values of a feature of text that has less
    than ``CATEGORIES`` of them, in order; else null.
    """
    domain = [_domain().alias("domain")] if "categories" in statistics.columns else []
    return statistics.select(
        "feature", "inferred_type",
        F.try_divide(F.col("present"), F.col("present") + F.col("missing")).alias("completeness"),
        F.coalesce(F.col("low") >= 0, F.lit(False)).alias("non_negative"), *domain,
    )


def _domain(prefix: str = "") -> Column:
    """All values of a feature of text, if its categories are complete."""
    categories = F.col(f"{prefix}categories")
    counted = F.aggregate(categories, F.lit(0).cast("long"), lambda n, c: n + c["count"])
    whole = (F.size(categories) < CATEGORIES) & (counted == F.col(f"{prefix}present"))
    return F.when(whole, F.array_sort(F.transform(categories, lambda c: c["item"])))


def _category_shares(prefix: str) -> Column:
    return F.map_from_entries(F.transform(f"{prefix}categories", lambda c: F.struct(c["item"], c["count"] / F.col(f"{prefix}present"))))


def category_distance(left: str = "", right: str = "base_") -> Column:
    """Largest difference between the shares of a value."""
    a, b = _category_shares(left), _category_shares(right)
    share = lambda m, k: F.coalesce(F.try_element_at(m, k), F.lit(0.0))
    return F.array_max(F.transform(F.array_union(F.map_keys(a), F.map_keys(b)), lambda k: F.abs(share(a, k) - share(b, k))))


def outside_share(left: str = "", right: str = "base_") -> Column:
    """Share of listed values that the baseline's complete domain lacks."""
    domain = _domain(right)
    strange = F.filter(f"{left}categories", lambda c: ~F.array_contains(domain, c["item"]))
    return F.aggregate(strange, F.lit(0).cast("long"), lambda n, c: n + c["count"]) / F.col(f"{left}present")


def _share(prefix: str, upto: int) -> Column:
    counted = sum((F.col(f"{prefix}{name}") for name in BUCKET_COLUMNS[: upto + 1]), F.lit(0))
    return F.try_divide(counted, F.col(f"{prefix}present"))


def histogram_distance(left: str = "", right: str = "base_") -> Column:
    """Largest difference between two cumulative histograms."""
    return F.greatest(*[F.abs(_share(left, i) - _share(right, i)) for i in range(BUCKETS)])


def with_baseline(batch: DataFrame, baseline: DataFrame, how: str = "left") -> DataFrame:
    """Put the baseline of each feature beside a profile; the baseline has one row per column."""
    renamed = baseline.select("feature", *[F.col(c).alias(f"base_{c}") for c in baseline.columns if c != "feature"])
    return batch.join(F.broadcast(renamed) if how == "left" else renamed, "feature", how)


def violations(batch: DataFrame, baseline: DataFrame, drift_limit: float = 0.1, by: Sequence[str] = ()) -> DataFrame:
    """Rows (feature, check, observed, allowed, description) for every check that fails.

    Checks: feature unknown to the baseline, feature of the baseline missing (with ``by``, see
    ``hourly_violations``), changed type, lower completeness, negative values where the baseline has
    none, a histogram distance above ``drift_limit``, and for features of text a difference of shares
    above it, or values outside the baseline's domain if that is small.
    """
    completeness = F.try_divide(F.col("present"), F.col("present") + F.col("missing"))
    base_completeness = F.try_divide(F.col("base_present"), F.col("base_present") + F.col("base_missing"))

    def check(failed: Column, name: str, observed: Column, allowed: Column, text: str) -> Column:
        return F.when(failed, F.struct(
            F.lit(name).alias("check"), observed.cast("double").alias("observed"),
            allowed.cast("double").alias("allowed"), F.lit(text).alias("description"),
        ))

    known = F.col("base_present").isNotNull()
    numbers = F.col("low").isNotNull() & F.col("base_low").isNotNull()
    checks = [
        check(F.col("present").isNull(), "missing_column_check", F.lit(None), F.lit(None), MISSING),
        check(~known, "extra_column_check", F.col("present"), F.lit(0), "feature is not in the baseline"),
        check(completeness < base_completeness, "completeness_check", completeness, base_completeness,
              "share of present values is below the baseline"),
        check((F.col("low") < 0) & (F.col("base_low") >= 0), "non_negative_check", F.col("low"), F.lit(0),
              "negative values where the baseline has none"),
        check(numbers & (histogram_distance() > drift_limit), "baseline_drift_check", histogram_distance(), F.lit(drift_limit),
              "distance to the baseline distribution is above the limit"),
    ]
    if "categories" in batch.columns and "categories" in baseline.columns:
        checks += [
            check(category_distance() > drift_limit, "baseline_drift_check", category_distance(), F.lit(drift_limit),
                  "distance to the baseline distribution is above the limit"),
            check(outside_share() > 0, "categorical_values_check", outside_share(), F.lit(0), "values outside those of the baseline"),
        ]
    if "inferred_type" in batch.columns and "inferred_type" in baseline.columns:
        checks.append(check(
            F.col("inferred_type") != F.col("base_inferred_type"), "data_type_check", F.lit(None), F.lit(None),
            "type differs from the baseline"))
    rows = with_baseline(batch, baseline, "left" if by else "full_outer").select(*by, "feature", F.explode(F.array_compact(F.array(*checks))).alias("_v"))
    return rows.select(*by, "feature", "_v.*")


def drift_violations(
    baseline_df: DataFrame, batch_df: DataFrame, columns: Sequence[str], drift_limit: float = 0.1
) -> DataFrame:
    """Failed checks of a batch against a baseline, for the features that are in either."""
    present = [[c for c in columns if c in df.columns] for df in (baseline_df, batch_df)]
    bounds = value_bounds(baseline_df, present[0])
    base = baseline_statistics(baseline_df, present[0], bounds)
    batch = baseline_statistics(batch_df, present[1], bounds)
    return violations(batch, base, drift_limit)


def hourly_profile(df: DataFrame, columns: Sequence[str], bounds: Bounds, ts: str = "ts") -> DataFrame:
    """Profile per hour and feature; also works on a stream with a watermark on ``ts``."""
    stats = profile(long_features(df, columns, keep=[ts]), bounds, by=[F.window(ts, "1 hour").alias("_hour")])
    return stats.select(F.col("_hour.start").alias("hour"), *stats.columns[1:])


def hourly_drift(df: DataFrame, baseline: DataFrame, columns: Sequence[str], bounds: Bounds, ts: str = "ts") -> DataFrame:
    """Distance of each hour and feature to the baseline."""
    hours = with_baseline(hourly_profile(df, columns, bounds, ts), baseline)
    return hours.select("hour", "feature", "present", histogram_distance().alias("distance"))


def hourly_violations(
    hours: DataFrame, baseline: DataFrame, absent: Sequence[str] = (), drift_limit: float = 0.1
) -> DataFrame:
    """Failed checks of each hour; every hour also reports the features that are ``absent`` from the input.

    A feature without a value in an hour fails the completeness check; it has no distance to the baseline.
    """
    found = violations(hours, baseline, drift_limit, by=["hour"])
    if not absent:
        return found
    missing = hours.select("hour").distinct().select(
        "hour", F.explode(F.array(*[F.lit(c) for c in absent])).alias("feature"),
        F.lit("missing_column_check").alias("check"), F.lit(None).cast("double").alias("observed"),
        F.lit(None).cast("double").alias("allowed"), F.lit(MISSING).alias("description"))
    return found.unionByName(missing)


PROFILE_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()), T.StructField("inferred_type", T.StringType()),
    T.StructField("numerical_statistics", T.StructType([
        T.StructField("present", T.LongType()), T.StructField("missing", T.LongType()),
        T.StructField("mean", T.DoubleType()), T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()),
    ])),
])


def statistics_report(statistics: DataFrame) -> DataFrame:
    """The statistics as one JSON report with a ``features`` array, one element per column."""
    numbers = F.struct("present", "missing", "mean", "low", "high").alias("numerical_statistics")
    element = F.struct("feature", "inferred_type", numbers)
    return statistics.agg(F.to_json(F.struct(F.sort_array(F.collect_list(element)).alias("features"))).alias("body"))
