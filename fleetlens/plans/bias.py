"""Pre-training bias between two groups of rows.

Group d holds the listed facet values (or those above a threshold), group a the rest. All metrics
come from one count per label, group and side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_group_d(facet: str, values: Sequence | None = None, threshold: float | None = None) -> Column:
    if (values is None) == (threshold is None):
        raise ValueError("give either facet values or a threshold")
    test = F.col(facet).isin(list(values)) if values is not None else F.col(facet) > threshold
    return F.coalesce(test, F.lit(False))


def pretraining_bias(
    df: DataFrame,
    label: str,
    positive: Sequence,
    facet: str,
    facet_values: Sequence | None = None,
    facet_threshold: float | None = None,
    group: str | None = None,
) -> DataFrame:
    """Rows (metric, value) for CI, DPL, KL, JS, LP, TVD, KS and, with ``group``, CDDL."""
    in_d = in_group_d(facet, facet_values, facet_threshold)
    by = ["label"] if group is None else ["label", "grp"]
    rows = df.select(
        F.col(label).alias("label"), in_d.alias("in_d"), *([F.col(group).alias("grp")] if group else [])
    )
    counts = rows.groupBy(*by).agg(F.count_if(~F.col("in_d")).alias("a"), F.count_if("in_d").alias("d"))

    labels = counts.groupBy("label").agg(F.sum("a").alias("a"), F.sum("d").alias("d"))
    accepted = F.col("label").isin(list(positive))
    totals = labels.agg(
        F.sum("a").alias("na"), F.sum("d").alias("nd"),
        F.sum(F.when(accepted, F.col("a")).otherwise(0)).alias("qa"),
        F.sum(F.when(accepted, F.col("d")).otherwise(0)).alias("qd"),
    ).first()  # four numbers

    def share(part, whole) -> Column:
        return F.try_divide(F.lit(part) if not isinstance(part, str) else F.col(part), F.lit(whole))

    p, q = share("a", totals.na), share("d", totals.nd)
    middle = (p + q) / 2

    def divergence(x: Column, y: Column) -> Column:
        """x ln(x / y): zero where x is zero, null where only y is."""
        return F.when(x == 0, F.lit(0.0)).otherwise(x * F.ln(F.try_divide(x, F.nullif(y, F.lit(0.0)))))

    def total(term: Column) -> Column:
        """A sum that is null if a term is."""
        return F.when(F.count_if(term.isNull()) == 0, F.coalesce(F.sum(term), F.lit(0.0)))

    rows_a, rows_d = F.lit(totals.na), F.lit(totals.nd)
    metrics = {
        "CI": F.try_divide(rows_a - rows_d, rows_a + rows_d),
        "DPL": share(totals.qa, totals.na) - share(totals.qd, totals.nd),
        "KL": total(divergence(p, q)),
        "JS": (total(divergence(p, middle)) + total(divergence(q, middle))) / 2,
        "LP": F.sqrt(total(F.pow(p - q, F.lit(2)))),
        "TVD": total(F.abs(p - q)) / 2,
        "KS": F.max(F.abs(p - q)),
    }
    wide = labels.agg(*[m.cast("double").alias(n) for n, m in metrics.items()])
    result = wide.unpivot([], list(metrics), "metric", "value")
    if group is None:
        return result
    return result.unionByName(_demographic_disparity(counts.withColumn("accepted", accepted)))


def _demographic_disparity(counts: DataFrame) -> DataFrame:
    """CDDL: demographic disparity of each group, weighted by its size."""

    def n(side: str, accepted: bool) -> Column:
        return F.sum(F.when(F.col("accepted") == accepted, F.col(side)).otherwise(0))

    groups = counts.groupBy("grp").agg(
        (F.sum("a") + F.sum("d")).alias("n"),
        n("d", False).alias("d0"), (n("a", False) + n("d", False)).alias("n0"),
        n("d", True).alias("d1"), (n("a", True) + n("d", True)).alias("n1"),
    )
    disparity = F.coalesce(F.try_divide("d0", "n0"), F.lit(0.0)) - F.coalesce(F.try_divide("d1", "n1"), F.lit(0.0))
    return groups.agg(F.try_divide(F.sum(F.col("n") * disparity), F.sum("n")).alias("value")).select(
        F.lit("CDDL").alias("metric"), "value"
    )
