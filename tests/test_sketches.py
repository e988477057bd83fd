"""Profiles of text, mergeable sketches, distributed ranks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import ranks, summary
from fleetlens.plans import monitor, sketches


def mixed(spark, rows):
    return spark.createDataFrame(rows, "model string, failure string, age double, since date, spare boolean").coalesce(3)


BASE = [(f"model{k % 4}", None if k % 10 == 0 else "comp1" if k % 3 else "none", float(k % 50), None, k % 2 == 0) for k in range(1000)]
COLUMNS = ("model", "failure", "age", "since", "spare")


def test_statistics_of_mixed_columns(spark):
    stats = {r.feature: r for r in monitor.baseline_statistics(mixed(spark, BASE), COLUMNS).collect()}
    assert {f: r.inferred_type for f, r in stats.items()} == {
        "model": "String", "failure": "String", "age": "Fractional", "since": "String", "spare": "String"}
    assert (stats["model"].present, stats["model"].missing, stats["model"].distinct) == (1000, 0, 4)
    assert dict(map(tuple, stats["failure"].categories)) == Counter(f for _, f, *_ in BASE if f)
    assert stats["failure"].missing == 100 and stats["failure"].mean is None
    assert (stats["since"].present, stats["since"].missing, stats["since"].categories) == (0, 1000, None)
    assert dict(map(tuple, stats["spare"].categories)) == {"true": 500, "false": 500}
    assert stats["age"].high == 49.0 and stats["age"].categories is None and sum(stats["age"][b] for b in monitor.BUCKET_COLUMNS) == 1000
    rules = {r.feature: r for r in monitor.baseline_constraints(monitor.baseline_statistics(mixed(spark, BASE), COLUMNS)).collect()}
    assert rules["model"].domain == ["model0", "model1", "model2", "model3"] and rules["age"].domain is None
    assert rules["failure"].completeness == 0.9 and not rules["model"].non_negative


def test_violations_of_text(spark):
    base = mixed(spark, BASE)
    assert monitor.drift_violations(base, base, COLUMNS).count() == 0
    changed = [("model9" if k < 50 else m, f if k % 2 else None, a, s, True) for k, (m, f, a, s, _) in enumerate(BASE)]
    found = {(r.feature, r.check): r.observed for r in monitor.drift_violations(base, mixed(spark, changed), COLUMNS).collect()}
    assert set(found) == {("model", "categorical_values_check"), ("failure", "completeness_check"), ("spare", "baseline_drift_check")}
    assert found["model", "categorical_values_check"] == pytest.approx(0.05)
    assert found["spare", "baseline_drift_check"] == pytest.approx(0.5)


def test_numbers_that_became_text_and_lost_columns(spark):
    base = spark.createDataFrame([(1.0, "a", 1)], "x double, y string, z int")
    batch = spark.createDataFrame([("1", "a", "b")], "x string, y string, w string")
    found = {(r.feature, r.check) for r in monitor.drift_violations(base, batch, ["x", "y", "z", "w"]).collect()}
    assert found == {("x", "data_type_check"), ("z", "missing_column_check"), ("w", "extra_column_check")}


def test_empty_table(spark):
    assert monitor.baseline_statistics(mixed(spark, []), COLUMNS).count() == 0
    assert sketches.sketch_profile(mixed(spark, []), COLUMNS).count() == 0


def test_more_values_than_the_summary_holds(spark):
    """Counts of the commonest of 60,000 values, 512 of them tracked, against full counts."""
    r = random.Random(3)
    values = [f"v{int(1000 * r.paretovariate(0.8)) % 60000}" for _ in range(40000)] + [f"rare{k}" for k in range(20000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    found = sketches.sketch_statistics(sketches.sketch_profile(df, ["v"], tracked=512)).first()
    full = Counter(values)
    bound = 3.5 / 512 * len(values)
    for item, count in map(tuple, found.categories):
        assert full[item] <= count <= full[item] + bound
    assert abs(found.distinct - len(full)) < 0.05 * len(full)
    exact = monitor.baseline_statistics(df.limit(5000), ["v"]).first()
    assert exact.present == 5000 and len(exact.categories) == monitor.CATEGORIES
    assert monitor.baseline_constraints(monitor.baseline_statistics(df, ["v"])).first().domain is None


def test_merged_profiles_equal_one_of_all(spark):
    df = mixed(spark, BASE).withColumn("day", F.col("age").cast("int") % 7)
    merged = sketches.merge_profiles(sketches.sketch_profile(df, COLUMNS, by=["day"]))
    whole = sketches.sketch_profile(df, COLUMNS)
    a, b = ({r.feature: r for r in sketches.sketch_statistics(p).collect()} for p in (merged, whole))
    for feature in COLUMNS:
        for column in ("present", "missing", "low", "high", "distinct"):
            assert a[feature][column] == b[feature][column]
        assert sorted(map(tuple, a[feature].categories or [])) == sorted(map(tuple, b[feature].categories or []))
    assert a["age"].quantiles == b["age"].quantiles  # fewer values than the sketch holds
    assert {r.feature: r.distance for r in sketches.ks_distances(merged, whole).collect()} == {"age": 0.0}


def ks(left, right):
    points = sorted({*left, *right})
    return max(abs(sum(x <= p for x in left) / len(left) - sum(x <= p for x in right) / len(right)) for p in points)


def test_distance_is_not_hidden_by_one_value_far_out(spark):
    r = random.Random(5)
    left = [r.gauss(0, 1) for _ in range(3000)]
    right = [r.gauss(1, 1) for _ in range(2000)]
    frames = [spark.createDataFrame([(x,) for x in v], "x double").repartition(3) for v in ([*left, 1e9], [*right, -1e9])]
    exact = ranks.kolmogorov_smirnov(*frames, "x").first().distance
    assert exact == pytest.approx(ks([*left, 1e9], [*right, -1e9]))
    base, batch = (sketches.sketch_profile(f, ["x"]) for f in frames)
    found = sketches.ks_distances(batch, base).first().distance
    assert abs(found - exact) <= sketches.distance_error() < 0.02 and found > 0.3
    assert sketches.ks_violations(batch, base).first().check == "baseline_drift_check"
    assert monitor.drift_violations(*frames, ["x"]).filter("check = 'baseline_drift_check'").count() == 0  # ten equal buckets see nothing


def test_exact_distance_with_ties_nulls_and_groups(spark):
    r = random.Random(7)
    rows = [(g, float(r.randrange(6)) if r.random() < 0.9 else None, s) for g in "ab" for s in (0, 1) for _ in range(300 + 100 * s)]
    df = spark.createDataFrame(rows, "g string, x double, side int")
    found = {row.g: row.distance for row in ranks.kolmogorov_smirnov(df.filter("side = 0"), df.filter("side = 1"), "x", ["g"]).collect()}
    for g in "ab":
        left, right = ([x for h, x, s in rows if h == g and s == side and x is not None] for side in (0, 1))
        assert found[g] == pytest.approx(ks(left, right))
    assert ranks.kolmogorov_smirnov(df.filter("side = 0"), df.filter("side = 5"), "x").first().distance is None


def auc(rows):
    up, down = ([s for s, y in rows if y], [s for s, y in rows if not y])
    if not up or not down:
        return None
    return sum((a > b) + (a == b) / 2 for a in up for b in down) / (len(up) * len(down))


@pytest.mark.parametrize("values", [1, 4, 10**6])
def test_area_under_curve(spark, values):
    r = random.Random(values)
    rows = [(g, r.randrange(values) / 7, r.random() < 0.3) for g in ("a", "b") for _ in range(250)] + [("c", 0.5, True)]
    df = spark.createDataFrame([*rows, ("a", None, True), ("a", 0.1, None)], "g string, score double, y boolean").repartition(4)
    found = {x.g: x for x in ranks.area_under_curve(df, "score", F.col("y"), ["g"]).collect()}
    for g in "abc":
        mine = [(s, y) for h, s, y in rows if h == g]
        assert found[g].auc == (None if g == "c" else pytest.approx(auc(mine))) and found[g].positives == sum(y for _, y in mine)


def test_one_vs_rest(spark):
    rows = [("x", 0.9, 0.1), ("y", 0.2, 0.8), ("x", 0.2, 0.3), ("z", 0.2, 0.2)]
    df = spark.createDataFrame(rows, "label string, sx double, sy double")
    found = {r.label: r.auc for r in ranks.label_areas(df, "label", {"x": "sx", "y": "sy"}).collect()}
    assert found == {"x": pytest.approx(auc([(s, y == "x") for y, s, _ in rows])), "y": pytest.approx(auc([(s, y == "y") for y, _, s in rows]))}


def test_running_totals_over_one_hot_value(spark):
    df = spark.range(200000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("v"))
    groups = df.groupBy("v").agg(F.count("*").alias("n"))
    rows = sorted(map(tuple, ranks.running_totals(groups, [], "v", ["n"]).collect()))
    total = 0
    for _, n, before in rows:
        assert before == total
        total += n
    assert total == 200000


def test_class_metrics(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("b", None), (None, "a")]
    df = spark.createDataFrame(rows, "label string, prediction string")
    assert sorted(map(tuple, summary.confusion(df, "label", "prediction").collect()), key=str) == sorted(
        [(a, b, n) for (a, b), n in Counter(rows).items()], key=str)
    found = {r["class"]: r for r in summary.class_metrics(df, "label", "prediction").collect()}
    assert (found["a"].actual, found["a"].predicted, found["a"].correct, found["a"].precision, found["a"].recall) == (2, 3, 1, pytest.approx(1 / 3), 0.5)
    assert found["c"].precision is None and found["c"].recall == 0.0 and set(found) == {"a", "b", "c"}
