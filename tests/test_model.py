"""Splits and the forest."""

from datetime import datetime

from pyspark.sql import functions as F

from fleetlens.operators.summary import accuracy
from fleetlens.plans import model, splits
from fleetlens.schemas import LABELED_FEATURES, MODEL_DUMMIES, MODEL_MATRIX

FOLDS = (("2015-01-05 00:00:00", "2015-01-06 00:00:00"), ("2015-01-10 00:00:00", "2015-01-12 00:00:00"))


def labeled(spark, rows=400):
    ids = spark.range(rows)
    numeric = [c for c in LABELED_FEATURES if c not in ("machineID", "datetime", "model", "failure")]
    x = (F.col("id") * 37) % 101
    return ids.select(
        F.col("id").alias("machineID"),
        F.timestamp_seconds(F.lit(1420070400) + F.col("id") * 3600).alias("datetime"),
        *[(x + F.lit(i)).cast("double").alias(c) for i, c in enumerate(numeric)],
        F.lit("model3").alias("model"),
        F.when(x > 60, "comp2").otherwise("none").alias("failure"),
    ).withColumn("age", F.col("age").cast("long")).select(*LABELED_FEATURES)


def test_limits_are_strict_and_dummies_fixed(spark):
    rows = labeled(spark)
    train, test = splits.time_split(rows, FOLDS)
    assert train.columns == [*MODEL_MATRIX, "failure"]
    assert train.count() == 9 * 24 and test.count() == 400 - 11 * 24 - 1
    assert [c for c in MODEL_DUMMIES if train.agg(F.max(c)).first()[0]] == ["model_model3"]
    edge = rows.filter(F.col("datetime").isin(datetime(2015, 1, 10), datetime(2015, 1, 12)))
    assert edge.count() == 2 and splits.time_split(edge, FOLDS)[1].count() == 0


def test_walk_forward(spark):
    counts = {(r.fold, r.role): r["count"] for r in splits.walk_forward(labeled(spark), FOLDS).groupBy("fold", "role").count().collect()}
    assert counts == {(0, "train"): 96, (0, "test"): 279, (1, "train"): 216, (1, "test"): 135}


def test_forest_learns_and_reloads(spark, tmp_path):
    train, test = splits.time_split(labeled(spark), FOLDS)
    forest = model.fit_forest(train, trees=5, max_depth=5)
    scored = model.score(forest, test)
    assert accuracy(scored, "failure", "predicted_failure").first().accuracy > 0.95
    model.save_model(forest, str(tmp_path / "m"))
    again = model.score(model.load_model(str(tmp_path / "m")), test.drop("failure"))
    assert [r[0] for r in again.orderBy(*MODEL_MATRIX).select("predicted_failure").collect()] == [
        r[0] for r in scored.orderBy(*MODEL_MATRIX).select("predicted_failure").collect()]


def test_every_row_is_scored(spark):
    train, test = splits.time_split(labeled(spark), FOLDS)
    holes = test.withColumn("comp1", F.lit(None).cast("double")).withColumn(MODEL_MATRIX[0], F.lit(float("nan")))
    forest = model.fit_forest(train.unionByName(holes.limit(5)), trees=3, max_depth=4)
    scored = model.score(forest, holes)
    assert scored.columns == [*holes.columns, "predicted_failure"]
    assert scored.filter("predicted_failure IS NOT NULL").count() == holes.count()


def test_model_from_elsewhere(spark):
    rows = labeled(spark, 30).select("machineID", "volt" + "mean_3h", "age")
    out = model.apply_model(rows, lambda x: (x["age"] > 50).map({True: "comp1", False: "none"}), ["voltmean_3h", "age"])
    assert {r.predicted_failure for r in out.filter("age > 50").collect()} <= {"comp1"} and out.count() == 30


def test_equal_rows_are_kept_once_until_they_are_read(spark):
    """The forest's table had each row as many times as its machine and time had readings."""
    import pytest

    from fleetlens.catalog.features import labeled as rows_of
    from fleetlens.catalog.training import _matrix
    from fleetlens.operators.joins import repeat_rows

    def counted(df):
        return {tuple(r) for r in df.groupBy("machineID", "datetime", "failure").agg(F.count("*")).collect()}

    whole, once = (rows_of(spark, "/root/testdata/sf0.001", repeated=r) for r in (True, False))
    wanted = counted(whole)
    assert counted(repeat_rows(once, "_times")) == wanted
    matrix = _matrix(spark, "/root/testdata/sf0.001")
    assert counted(matrix) == wanted and "_times" not in matrix.columns
    written = spark.read.parquet(*matrix.inputFiles())
    assert written.count() == len(wanted) < whole.count()
    with pytest.raises(ValueError):
        rows_of(spark, "/root/testdata/sf0.001", backfill_rows=2, repeated=False)
