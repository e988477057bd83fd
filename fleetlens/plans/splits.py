"""Splits by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.clean import one_hot
from fleetlens.schemas import MODEL_MATRIX, MODELS

# Last training time and first test time of each fold.
THRESHOLDS = (
    ("2015-07-31 01:00:00", "2015-08-01 01:00:00"),
    ("2015-08-31 01:00:00", "2015-09-01 01:00:00"),
    ("2015-09-30 01:00:00", "2015-10-01 01:00:00"),
)


def model_matrix(labeled: DataFrame, *keep: str) -> DataFrame:
    """The 30 numeric columns a model is fitted on, then the label."""
    numeric = [c for c in MODEL_MATRIX if not c.startswith("model_")]
    return labeled.select(*keep, *numeric, *one_hot("model", MODELS, "model_"), "failure")


def _ts(text: str):
    return F.lit(text).cast("timestamp")


def train_rows(labeled: DataFrame, fold: Sequence[str]) -> DataFrame:
    return labeled.filter(F.col("datetime") < _ts(fold[0]))


def test_rows(labeled: DataFrame, fold: Sequence[str]) -> DataFrame:
    return labeled.filter(F.col("datetime") > _ts(fold[1]))


def time_split(labeled: DataFrame, folds: Sequence[Sequence[str]] = THRESHOLDS) -> tuple[DataFrame, DataFrame]:
    """Training and test matrix of the last fold; rows in the gap belong to neither."""
    return model_matrix(train_rows(labeled, folds[-1])), model_matrix(test_rows(labeled, folds[-1]))


def walk_forward(labeled: DataFrame, folds: Sequence[Sequence[str]] = THRESHOLDS) -> DataFrame:
    """Every row once per fold it belongs to, with ``fold`` and ``role``.

    The few folds are an array in the plan, so rows are multiplied in place, without a join.
    """
    roles = [
        F.struct(
            F.lit(i).alias("fold"),
            F.when(F.col("datetime") < _ts(last), "train").when(F.col("datetime") > _ts(first), "test").alias("role"),
        )
        for i, (last, first) in enumerate(folds)
    ]
    kept = F.filter(F.array(*roles), lambda r: r["role"].isNotNull())
    return labeled.select("*", F.inline(kept))
