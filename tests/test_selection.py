"""Selection by rank against ordering everything."""

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import ordering, selection, summary

INF, NAN = float("inf"), float("nan")


def in_order(values):
    return sorted((v + 0.0 for v in values if v is not None), key=lambda v: (math.isnan(v), v))


NUMBERS = {
    "ties": [float(k % 7) for k in range(500)],
    "far out": [1e-300, 2e-300, 1e300, -1e300, 1.0, 1.0 + 2**-52, 0.0, -0.0, 5e-324, None],
    "no numbers": [INF, -INF, NAN, NAN, 1.0, None, 2.0, -INF],
    "logarithmic": [10.0**k for k in range(-200, 200)],
    "whole range": [-1.7e308, 1.7e308, 0.0, 1.0],
    "one": [3.0],
    "only infinite": [INF, INF],
}


@pytest.mark.parametrize("name", NUMBERS)
def test_every_rank_of_numbers(spark, name):
    values = NUMBERS[name]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    want = in_order(values)
    ranks = sorted({0, len(want) // 3, len(want) // 2, len(want) - 1})
    total, found = selection.select_numbers(df, {"x": F.col("x")}, lambda n: [*ranks, n, -1])["x"]
    assert total == len(want) and [repr(v) for v in found] == [repr(want[k]) for k in ranks]
    images = selection.select(df, {"x": selection.Image.of_double(F.col("x"))}, lambda n: ranks)["x"][1]
    for k, f in zip(ranks, images):
        value = selection.double_of(f.image)
        same = [v for v in want if v == value or math.isnan(v) and math.isnan(value)]
        assert repr(value) == repr(want[k]) and f.equal == len(same) and f.before == min(i for i, v in enumerate(want) if repr(v) == repr(value))


def test_nothing_to_select(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert selection.select_numbers(df, {"x": F.col("x")}, lambda n: [0])["x"] == (0, [])
    assert [r.column for r in summary.exact_quantiles(df, ["x", "y"], (0.5,)).collect()] == ["y"]
    assert summary.describe(df.limit(0), ["x"]).first()["count"] == 0


ROWS = [(k % 5 if k % 11 else None, None if k % 13 == 0 else "äbc"[: k % 4] + "x" * (k % 9), (k * 7919 % 100) / 8 if k % 17 else NAN,
         datetime(2024, 1, 1) + timedelta(hours=k % 50), k) for k in range(400)]
SCHEMA = "a int, b string, c double, d timestamp, k long"


def spark_key(row, columns):
    key = []
    for c in columns:
        v = row["abcdk".index(c)]
        key.append((v is not None, v.encode() if isinstance(v, str) else (math.isnan(v), v) if isinstance(v, float) and not math.isnan(v) else (True, 0.0) if isinstance(v, float) else v) if v is not None else (False, 0))
    return tuple(key)


@pytest.mark.parametrize("columns", ["ak", "bk", "cdk"])
def test_row_ranges(spark, columns):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    want = sorted(ROWS, key=lambda r: spark_key(r, columns))
    for start, stop in ((0, 5), (150, 290), (395, 450), (10, 10)):
        got = [tuple(r) for r in ordering.row_range(df, list(columns), start, stop).collect()]
        assert [spark_key(r, columns) for r in got] == [spark_key(r, columns) for r in want[start:stop]]
        assert len({r[4] for r in got}) == len(got)


def test_ten_million_equal_values(spark):
    df = spark.range(10**7).select(F.lit(2.5).alias("x"), F.when(F.col("id") < 3, F.col("id")).otherwise(7).alias("n"))
    found = {r.probability: r.value for r in summary.exact_quantiles(df, ["x"], (0.25, 0.5, 0.75)).collect()}
    assert found == {0.25: 2.5, 0.5: 2.5, 0.75: 2.5}
    rows = ordering.row_range(df, ["n"], 1, 5).select("n").collect()
    assert [r.n for r in rows] == [1, 2, 7, 7]
    deep = ordering.row_range(df, ["n"], 9_999_990, 10**7 + 5)
    assert deep.count() == 10 and "TakeOrdered" not in deep._jdf.queryExecution().executedPlan().toString()


def test_samples(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("key"), "id")
    got = ordering.sample_rows(df, "key", 123, seed=3).collect()
    best = sorted(((__import__("hashlib").md5(f"{k}-3".encode()).hexdigest(), k) for k in range(1000)))
    assert len(got) == 123 and {r.key for r in got} == {k for _, k in best[:25]}
    assert ordering.sample_rows(df, "key", 9999).count() == 5000 and ordering.sample_rows(df, "key", 0).count() == 0


def test_quantiles_of_random_numbers(spark):
    r = random.Random(1)
    values = [r.gauss(0, 1) ** 5 for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    found = [row.value for row in summary.exact_quantiles(df, ["x"], (0.25, 0.5, 0.75)).orderBy("probability").collect()]
    assert found == [pytest.approx(q) for q in statistics.quantiles(values, n=4, method="inclusive")]
