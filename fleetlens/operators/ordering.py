"""Ordered output, first rows, repeatable samples and row ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.selection import Image, images, rows_between, smallest_rows
from fleetlens.session import materialize


def sort_machine_time(df: DataFrame) -> DataFrame:
    return df.orderBy("machineID", "datetime")


def head(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows chosen by a seeded hash of their key: the same rows on every run, if keys are unique."""
    chosen = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))
    parts = [Image.of_long(F.conv(F.substring(chosen, at, 15), 16, 10).cast("long")) for at in (1, 16, 31)]
    narrow = materialize(df.select(key), "keys")
    return smallest_rows(df, [*parts, *images(narrow, key)], n, narrow)


def row_range(df: DataFrame, order_by: Sequence[str], start: int, stop: int) -> DataFrame:
    """The rows at ranks ``start`` to ``stop`` (without), in order. Only these are ever put in order."""
    narrow = materialize(df.select(*order_by), "keys")
    keys = [image for c in order_by for image in images(narrow, c)]
    return rows_between(df, keys, start, stop, narrow).orderBy(*order_by)
