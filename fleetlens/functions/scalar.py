"""Scalar column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def days_between(later: Column, earlier: Column) -> Column:
    """Difference in days with its fraction."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / MICROS_PER_DAY


def json_request(columns: Sequence[str]) -> Column:
    """One record as a JSON list of lists."""
    return F.to_json(F.array(F.array(*columns)))


def csv_request(columns: Sequence[str]) -> Column:
    """One record as a CSV line; a null is an empty place."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def dashed(column: Column) -> Column:
    return F.translate(column, "_", "-")


def feature_name(index: int) -> str:
    """Positional feature name, ten digits wide."""
    return f"feature{index:010d}"


def hash_percent(column: Column) -> Column:
    """A number from 0 to 99 that depends only on the value, for repeatable sampling."""
    return F.conv(F.substring(F.md5(column.cast("string")), 1, 8), 16, 10).cast("long") % 100
