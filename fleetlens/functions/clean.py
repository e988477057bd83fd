"""Parsing, category checks, null handling, one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import NO_FAILURE, TIMESTAMP_FORMAT


def parse_datetime(df: DataFrame, column: str = "datetime", fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Text to timestamp; text that does not match becomes null instead of failing the job."""
    return df.withColumn(column, F.try_to_timestamp(F.col(column), F.lit(fmt)))


def in_domain(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isin(list(values))


def category_code(column: str, values: Sequence[str]) -> Column:
    """Position of a category in its declared list, null for a value outside it."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return F.when(place > 0, place - 1)


def with_category(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Add the code of a category column and whether its value is declared."""
    return df.withColumn(f"{column}_code", category_code(column, values)).withColumn(
        f"{column}_known", F.coalesce(in_domain(column, values), F.lit(False))
    )


def one_hot(column: str, values: Sequence[str], prefix: str = "") -> list[Column]:
    """One 0/1 column per declared value, whether or not it occurs."""
    return [F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{prefix}{v}") for v in values]


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0.0, list(columns))


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in columns})


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def label_or_none(column: str = "failure") -> Column:
    """Missing labels, also those stored as the text ``nan``, become ``none``."""
    return F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("nan")), F.lit(NO_FAILURE))
