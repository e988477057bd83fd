"""Registry of queries, each with its checking SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

# Means of money amounts often end exactly in ...5 at the fifth decimal, where the last bit of a
# sum decides the rounding. Both engines add this much first, so such ties round the same way.
TIE_SHIFT = 3e-7


def settled(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded and timestamps without zone, so that two engines' results compare equal."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        value = F.col(f"`{field.name}`")
        if kind == "double":
            value = F.round(value + TIE_SHIFT, digits)
        elif kind == "timestamp":
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, digits: int = 4):
    """Register ``fn(spark, sf_dir)`` and, if given, the SQL with the same result."""

    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return settled(fn(spark, sf_dir), digits)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


def _load() -> None:
    from fleetlens.catalog import features, monitoring, operators, streams, tables, training  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
