"""Feature table with its whole history and a view of the latest record per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators.asof import asof_join
from fleetlens.operators.summary import column_info

_DECLARED = {int: T.LongType(), float: T.DoubleType(), str: T.StringType()}


def schema_from(declared: Mapping[str, type]) -> T.StructType:
    """Schema of a declaration that gives each feature as int, float or str."""
    return T.StructType([T.StructField(name, _DECLARED[kind]) for name, kind in declared.items()])


def feature_type(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "Integral"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "Fractional"
    return "String"


def feature_definitions(df: DataFrame) -> list[tuple[str, str]]:
    """Feature names and types inferred from a frame."""
    return [(f.name, feature_type(f.dataType)) for f in df.schema.fields]


def definition_rows(df: DataFrame) -> DataFrame:
    """Rows (name, type, non_null): each feature with its type and its number of values, counted in one pass."""
    kind = F.create_map(*[F.lit(x) for pair in feature_definitions(df) for x in pair])[F.col("column")]
    return column_info(df).select(F.col("column").alias("name"), kind.alias("type"), "non_null")


def check_definitions(df: DataFrame, definitions: list[tuple[str, str]]) -> None:
    found = feature_definitions(df)
    if found != definitions:
        raise ValueError(f"features {found} do not match the definitions {definitions}")


def with_event_time(df: DataFrame, event_time: str | None = None) -> DataFrame:
    """Add the ingestion time as epoch seconds and, beside it, as a date to partition by.

    Without a given time it is the current one; a given time makes the job repeatable.
    """
    ts = F.lit(event_time).cast("timestamp") if event_time else F.current_timestamp()
    return df.withColumn("event_time", F.unix_micros(ts) / 1e6).withColumn("event_date", F.to_date(ts))


def append_offline(df: DataFrame, path: str, event_time: str | None = None, definitions: list[tuple[str, str]] | None = None) -> None:
    """Append records to the history, one folder per ingestion date."""
    if definitions is not None:
        check_definitions(df, definitions)
    with_event_time(df, event_time).write.mode("append").partitionBy("event_date").parquet(path)


def read_offline(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole history. Without a given schema columns are those of all appends, null where one lacked them."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    return reader.parquet(path)


def features_as_of(
    spine: DataFrame, history: DataFrame, key: str, time: str, event_time: str = "event_time", tie_breaks: Sequence[str] = (),
    within: float | None = None,
) -> DataFrame:
    """Rows of ``spine`` with the features known at their time: the key's last record of the history at or before it.

    ``event_time`` may be epoch seconds; it is then compared with the seconds of a timestamp ``time``.
    """
    if not isinstance(spine.schema[time].dataType, T.NumericType) and isinstance(history.schema[event_time].dataType, T.NumericType):
        numbered = spine.withColumn("_seconds", F.unix_micros(F.col(time).cast("timestamp")) / 1e6)
        return asof_join(numbered, history, [key], "_seconds", event_time, tie_breaks, within).drop("_seconds")
    return asof_join(spine, history, [key], time, event_time, tie_breaks, within)


def latest_records(history: DataFrame, key: str, event_time: str, *tie_breaks: str) -> DataFrame:
    """Latest record per key.

    The maximum of a struct aggregates before the shuffle, so a key with a long history costs one
    row per input partition; a ranking window would send the whole history to one task.
    """
    others = [c for c in history.columns if c not in (key, event_time, *tie_breaks)]
    newest = F.max(F.struct(event_time, *tie_breaks, *others)).alias("_newest")
    return history.groupBy(key).agg(newest).select(key, "_newest.*").select(*history.columns)


def distinct_features(history: DataFrame, *columns: str) -> DataFrame:
    return history.select(*columns).distinct()
