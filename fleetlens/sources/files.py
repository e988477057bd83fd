"""CSV and Parquet tables at any path Spark can read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.schemas import HEADERLESS_MATRIX, TIMESTAMP_FORMAT


#: Column of ``csv_rejects`` with the text of a row of another width.
RECORD = "record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header; columns are found by name and parsed as declared, without an inference pass.

    NaN is null. A value that can't be parsed is null too, as are values that a short row lacks;
    ``csv_rejects`` lists all such rows. A quote in a quoted value is doubled. ``multi_line`` allows line
    breaks in quoted values; each file is then read by one task. Without it both parts of such a row are
    rows of another width and so among the rejects.
    """
    raw = _raw_csv(spark, path, schema, multi_line)
    return raw.select(*[_parsed(f).alias(f.name) for f in schema.fields])


def csv_rejects(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Rows as text that lose something in ``read_csv``, with ``bad_columns`` and ``record``.

    ``bad_columns`` names columns with a value that can't be parsed; ``record`` is the whole text of a row
    that has more or fewer values than the header.
    """
    raw = _raw_csv(spark, path, schema, multi_line, with_record=True)
    bad = [F.when(_parsed(f, keep_nan=True).isNull() & F.col(f"`{f.name}`").isNotNull(), F.lit(f.name)) for f in schema.fields]
    found = raw.withColumn("bad_columns", F.array_compact(F.array(*bad)))
    return found.filter((F.size("bad_columns") > 0) | F.col(RECORD).isNotNull())


def _raw_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, with_record: bool = False) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    raw = reader.csv(path)
    missing = set(schema.names) - set(raw.columns)
    if missing:
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    names = [F.col(f"`{n}`") for n in schema.names]
    if not with_record:
        return raw.select(*names)
    texts = T.StructType([*raw.schema.fields, T.StructField(RECORD, T.StringType())])
    # widths are seen only if all columns are parsed
    whole = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", RECORD).schema(texts).csv(path)
    return whole.select(*names, RECORD)


def _parsed(field: T.StructField, keep_nan: bool = False) -> Column:
    text = F.trim(F.col(f"`{field.name}`"))
    if isinstance(field.dataType, T.TimestampType):
        return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))
    if isinstance(field.dataType, T.StringType):
        return F.col(f"`{field.name}`")
    value = text.try_cast(field.dataType)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)) and not keep_nan:
        return F.nanvl(value, F.lit(None).cast(field.dataType))
    return value


def read_matrix(spark: SparkSession, path: str, schema: T.StructType = HEADERLESS_MATRIX) -> DataFrame:
    """CSV of numbers without a header, columns by position."""
    return spark.read.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    writer = df.write.mode("overwrite").option("header", header).option("escape", '"')
    writer.option("timestampFormat", TIMESTAMP_FORMAT).csv(path)


def write_stages(stages: Mapping[str, DataFrame], out: str) -> dict[str, str]:
    """Write each named stage as a Parquet table below ``out`` and say where."""
    paths = {name: f"{out.rstrip('/')}/{name}" for name in stages}
    for name, df in stages.items():
        df.write.mode("overwrite").parquet(paths[name])
    return paths
