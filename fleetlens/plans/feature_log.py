"""The feature history as a log of batches, and a view of the latest records that is kept up to date.

A batch of records is written to a folder of its own and counts from the moment its commit is there: a file
with its schema that can be created only once. Writing a batch again, after a failure or by a retry, changes
nothing; a batch without a commit is never read. Columns may be added and types widened as declared, and
older batches are read accordingly. The view of the latest records is dealt into folders by a hash of the
key; a batch rewrites only the folders of its own keys.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.plans.feature_table import latest_records, with_event_time
from fleetlens.session import materialize

#: Types that may become wider ones without a value changing.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"), "int": ("bigint", "double"),
    "float": ("double",), "date": ("timestamp_ntz",),
}
BUCKETS = 64


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def commits(spark: SparkSession, path: str) -> list[dict]:
    """The commits of a history in order of their writing: batch, position and schema, one small file each."""
    fs, folder = _file_system(spark, f"{path}/commits")
    if not fs.exists(folder) or not len(fs.listStatus(folder)):
        return []
    texts = spark.read.text(f"{path}/commits/*.json", wholetext=True).collect()
    return sorted((json.loads(row.value) for row in texts), key=lambda c: (c["position"], c["batch"]))


def merged_schema(before: T.StructType | None, new: T.StructType) -> T.StructType:
    """The schema of a history that gets a batch of schema ``new``; raises if a column is gone or its type has changed."""
    if before is None:
        return new
    missing = [f.name for f in before.fields if f.name not in new.names]
    if missing:
        raise ValueError(f"the batch lacks {', '.join(missing)}")
    fields = []
    for old in before.fields:
        a, b = old.dataType.simpleString(), new[old.name].dataType.simpleString()
        if a == b or a in WIDER.get(b, ()):
            fields.append(old)
        elif b in WIDER.get(a, ()):
            fields.append(T.StructField(old.name, new[old.name].dataType))
        else:
            raise ValueError(f"{old.name} was {a} and is {b} in the batch")
    return T.StructType([*fields, *[f for f in new.fields if f.name not in before.names]])


def history_schema(spark: SparkSession, path: str) -> T.StructType | None:
    found = commits(spark, path)
    return T.StructType.fromJson(found[-1]["schema"]) if found else None


def append_batch(df: DataFrame, path: str, batch: str, event_time: str | None = None) -> bool:
    """Append records as the batch named ``batch``; False if it is there already, and then nothing changes.

    Without ``event_time`` records get the current time. The commit of a batch holds the schema of the whole
    history from then on. Batches are appended one after the other, as in a scheduled job.
    """
    if not batch or any(c in batch for c in "/= "):
        raise ValueError(f"{batch!r} can't name a folder")
    spark = df.sparkSession
    done = commits(spark, path)
    if any(c["batch"] == batch for c in done):
        return False
    timed = with_event_time(df, event_time)
    schema = merged_schema(T.StructType.fromJson(done[-1]["schema"]) if done else None, _nullable(timed.schema))
    cast = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    timed.select(*cast).write.mode("overwrite").parquet(f"{path}/records/batch={batch}")
    fs, commit = _file_system(spark, f"{path}/commits/{batch}.json")
    out = fs.create(commit, False)  # fails if another run has committed the batch meanwhile
    out.write(bytearray(json.dumps({"batch": batch, "position": len(done), "schema": schema.jsonValue()}), "utf-8"))
    out.close()
    return True


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All records of committed batches in the schema of the newest, with ``batch``; a column added later is null before."""
    done = commits(spark, path)
    if not done:
        raise ValueError(f"{path} holds no history")
    schema = T.StructType([*T.StructType.fromJson(done[-1]["schema"]).fields, T.StructField("batch", T.StringType())])
    folders = [f"{path}/records/batch={c['batch']}" for c in done]
    return spark.read.schema(schema).option("basePath", f"{path}/records").parquet(*folders)


def update_latest(batch: DataFrame, path: str, key: str, event_time: str, *tie_breaks: str, buckets: int = BUCKETS) -> None:
    """Merge a batch into the view of the latest record per key at ``path``; the same batch again changes nothing.

    Only folders of keys in the batch are read and rewritten, each in one step of the file system's commit.
    ``buckets`` belongs to the view and must stay the same; a few times the number of cores is a good size.
    """
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")
    placed = materialize(latest_records(batch, key, event_time, *tie_breaks).select("*", bucket), "newest")
    touched = [row.bucket for row in placed.select("bucket").distinct().collect()]  # at most ``buckets``
    fs, folder = _file_system(spark, path)
    if fs.exists(folder):
        before = spark.read.schema(placed.schema).parquet(path).filter(F.col("bucket").isin(touched))
        both = before.unionByName(placed)
        placed = materialize(latest_records(both.drop("bucket"), key, event_time, *tie_breaks).select("*", bucket), "merged")
    writer = placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(path)


def read_latest(spark: SparkSession, path: str, key: str | None = None, value=None, buckets: int = BUCKETS) -> DataFrame:
    """The view, or the record of one key, for which one folder is read."""
    view = spark.read.parquet(path)
    if key is not None:
        typed = F.lit(value).cast(view.schema[key].dataType)
        number = spark.range(1).select(F.pmod(F.xxhash64(typed), F.lit(buckets))).first()[0]
        view = view.filter((F.col("bucket") == number) & (F.col(key) == typed))
    return view.drop("bucket")
