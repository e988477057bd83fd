"""Session settings and tables that cut the lineage of a long plan."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "fleetlens", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # plans of many columns are built faster without a recorded call site for each expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Timestamps without a zone are taken as UTC; bins are counted from the UTC epoch."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and stream checkpoints of this application.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local session may
    do without: it gets a temporary folder, since there driver and executors are one machine.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/fleetlens-{app}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="fleetlens-")
    return _LOCAL_DIRS[app]


def clear_work(spark: SparkSession) -> None:
    """Delete the intermediate tables and checkpoints of this application, once no result needs them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def batches_by_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside send rows to Python in batches bounded by their number alone, so rows must be narrow.

    With a bound on bytes, too, Spark adds up the sizes of all columns again for every row.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str((1 << 31) - 1))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet, with the writer's ``options``, in the shared folder and go on from the written table.

    Later readers prune columns from it, and a lost executor costs a re-read, not the whole lineage.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
