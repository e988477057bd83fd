"""Reading the inputs, and tables that hold what several steps use."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import materialize

#: An Arrow batch sent to Python holds at most so many bytes, or one row.
BATCH_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded bytes, so that a run of very long texts doesn't fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def keep(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with the writer's ``options``, and go on from there.

    What the writing job shuffled isn't needed any more. Spark deletes such files when the driver's
    garbage is collected; asking for that here keeps the disk use of a chain of steps near that of one.
    """
    kept = materialize(df, name, **options)
    del df
    gc.collect()
    kept.sparkSession.sparkContext._jvm.System.gc()
    return kept


def documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns of ``docs`` that operators read, as ``doc_id`` and ``text``, and ``_th``, a hash of the text.

    (doc_id, _th) names a row up to repeated rows, also where ids are null or used twice.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_th"))


def same_row(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}._th") == F.col(f"{right}._th"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, seed: int) -> DataFrame:
    """Rows (text, label) of about ``most`` labelled ids at most, chosen by a hash of the id.

    Rows of ``labels`` without id or label and repeated ones are left out. The chosen ids, bounded by
    ``most``, are sent to the documents, so no text is moved.
    """
    known = labels.select("doc_id", F.col(label).cast("long").alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL").distinct()
    share = min(1.0, 0.9 * most / max(known.count(), 1))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) < share * (1 << 40)).limit(most)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label")


def spread(df: DataFrame) -> DataFrame:
    """As many partitions as shuffles have, for rows whose work is much larger than their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of rows that hold whole groups, from batches of a partition sorted by ``keys`` (longs or ints)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], 1)
        changes = np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1
        if held:
            last = np.array([held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in keys])
            if (last != marks[0]).any():
                yield pa.Table.from_batches(held)
                held = []
        if len(changes):
            cut = int(changes[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where groups of a sorted table begin, and its end."""
    marks = np.stack([table.column(k).to_numpy() for k in keys], 1)
    return np.concatenate([[0], np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1, [len(marks)]])
