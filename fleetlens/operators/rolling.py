"""Binned statistics and trailing windows over bins, in one pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.config import FeatureSpec
from fleetlens.operators.binning import bin_end, bin_index, first_in_time
from fleetlens.operators.sequence import (
    MachineOrder,
    chunk_offsets,
    chunk_size,
    copy_to_chunks,
    in_own_chunk,
)
from fleetlens.session import batches_by_rows, materialize


def rolled_bins(
    slots: DataFrame,
    spec: FeatureSpec,
    order: MachineOrder | None,
    measures: Sequence[str] = (),
    counts: Sequence[str] = (),
) -> DataFrame:
    """Bins of ``slots`` with statistics per bin and over the trailing ``window_rows`` bins.

    ``slots`` has one row per machine and time. Measures get mean and sd per bin and rolling mean
    and sd of the bins' first readings; counts, which have no nulls, get the rolling sum of the
    bins' first values.
    A rolling value needs all its bins, so empty bins break the windows they fall in.

    On the grid of all bins a row's position is plain arithmetic. The windows are ranges over that
    position, so empty bins need no rows. Slots are combined into bins before they are shuffled, so
    the number of readings in a bin does not matter. Only bins go on into chunks of consecutive
    positions plus the few bins before each chunk; windows are then built in place, for all rows of a
    batch at once. A window frame would add up its bins row by row, which took most of the time.
    """
    first = {c: F.sum(c) if c in counts and spec.error_statistic == "sum" else first_in_time(c)
             for c in (*measures, *counts)}
    index = F.col("_bin")
    bins_of = slots.groupBy("machineID", bin_index(F.col("datetime"), spec.bin_seconds).alias("_bin"))
    binned = bins_of.agg(
        *[F.avg(m).alias(f"{m}mean_3h") for m in measures],
        *[F.stddev_samp(m).alias(f"{m}sd_3h") for m in measures],
        *[first[c].alias(c) for c in (*measures, *counts)],
    ).withColumn("datetime", bin_end(index, spec.bin_seconds))
    if order is None:
        placed = binned.withColumn("_pos", index)
        part = ["machineID", "_chunk"]
        size = spec.chunk_bins
    else:
        first_bin = order.grid_low // spec.bin_seconds
        bins = order.grid_high // spec.bin_seconds - first_bin + 1
        placed = order.attach(binned, "rank").withColumn("_pos", F.col("rank") * bins + index - first_bin).drop("rank")
        part = ["_chunk"]
        size = chunk_size(order.grid_machines * bins, spec.chunk_bins)
    n = spec.window_rows
    chunked = copy_to_chunks(placed, "_pos", size, n - 1)

    sds = order is not None and bool(measures)
    values = [F.col(c).cast("double").alias(c) for c in (*measures, *counts)]
    bins_3h = [f"{m}{kind}_3h" for kind in ("mean", "sd") for m in measures]
    rows = chunked.select("machineID", "_chunk", "_pos", "datetime", *bins_3h, in_own_chunk("_pos", size).alias("_own"), *values)
    made = [f"{m}mean_24h" for m in measures], [f"{m}sd_24h" for m in measures], [f"{c}count" for c in counts]
    kept = T.StructType([rows.schema[c] for c in ("machineID", "_chunk", "_pos", "datetime", *bins_3h)])
    for c in sum(made, []):
        kept = kept.add(c, "double")
    if sds:
        kept = kept.add("_nth", "long")
    in_order = rows.repartition(*part).sortWithinPartitions(*part, "_pos")
    return in_order.mapInArrow(_trailing(part, n, tuple(measures), tuple(counts), kept.names, sds), kept)


def _window(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum and sum of squared distances from the mean over each ``n`` values, added up one by one as Spark does."""
    size = len(values) - n + 1
    total, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for k in range(n):
        value = values[k : k + size]
        total += value
        delta = value - mean
        step = delta / (k + 1.0)
        mean += step
        square += delta * (delta - step)
    return total, square


def _trailing(part: Sequence[str], n: int, measures: Sequence[str], counts: Sequence[str], names: Sequence[str], sds: bool):
    """Values over each row and the ``n - 1`` bins before it, null unless all are there, for rows in order of ``part`` and position.

    Rows of a chunk other than their own are left out. ``_nth`` numbers the rolling sds within a chunk.
    """

    def same(table: pa.Table, apart: int) -> np.ndarray:
        """Whether a row and that so many rows before it are of one part."""
        found = np.ones(max(len(table) - apart, 0), bool)
        for c in part:
            late, early = table.column(c)[apart:], table.column(c)[: len(found)]
            found &= pc.or_(pc.fill_null(pc.equal(late, early), False), pc.and_(pc.is_null(late), pc.is_null(early))).to_numpy()
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, nth = None, 0  # the last rows of the batches before, and the number of the last rolling sd
        for batch in batches:
            if not batch.num_rows:
                continue
            before = 0 if held is None else len(held)
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            full = np.zeros(len(table), bool)
            if len(table) >= n:
                pos = table.column("_pos").to_numpy()
                full[n - 1 :] = same(table, n - 1) & (pos[n - 1 :] - pos[: len(pos) - n + 1] == n - 1)
            new = {}
            for c in (*measures, *counts):
                column, filled = table.column(c), full.copy()
                total = square = np.zeros(len(table))
                if len(table) >= n:
                    missing = np.concatenate([[0], np.cumsum(column.is_null().to_numpy())])
                    filled[n - 1 :] &= missing[n:] == missing[:-n]
                    with np.errstate(all="ignore"):
                        total, square = (np.concatenate([np.zeros(n - 1), v]) for v in _window(column.to_numpy(), n))
                if c in counts:
                    new[f"{c}count"] = pa.array(total, mask=~full)
                else:
                    new[f"{c}mean_24h"] = pa.array(total / n, mask=~filled)
                    # a single value has no sd
                    new[f"{c}sd_24h"] = pa.array(np.sqrt(square / max(n - 1, 1)), mask=~filled | (n == 1))
            own = table.column("_own").to_numpy()
            if sds:
                placed = own & new[f"{measures[0]}sd_24h"].is_valid().to_numpy(zero_copy_only=False)
                placed[:before] = False
                first = np.ones(len(table), bool)  # rows of a part are numbered from 1
                first[1:] = ~same(table, 1)
                so_far, at = np.cumsum(placed), np.arange(len(table))
                start = np.maximum.accumulate(np.where(first & (at >= before), at, -1))
                number = so_far + np.where(start < 0, nth, (placed - so_far)[start])
                new["_nth"] = pa.array(number, mask=~placed)
                nth = int(number[-1])
            for name, value in new.items():
                table = table.append_column(name, value)
            wanted = own.copy()
            wanted[:before] = False
            yield from table.filter(pa.array(wanted)).select(names).to_batches()
            held = table.select(batch.schema.names).slice(max(len(table) - max(n - 1, 1), 0))

    return run


def place_sd_by_position(rolled: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Move the k-th rolling sd of the whole sequence to the k-th bin of the grid.

    Only bins that receive an sd remain. ``rolled`` is written once: its chunk counts, its sds
    and its other columns are three different reads of it.
    """
    with batches_by_rows(rolled.sparkSession):
        rolled = materialize(rolled, "rolled")
    sd_columns = [f"{m}sd_24h" for m in measures]
    present = rolled.filter(F.col("_nth").isNotNull())
    counts = present.groupBy("_chunk").agg(F.count("*").alias("n"))
    offsets = chunk_offsets(counts, "_chunk", ["n"])
    placed = present.join(F.broadcast(offsets), "_chunk").select(
        (F.col("n_before") + F.col("_nth") - 1).alias("_pos"), *sd_columns
    )
    rest = rolled.drop("_nth", "_chunk", *sd_columns)
    complete = rest.filter(F.col(f"{measures[0]}mean_24h").isNotNull())
    return complete.join(placed, "_pos")
