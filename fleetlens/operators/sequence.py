"""Work on one long sequence of rows without sorting it in one task.

The sequence is all machines one after the other, each in time order. It is cut into chunks that
follow each other in that order. A row's position, a carried-over value or a window across a chunk
border then needs only a small summary per chunk, or a few rows copied from the chunk before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from fleetlens.operators.joins import BROADCAST_ROWS, lookup_join
from fleetlens.session import materialize

MAX_CHUNKS = 500_000  # chunk summaries hold one narrow row per chunk, so this bounds them


def chunk_size(total: int, wanted: int) -> int:
    """Chunk length that keeps the number of chunks within ``MAX_CHUNKS``."""
    return max(wanted, -(-total // MAX_CHUNKS))


def _sums_before(totals: Sequence[str], window: WindowSpec) -> list[Column]:
    before = window.rowsBetween(W.unboundedPreceding, -1)
    return [F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"{t}_before") for t in totals]


def chunk_offsets(sizes: DataFrame, chunk: str, totals: Sequence[str]) -> DataFrame:
    """Sums of ``totals`` over all earlier chunks. ``sizes`` has one row per chunk, a bounded table."""
    return sizes.select(chunk, *_sums_before(totals, W.orderBy(chunk)))


def prefix_sums(df: DataFrame, key: str, totals: Sequence[str], rows: int, per_part: int = BROADCAST_ROWS) -> DataFrame:
    """Sums of ``totals`` over all smaller keys of a table with one row per key.

    Above ``per_part`` rows the keys are cut at approximate quantiles, summed within each part and
    shifted by the sums of the parts before it.
    """
    parts = -(-max(rows, 1) // per_part)
    if parts == 1:
        return df.select(*df.columns, *_sums_before(totals, W.orderBy(key)))
    fractions = [i / parts for i in range(1, parts)]
    cuts = df.select(F.percentile_approx(key, fractions, 10 * parts)).first()[0]
    part = F.size(F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts))]), lambda c: c < F.col(key)))
    parted = df.withColumn("_part", part)
    sizes = parted.groupBy("_part").agg(*[F.sum(t).alias(f"{t}_earlier") for t in totals])
    shift = chunk_offsets(sizes, "_part", [f"{t}_earlier" for t in totals])
    within = parted.select(*parted.columns, *_sums_before(totals, W.partitionBy("_part").orderBy(key)))
    shifted = within.join(F.broadcast(shift), "_part")
    return shifted.select(
        *df.columns, *[(F.col(f"{t}_before") + F.col(f"{t}_earlier_before")).alias(f"{t}_before") for t in totals]
    )


_PIECE = ("_before", "_rows", "_low", "_high")


def _part(step: int) -> Column:
    """Which part of its piece a row falls in, where a piece of too many rows is cut evenly over its time."""
    parts = F.when(F.col("_rows") > step, F.ceil(2 * F.col("_rows") / step)).otherwise(1)
    share = (F.unix_seconds("datetime") - F.col("_low")) / (F.col("_high") - F.col("_low") + 1)
    return F.floor(share * parts)


@dataclass(frozen=True)
class MachineOrder:
    """All machines in order, with what is needed to find a row's place in the whole sequence.

    ``grid_machines``, ``grid_low`` and ``grid_high`` (seconds) describe the grid of bins: they
    count only the first of the frames the order was made from, the telemetry.
    """

    table: DataFrame  # machineID, rank within the grid, rows, rows_before, low, high (seconds)
    keys: DataFrame  # machineID, datetime of all rows
    machines: int
    longest: int  # rows of the largest machine
    rows: int
    grid_machines: int
    grid_low: int
    grid_high: int
    _levels: dict[int, list[tuple[DataFrame, int]]] = field(default_factory=dict, repr=False, compare=False)

    def attach(self, df: DataFrame, *columns: str) -> DataFrame:
        return lookup_join(
            df, self.table.select("machineID", *columns), ["machineID"],
            spread_by=["datetime"], rows=self.machines,
        )

    def with_chunk(self, df: DataFrame, wanted_rows: int) -> DataFrame:
        """Chunk number that grows with (machineID, datetime); a chunk has less than twice the wanted rows.

        The sequence is first cut into pieces of at most the wanted rows, and a chunk is the pieces
        that start in it. A machine is one piece unless it has more rows. Then it is cut evenly over
        its time span, the rows of the parts are counted, and parts that still have too many rows are
        cut again over their own span, so times far off do no harm. Only rows of one machine within
        one second can't be cut. Jobs that count the parts run when the plan is built.
        """
        step = chunk_size(self.rows, wanted_rows)
        if step not in self._levels:
            self._levels[step] = self._cut(step)
        placed = self._pieces(df, step, self._levels[step])
        return placed.withColumn("_chunk", F.floor(F.col("_before") / step)).drop(*_PIECE)

    def _pieces(self, df: DataFrame, step: int, levels: Sequence[tuple[DataFrame, int]]) -> DataFrame:
        """Put the piece of each row beside it: its span, its rows and the rows before it."""
        named = self.table.select(
            "machineID", F.col("rows_before").alias("_before"), F.col("rows").alias("_rows"),
            F.col("low").alias("_low"), F.col("high").alias("_high"))
        placed = lookup_join(df, named, ["machineID"], spread_by=["datetime"], rows=self.machines)
        for level, parts in levels:
            whole = placed.withColumn("_part", _part(step)).withColumnRenamed("_before", "_whole")
            found = lookup_join(whole.drop("_rows", "_low", "_high"), level, ["_whole", "_part"], ["datetime"], rows=parts)
            placed = found.drop("_whole", "_part")
        return placed

    def _cut(self, step: int) -> list[tuple[DataFrame, int]]:
        """Lookup tables, each of which leads from pieces and parts of them to smaller pieces."""
        levels: list[tuple[DataFrame, int]] = []
        longest = self.longest
        while longest > step:
            placed = self._pieces(self.keys, step, levels).withColumn("_part", _part(step))
            seconds = F.unix_seconds("datetime")
            counted = placed.groupBy(F.col("_before").alias("_whole"), "_part").agg(
                F.count("*").alias("_rows"), F.min(seconds).alias("_low"), F.max(seconds).alias("_high"))
            earlier = W.partitionBy("_whole").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
            before = F.col("_whole") + F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
            level = materialize(counted.withColumn("_before", before), "parts")
            can_be_cut = F.when(F.col("_high") > F.col("_low"), F.col("_rows"))
            parts, longest = level.agg(F.count("*"), F.coalesce(F.max(can_be_cut), F.lit(0))).first()
            levels.append((level, parts))
        return levels

    def chunks(self, wanted_rows: int) -> int:
        return self.rows // chunk_size(self.rows, wanted_rows) + 1


def machine_order(telemetry: DataFrame, *others: DataFrame) -> MachineOrder:
    """Read (machineID, datetime) of the frames once and order the machines."""
    seconds = F.unix_seconds("datetime")
    keys = telemetry.select("machineID", "datetime", seconds.alias("grid"))
    for more in others:
        keys = keys.unionByName(more.select("machineID", "datetime", F.lit(None).cast("long").alias("grid")))
    extents = materialize(
        keys.groupBy("machineID").agg(
            F.count("*").alias("rows"), F.min(seconds).alias("low"), F.max(seconds).alias("high"),
            F.min("grid").alias("grid_low"), F.max("grid").alias("grid_high"),
        ).withColumn("in_grid", F.col("grid_low").isNotNull().cast("long")),
        "machines",
    )
    machines, *totals = extents.agg(
        F.count("*"), F.max("rows"), F.sum("rows"), F.sum("in_grid"), F.min("grid_low"), F.max("grid_high")
    ).first()
    table = prefix_sums(extents, "machineID", ["in_grid", "rows"], machines)
    table = table.withColumnRenamed("in_grid_before", "rank").drop("in_grid", "grid_low", "grid_high")
    return MachineOrder(table, keys.select("machineID", "datetime"), machines, *[t or 0 for t in totals])


def copy_to_chunks(df: DataFrame, position: str, size: int, reach: int) -> DataFrame:
    """Copy each row into its own chunk and into later ones whose windows look ``reach`` rows back."""
    pos = F.col(position)
    chunks = F.sequence(F.floor(pos / size), F.floor((pos + reach) / size))
    return df.withColumn("_chunk", F.explode(chunks))


def in_own_chunk(position: str, size: int) -> Column:
    return F.col("_chunk") == F.floor(F.col(position) / size)


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "position") -> DataFrame:
    """Consecutive numbers from 0 over a sequence whose rows carry an ordered ``_chunk``.

    ``df`` is read twice, once to count the rows of each chunk.
    """
    sizes = df.groupBy("_chunk").agg(F.count("*").alias("n"))
    within = F.row_number().over(W.partitionBy("_chunk").orderBy(*order_by))
    numbered = df.join(F.broadcast(chunk_offsets(sizes, "_chunk", ["n"])), "_chunk")
    return numbered.withColumn(name, F.col("n_before") + within - 1).drop("n_before")


def forward_fill(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], sources: DataFrame, chunks: int
) -> DataFrame:
    """Last non-null value so far over the whole sequence.

    ``df`` has one row per place and an ordered ``_chunk``. ``sources`` has, per chunk, the last
    non-null value of each column (chunks without any may be absent); it decides what a chunk
    takes over from the chunks before it.
    """
    earlier = W.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    every = df.sparkSession.range(chunks).select(F.col("id").alias("_chunk"))
    carried = every.join(F.broadcast(sources), "_chunk", "left").select(
        "_chunk", *[F.last(c, ignorenulls=True).over(earlier).alias(f"_carried_{c}") for c in columns]
    )
    so_far = W.partitionBy("_chunk").orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0)
    filled = df.join(F.broadcast(carried), "_chunk", "left")
    for c in columns:
        filled = filled.withColumn(
            c, F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"_carried_{c}"))
        )
    return filled.drop(*[f"_carried_{c}" for c in columns])


def backward_fill(df: DataFrame, column: str, limit: int, position: str, size: int) -> DataFrame:
    """First non-null value among a row and the ``limit`` rows after it, by consecutive position."""
    pos = F.col(position)
    copies = df.withColumn(
        "_chunk", F.explode(F.sequence(F.floor((pos - limit) / size), F.floor(pos / size)))
    )
    ahead = W.partitionBy("_chunk").orderBy(position).rangeBetween(0, limit)
    filled = copies.withColumn(column, F.first(column, ignorenulls=True).over(ahead))
    return filled.filter(in_own_chunk(position, size)).drop("_chunk")

