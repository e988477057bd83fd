"""Joins against lookup tables, and key-aligned joins of feature parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import COMPONENTS, ERROR_CODES, KEYS

BROADCAST_ROWS = 500_000


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    rows: int | None = None,
    salts: int = 32,
) -> DataFrame:
    """Add the columns of a table with narrow rows and one row per key.

    The lookup is broadcast only when it is counted to be small. Otherwise both sides shuffle on
    the key and a salt taken from ``spread_by``, so that a key with a large share of all rows is
    spread over ``salts`` tasks.
    """
    on = list(on)
    if rows is None:
        rows = lookup.limit(BROADCAST_ROWS + 1).count()
    if rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(lookup), on, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def join_spine_errors(spine: DataFrame, error_counts: DataFrame) -> DataFrame:
    """Every spine row with its error counts, zero where there are none."""
    return spine.join(error_counts, list(KEYS), "left").na.fill(0, list(ERROR_CODES))


def join_spine_maint(spine: DataFrame, comp_counts: DataFrame) -> DataFrame:
    """Spine rows and replacement rows, matched where both exist, zero where there is none.

    Repeated spine rows are counted before the join and written out after it, so a time with very
    many readings is one row in the shuffle.
    """
    counted = spine.groupBy(*KEYS).agg(F.count("*").alias("_copies"))
    joined = counted.join(comp_counts, list(KEYS), "full_outer")
    return repeat_rows(joined.na.fill(0, list(COMPONENTS)).na.fill(1, ["_copies"]), "_copies")


def repeat_rows(df: DataFrame, times: str, block: int = 10_000) -> DataFrame:
    """Each row ``times`` times. Large counts are expanded in blocks, so no long array is built."""
    starts = F.sequence(F.lit(0).cast("long"), (F.col(times) - 1).cast("long"), F.lit(block).cast("long"))
    blocks = df.withColumn("_start", F.explode(starts))
    length = F.least(F.col(times) - F.col("_start"), F.lit(block)).cast("int")
    return blocks.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), length))).drop("_start", "_copy", times)


def concat_columns(left: DataFrame, right: DataFrame, position: str = "position") -> DataFrame:
    """Two frames side by side, aligned on a computed position; unmatched positions are kept."""
    return left.join(right, position, "full_outer")
