"""Selection by rank: the k-th smallest value of a column without putting the column in order.

Keys of rows are looked at as whole numbers whose order is that of the values (images). Their digits of
sixteen bits are counted from the highest on; after each count only the values that share the found digits
are looked at again. So one task never orders more than the 65,536 digits of a prefix, whatever the number
of values and however many are equal, and what the driver learns is one row per rank and digit. Numbers of
profiles are counted by parts of their range instead, which needs no image.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BITS = 16
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1
#: Images of the infinities and of NaN.
_INF, _NAN, _MINUS_INF = 0x7FF0 << 48, 0x7FF8 << 48, -(0x7FF0 << 48) - 1
_STRING_BYTES = 7


@F.pandas_udf(T.LongType())
def _double_image(values: pd.Series) -> pd.Series:
    x = values.to_numpy(np.float64, na_value=np.nan) + 0.0  # -0.0 is 0.0
    x[np.isnan(x)] = np.nan
    bits = x.view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


def double_of(image: int) -> float:
    bits = image ^ 0x7FFFFFFFFFFFFFFF if image < 0 else image
    return struct.unpack("<d", struct.pack("<q", bits))[0]


@dataclass(frozen=True)
class Image:
    """A column as a long of the same order; ``within`` says, on the column itself, that the image lies in a range."""

    column: Column
    within: Callable[[int, int], Column]

    @staticmethod
    def of_long(column: Column) -> Image:
        return Image(column, lambda low, high: column.between(F.lit(max(low, _LOWEST)), F.lit(min(high, _HIGHEST))))

    @staticmethod
    def of_double(column: Column) -> Image:
        """NaN is the greatest value."""

        def within(low: int, high: int) -> Column:
            above = column.isNotNull() if low <= _MINUS_INF else F.isnan(column) if low > _INF else column >= double_of(low)
            return above if high >= _NAN else above & ~F.isnan(column) & (column <= double_of(min(high, _INF)))

        return Image(F.when(column.isNotNull(), _double_image(column)), within)


def images(df: DataFrame, column: str) -> list[Image]:
    """Images that, compared one after the other, order rows as ``column`` ascending with nulls first."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    there = Image.of_long(value.isNotNull().cast("long"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [there, Image.of_double(value.cast("double"))]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [there, Image.of_long(F.unix_micros(value.cast("timestamp")))]
    if isinstance(kind, T.DateType):
        return [there, Image.of_long(F.unix_date(value))]
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return [there, Image.of_long(value.cast("long"))]
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return [there, Image.of_long((value * F.lit(10**kind.scale)).cast("long"))]
    if isinstance(kind, T.StringType):
        longest = df.agg(F.max(F.octet_length(value))).first()[0] or 0
        data = F.encode(value, "utf-8")
        parts = [F.conv(F.rpad(F.hex(F.substring(data, _STRING_BYTES * i + 1, _STRING_BYTES)), 2 * _STRING_BYTES, "0"), 16, 10).cast("long")
                 for i in range(-(-longest // _STRING_BYTES))]
        return [there, *map(Image.of_long, parts), Image.of_long(F.octet_length(value).cast("long"))]
    raise TypeError(f"{column} is {kind.simpleString()}, which has no order here")


@dataclass
class Found:
    """A selected image, how many are smaller and how many equal."""

    rank: int
    image: int
    before: int
    equal: int


def select(df: DataFrame, columns: Mapping[str, Image], ranks: Callable[[int], Sequence[int]]) -> dict[str, tuple[int, list[Found]]]:
    """Of each column the number of values that aren't null, and those at ``ranks(number)`` (from 0; others are left out)."""
    spans = df.agg(*[F.struct(F.min(i.column), F.max(i.column), F.count(i.column)).alias(c) for c, i in columns.items()]).first()
    out: dict[str, tuple[int, list[Found]]] = {}
    low, bits, open_ = {}, {}, []
    for c in columns:
        first, last, total = spans[c]
        wanted = [k for k in ranks(total) if 0 <= k < total]
        out[c] = (total, [Found(k, 0, 0, 0) for k in wanted])
        if wanted:
            narrow = last - first < 1 << 63
            low[c], bits[c] = (first, (last - first).bit_length()) if narrow else (_LOWEST, 64)
            open_ += [[c, n, 0, k, total] for n, k in enumerate(wanted)]  # column, which, digits so far, rank among those, equal
    shift = {c: max(0, -(-b // _BITS) * _BITS) for c, b in bits.items()}
    while any(shift[c] for c, *_ in open_):
        busy = [o for o in open_ if shift[o[0]]]
        hits = _digits(df, columns, low, shift, busy, bits)
        for o in busy:
            digit, before, equal = hits[o[0], o[2], o[3]]
            o[2], o[3], o[4] = o[2] << _BITS | digit, o[3] - before, equal
            out[o[0]][1][o[1]].before += before
        shift = {c: max(0, s - _BITS) for c, s in shift.items()}
    for c, n, digits, _, equal in open_:
        out[c][1][n].image, out[c][1][n].equal = digits + low[c], equal
    return out


def _digits(df, columns, low, shift, busy, bits) -> dict[tuple[str, int, int], tuple[int, int, int]]:
    """For each (column, digits so far, rank): the next digit, how many are smaller, and how many have it."""
    cells = []
    for c in dict.fromkeys(o[0] for o in busy):
        prefixes, s = {o[2] for o in busy if o[0] == c}, shift[c]
        # a difference of up to 64 bits, as an unsigned number
        key = columns[c].column.bitwiseXOR(F.lit(_LOWEST)) if low[c] == _LOWEST else columns[c].column - F.lit(low[c])
        prefix = F.shiftrightunsigned(key, s) if s < 64 else F.lit(0).cast("long")
        digit = F.shiftrightunsigned(key, s - _BITS).bitwiseAND(F.lit((1 << _BITS) - 1))
        if s < -(-bits[c] // _BITS) * _BITS:
            ranges = [columns[c].within((p << s) + low[c], (p << s) + (1 << s) - 1 + low[c]) for p in sorted(prefixes)]
            open_ = ranges[0]
            for r in ranges[1:]:
                open_ |= r
        else:
            open_ = columns[c].column.isNotNull()
        cells.append(F.when(open_, F.struct(F.lit(c).alias("column"), prefix.alias("prefix"), digit.alias("digit"))))
    long = df.select(F.explode(F.array_compact(F.array(*cells))).alias("_at")).select("_at.*")
    counted = long.groupBy("column", "prefix", "digit").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("column", "prefix").orderBy("digit").rowsBetween(W.unboundedPreceding, -1)
    summed = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    wanted = df.sparkSession.createDataFrame(sorted({(o[0], o[2], o[3]) for o in busy}), "column string, prefix long, rank long")
    hits = summed.join(F.broadcast(wanted), ["column", "prefix"]).filter("before <= rank AND rank < before + n")
    return {(r["column"], r["prefix"], r["rank"]): (r["digit"], r["before"], r["n"]) for r in hits.collect()}


#: Parts that a range of numbers is cut into, and so rows that are ordered together.
PARTS = 4096


def select_numbers(df: DataFrame, columns: Mapping[str, Column], ranks: Callable[[int], Sequence[int]]) -> dict[str, tuple[int, list[float]]]:
    """As ``select``, of doubles: of each column the number of values and those at ``ranks(number)``; NaN is the greatest.

    The range of all finite values is cut into equal parts and their values are counted; the part that holds
    the rank is cut again, from its smallest to its largest value, until all its values are equal. A second
    pass goes by powers of two where sizes are very different, so there are at most about seven passes.
    """
    infinite = float("inf")

    def span(x: Column) -> Column:
        finite = F.when(F.abs(x) < infinite, x)
        return F.struct(F.min(finite), F.max(finite), F.count_if(x == -infinite), F.count(finite), F.count_if(x == infinite), F.count(x))

    spans = df.agg(*[span(x.cast("double")).alias(c) for c, x in columns.items()]).first()
    out: dict[str, tuple[int, list[float]]] = {}
    open_: list[tuple[str, int, float, float, int]] = []  # column, which, range, rank within it
    for c in columns:
        low, high, below, finite, above, total = spans[c]
        wanted = [k for k in ranks(total) if 0 <= k < total]
        out[c] = (total, [-infinite if k < below else infinite if k < below + finite + above else float("nan") for k in wanted])
        for n, k in enumerate(wanted):
            if below <= k < below + finite:
                open_.append((c, n, low, high, k - below))
    passes = 0
    while open_:
        ranges = list(dict.fromkeys((c, low, high) for c, _, low, high, _ in open_))
        hits = _parts(df, columns, ranges, [(ranges.index((c, low, high)), k) for c, _, low, high, k in open_], passes == 1)
        passes += 1
        again = []
        for c, n, low, high, k in open_:
            first, last, before = hits[ranges.index((c, low, high)), k]
            if first == last:
                out[c][1][n] = first
            else:
                again.append((c, n, first, last, k - before))
        open_ = again
    return out


def _sizes_differ(low: float, high: float) -> bool:
    small, large = sorted((abs(low), abs(high)))
    return low < 0 < high or small * 2**16 < large


def _parts(df, columns, ranges, wanted, by_size) -> dict[tuple[int, int], tuple[float, float, int]]:
    """For each (number of a range, rank): smallest and largest value of the part with the rank, and how many are below it.

    ``by_size`` cuts ranges that hold very different sizes by sign and power of two.
    """
    cells = [F.when(columns[c].between(low, high), columns[c].cast("double")).alias(str(i)) for i, (c, low, high) in enumerate(ranges)]
    long = df.select(*cells).unpivot([], [str(i) for i in range(len(ranges))], "range", "value").filter("value IS NOT NULL")
    value = F.col("value")

    def of_range(*numbers: float) -> Column:
        return F.create_map(*[F.lit(x) for i, n in enumerate(numbers) for x in (str(i), n)])[F.col("range")]

    # equal parts, of halves so that no difference is infinite; each step keeps the order of values
    low = of_range(*[low for _, low, _ in ranges])
    width = of_range(*[high * 0.5 - low * 0.5 for _, low, high in ranges])
    share = F.when(width > 0, (value * 0.5 - low * 0.5) / width).otherwise((value > low).cast("double"))
    part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1))
    wide = [by_size and _sizes_differ(low, high) for _, low, high in ranges]
    if any(wide):
        size = F.floor(F.log2(F.abs(value))) + 1100  # positive for all doubles but 0
        sized = F.when(value > 0, size).when(value < 0, -size).otherwise(0)
        part = F.when(F.col("range").isin([str(i) for i, w in enumerate(wide) if w]), sized).otherwise(part)
    long = long.select(F.col("range").cast("int").alias("range"), part.alias("part"), "value")
    counted = long.groupBy("range", "part").agg(F.count("*").alias("n"), F.min("value").alias("first"), F.max("value").alias("last"))
    earlier = W.partitionBy("range").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    summed = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    asked = df.sparkSession.createDataFrame(sorted(set(wanted)), "range int, rank long")
    hits = summed.join(F.broadcast(asked), "range").filter("before <= rank AND rank < before + n")
    return {(r["range"], r["rank"]): (r["first"], r["last"], r["before"]) for r in hits.collect()}


def _smallest(df: DataFrame, keys: Sequence[Image], n: int) -> tuple[Column, Column, int, int]:
    """What tells the ``n`` smallest rows: a condition for sure ones, one for ties, how many of these belong, and how many there are."""
    sure, tie = F.lit(False), F.lit(True)
    if n <= 0:
        return sure, F.lit(False), 0, 0
    for image in keys:
        total, found = select(df.filter(tie), {"key": image}, lambda count: [n - 1])["key"]  # noqa: B023
        if not found:  # fewer rows, or only nulls, which the column's first image tells apart
            if total:
                return sure | tie, F.lit(False), 0, 0
            continue
        at = found[0]
        below, equal = image.within(_LOWEST, at.image - 1), image.within(at.image, at.image)
        if at.image > _LOWEST and at.before:
            sure |= tie & below
        tie, n = tie & equal, n - at.before
        if at.equal == n:
            return sure | tie, F.lit(False), 0, 0
    return sure, tie, n, df.filter(tie).count()


def smallest_rows(df: DataFrame, keys: Sequence[Image], n: int, narrow: DataFrame | None = None) -> DataFrame:
    """The ``n`` rows that come first by ``keys``; of rows equal in all keys any.

    ``narrow`` holds the same rows with the columns of the keys; it is read several times, ``df`` once or twice.
    """
    sure, tie, need, _ = _smallest(df if narrow is None else narrow, keys, n)
    rows = df.filter(F.coalesce(sure, F.lit(False)))
    return rows.unionByName(df.filter(tie).limit(need)) if need else rows


def rows_between(df: DataFrame, keys: Sequence[Image], start: int, stop: int, narrow: DataFrame | None = None) -> DataFrame:
    """The rows at ranks ``start`` to ``stop`` (without) by ``keys``; rows equal in all keys may stand for one another."""
    start = max(start, 0)
    if stop <= start:
        return df.limit(0)
    looked = df if narrow is None else narrow
    below, tie, skipped, size = _smallest(looked, keys, start)
    sure, last, need, _ = _smallest(looked, keys, stop)
    below, tie, sure, last = (F.coalesce(c, F.lit(False)) for c in (below, tie, sure, last))
    if skipped and need and looked.filter(tie & last).limit(1).count():  # both ends lie in one group of equal rows
        return df.filter(tie).limit(stop - start)
    rows = df.filter(sure & ~below & ~tie) if skipped else df.filter(sure & ~below)
    if skipped:
        rows = rows.unionByName(df.filter(tie).limit(size - skipped))
    return rows.unionByName(df.filter(last).limit(need)) if need else rows
