"""Stateful operators of our own: hours that say which rows came too late, and trailing bins per machine.

Spark's windowed aggregates drop rows behind the watermark without a trace. The operators here get every
row: they read the time as a plain number, so that nothing is filtered before them, and compare it with the
watermark themselves. Rows in time go into the state, late ones come out as they are.

Both need the RocksDB state store, which ``started`` sets for the query it starts and for no other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fleetlens.config import FeatureSpec
from fleetlens.plans.monitor import BUCKETS, Bounds
from fleetlens.schemas import MEASURES, TELEMETRY_FEATURES

HOUR_MS = 3_600_000
#: An hour's rows are dealt to so many keys, since one hour may hold a third of all rows.
SHARDS = 4
#: Machines are dealt to so many keys, since a call for a key costs milliseconds however little it holds.
MACHINE_SHARDS = 1024
#: Stands for the time of a reading without one.
NO_TIME = -(1 << 60)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def started(rows: DataFrame, path: str, checkpoint: str, trigger) -> StreamingQuery:
    """Write every batch to a folder of its own below ``path``, overwritten if the batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    spark = rows.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def _with_columns(rows: pd.DataFrame, columns: Sequence[str]) -> pd.DataFrame:
    """``rows`` with all of ``columns``, null where it has none."""
    none = {c: pd.Series([None] * len(rows), index=rows.index, dtype=object) for c in columns if c not in rows}
    return rows.assign(**none)[list(columns)]


class HourProfiles(StatefulProcessor):
    """Profile of one shard of an hour; late rows go through."""

    def __init__(self, columns: Sequence[str], bounds: Bounds):
        self.columns, self.bounds = list(columns), dict(bounds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("profile", "profile array<array<double>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hour, shard = key
        end = (int(hour) + 1) * HOUR_MS
        if end <= timerValues.getCurrentWatermarkInMs():
            for batch in rows:
                late = batch[["ts_us", *self.columns]].copy()
                late.insert(0, "late", True)
                yield self.out(late)
            return
        if (found := self.state.get()) is not None:
            profile = [list(p) for p in found[0]]
        else:
            profile = [[0.0] * (4 + BUCKETS) + [np.inf, -np.inf] for _ in self.columns]
            self.handle.registerTimer(end)
        for batch in rows:
            profile = [self.merged(p, batch[c].to_numpy(np.float64), c) for p, c in zip(profile, self.columns)]
        self.state.update((profile,))
        yield self.out(pd.DataFrame({
            "late": False, "hour": int(hour), "shard": int(shard), "feature": self.columns, "profile": profile}))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()  # the hour is closed; its profile was written when it last changed
        return iter([])

    def close(self) -> None:
        pass

    def merged(self, old: list[float], values: np.ndarray, column: str) -> list[float]:
        """[present, missing, mean, squares, buckets, low, high] with further values."""
        there = values[~np.isnan(values)]
        n, m = old[0], len(there)
        out = [n + m, old[1] + len(values) - m, old[2], old[3], *old[4:]]
        if m:
            mean, step = there.mean(), there.mean() - old[2]
            out[2] = old[2] + step * m / (n + m)
            out[3] = old[3] + ((there - mean) ** 2).sum() + step**2 * n * m / (n + m)
            low, high = self.bounds[column]
            place = np.floor((there - low) * BUCKETS / (high - low)) if high > low else np.zeros(m)
            counts = np.bincount(np.clip(place, 0, BUCKETS - 1).astype(int), minlength=BUCKETS)
            out[4 : 4 + BUCKETS] = (np.array(old[4 : 4 + BUCKETS]) + counts).tolist()
            out[4 + BUCKETS] = min(old[4 + BUCKETS], there.min())
            out[5 + BUCKETS] = max(old[5 + BUCKETS], there.max())
        return [float(x) for x in out]

    def out(self, rows: pd.DataFrame) -> pd.DataFrame:
        return _with_columns(rows, ["late", "hour", "shard", "feature", "profile", "ts_us", *self.columns])


def hour_profiles(events: DataFrame, columns: Sequence[str], bounds: Bounds, ts: str = "ts", delay: str = "10 minutes", shards: int = SHARDS) -> DataFrame:
    """A stream of profiles of hours (several per hour, merged by ``read_hours``) and of late rows.

    A row is late if its hour ended at or before the watermark, ``delay`` behind the newest time of the
    batches before. Rows without a time are late. ``columns`` are numbers; those without bounds need none
    if they have no value.
    """
    timed = events.withWatermark(ts, delay)
    us = F.unix_micros(ts)
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    hour = F.coalesce(F.floor(us / (1000 * HOUR_MS)), F.lit(-(1 << 40)))
    shard = F.pmod(F.xxhash64(us, *numbers), F.lit(shards))
    keyed = timed.select(hour.alias("_hour"), shard.alias("_shard"), us.alias("ts_us"), *numbers)
    schema = "late boolean, hour long, shard long, feature string, profile array<double>, ts_us long, " + ", ".join(f"`{c}` double" for c in columns)
    found = {c: bounds.get(c, (0.0, 0.0)) for c in columns}
    return keyed.groupBy("_hour", "_shard").transformWithStateInPandas(HourProfiles(columns, found), schema, "update", "eventTime")


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """Profiles of hours and features as of the newest batches: hour, feature, present, missing, mean, total, sd, low, high, buckets."""
    rows = spark.read.parquet(path).filter("NOT late")
    newest = rows.groupBy("hour", "shard", "feature").agg(F.max_by("profile", "batch").alias("p"))
    at = lambda i: F.col("p")[i]
    shards = newest.withColumn("_total", at(0) * at(2))
    sums = shards.groupBy("hour", "feature").agg(
        F.sum(at(0)).cast("long").alias("present"), F.sum(at(1)).cast("long").alias("missing"), F.sum("_total").alias("total"),
        F.sum(at(3)).alias("_squares"), F.collect_list(F.struct(at(0).alias("n"), at(2).alias("mean"))).alias("_means"),  # one per shard
        F.min(at(4 + BUCKETS)).alias("low"), F.max(at(5 + BUCKETS)).alias("high"),
        *[F.sum(at(4 + i)).cast("long").alias(f"bucket{i}") for i in range(BUCKETS)])
    some = F.col("present") > 0
    mean = F.when(some, F.col("total") / F.col("present"))
    between = F.aggregate("_means", F.lit(0.0), lambda s, m: s + m["n"] * (m["mean"] - F.col("mean")) ** 2)
    sd = F.when(F.col("present") > 1, F.sqrt((F.col("_squares") + between) / (F.col("present") - 1)))
    return sums.withColumn("mean", mean).select(
        F.timestamp_seconds(F.col("hour") * (HOUR_MS // 1000)).alias("hour"), "feature", "present", "missing", "mean",
        F.when(some, F.col("total")).alias("total"), sd.alias("sd"), F.when(some, F.col("low")).alias("low"),
        F.when(some, F.col("high")).alias("high"), *[f"bucket{i}" for i in range(BUCKETS)])


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Late rows: their time as ``ts``, their numbers, and the ``batch`` they came in."""
    rows = spark.read.parquet(path).filter("late")
    return rows.select(F.timestamp_micros("ts_us").alias("ts"), *[c for c in rows.columns if c not in (
        "late", "hour", "shard", "feature", "profile", "ts_us")])


def late_stream(events: DataFrame, columns: Sequence[str], bounds: Bounds, path: str, checkpoint: str, ts: str = "ts", delay: str = "10 minutes", trigger={"availableNow": True}) -> StreamingQuery:
    """Profile hours as ``jobs.hourly_stream`` does, and keep the rows that came too late for theirs."""
    return started(hour_profiles(events, columns, bounds, ts, delay), path, checkpoint, trigger)


class TrailingBins(StatefulProcessor):
    """Open slots and the last closed bins of the machines of a shard, all worked on at once.

    The open table holds per machine and time of a reading the sums and counts of each measure. When the
    watermark has passed a bin's end, its slots become mean, sd and first value, the first values join the
    machine's ring of the last ``window_rows`` bins, and the bin's row comes out if its whole window is there.
    """

    def __init__(self, spec: FeatureSpec):
        self.seconds, self.rows, self.size = spec.bin_seconds, spec.window_rows, len(MEASURES)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "bins", "open binary, open_values binary, ring binary, ring_values binary, due long")

    def load(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """(machine, slot) and (sums, counts) of open slots, (machine, bin) and values of the ring, both in order, and the timer."""
        found = self.state.get() or (b"", b"", b"", b"", 0)
        kinds = ((np.int64, 2), (np.float64, 2 * self.size), (np.int64, 2), (np.float64, self.size))
        return *[np.frombuffer(bytes(x), kind).reshape(-1, n) for x, (kind, n) in zip(found, kinds)], found[4]

    def save(self, slots: np.ndarray, sums: np.ndarray, ring: np.ndarray, values: np.ndarray, due: int) -> None:
        """``due`` is the time (ms) of the one timer that waits for the first open bin; 0 without one."""
        width = self.seconds * 1_000_000
        if len(slots):
            first = (int(slots[:, 1].min()) // width + 1) * (width // 1000)
            if not due or first < due:
                self.handle.registerTimer(due := first)
        self.state.update((*[x.tobytes() for x in (slots, sums, ring, values)], due))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        slots, sums, ring, values, due = self.load()
        width = self.seconds * 1_000_000
        parts, columns = [], [f"{s}_{m}" for s in ("sum", "n") for m in MEASURES]
        for batch in rows:
            at = batch["slot_us"].to_numpy(np.int64)
            late = (at // width + 1) * (width // 1000) <= timerValues.getCurrentWatermarkInMs()
            if late.any():
                found = batch[late].assign(late=True)
                found["slot_us"] = found["slot_us"].astype("Int64").mask(found["slot_us"] == NO_TIME)
                yield self.out(found, key)
            if not late.all():
                parts.append(batch[~late].groupby(["machineID", "slot_us"])[columns].sum())
        if parts:
            parts.append(pd.DataFrame(sums, columns=columns, index=pd.MultiIndex.from_arrays(slots.T, names=["machineID", "slot_us"])))
            summed = pd.concat(parts).groupby(level=[0, 1]).sum()  # in order of machine and slot
            slots = np.column_stack([summed.index.get_level_values(i).to_numpy(np.int64) for i in (0, 1)])
            sums = summed[columns].to_numpy(np.float64)
            self.save(slots, np.ascontiguousarray(sums), ring, values, due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Close all bins that the watermark has passed."""
        slots, sums, ring, values, _ = self.load()
        width = self.seconds * 1_000_000
        closed = slots[:, 1] // width <= timerValues.getCurrentWatermarkInMs() // (width // 1000) - 1
        mine, of = np.column_stack([slots[closed, 0], slots[closed, 1] // width]), sums[closed]
        slots, sums = slots[~closed], sums[~closed]
        if not len(mine):
            self.save(slots, sums, ring, values, 0)
            return
        with np.errstate(invalid="ignore", divide="ignore"):
            means = of[:, : self.size] / of[:, self.size :]
        starts = np.flatnonzero(np.r_[True, (mine[1:] != mine[:-1]).any(1)])
        bins, there = mine[starts], ~np.isnan(means)
        n = np.add.reduceat(there, starts, 0, dtype=np.int64)
        mean = np.where(n > 0, np.add.reduceat(np.where(there, means, 0), starts, 0) / np.maximum(n, 1), np.nan)
        number = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(mine)]))
        squares = np.add.reduceat(np.where(there, means - mean[number], 0) ** 2, starts, 0)
        sd = np.where(n > 1, np.sqrt(squares / np.maximum(n - 1, 1)), np.nan)
        place = np.minimum.reduceat(np.where(there, np.arange(len(mine))[:, None], len(mine) - 1), starts, 0)
        first = means[place, np.arange(self.size)]  # NaN without a reading
        first[n == 0] = np.nan

        every, values = np.concatenate([ring, bins]), np.concatenate([values, first])
        order = np.lexsort((every[:, 1], every[:, 0]))
        every, values = every[order], values[order]
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        at = at[len(ring) :]  # of each closed bin
        start = at - self.rows + 1
        from_ = np.maximum(start, 0)
        full = (start >= 0) & (every[from_, 0] == bins[:, 0]) & (every[from_, 1] == bins[:, 1] - self.rows + 1)
        window = values[start[full, None] + np.arange(self.rows)]
        rolled = window.mean(1)
        spread = np.sqrt(((window - rolled[:, None]) ** 2).sum(1) / (self.rows - 1)) if self.rows > 1 else np.full_like(rolled, np.nan)
        out = np.column_stack([mean[full], sd[full], rolled, spread])
        whole = ~np.isnan(out).any(1)

        last = np.r_[every[1:, 0] != every[:-1, 0], True]
        newest = every[last, 1][np.cumsum(last) - last]  # of the machine
        kept = every[:, 1] > newest - self.rows
        self.save(slots, sums, every[kept], values[kept], 0)
        if whole.any():
            names = [c for c in TELEMETRY_FEATURES if c not in ("machineID", "datetime")]
            rows = pd.DataFrame(out[whole], columns=names)
            found = bins[full][whole]
            yield self.out(rows.assign(late=False, machineID=found[:, 0], slot_us=(found[:, 1] + 1) * width), key)

    def close(self) -> None:
        pass

    def out(self, rows: pd.DataFrame, key) -> pd.DataFrame:
        if key[0] == -1:  # readings without a machine; Spark mixes up keys of a batch that has a null one
            rows = rows.assign(machineID=pd.Series([None] * len(rows), index=rows.index, dtype=object))
        names = [c for c in TELEMETRY_FEATURES if c not in ("machineID", "datetime")]
        return _with_columns(rows, ["late", "machineID", "slot_us", *names, *[f"{s}_{m}" for m in MEASURES for s in ("sum", "n")]])


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Readings of a machine and time become one row of sums, so that a busy machine gives few rows."""
    for batch in batches:
        groups = batch.groupby(["machineID", "slot_us"], dropna=False, sort=False)[list(MEASURES)]
        sums, counts = groups.sum(), groups.count()
        sums.columns, counts.columns = [f"sum_{m}" for m in MEASURES], [f"n_{m}" for m in MEASURES]
        yield pd.concat([sums, counts], axis=1).reset_index()


def trailing_features(telemetry: DataFrame, spec: FeatureSpec, delay: str = "0 seconds", shards: int = MACHINE_SHARDS) -> DataFrame:
    """A stream of ``plans.features.telemetry_features`` in keyed mode, each row as its bin closes, and of late readings.

    A bin closes when the watermark, ``delay`` behind the newest reading of the batches before, passes its
    end; it takes a later batch to close the newest bins. Readings of a closed bin, or without a time, are
    late. State per machine: the open slots and ``window_rows`` bins; a machine that sends nothing more keeps
    its last ring. The machines of a shard share a state, which is read and written in one piece: raise
    ``shards`` with many millions of machines.
    """
    numbers = [F.col(m).cast("double").alias(m) for m in MEASURES]
    timed = telemetry.withWatermark("datetime", delay).select(
        F.col("machineID").cast("long").alias("machineID"), F.unix_micros("datetime").alias("slot_us"), *numbers)
    sums = ", ".join(f"sum_{m} double" for m in MEASURES) + ", " + ", ".join(f"n_{m} long" for m in MEASURES)
    combined = timed.mapInPandas(_combine, f"machineID long, slot_us long, {sums}")
    machine = F.col("machineID")
    keyed = combined.withColumn("_shard", F.when(machine.isNull(), -1).otherwise(F.pmod(F.xxhash64(machine), F.lit(shards)))).withColumns(
        {"machineID": F.coalesce(machine, F.lit(0).cast("long")), "slot_us": F.coalesce("slot_us", F.lit(NO_TIME).cast("long"))})
    names = [c for c in TELEMETRY_FEATURES if c not in ("machineID", "datetime")]
    schema = "late boolean, machineID long, slot_us long, " + ", ".join(f"`{c}` double" for c in names) + ", " + ", ".join(
        f"sum_{m} double, n_{m} double" for m in MEASURES)
    return keyed.groupBy("_shard").transformWithStateInPandas(TrailingBins(spec), schema, "update", "eventTime")


def features_stream(telemetry: DataFrame, spec: FeatureSpec, path: str, checkpoint: str, delay: str = "0 seconds", trigger={"availableNow": True}) -> StreamingQuery:
    return started(trailing_features(telemetry, spec, delay), path, checkpoint, trigger)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path).filter("NOT late")
    return rows.withColumn("datetime", F.timestamp_micros("slot_us")).select(*TELEMETRY_FEATURES)


def read_late_readings(spark: SparkSession, path: str) -> DataFrame:
    """Sums and counts of the late readings of a machine and time, with the ``batch`` they came in."""
    rows = spark.read.parquet(path).filter("late")
    return rows.select("machineID", F.timestamp_micros("slot_us").alias("datetime"), *[
        c for m in MEASURES for c in (f"sum_{m}", f"n_{m}")], "batch")
