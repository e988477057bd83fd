"""From the five input tables to labelled features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import FLAT, FeatureSpec
from fleetlens.functions.clean import drop_incomplete, in_domain, label_or_none
from fleetlens.functions.scalar import days_between
from fleetlens.operators.binning import at_bin_edge, dedupe_mean
from fleetlens.operators.joins import join_spine_errors, lookup_join, repeat_rows
from fleetlens.operators.rolling import place_sd_by_position, rolled_bins
from fleetlens.operators.sequence import (
    MachineOrder,
    backward_fill,
    forward_fill,
    machine_order,
    number_rows,
)
from fleetlens.schemas import (
    COMPONENTS,
    ERROR_CODES,
    ERROR_COUNTS,
    ERROR_FEATURES,
    FINAL_FEATURES,
    KEYS,
    LABELED_FEATURES,
    MAINTENANCE_FEATURES,
    MEAN_BIN,
    MEAN_ROLL,
    MEASURES,
    SD_BIN,
    SD_ROLL,
    TELEMETRY_FEATURES,
)
from fleetlens.session import materialize

DEFAULT = FeatureSpec()
_SENSOR = (*MEAN_BIN, *SD_BIN, *MEAN_ROLL, *SD_ROLL)


def code_counts(events: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """How often each declared code occurs per machine and time, one column per code."""
    return events.groupBy(*KEYS).agg(
        *[F.count_if(F.col(column) == v).cast("double").alias(v) for v in values]
    )


def _order_for(spec: FeatureSpec, telemetry: DataFrame, order: MachineOrder | None) -> MachineOrder | None:
    """The order of machines is needed in flat mode only."""
    if spec.mode != FLAT:
        return None
    return order or machine_order(telemetry)


def _finish_rolled(rolled: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Complete sensor rows; in flat mode the rolling sds are placed by position first."""
    if spec.mode == FLAT:
        rolled = place_sd_by_position(rolled, MEASURES)
    return drop_incomplete(rolled, _SENSOR)


def telemetry_features(
    telemetry: DataFrame, spec: FeatureSpec = DEFAULT, order: MachineOrder | None = None
) -> DataFrame:
    """Mean and sd per bin and over the trailing bins, 16 columns per machine and bin."""
    rolled = rolled_bins(dedupe_mean(telemetry), spec, _order_for(spec, telemetry, order), MEASURES)
    return _finish_rolled(rolled, spec).select(*TELEMETRY_FEATURES)


def error_slots(errors: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Error counts at every machine and time that has telemetry; other errors are left out."""
    spine = telemetry.select(*KEYS).distinct()
    return join_spine_errors(spine, code_counts(errors, "errorID", ERROR_CODES))


def error_features(
    errors: DataFrame, telemetry: DataFrame, spec: FeatureSpec = DEFAULT, order: MachineOrder | None = None
) -> DataFrame:
    """Rolling sums of error counts, 5 columns per machine and bin."""
    order = _order_for(spec, telemetry, order)
    rolled = rolled_bins(error_slots(errors, telemetry), spec, order, counts=ERROR_CODES)
    return drop_incomplete(rolled, ERROR_COUNTS).select(*ERROR_FEATURES)


def sensor_and_error_features(
    telemetry: DataFrame, errors: DataFrame, spec: FeatureSpec = DEFAULT, order: MachineOrder | None = None
) -> DataFrame:
    """``telemetry_features`` left-joined with ``error_features``, computed in one pass.

    Both live on the same grid of bins, so the error counts ride along with the readings through
    one shuffle and one window instead of being binned again and joined.
    """
    counts = code_counts(errors, "errorID", ERROR_CODES)
    slots = join_spine_errors(dedupe_mean(telemetry), counts)
    rolled = rolled_bins(slots, spec, _order_for(spec, telemetry, order), MEASURES, ERROR_CODES)
    return _finish_rolled(rolled, spec).select(*TELEMETRY_FEATURES, *ERROR_COUNTS)


def last_replacements(
    maint: DataFrame, telemetry: DataFrame, spec: FeatureSpec = DEFAULT, order: MachineOrder | None = None
) -> DataFrame:
    """Time of the last replacement of each component, one row per machine and time.

    ``copies`` says how many rows the machine and time stands for: one per telemetry reading, or
    one for a replacement without telemetry. In flat mode a machine without an earlier replacement
    takes over the last one of the machines before it.
    """
    order = order or machine_order(telemetry, maint)
    is_comp = {c: F.col("comp") == c for c in COMPONENTS}
    place = F.struct("machineID", "datetime")
    readings = telemetry.groupBy(*KEYS).agg(F.count("*").alias("copies"))
    replaced = maint.groupBy(*KEYS).agg(*[F.bool_or(is_comp[c]).alias(c) for c in COMPONENTS])
    joined = readings.join(replaced, list(KEYS), "full_outer").na.fill(1, ["copies"])
    spine = joined.select(*KEYS, *[F.when(F.col(c), place).alias(c) for c in COMPONENTS], "copies")
    latest = [F.max(F.when(is_comp[c], place)).alias(c) for c in COMPONENTS]
    per_chunk = order.with_chunk(maint, spec.chunk_rows).groupBy("_chunk").agg(*latest)
    placed = order.with_chunk(spine, spec.chunk_rows)
    filled = forward_fill(placed, COMPONENTS, KEYS, per_chunk, order.chunks(spec.chunk_rows))

    def time(c: str):
        same = F.lit(True) if spec.mode == FLAT else F.col(f"{c}.machineID") == F.col("machineID")
        return F.when(same, F.col(f"{c}.datetime")).alias(c)

    return filled.select(*KEYS, *[time(c) for c in COMPONENTS], "copies")


def replacement_days(
    maint: DataFrame, telemetry: DataFrame, spec: FeatureSpec = DEFAULT, order: MachineOrder | None = None
) -> DataFrame:
    """Days since the last replacement, after ``start_after``; earlier rows only seed the fill."""
    replaced = last_replacements(maint, telemetry, spec, order)
    kept = replaced.filter(F.col("datetime") > F.lit(spec.start_after).cast("timestamp"))
    days = [days_between(F.col("datetime"), F.col(c)).alias(c) for c in COMPONENTS]
    return kept.select("datetime", "machineID", *days, "copies")


def maintenance_features(
    maint: DataFrame, telemetry: DataFrame, spec: FeatureSpec = DEFAULT, order: MachineOrder | None = None
) -> DataFrame:
    """Days since replacement for every telemetry row and every replacement.

    Flat mode keeps one row per telemetry reading, also where readings repeat a machine and time;
    keyed mode keeps one row per machine and time.
    """
    days = replacement_days(maint, telemetry, spec, order)
    if spec.mode == FLAT:
        days = repeat_rows(days, "copies")
    return days.select(*MAINTENANCE_FEATURES)


def failure_features(failures: DataFrame) -> DataFrame:
    """Failures by name; one of an undeclared component keeps its name, see ``undeclared``."""
    return failures.select("datetime", "machineID", "failure")


def undeclared(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """How often each value of ``column`` occurs that is not declared: rows (value, rows)."""
    return df.filter(~in_domain(column, values)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def final_features(
    telemetry_feat: DataFrame, error_feat: DataFrame, maint_feat: DataFrame, machines: DataFrame
) -> DataFrame:
    """Sensor features with error counts, days since replacement and machine attributes."""
    joined = telemetry_feat.join(error_feat, list(KEYS), "left").join(maint_feat, list(KEYS), "left")
    return lookup_join(joined, machines, ["machineID"], spread_by=["datetime"]).select(*FINAL_FEATURES)


def label_rows(
    final: DataFrame, failures: DataFrame, spec: FeatureSpec = DEFAULT, backfill_rows: int = 0, repeated: bool = True
) -> DataFrame:
    """Join failures to the rows at exactly their time; several failures give several rows.

    Equal failures are counted before the join and written out after it, together with the
    ``copies`` that a row of ``final`` may stand for. With ``backfill_rows`` a row also takes the
    first failure among that many rows after it. Without ``repeated`` equal rows stay one, whose
    number is in ``_times``, for a table that ``repeat_rows`` writes out where it is read.
    """
    if backfill_rows and not repeated:
        raise ValueError("labels are taken from rows after a row, which must be written out")
    counted = failures.groupBy(*KEYS, "failure").agg(F.count("*").alias("_times"))
    joined = final.join(counted, list(KEYS), "left").na.fill(1, ["_times"])
    if "copies" in final.columns:
        joined = joined.withColumn("_times", F.col("_times") * F.col("copies")).drop("copies")
    if not repeated:
        return joined.withColumn("failure", label_or_none()).select(*LABELED_FEATURES, "_times")
    labeled = repeat_rows(joined, "_times")
    if backfill_rows:
        labeled = backfill_labels(labeled, spec, backfill_rows)
    return labeled.withColumn("failure", label_or_none()).select(*LABELED_FEATURES)


def backfill_labels(labeled: DataFrame, spec: FeatureSpec, rows: int, column: str = "failure") -> DataFrame:
    labeled = materialize(labeled.withColumn("_own", F.col(column)), "labeled")
    order = machine_order(labeled)
    numbered = number_rows(order.with_chunk(labeled, spec.chunk_rows), [*KEYS, F.col("_own").asc_nulls_last()])
    marked = numbered.withColumn(
        column, F.when(F.col("_own").isNotNull(), F.struct("machineID", F.col("_own").alias("label")))
    )
    filled = backward_fill(marked.drop("_chunk"), column, rows, "position", spec.chunk_rows)
    label = F.col(f"{column}.label")
    if spec.mode != FLAT:
        label = F.when(F.col(f"{column}.machineID") == F.col("machineID"), label)
    return filled.withColumn(column, label).drop("_own", "position")


def label_construct(
    telemetry_feat: DataFrame,
    error_feat: DataFrame,
    maint_feat: DataFrame,
    machines: DataFrame,
    failures: DataFrame,
    spec: FeatureSpec = DEFAULT,
    backfill_rows: int = 0,
) -> DataFrame:
    """Labelled features from the separate feature tables."""
    final = final_features(telemetry_feat, error_feat, maint_feat, machines)
    return label_rows(final, failures, spec, backfill_rows)


def labeled_features(
    telemetry: DataFrame,
    errors: DataFrame,
    maint: DataFrame,
    failures: DataFrame,
    machines: DataFrame,
    spec: FeatureSpec = DEFAULT,
    backfill_rows: int = 0,
    repeated: bool = True,
) -> DataFrame:
    """The whole way from the five input tables to labelled features.

    Gives the rows of ``label_construct`` with less work: the machines are ordered once, readings
    and errors share one pass, and the fill of replacement times keeps of the telemetry only the
    readings at the end of a bin, the only ones that can meet a feature row.
    """
    order = machine_order(telemetry, maint)
    sensors = sensor_and_error_features(telemetry, errors, spec, order)
    at_end = at_bin_edge(F.col("datetime"), spec.bin_seconds)
    days = replacement_days(maint, telemetry.filter(at_end), spec, order).filter(at_end)
    joined = sensors.join(days, list(KEYS), "left")
    final = lookup_join(joined.na.fill(1, ["copies"]), machines, ["machineID"], spread_by=["datetime"])
    copies = ["copies"] if spec.mode == FLAT else []
    return label_rows(final.select(*FINAL_FEATURES, *copies), failure_features(failures), spec, backfill_rows, repeated)
