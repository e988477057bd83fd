"""Rolling windows, fills and the feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import adapters
from fleetlens.catalog.registry import query
from fleetlens.catalog.sql import FEATURES_OUT, SENSOR, cols, compose, rnds
from fleetlens.config import FLAT
from fleetlens.operators.binning import dedupe_mean
from fleetlens.operators.rolling import rolled_bins
from fleetlens.operators.sequence import backward_fill, machine_order, number_rows
from fleetlens.plans import features as plans
from fleetlens.schemas import COMPONENTS, ERROR_CODES, ERROR_COUNTS, KEYS, MEAN_ROLL, MEASURES, SD_ROLL

MODES = ("flat", "keyed")


def _name(base: str, mode: str) -> str:
    return base if mode == "flat" else f"{base}_keyed"


def _rolled(spark, sf_dir, mode, columns, what):
    data, spec = adapters.inputs(spark, sf_dir), adapters.spec(mode)
    order = machine_order(data.telemetry) if mode == FLAT else None
    if what == "errors":
        rolled = rolled_bins(plans.error_slots(data.errors, data.telemetry), spec, order, counts=ERROR_CODES)
    else:
        rolled = rolled_bins(dedupe_mean(data.telemetry), spec, order, MEASURES)
    return rolled.select(*KEYS, *columns).na.drop("any")


def _final(spark, sf_dir, mode):
    data, spec = adapters.inputs(spark, sf_dir), adapters.spec(mode)
    order = machine_order(data.telemetry, data.maint)
    return plans.final_features(
        plans.telemetry_features(data.telemetry, spec, order),
        plans.error_features(data.errors, data.telemetry, spec, order),
        plans.maintenance_features(data.maint, data.telemetry, spec, order),
        data.machines,
    )


def labeled(spark, sf_dir, mode="flat", backfill_rows=0, repeated=True):
    data = adapters.inputs(spark, sf_dir)
    return plans.labeled_features(
        data.telemetry, data.errors, data.maint, data.failures, data.machines, adapters.spec(mode), backfill_rows, repeated
    )


def _register(mode: str) -> None:
    for base, columns, what in (
        ("rolling_mean_24", MEAN_ROLL, "sensors"),
        ("rolling_std_24", SD_ROLL, "sensors"),
        ("rolling_error_sum_24", ERROR_COUNTS, "errors"),
    ):
        complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)

        @query(_name(base, mode), compose(
            f"SELECT machineID, datetime, {rnds(columns)} FROM rolled_{mode} WHERE {complete}", f"rolled_{mode}"))
        def rolling(spark, sf_dir, columns=columns, what=what):
            return _rolled(spark, sf_dir, mode, columns, what)

    replaced = compose(
        f"SELECT DISTINCT machineID, datetime, {cols(COMPONENTS)} FROM replaced_{mode}", f"replaced_{mode}")

    @query(_name("ffill_last", mode), replaced)
    def ffill_last(spark, sf_dir):
        data = adapters.inputs(spark, sf_dir)
        return plans.last_replacements(data.maint, data.telemetry, adapters.spec(mode)).drop("copies")

    part = "" if mode == "flat" else "PARTITION BY machineID "

    @query(_name("bfill_limit7", mode), compose(f"""SELECT machineID, datetime, first_value(failure IGNORE NULLS) OVER
      ({part}ORDER BY machineID, datetime ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS failure FROM
      (SELECT s.machineID, s.datetime, x.failure FROM slots s LEFT JOIN
       (SELECT machineID, datetime, max(failure) AS failure FROM failures GROUP BY machineID, datetime) x
       ON s.machineID = x.machineID AND s.datetime = x.datetime)""", "slots", "failures"))
    def bfill_limit7(spark, sf_dir):
        data = adapters.inputs(spark, sf_dir)
        last = data.failures.groupBy(*KEYS).agg(F.max("failure").alias("failure"))
        rows = data.telemetry.select(*KEYS).distinct().join(last, list(KEYS), "left")
        return plans.backfill_labels(rows, adapters.spec(mode), 7).select(*KEYS, "failure")

    @query(_name("telemetry_features", mode), compose(
        f"SELECT machineID, datetime, {rnds(SENSOR)} FROM tele_{mode}", f"tele_{mode}"))
    def telemetry_features(spark, sf_dir):
        return plans.telemetry_features(adapters.inputs(spark, sf_dir).telemetry, adapters.spec(mode))

    @query(_name("error_features", mode), compose(
        f"SELECT machineID, datetime, {rnds(ERROR_COUNTS)} FROM err_{mode}", f"err_{mode}"))
    def error_features(spark, sf_dir):
        data = adapters.inputs(spark, sf_dir)
        return plans.error_features(data.errors, data.telemetry, adapters.spec(mode))

    @query(_name("maintenance_features", mode), compose(
        f"SELECT datetime, machineID, {rnds(COMPONENTS)} FROM maint_{mode}", f"maint_{mode}"))
    def maintenance_features(spark, sf_dir):
        data = adapters.inputs(spark, sf_dir)
        return plans.maintenance_features(data.maint, data.telemetry, adapters.spec(mode))

    @query(_name("final_features", mode), compose(f"SELECT {FEATURES_OUT} FROM final_{mode}", f"final_{mode}"))
    def final_features(spark, sf_dir):
        return _final(spark, sf_dir, mode)

    @query(_name("labeled_features", mode), compose(f"SELECT {FEATURES_OUT}, failure FROM labeled_{mode}", f"labeled_{mode}"))
    def labeled_features(spark, sf_dir):
        return labeled(spark, sf_dir, mode)

    @query(_name("labeled_features_backfilled", mode), compose(
        f"SELECT {FEATURES_OUT}, failure FROM backfilled_{mode}", f"backfilled_{mode}"))
    def labeled_features_backfilled(spark, sf_dir):
        return labeled(spark, sf_dir, mode, backfill_rows=7)


for _mode in MODES:
    _register(_mode)


@query("failure_features", compose("SELECT datetime, machineID, failure FROM failures", "failures"))
def failure_features(spark, sf_dir):
    return plans.failure_features(adapters.inputs(spark, sf_dir).failures)


@query("label_construct", compose(f"SELECT {FEATURES_OUT}, failure FROM labeled_flat", "labeled_flat"))
def label_construct(spark, sf_dir):
    """The labelled table joined from the separate feature tables."""
    data = adapters.inputs(spark, sf_dir)
    return plans.label_rows(_final(spark, sf_dir, FLAT), plans.failure_features(data.failures), adapters.spec())


@query("global_row_number", compose(
    "SELECT machineID, datetime, row_number() OVER (ORDER BY machineID, datetime) - 1 AS position FROM slots", "slots"))
def global_row_number(spark, sf_dir):
    data, spec = adapters.inputs(spark, sf_dir), adapters.spec()
    order = machine_order(data.telemetry)
    slots = data.telemetry.select(*KEYS).distinct()
    return number_rows(order.with_chunk(slots, spec.chunk_rows), KEYS).select(*KEYS, "position")
