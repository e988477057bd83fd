"""Single operators: cleaning, joins, aggregates, ordering, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import adapters
from fleetlens.catalog.features import labeled
from fleetlens.catalog.registry import query
from fleetlens.catalog.sql import FEATURES_OUT, cols, compose, rnd, rnds
from fleetlens.functions import clean, scalar
from fleetlens.operators import binning, joins, ordering, summary
from fleetlens.operators.sequence import machine_order, number_rows
from fleetlens.plans.features import code_counts
from fleetlens.schemas import (
    COMPONENTS,
    ERROR_CODES,
    KEYS,
    LABELED_FEATURES,
    MEAN_BIN,
    MEASURES,
    SD_BIN,
)

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")
NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _slots(spark, sf_dir):
    return binning.dedupe_mean(adapters.inputs(spark, sf_dir).telemetry)


# Projections, filters, cleaning


@query("parse_datetime", """SELECT o_orderkey, try_strptime(t, '%Y-%m-%d %H:%M:%S') AS datetime,
try_strptime(t, '%Y-%m-%d %H:%M:%S') IS NULL AS rejected FROM (SELECT o_orderkey,
CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS t
FROM orders)""")
def parse_datetime(spark, sf_dir):
    orders = adapters.read_table(spark, sf_dir, "orders")
    full, short = (F.date_format("o_orderdate", f) for f in ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy"))
    text = orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", short).otherwise(full).alias("datetime"))
    return clean.parse_datetime(text).withColumn("rejected", F.col("datetime").isNull())


@query("category_domain", f"""SELECT c_custkey, c_mktsegment, CAST(CASE c_mktsegment
{' '.join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SEGMENTS))} END AS BIGINT) AS c_mktsegment_code,
c_mktsegment IN ({', '.join(f"'{s}'" for s in SEGMENTS)}) AS c_mktsegment_known FROM customer""")
def category_domain(spark, sf_dir):
    customers = adapters.read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return clean.with_category(customers, "c_mktsegment", SEGMENTS)


def _sds(spark, sf_dir):
    return binning.tumbling_std(_slots(spark, sf_dir), adapters.BIN_SECONDS)


@query("fill_null_zero", compose("SELECT machineID, datetime, " + ", ".join(
    rnd(f"coalesce({c}, 0)", c) for c in SD_BIN) + " FROM bins", "bins"))
def fill_null_zero(spark, sf_dir):
    return clean.fill_zero(_sds(spark, sf_dir), SD_BIN)


@query("dropna_any", compose(f"SELECT machineID, datetime, {rnds(SD_BIN)} FROM bins WHERE "
                             + " AND ".join(f"{c} IS NOT NULL" for c in SD_BIN), "bins"))
def dropna_any(spark, sf_dir):
    return clean.drop_incomplete(_sds(spark, sf_dir))


@query("filter_label_topn", compose(f"""SELECT {FEATURES_OUT}, failure FROM (SELECT * FROM labeled_keyed
WHERE failure = 'comp4' ORDER BY machineID, datetime LIMIT 16)""", "labeled_keyed"))
def filter_label_topn(spark, sf_dir):
    rows = labeled(spark, sf_dir, "keyed").filter(F.col("failure") == "comp4")
    return ordering.head(rows, KEYS, 16).select(*LABELED_FEATURES)


@query("one_hot", compose("SELECT machineID, datetime, " + ", ".join(
    f"CASE WHEN errorID = '{c}' THEN 1 ELSE 0 END AS {c}" for c in ERROR_CODES) + " FROM errors", "errors"))
def one_hot(spark, sf_dir):
    return adapters.inputs(spark, sf_dir).errors.select(*KEYS, *clean.one_hot("errorID", ERROR_CODES))


# Joins and the grid


@query("join_spine_errors", compose(f"""SELECT t.machineID, t.datetime, {cols(ERROR_CODES, 'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}')}
FROM telemetry t LEFT JOIN error_counts e ON t.machineID = e.machineID AND t.datetime = e.datetime""", "telemetry", "error_counts"))
def join_spine_errors(spark, sf_dir):
    data = adapters.inputs(spark, sf_dir)
    return joins.join_spine_errors(data.telemetry.select(*KEYS), code_counts(data.errors, "errorID", ERROR_CODES))


@query("join_spine_maint", compose(f"""SELECT coalesce(t.machineID, k.machineID) AS machineID,
coalesce(t.datetime, k.datetime) AS datetime, {cols(COMPONENTS, 'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}')}
FROM telemetry t FULL JOIN (SELECT * REPLACE (CASE WHEN machineID % 3 = 0 THEN datetime + INTERVAL 12 HOURS
ELSE datetime END AS datetime) FROM comp_counts) k ON t.machineID = k.machineID AND t.datetime = k.datetime""", "telemetry", "comp_counts"))
def join_spine_maint(spark, sf_dir):
    """All readings as the spine; replacements of every third machine are moved off it, so both sides have unmatched rows."""
    data = adapters.inputs(spark, sf_dir)
    moved = F.when(F.col("machineID") % 3 == 0, F.col("datetime") + F.expr("INTERVAL 12 HOURS")).otherwise(F.col("datetime"))
    counts = code_counts(data.maint.withColumn("datetime", moved), "comp", COMPONENTS)
    return joins.join_spine_maint(data.telemetry.select(*KEYS), counts)


@query("positional_concat", compose(f"""SELECT coalesce(a.position, b.position) AS position, {rnds(MEAN_BIN)}, {rnds(SD_BIN)}
FROM (SELECT row_number() OVER (ORDER BY machineID, datetime) - 1 AS position, {cols(MEAN_BIN)} FROM bins) a
FULL JOIN (SELECT row_number() OVER (ORDER BY machineID, datetime) - 1 AS position, {cols(SD_BIN)} FROM bins
WHERE voltsd_3h IS NOT NULL) b ON a.position = b.position""", "bins"))
def positional_concat(spark, sf_dir):
    slots, spec = _slots(spark, sf_dir), adapters.spec()
    order = machine_order(slots)
    means = order.with_chunk(binning.tumbling_mean(slots, spec.bin_seconds), spec.chunk_rows)
    sds = order.with_chunk(_sds(spark, sf_dir).filter(F.col("voltsd_3h").isNotNull()), spec.chunk_rows)
    left, right = (number_rows(df, KEYS).drop("_chunk", *KEYS) for df in (means, sds))
    return joins.concat_columns(left, right)


@query("dense_grid", compose("SELECT machineID, datetime FROM grid", "grid"))
def dense_grid(spark, sf_dir):
    return binning.dense_grid(adapters.inputs(spark, sf_dir).telemetry, adapters.BIN_SECONDS)


# Aggregates


@query("dedupe_mean", compose(f"SELECT machineID, datetime, {rnds(MEASURES)} FROM slots", "slots"))
def dedupe_mean(spark, sf_dir):
    return _slots(spark, sf_dir)


@query("tumbling_mean", compose(f"SELECT machineID, datetime, {rnds(MEAN_BIN)} FROM bins", "bins"))
def tumbling_mean(spark, sf_dir):
    return binning.tumbling_mean(_slots(spark, sf_dir), adapters.BIN_SECONDS)


@query("tumbling_std", compose(f"SELECT machineID, datetime, {rnds(SD_BIN)} FROM bins", "bins"))
def tumbling_std(spark, sf_dir):
    return _sds(spark, sf_dir)


@query("tumbling_first", compose(f"SELECT machineID, datetime, {rnds(MEASURES)} FROM bins", "bins"))
def tumbling_first(spark, sf_dir):
    return binning.tumbling_first(_slots(spark, sf_dir), adapters.BIN_SECONDS)


@query("event_counts_pivot", compose(f"SELECT machineID, datetime, {cols(ERROR_CODES)} FROM error_counts", "error_counts"))
def event_counts_pivot(spark, sf_dir):
    return summary.code_pivot(adapters.inputs(spark, sf_dir).errors, KEYS, "errorID", ERROR_CODES)


@query("wide_to_long", compose("\nUNION ALL ".join(
    f"SELECT machineID, datetime, '{m}' AS variable, {rnd(m, 'value')} FROM slots" for m in MEASURES), "slots"))
def wide_to_long(spark, sf_dir):
    return summary.wide_to_long(_slots(spark, sf_dir), KEYS, MEASURES)


@query("describe_table", "\nUNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, {rnd(f'avg({c})', 'mean')},
{rnd(f'stddev_samp({c})', 'std')}, {rnd(f'min({c})', 'min')}, {rnd(f'quantile_cont({c}, 0.25)', 'q25')},
{rnd(f'quantile_cont({c}, 0.5)', 'q50')}, {rnd(f'quantile_cont({c}, 0.75)', 'q75')}, {rnd(f'max({c})', 'max')} FROM lineitem"""
                                             for c in NUMBERS))
def describe_table(spark, sf_dir):
    return summary.describe(adapters.read_table(spark, sf_dir, "lineitem"), NUMBERS)


@query("row_counts", compose("\nUNION ALL ".join(
    f"""SELECT '{t}' AS "table", count(*) AS rows FROM {t}""" for t in ("telemetry", "errors", "maint", "failures", "machines")),
    "telemetry", "errors", "maint", "failures", "machines"))
def row_counts(spark, sf_dir):
    return summary.row_counts(vars(adapters.inputs(spark, sf_dir)))


@query("column_info", compose("\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS non_null, '{t}' AS type FROM bins"""
    for c, t in (("machineID", "bigint"), *((c, "double") for c in SD_BIN), ("datetime", "timestamp"))), "bins"))
def column_info(spark, sf_dir):
    return summary.column_info(_sds(spark, sf_dir))


@query("accuracy_metric", f"""SELECT count(*) AS rows, count(*) FILTER (WHERE quality = 1 - toxic) AS correct,
{rnd('avg(CASE WHEN quality = 1 - toxic THEN 1.0 ELSE 0.0 END)', 'accuracy')} FROM labels""")
def accuracy_metric(spark, sf_dir):
    labels = adapters.read_table(spark, sf_dir, "labels").withColumn("prediction", 1 - F.col("toxic"))
    return summary.accuracy(labels, "quality", "prediction")


# Ordering, limits, sampling


@query("sort_machine_time", compose(f"SELECT machineID, datetime, {rnds(MEASURES)} FROM slots ORDER BY machineID, datetime", "slots"))
def sort_machine_time(spark, sf_dir):
    return ordering.sort_machine_time(_slots(spark, sf_dir))


@query("head_n", compose(f"SELECT machineID, datetime, {rnds(MEASURES)} FROM slots ORDER BY machineID, datetime LIMIT 10", "slots"))
def head_n(spark, sf_dir):
    return ordering.head(_slots(spark, sf_dir), KEYS, 10)


@query("sample_n", """SELECT event_id, user_id, event_type FROM events
ORDER BY md5(CAST(event_id AS VARCHAR) || '-42'), event_id LIMIT 100""")
def sample_n(spark, sf_dir):
    events = adapters.read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return ordering.sample_rows(events, "event_id", 100, seed=42)


@query("row_slice", compose(
    f"SELECT machineID, datetime, {rnds(MEASURES)} FROM slots ORDER BY machineID, datetime LIMIT 100 OFFSET 100", "slots"))
def row_slice(spark, sf_dir):
    return ordering.row_range(_slots(spark, sf_dir), KEYS, 100, 200)


# Scalar functions


@query("days_between_frac", f"""SELECT event_id,
{rnd("(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) / 86400000000.0", 'days')} FROM events""")
def days_between_frac(spark, sf_dir):
    events = adapters.read_table(spark, sf_dir, "events")
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return events.select("event_id", scalar.days_between(F.col("ts"), noon).alias("days"))


@query("string_replace", "SELECT p_partkey, replace(p_brand || '_' || p_type, '_', '-') AS name FROM part")
def string_replace(spark, sf_dir):
    part = adapters.read_table(spark, sf_dir, "part")
    return part.select("p_partkey", scalar.dashed(F.concat_ws("_", "p_brand", "p_type")).alias("name"))


@query("serialize_request", f"""SELECT l_orderkey, l_linenumber, CAST(to_json([[{cols(NUMBERS)}]]) AS VARCHAR) AS json,
concat_ws(',', {cols(NUMBERS, 'CAST({c} AS VARCHAR)')}) AS csv FROM lineitem""")
def serialize_request(spark, sf_dir):
    lines = adapters.read_table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", scalar.json_request(NUMBERS).alias("json"), scalar.csv_request(NUMBERS).alias("csv"))
