"""Profiles, drift, bias, captured records and streams of them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import adapters
from fleetlens.catalog.registry import query
from fleetlens.catalog.sql import cols, rnd
from fleetlens.catalog.tables import CAPTURED, SAMPLE_PERCENT, capture_records
from fleetlens.functions.records import apply_handler, apply_preprocessor, positional_features
from fleetlens.operators import ranks
from fleetlens.plans import monitor, sketches
from fleetlens.plans.bias import pretraining_bias
from fleetlens.plans.monitor import BUCKET_COLUMNS, BUCKETS
from fleetlens.schemas import CAPTURE
from fleetlens.session import new_path
from fleetlens.sources import capture
from fleetlens.streaming import jobs

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
EVENT_NUMBERS = ("value", "k")
CUT = "1998-07-01 00:00:00"


def _profile_sql(source: str, bounds: str, columns, by: str = "") -> str:
    """Long rows of ``source`` profiled in SQL over the bounds of ``bounds``, a (feature, lo, hi) table."""
    long = " UNION ALL ".join(f"SELECT {by}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns)
    buckets = ", ".join(f"count(*) FILTER (WHERE b = {i}) AS {name}" for i, name in enumerate(BUCKET_COLUMNS))
    return f"""SELECT {by}feature, count(value) AS present, count(*) - count(value) AS missing, avg(value) AS mean,
  sum(value) AS total, stddev_samp(value) AS sd, min(value) AS low, max(value) AS high, {buckets} FROM
  (SELECT *, CASE WHEN value IS NOT NULL THEN least({BUCKETS - 1}, greatest(0,
     CASE WHEN hi > lo THEN floor((value - lo) * {BUCKETS} / (hi - lo)) ELSE 0 END)) END AS b
   FROM ({long}) JOIN {bounds} USING (feature)) GROUP BY {by}feature"""


def _bounds_sql(source: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {source}" for c in columns)


_STATS = ", ".join(rnd(c) for c in ("mean", "sd", "low", "high")) + ", " + rnd("total", digits=2)


@query("baseline_statistics", f"""WITH bounds AS ({_bounds_sql('lineitem', NUMBERS)}),
stats AS ({_profile_sql('lineitem', 'bounds', NUMBERS)})
SELECT feature, 'Fractional' AS inferred_type, present, missing, {_STATS}, {cols(BUCKET_COLUMNS)} FROM stats""")
def baseline_statistics(spark, sf_dir):
    stats = monitor.baseline_statistics(adapters.read_table(spark, sf_dir, "lineitem"), NUMBERS)
    return stats.withColumn("total", F.round(F.col("total"), 2))


@query("baseline_constraints", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, '{t}' AS inferred_type, {rnd(f'count({c}) / count(*)', 'completeness')},
min({c}) >= 0 AS non_negative FROM {src}""" for c, t, src in (
        ("c_acctbal", "Fractional", "customer"), ("c_nationkey", "Integral", "customer"))))
def baseline_constraints(spark, sf_dir):
    customers = adapters.read_table(spark, sf_dir, "customer")
    return monitor.baseline_constraints(monitor.baseline_statistics(customers, ("c_acctbal", "c_nationkey")))


_DISTANCE = "greatest(" + ", ".join(
    f"abs(({' + '.join('p.' + b for b in BUCKET_COLUMNS[: i + 1])}) / p.present - ({' + '.join('q.' + b for b in BUCKET_COLUMNS[: i + 1])}) / q.present)"
    for i in range(BUCKETS)) + ")"


def _violations_sql(batch: str, baseline: str, by: str = "") -> str:
    completeness = "{a}.present / ({a}.present + {a}.missing)"
    mine, base = completeness.format(a="p"), completeness.format(a="q")
    checks = (
        (f"{mine} < {base}", "completeness_check", mine, base, "share of present values is below the baseline"),
        ("p.low < 0 AND q.low >= 0", "non_negative_check", "p.low", "0", "negative values where the baseline has none"),
        (f"p.present > 0 AND {_DISTANCE} > 0.1", "baseline_drift_check", _DISTANCE, "0.1", "distance to the baseline distribution is above the limit"),
    )
    return " UNION ALL ".join(f"""SELECT {by}p.feature AS feature, '{name}' AS "check", {rnd(f'CAST({seen} AS DOUBLE)', 'observed')},
  {rnd(f'CAST({allowed} AS DOUBLE)', 'allowed')}, '{text}' AS description FROM {batch} p JOIN {baseline} q ON p.feature = q.feature
  WHERE {failed}""" for failed, name, seen, allowed, text in checks)


def _drift_sql(batch_columns: str) -> str:
    return f"""WITH before AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}'),
after AS (SELECT {batch_columns} FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}'),
bounds AS ({_bounds_sql('before', NUMBERS)}),
base AS ({_profile_sql('before', 'bounds', NUMBERS)}), batch AS ({_profile_sql('after', 'bounds', NUMBERS)})
{_violations_sql('batch', 'base')}"""


def _before_after(spark, sf_dir):
    lines = adapters.read_table(spark, sf_dir, "lineitem")
    cut = F.lit(CUT).cast("timestamp")
    return lines.filter(F.col("l_shipdate") < cut), lines.filter(F.col("l_shipdate") >= cut)


@query("drift_violations", _drift_sql("""l_quantity * 1.5 AS l_quantity, l_extendedprice,
CASE WHEN l_returnflag <> 'R' THEN l_discount END AS l_discount, l_tax - 0.01 AS l_tax"""))
def drift_violations(spark, sf_dir):
    """Later lines with a shift, missing values and negative values put in."""
    before, after = _before_after(spark, sf_dir)
    changed = after.select(
        (F.col("l_quantity") * 1.5).alias("l_quantity"), "l_extendedprice",
        F.when(F.col("l_returnflag") != "R", F.col("l_discount")).alias("l_discount"),
        (F.col("l_tax") - 0.01).alias("l_tax"),
    )
    return monitor.drift_violations(before, changed, NUMBERS)


@query("drift_none", _drift_sql("*"))
def drift_none(spark, sf_dir):
    """Later lines as they are: nothing is reported."""
    return monitor.drift_violations(*_before_after(spark, sf_dir), NUMBERS)


FLAGS = ("l_returnflag", "l_linestatus", "l_discount")
_TEXTS = FLAGS[:2]


@query("baseline_categories", "\nUNION ALL ".join(f"""SELECT '{c}' AS feature, 'String' AS inferred_type, present, missing, "distinct",
domain, category, n, {rnd('n / present', 'share')} FROM (SELECT {c} AS category, count(*) AS n FROM orders LEFT JOIN lineitem
ON o_orderkey = l_orderkey AND l_quantity > 40 WHERE {c} IS NOT NULL GROUP BY {c}), (SELECT count({c}) AS present, count(*) - count({c}) AS missing,
count(DISTINCT {c}) AS "distinct", string_agg(DISTINCT {c}, ',' ORDER BY {c}) AS domain FROM orders LEFT JOIN lineitem
ON o_orderkey = l_orderkey AND l_quantity > 40)""" for c in _TEXTS) + """
UNION ALL SELECT 'l_discount', 'Fractional', count(l_discount), count(*) - count(l_discount), NULL, NULL, NULL, NULL, NULL
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_quantity > 40""")
def baseline_categories(spark, sf_dir):
    """Text and number features of orders with their large lines; orders without one have none."""
    lines = adapters.read_table(spark, sf_dir, "lineitem").filter("l_quantity > 40")
    orders = adapters.read_table(spark, sf_dir, "orders")
    mixed = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").select(*FLAGS)
    stats = monitor.baseline_statistics(mixed, FLAGS)
    domains = monitor.baseline_constraints(stats).select("feature", F.array_join("domain", ",").alias("domain"))
    rows = stats.join(domains, "feature").select(
        "feature", "inferred_type", "present", "missing", "distinct", "domain", F.inline_outer("categories"))
    return rows.withColumnsRenamed({"item": "category", "count": "n"}).withColumn("share", F.col("n") / F.col("present"))


_FLAG_SHARES = "\nUNION ALL ".join(f"""SELECT '{c}' AS feature, {c} AS category, count(*) FILTER (WHERE NOT later) / sum(count(*) FILTER (WHERE NOT later)) OVER () AS p,
count(*) FILTER (WHERE later) / sum(count(*) FILTER (WHERE later)) OVER () AS q FROM flags GROUP BY {c}""" for c in _TEXTS)


@query("drift_categories", f"""WITH flags AS (SELECT l_shipdate >= TIMESTAMP '{CUT}' AS later,
CASE WHEN l_shipdate >= TIMESTAMP '{CUT}' AND l_quantity > 30 THEN 'X' ELSE l_returnflag END AS l_returnflag,
CASE WHEN l_shipdate >= TIMESTAMP '{CUT}' AND l_quantity > 25 THEN 'F' ELSE l_linestatus END AS l_linestatus FROM lineitem),
shares AS ({_FLAG_SHARES}),
found AS (SELECT feature, 'baseline_drift_check' AS "check", max(abs(p - q)) AS observed, CAST(0.1 AS DOUBLE) AS allowed,
'distance to the baseline distribution is above the limit' AS description FROM shares GROUP BY feature HAVING max(abs(p - q)) > 0.1
UNION ALL SELECT feature, 'categorical_values_check', sum(q) FILTER (WHERE p = 0), 0, 'values outside those of the baseline' FROM shares
GROUP BY feature HAVING sum(q) FILTER (WHERE p = 0) > 0)
SELECT feature, "check", {rnd('observed')}, {rnd('allowed')}, description FROM found""")
def drift_categories(spark, sf_dir):
    """Later lines with a new return flag and more lines of one status."""
    before, after = _before_after(spark, sf_dir)
    changed = after.withColumns({
        "l_returnflag": F.when(F.col("l_quantity") > 30, F.lit("X")).otherwise(F.col("l_returnflag")),
        "l_linestatus": F.when(F.col("l_quantity") > 25, F.lit("F")).otherwise(F.col("l_linestatus"))})
    return monitor.drift_violations(before, changed, FLAGS)


def _numbered_events(spark, sf_dir):
    events = adapters.read_table(spark, sf_dir, "events")
    return events.select("ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))


_EVENTS = "numbered AS (SELECT date_trunc('hour', ts) AS hour, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)"
_HOURLY = f"""WITH {_EVENTS}, bounds AS ({_bounds_sql('numbered', EVENT_NUMBERS)}),
hours AS ({_profile_sql('numbered', 'bounds', EVENT_NUMBERS, by='hour, ')})"""


@query("drift_hourly", f"""{_HOURLY}, base AS ({_profile_sql('numbered', 'bounds', EVENT_NUMBERS)})
SELECT p.hour, p.feature, p.present, {rnd(_DISTANCE, 'distance')} FROM hours p JOIN base q ON p.feature = q.feature""")
def drift_hourly(spark, sf_dir):
    events = _numbered_events(spark, sf_dir)
    bounds = monitor.value_bounds(events, EVENT_NUMBERS)
    baseline = monitor.baseline_statistics(events, EVENT_NUMBERS, bounds)
    return monitor.hourly_drift(events, baseline, EVENT_NUMBERS, bounds)


_KS_LINES = """lines AS (SELECT l_orderkey, l_linenumber, l_shipdate >= TIMESTAMP '{cut}' AS later, CASE WHEN l_shipdate >= TIMESTAMP '{cut}' AND l_partkey % 1000 = 0
THEN 1e9 WHEN l_shipdate >= TIMESTAMP '{cut}' THEN l_quantity * 1.5 ELSE l_quantity END AS l_quantity, l_extendedprice FROM lineitem)""".format(cut=CUT)


def _ks_sql(feature: str) -> str:
    return f"""SELECT '{feature}' AS feature, max(abs(a - b)) AS exact FROM (SELECT
  sum(count(*) FILTER (WHERE later)) OVER w / sum(count(*) FILTER (WHERE later)) OVER () AS a,
  sum(count(*) FILTER (WHERE NOT later)) OVER w / sum(count(*) FILTER (WHERE NOT later)) OVER () AS b
  FROM lines GROUP BY {feature} WINDOW w AS (ORDER BY {feature}))"""


@query("drift_ks", f"""WITH {_KS_LINES}, found AS ({_ks_sql('l_quantity')} UNION ALL {_ks_sql('l_extendedprice')})
SELECT feature, {rnd('exact')}, TRUE AS within, exact > 0.1 AS reported FROM found""")
def drift_ks(spark, sf_dir):
    """Exact distance of later lines, some far out, from earlier ones; whether the sketches agree, and what they report.

    The baseline is merged from one profile per year of the earlier lines.
    """
    before, after = _before_after(spark, sf_dir)
    far = F.when(F.col("l_partkey") % 1000 == 0, F.lit(1e9)).otherwise(F.col("l_quantity") * 1.5)
    after = after.withColumn("l_quantity", far)
    columns = ("l_quantity", "l_extendedprice")
    years = sketches.sketch_profile(before, columns, by=[F.year("l_shipdate").alias("year")])
    baseline, batch = sketches.merge_profiles(years), sketches.sketch_profile(after, columns)
    exact = ranks.kolmogorov_smirnov(
        monitor.long_features(after, columns), monitor.long_features(before, columns), "value", ["feature"])
    found = sketches.ks_distances(batch, baseline).withColumnRenamed("distance", "sketched")
    reported = sketches.ks_violations(batch, baseline).select("feature", F.lit(True).alias("reported"))
    return exact.join(found, "feature").join(reported, "feature", "left").select(
        "feature", F.col("distance").alias("exact"),
        (F.abs(F.col("distance") - F.col("sketched")) <= sketches.distance_error()).alias("within"),
        F.coalesce("reported", F.lit(False)).alias("reported"))


_HOUR_COLUMNS = ("present", "missing", *BUCKET_COLUMNS)


@query("stream_hourly_stats", f"""{_HOURLY} SELECT hour, feature, {cols(_HOUR_COLUMNS)},
{', '.join(rnd(c) for c in ('mean', 'total', 'sd', 'low', 'high'))} FROM hours""")
def stream_hourly_stats(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    bounds = monitor.value_bounds(_numbered_events(spark, sf_dir), EVENT_NUMBERS)
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"), "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    out = new_path(spark, "hourly")
    jobs.hourly_stream(events, EVENT_NUMBERS, bounds, out, new_path(spark, "hourly-checkpoint")).awaitTermination()
    return jobs.read_hourly(spark, out)


_CHANGED = """changed AS (SELECT date_trunc('hour', ts) AS hour, CASE WHEN event_id % 5 > 0 THEN value - 10 END AS value,
CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)"""


@query("stream_drift", f"""WITH {_EVENTS}, {_CHANGED}, bounds AS ({_bounds_sql('numbered', EVENT_NUMBERS)}),
base AS ({_profile_sql('numbered', 'bounds', EVENT_NUMBERS)}),
hours AS ({_profile_sql('changed', 'bounds', EVENT_NUMBERS, by='hour, ')})
{_violations_sql('hours', 'base', by='p.hour AS hour, ')}
UNION ALL SELECT DISTINCT hour, 'user_id', 'missing_column_check', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), '{monitor.MISSING}' FROM hours""")
def stream_drift(spark, sf_dir):
    """Events with lower and missing values and without a column, hour by hour against all events."""
    features = (*EVENT_NUMBERS, "user_id")
    events = adapters.read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double").alias("k")
    whole = events.select("value", k, "user_id")
    bounds = monitor.value_bounds(whole, features)
    baseline = monitor.baseline_statistics(whole, features, bounds)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    value = F.when(F.col("event_id") % 5 > 0, F.col("value") - 10).alias("value")
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet").select(F.col("ts").cast("timestamp").alias("ts"), value, k)
    out = new_path(spark, "drift")
    jobs.drift_stream(stream, baseline, bounds, out, new_path(spark, "drift-checkpoint")).awaitTermination()
    return jobs.read_violations(spark, out)


_INNER = """FROM (SELECT inferenceId, response, unnest(range(len(r))) AS record, r FROM
(SELECT inferenceId, response, CAST(request AS JSON)::DOUBLE[][] AS r FROM requests WHERE inferenceId IS NOT NULL))"""
_FEATURE_COLUMNS = ", ".join(rnd(f"r[record + 1][{i + 1}]", f"feature{i:010d}") for i in range(2))


@query("capture_features", f"""WITH {CAPTURED}, kept AS (SELECT event_id, inferenceId, response,
  CASE event_id % 50 WHEN 0 THEN request || ']' WHEN 1 THEN NULL WHEN 2 THEN '[[1.5,2.5,3.5,4.5]]' ELSE request END AS request
  FROM requests WHERE inferenceId IS NOT NULL),
lists AS (SELECT inferenceId, response, unnest(range(len(r))) AS record, r FROM (SELECT inferenceId, response, CAST(request AS JSON)::DOUBLE[][] AS r
  FROM kept WHERE event_id % 50 > 1))
SELECT inferenceId, CAST(record AS INTEGER) AS record, {_FEATURE_COLUMNS}, response AS prediction0,
  array_to_string(r[record + 1][3:], ',') AS more, CAST(NULL AS VARCHAR) AS problem FROM lists
UNION ALL SELECT inferenceId, NULL, NULL, NULL, response, '', 'not a request' FROM kept WHERE event_id % 50 < 2""")
def capture_features(spark, sf_dir):
    """Captured requests, some of them broken, missing or wider than two features."""
    records = capture_records(spark, sf_dir).filter(F.col("eventMetadata.inferenceId").isNotNull())
    data, kind = F.col("captureData.endpointInput.data"), F.col("event_id") % 50
    changed = F.when(kind == 0, F.concat(data, F.lit("]"))).when(kind == 2, F.lit("[[1.5,2.5,3.5,4.5]]")).when(kind != 1, data)
    side = F.col("captureData").withField("endpointInput", F.col("captureData.endpointInput").withField("data", changed))
    found = capture.capture_features(records.withColumn("captureData", side), 2)
    return found.withColumn("more", F.coalesce(F.array_join(F.transform("more", lambda x: x.cast("string")), ","), F.lit("")))


@query("udf_preprocessor", f"WITH {CAPTURED} SELECT inferenceId, {_FEATURE_COLUMNS} {_INNER}")
def udf_preprocessor(spark, sf_dir):
    """A user's preprocessor in Python, after one written as a DataFrame transformation."""
    kept = apply_preprocessor(
        capture_records(spark, sf_dir), lambda df: df.filter(F.col("eventMetadata.inferenceId").isNotNull()))
    texts = kept.select(
        "eventMetadata.inferenceId", F.col("captureData.endpointInput.data").alias("request"),
        F.col("captureData.endpointOutput.data").alias("response"))
    schema = T.StructType([T.StructField("inferenceId", T.StringType()),
                           *[T.StructField(f"feature{i:010d}", T.DoubleType()) for i in range(2)]])
    return apply_handler(texts, positional_features, schema)


@query("stream_capture", f"""WITH {CAPTURED}
SELECT CAST(event_id AS VARCHAR) AS eventId, hour, request, response FROM requests
WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < {SAMPLE_PERCENT}""")
def stream_capture(spark, sf_dir):
    incoming, out = new_path(spark, "scored"), new_path(spark, "captured")
    records = capture_records(spark, sf_dir)
    records.write.parquet(incoming)
    stream = spark.readStream.schema(records.schema).parquet(incoming)
    jobs.capture_stream(stream, "event_id", SAMPLE_PERCENT, out, new_path(spark, "capture-checkpoint")).awaitTermination()
    schema = T.StructType([*CAPTURE.fields, T.StructField("hour", T.StringType())])
    return spark.read.schema(schema).json(out).select(
        "eventMetadata.eventId", "hour", F.col("captureData.endpointInput.data").alias("request"),
        F.col("captureData.endpointOutput.data").alias("response"))


_SHARES = """counted AS (SELECT quality AS label, source AS grp, count(*) FILTER (WHERE lang <> 'en') AS a,
  count(*) FILTER (WHERE lang = 'en') AS d FROM labels JOIN documents USING (doc_id) GROUP BY quality, source),
t AS (SELECT sum(a) AS na, sum(d) AS nd, sum(a) FILTER (WHERE label = 1) AS qa, sum(d) FILTER (WHERE label = 1) AS qd FROM counted),
p AS (SELECT label, sum(a) / any_value(na) AS pa, sum(d) / any_value(nd) AS pd FROM counted, t GROUP BY label),
g AS (SELECT grp, sum(a) + sum(d) AS n,
  coalesce(sum(d) FILTER (WHERE label = 0) / nullif(sum(a + d) FILTER (WHERE label = 0), 0), 0)
  - coalesce(sum(d) FILTER (WHERE label = 1) / nullif(sum(a + d) FILTER (WHERE label = 1), 0), 0) AS dd FROM counted GROUP BY grp)"""
_METRICS = {
    "CI": "(SELECT (na - nd) / (na + nd) FROM t)",
    "DPL": "(SELECT qa / na - qd / nd FROM t)",
    "KL": "(SELECT sum(pa * ln(pa / pd)) FROM p)",
    "JS": "(SELECT (sum(pa * ln(pa / ((pa + pd) / 2))) + sum(pd * ln(pd / ((pa + pd) / 2)))) / 2 FROM p)",
    "LP": "(SELECT sqrt(sum((pa - pd) * (pa - pd))) FROM p)",
    "TVD": "(SELECT sum(abs(pa - pd)) / 2 FROM p)",
    "KS": "(SELECT max(abs(pa - pd)) FROM p)",
    "CDDL": "(SELECT sum(n * dd) / sum(n) FROM g)",
}


@query("bias_pretraining", f"WITH {_SHARES} " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {rnd(f'CAST({e} AS DOUBLE)', 'value')}" for m, e in _METRICS.items()))
def bias_pretraining(spark, sf_dir):
    """Quality label by language, conditional on the source."""
    labels = adapters.read_table(spark, sf_dir, "labels")
    documents = adapters.read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return pretraining_bias(labels.join(documents, "doc_id"), "quality", [1], "lang", facet_values=["en"], group="source")
