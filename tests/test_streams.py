"""Stateful streams: nothing is lost, restarts repeat nothing, features equal those in batch."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from fleetlens.config import FeatureSpec
from fleetlens.plans import features, monitor
from fleetlens.schemas import MEASURES, TELEMETRY, TELEMETRY_FEATURES
from fleetlens.streaming import pairs, state

START = datetime(2024, 1, 1)
EVENTS = "ts timestamp, value double, k double"


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def expected_late(batches, delay):
    """Rows whose hour ended at or before the newest time of earlier batches less the delay."""
    newest, on_time, late = None, [], []
    for rows in batches:
        for row in rows:
            behind = row[0] is None or newest is not None and row[0].replace(minute=0, second=0, microsecond=0) + timedelta(hours=1) <= newest - delay
            (late if behind else on_time).append(row)
        times = [r[0] for r in rows if r[0] is not None]
        newest = max([*times, *([newest] if newest else [])], default=None)
    return on_time, late


def test_late_rows_are_kept_and_a_restart_repeats_nothing(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    r = random.Random(2)
    batches = [[(START + timedelta(minutes=300 * b + r.randrange(-400, 300), seconds=r.randrange(60)), r.random() * 10 if r.random() < 0.9 else None, 1.0)
                for _ in range(120)] for b in range(4)]
    batches[1].append((None, 5.0, 5.0))
    bounds = {"value": (0.0, 10.0), "k": (1.0, 1.0)}
    for rows in batches[:2]:
        put(spark, rows, EVENTS, source)
    for more in ([], batches[2:], []):  # the second run goes on where the first one stopped, the third finds nothing
        for rows in more:
            put(spark, rows, EVENTS, source)
        state.late_stream(stream(spark, EVENTS, source), ["value", "k"], bounds, out, check).awaitTermination()
    on_time, late = expected_late(batches, timedelta(minutes=10))
    assert late and Counter(map(tuple, state.read_late(spark, out).select("ts", "value", "k").collect())) == Counter(late)
    found = {(x.hour, x.feature): x for x in state.read_hours(spark, out).collect()}
    whole = monitor.hourly_profile(spark.createDataFrame(on_time, EVENTS), ["value", "k"], bounds).collect()
    assert len(found) == len(whole)
    for x in whole:
        mine = found[x.hour, x.feature]
        assert (mine.present, mine.missing, mine.low, mine.high) == (x.present, x.missing, x.low, x.high)
        assert [mine[b] for b in monitor.BUCKET_COLUMNS] == [x[b] for b in monitor.BUCKET_COLUMNS]
        for c in ("mean", "total", "sd"):
            assert mine[c] == (None if x[c] is None else pytest.approx(x[c]))
    counted = sum(x.present + x.missing for x in found.values() if x.feature == "k") + len(late)
    assert counted == sum(map(len, batches))


def readings(machines, hours, r):
    rows = []
    for m in range(machines):
        for h in range(hours):
            if r.random() < 0.97:
                at = START + timedelta(hours=h)
                rows += [(at, m, *[r.random() if r.random() < 0.99 else None for _ in MEASURES]) for _ in range(1 + (r.random() < 0.1))]
    return rows


def test_features_equal_the_batch_plan(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spec = FeatureSpec(mode="keyed", bin_seconds=3 * 3600, window_rows=4)
    r = random.Random(4)
    rows = readings(5, 120, r)
    dealt = [[] for _ in range(4)]
    for row in rows:  # some come a batch late, within the delay
        dealt[min(3, (row[0] - START) // timedelta(hours=30) + (r.random() < 0.2))].append(row)
    late = [(START + timedelta(hours=2), 1, 9.0, None, 9.0, 9.0), (START + timedelta(hours=2), 1, 1.0, 2.0, 9.0, 9.0), (START, 99, 1.0, 1.0, 1.0, 1.0)]
    end = [(START + timedelta(days=99), -1, 0.0, 0.0, 0.0, 0.0)]
    for batch in [*dealt, end, late]:
        put(spark, batch, TELEMETRY, source)
    state.features_stream(stream(spark, TELEMETRY, source), spec, out, check, "31 hours").awaitTermination()
    want = features.telemetry_features(spark.createDataFrame(rows, TELEMETRY), spec).collect()
    found = {(x.machineID, x.datetime): x for x in state.read_features(spark, out).collect()}
    assert len(want) > 50 and len(found) == len(want)
    for x in want:
        for c in TELEMETRY_FEATURES[2:]:
            assert found[x.machineID, x.datetime][c] == pytest.approx(x[c])
    kept = {x.machineID: x for x in state.read_late_readings(spark, out).collect()}
    assert set(kept) == {1, 99} and (kept[1].n_volt, kept[1].sum_volt, kept[1].n_rotate) == (2.0, 10.0, 1.0)


def test_store_of_other_queries_is_left_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    source = str(tmp_path / "in")
    put(spark, [(START, 1.0, 1.0)], EVENTS, source)
    state.late_stream(stream(spark, EVENTS, source), ["value"], {}, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    row = state.read_hours(spark, str(tmp_path / "out")).first()
    assert (row.present, row.low, row.sd) == (1, 1.0, None)
    assert state.read_late(spark, str(tmp_path / "out")).count() == 0


def test_pairs_and_the_rest_are_all_rows(spark, tmp_path):
    schema = "inferenceId string, ts timestamp, data string"
    at = lambda minutes: START + timedelta(minutes=minutes)
    requests = [[("a", at(0), "ra"), ("b", at(1), "rb"), (None, at(2), "rn"), ("late", at(5), "rl")], [("c", at(200), "rc"), ("d", at(300), "rd")]]
    responses = [[("a", at(20), "sa"), ("x", at(3), "sx"), (None, at(9), "sn"), ("late", at(100), "sl")], [("c", at(201), "sc"), ("c", at(202), "sc2")]]
    far = [("end", START + timedelta(days=9), "")]
    sources = [str(tmp_path / n) for n in ("requests", "responses")]
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for part in (0, 1, 2):  # a run per batch; the last row ends all waiting
        for rows, path in ((requests, sources[0]), (responses, sources[1])):
            put(spark, rows[part] if part < 2 else far, schema, path)
        streams = [stream(spark, schema, path) for path in sources]
        pairs.pair_stream(*streams, out, check, wait="30 minutes").awaitTermination()
    matched = Counter((r.inferenceId, r.request, r.response) for r in pairs.read_pairs(spark, out).collect())
    assert matched == Counter({("a", "ra", "sa"): 1, ("c", "rc", "sc"): 1, ("c", "rc", "sc2"): 1, ("end", "", ""): 1})
    rest = Counter((r.inferenceId, r.status, r.request or r.response) for r in pairs.read_pairs(spark, out, matched=False).collect())
    assert rest == Counter([("b", "request", "rb"), (None, "request", "rn"), ("late", "request", "rl"), ("d", "request", "rd"),
                            ("x", "response", "sx"), (None, "response", "sn"), ("late", "response", "sl")])
