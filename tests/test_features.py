"""Feature plans against the rules written out in Python, over many small chunks."""

from collections import Counter
from datetime import datetime, timedelta

import brute
import pytest
from brute import at

from fleetlens.config import FeatureSpec
from fleetlens.operators import joins, sequence
from fleetlens.plans import features as plans
from fleetlens.schemas import COMPONENTS, ERRORS, FAILURES, KEYS, LABELED_FEATURES, MACHINES, MAINT, TELEMETRY
from fleetlens.session import materialize

HOURS3 = 3 * 3600
MODES = ("flat", "keyed")
CUT = datetime(2015, 1, 2)


def spec(mode, **changes):
    values = dict(mode=mode, window_rows=4, chunk_bins=3, chunk_rows=7, start_after=str(CUT)) | changes
    return FeatureSpec(**values)


def frames(spark, inputs):
    made = [spark.createDataFrame(rows, schema).coalesce(1) for rows, schema in zip(inputs, (TELEMETRY, ERRORS, MAINT, FAILURES))]
    return [materialize(df, "fixture") for df in made]


def rounded(rows):
    return Counter(tuple(round(v, 7) + 0.0 if isinstance(v, float) else v for v in r) for r in rows)


def check(df, wanted):
    found = rounded(tuple(r) for r in df.collect())
    wanted = rounded(tuple(float(v) if isinstance(v, int) and i > 1 else v for i, v in enumerate(r)) for r in wanted)
    assert found == wanted
    return found


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("seed", (1, 2))
def test_feature_tables(spark, mode, seed):
    data = brute.random_inputs(seed)
    telemetry, errors, maint, _ = frames(spark, data)
    s, keyed = spec(mode), mode == "keyed"
    assert check(plans.telemetry_features(telemetry, s), brute.telemetry_features(data[0], HOURS3, 4, keyed))
    assert check(plans.error_features(errors, telemetry, s), brute.error_features(data[1], data[0], HOURS3, 4, keyed))
    assert check(plans.maintenance_features(maint, telemetry, s), brute.maintenance_features(data[2], data[0], CUT, keyed))


def test_window_longer_than_a_machine(spark):
    """24 bins over machines of few bins: a flat window covers several machines."""
    data = brute.random_inputs(5, machines=8, hours=36)
    telemetry = frames(spark, data)[0]
    rows = [r for r in data[0] if None not in r]
    full = [(t, m, *v) for m in {r[1] for r in rows} for t in (at(h) for h in range(36)) for v in [(1.0 * m, 2.0, t.hour * 1.0, 4.0)]]
    telemetry = spark.createDataFrame(full, TELEMETRY)
    s = spec("flat", window_rows=24)
    assert check(plans.telemetry_features(telemetry, s), brute.telemetry_features(full, HOURS3, 24, False))
    assert plans.telemetry_features(telemetry, spec("keyed", window_rows=24)).count() == 0


@pytest.mark.parametrize("mode", MODES)
def test_joined_and_direct_labels_agree(spark, mode):
    data = brute.random_inputs(3)
    telemetry, errors, maint, failures = frames(spark, data)
    machines = spark.createDataFrame([(3 * i + 1, f"model{i % 4 + 1}", i) for i in range(5)], MACHINES)
    s = spec(mode)
    tele = plans.telemetry_features(telemetry, s)
    for rows in (0, 7):
        joined = plans.label_construct(
            tele, plans.error_features(errors, telemetry, s), plans.maintenance_features(maint, telemetry, s),
            machines, plans.failure_features(failures), s, rows)
        direct = plans.labeled_features(telemetry, errors, maint, failures, machines, s, rows)
        assert direct.columns == list(LABELED_FEATURES)
        found = rounded(tuple(r) for r in direct.collect())
        assert found and found == rounded(tuple(r) for r in joined.collect())


@pytest.mark.parametrize("mode", MODES)
def test_backfill(spark, mode):
    rows = sorted({(m, t) for t, m, *_ in brute.random_inputs(4)[0]})
    labeled = [(m, t, "comp1" if i % 23 == 5 else "comp2" if i % 31 == 7 else None) for i, (m, t) in enumerate(rows)]
    df = spark.createDataFrame(labeled, "machineID long, datetime timestamp, failure string")
    for chunk_rows in (3, 1000):
        out = plans.backfill_labels(df, spec(mode, chunk_rows=chunk_rows), 7)
        assert Counter(map(tuple, out.select("machineID", "datetime", "failure").collect())) == Counter(
            brute.backfill(labeled, 7, mode == "keyed"))


def test_results_do_not_depend_on_chunks_or_partitions(spark):
    data = brute.random_inputs(6)
    telemetry, _, maint, _ = frames(spark, data)
    wide = spec("flat", chunk_bins=10_000, chunk_rows=10_000)
    for one, other in (
        (plans.telemetry_features(telemetry, spec("flat")), plans.telemetry_features(telemetry.repartition(13), wide)),
        (plans.maintenance_features(maint, telemetry, spec("flat")), plans.maintenance_features(maint, telemetry.repartition(3), wide)),
    ):
        assert rounded(map(tuple, one.collect())) == rounded(map(tuple, other.collect()))


def test_keyed_machine_does_not_depend_on_others(spark):
    data = brute.random_inputs(7)
    telemetry, _, maint, _ = frames(spark, data)
    s = spec("keyed")
    only = telemetry.filter("machineID = 4")
    for whole, alone in (
        (plans.telemetry_features(telemetry, s), plans.telemetry_features(only, s)),
        (plans.maintenance_features(maint, telemetry, s), plans.maintenance_features(maint.filter("machineID = 4"), only, s)),
    ):
        assert rounded(map(tuple, whole.filter("machineID = 4").collect())) == rounded(map(tuple, alone.collect()))


def test_flat_and_keyed_differ_on_the_fixture(spark):
    """The checks above would notice a window kept within machines, or a fill stopped at them."""
    data = brute.random_inputs(1)
    assert rounded(brute.telemetry_features(data[0], HOURS3, 4, True)) != rounded(brute.telemetry_features(data[0], HOURS3, 4, False))
    assert rounded(brute.maintenance_features(data[2], data[0], CUT, True)) != rounded(brute.maintenance_features(data[2], data[0], CUT, False))


def reading(hours, machine=1, value=1.0):
    return (at(hours), machine, value, value, value, value)


def test_sd_moves_by_the_windows_length_without_holes(spark):
    rows = [reading(h, m, float((h * h * m) % 17)) for m in (1, 2) for h in range(90)]
    telemetry = spark.createDataFrame(rows, TELEMETRY)
    flat = {(r.machineID, r.datetime): r for r in plans.telemetry_features(telemetry, spec("flat")).collect()}
    keyed = {(r.machineID, r.datetime): r for r in plans.telemetry_features(telemetry, spec("keyed")).collect()}
    ends = [at(h) for h in range(3, 93, 3)]
    assert len(flat) == 2 * 30 - 3 - 3
    assert flat[1, ends[10]].voltsd_24h == pytest.approx(keyed[1, ends[13]].voltsd_24h)
    assert flat[1, ends[10]].voltmean_24h == pytest.approx(keyed[1, ends[10]].voltmean_24h)


def test_bin_edges_and_first_reading(spark):
    """[start, start + 3h) labelled by its end; the first non-null reading; sd null for one reading."""
    from fleetlens.operators import binning

    rows = [reading(0, value=None), reading(1, value=5.0), reading(2, value=9.0), reading(3, value=7.0)]
    slots = binning.dedupe_mean(spark.createDataFrame(rows, TELEMETRY))
    first = {r.datetime: r.volt for r in binning.tumbling_first(slots, HOURS3).collect()}
    assert first == {at(3): 5.0, at(6): 7.0}
    sd = {r.datetime: r.voltsd_3h for r in binning.tumbling_std(slots, HOURS3).collect()}
    assert sd[at(3)] == pytest.approx(8 ** 0.5) and sd[at(6)] is None
    assert [r.datetime for r in binning.dense_grid(slots, HOURS3).orderBy("datetime").collect()] == [at(3), at(6)]


def test_repeated_readings_are_averaged_first(spark):
    from fleetlens.operators import binning

    rows = [reading(0, value=0.0), reading(0, value=10.0), reading(1, value=8.0)]
    slots = binning.dedupe_mean(spark.createDataFrame(rows, TELEMETRY))
    assert binning.tumbling_mean(slots, HOURS3).first().voltmean_3h == pytest.approx(6.5)


@pytest.mark.parametrize("statistic, wanted", (("first", 1.0), ("sum", 3.0)))
def test_errors_of_later_slots(spark, statistic, wanted):
    """Only the first slot of a bin counts, unless sums are asked for; errors off the spine never do."""
    telemetry = spark.createDataFrame([reading(h) for h in range(12)], TELEMETRY)
    errors = spark.createDataFrame([(at(h), 1, "error1") for h in (3, 4, 5, 5.5)], ERRORS)
    s = spec("keyed", error_statistic=statistic)
    out = plans.error_features(errors, telemetry, s).collect()
    assert [(r.datetime, r.error1count, r.error2count) for r in out] == [(at(12), wanted, 0.0)]


def test_machine_never_maintained(spark):
    """Flat: it takes over the machine before it, with negative days; keyed: it has none."""
    telemetry = spark.createDataFrame([reading(h, m) for m in (1, 2) for h in (40, 41)], TELEMETRY)
    maint = spark.createDataFrame([(at(64), 1, "comp2"), (at(-40), 1, "comp1")], MAINT)
    flat = plans.maintenance_features(maint, telemetry, spec("flat")).filter("machineID = 2 and hour(datetime) = 22").first()
    assert (flat.comp1, flat.comp2, flat.comp3) == (80 / 24, -1.0, None)
    keyed = plans.maintenance_features(maint, telemetry, spec("keyed")).filter("machineID = 2").first()
    assert [keyed[c] for c in COMPONENTS] == [None] * 4


def test_start_is_exclusive_and_replacement_is_zero(spark):
    telemetry = spark.createDataFrame([(CUT, 1, 1.0, 1.0, 1.0, 1.0), (CUT + timedelta(hours=1), 1, 1.0, 1.0, 1.0, 1.0)], TELEMETRY)
    maint = spark.createDataFrame([(CUT + timedelta(hours=1), 1, "comp4")], MAINT)
    rows = plans.maintenance_features(maint, telemetry, spec("flat")).collect()
    assert [(r.datetime, r.comp4) for r in rows] == [(CUT + timedelta(hours=1), 0.0)]


def test_two_failures_give_two_rows(spark):
    telemetry = spark.createDataFrame([reading(h, value=float(h % 7)) for h in range(60)], TELEMETRY)
    errors = spark.createDataFrame([(at(0), 1, "error1")], ERRORS)
    maint = spark.createDataFrame([(at(0), 1, "comp1")], MAINT)
    failures = spark.createDataFrame([(at(30), 1, "comp1"), (at(30), 1, "comp3"), (at(31), 1, "comp2")], FAILURES)
    machines = spark.createDataFrame([(1, "model1", 3)], MACHINES)
    out = plans.labeled_features(telemetry, errors, maint, failures, machines, spec("keyed")).orderBy("datetime", "failure").collect()
    by_time = {}
    for r in out:
        by_time.setdefault(r.datetime, []).append(r.failure)
    assert by_time.pop(at(30)) == ["comp1", "comp3"]
    assert set(map(tuple, by_time.values())) == {("none",)}


def test_undeclared_failures_keep_their_name_and_are_counted(spark):
    from pyspark.sql import functions as F

    from fleetlens.functions.clean import label_or_none

    failures = spark.createDataFrame([(at(0), 1, "comp1"), (at(0), 2, "pump")], FAILURES)
    assert {r.machineID: r.failure for r in plans.failure_features(failures).collect()} == {1: "comp1", 2: "pump"}
    assert [tuple(r) for r in plans.undeclared(failures, "failure", ("comp1",)).collect()] == [("pump", 1)]
    rows = spark.createDataFrame([(None,), ("nan",), ("comp1",)], "failure string")
    assert [r[0] for r in rows.select(label_or_none()).collect()] == ["none", "none", "comp1"]


# Sequence tools


@pytest.mark.parametrize("per_part", (3, 1000))
def test_prefix_sums(spark, per_part):
    rows = [(i * i, i % 4 + 1, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "machineID long, rows long, one long")
    out = sequence.prefix_sums(df, "machineID", ["rows", "one"], len(rows), per_part).orderBy("machineID").collect()
    assert [r.one_before for r in out] == list(range(40))
    assert [r.rows_before for r in out] == [sum(x[1] for x in rows[:i]) for i in range(40)]


def test_number_rows_over_chunks_with_a_hot_machine(spark):
    places = [(1, at(h)) for h in range(200)] + [(m, at(h)) for m in (2, 3, 9) for h in range(10)]
    df = spark.createDataFrame(places, "machineID long, datetime timestamp")
    order = sequence.machine_order(df)
    chunked = order.with_chunk(df, 16)
    sizes = [r["count"] for r in chunked.groupBy("_chunk").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 40
    out = sequence.number_rows(chunked, KEYS).collect()
    assert sorted((r.machineID, r.datetime, r.position) for r in out) == [(*p, i) for i, p in enumerate(sorted(places))]


def test_chunks_hold_even_with_a_wrong_clock(spark):
    """A reading far off in time and a dense hour leave no chunk with twice the wanted rows."""
    base = datetime(2015, 1, 1)
    times = [datetime(1970, 1, 1), *[base + timedelta(seconds=i) for i in range(3000)],
             *[base + timedelta(days=i) for i in range(1, 500)]]
    rows = [(1, base + timedelta(hours=i)) for i in range(40)] + [(2, t) for t in times] + [(3, base)]
    df = spark.createDataFrame(rows, "machineID long, datetime timestamp")
    order = sequence.machine_order(df)
    chunked = order.with_chunk(df, 50).collect()
    assert len(chunked) == len(rows)
    sizes = Counter(r["_chunk"] for r in chunked)
    assert max(sizes.values()) < 100 and max(sizes) < order.chunks(50)
    in_order = [r["_chunk"] for r in sorted(chunked, key=lambda r: (r["machineID"], r["datetime"]))]
    assert in_order == sorted(in_order)


@pytest.mark.parametrize("limit", (2, 1000))
def test_lookup_join_both_ways(spark, limit, monkeypatch):
    """Below the limit a broadcast, above it a salted shuffle join: same rows."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    big = spark.range(300).selectExpr("id % 7 as k", "id as v")
    lookup = spark.createDataFrame([(k, f"x{k}") for k in range(5)], "k long, name string")
    out = joins.lookup_join(big, lookup, ["k"], spread_by=["v"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert ("_salt" in plan) == (limit == 2)
    assert sorted((r.k, r.v, r.name) for r in out.collect()) == sorted(
        (i % 7, i, f"x{i % 7}" if i % 7 < 5 else None) for i in range(300))


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 3)], "k string, copies long")
    out = Counter(r.k for r in joins.repeat_rows(df, "copies", block=3).collect())
    assert out == {"a": 1, "b": 7, "c": 3}


def test_flat_plan_has_no_single_task_over_telemetry(spark):
    """Windows without partition keys appear only over summaries; nothing is cross-joined."""
    data = brute.random_inputs(1)
    telemetry, errors, maint, failures = frames(spark, data)
    machines = spark.createDataFrame([(1, "model1", 1)], MACHINES)
    plan = plans.labeled_features(telemetry, errors, maint, failures, machines, spec("flat"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
