"""The feature rules written out over Python lists, as a check of the Spark plans on small frames."""

from __future__ import annotations

import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

START = datetime(2015, 1, 1, 6)
MEASURES = ("volt", "rotate", "pressure", "vibration")


def at(hours: float) -> datetime:
    return START + timedelta(hours=hours)


def random_inputs(seed: int, machines: int = 5, hours: int = 120):
    """Hourly readings with holes, doubled readings, missing values, and machines of unlike length."""
    rng = random.Random(seed)
    telemetry, errors, maint, failures = [], [], [], []
    for m in (3 * i + 1 for i in range(machines)):
        first, last = (0, hours) if m == 1 else (rng.randrange(hours // 3), hours - rng.randrange(hours // 3))
        hole = rng.randrange(hours)
        for h in range(first, last):
            if hole <= h < hole + 5 or rng.random() < 0.04:
                continue
            for _ in range(2 if rng.random() < 0.1 else 1):
                values = [round(rng.uniform(0, 200), 2) if rng.random() > 0.02 else None for _ in MEASURES]
                telemetry.append((at(h), m, *values))
            if rng.random() < 0.3:
                errors.append((at(h), m, f"error{rng.randrange(1, 6)}"))
            if rng.random() < 0.05:
                failures.append((at(h), m, f"comp{rng.randrange(1, 5)}"))
        for _ in range(rng.randrange(4)):
            maint.append((at(rng.randrange(-40, hours)), m, f"comp{rng.randrange(1, 5)}"))
    errors.append((at(0.5), 1, "error1"))  # no telemetry at this time
    return telemetry, errors, maint, failures


def slots(telemetry):
    """(machine, time) -> mean of each measure."""
    seen = defaultdict(list)
    for t, m, *values in telemetry:
        seen[m, t].append(values)
    out = {}
    for key, rows in seen.items():
        kept = [[v for v in column if v is not None] for column in zip(*rows)]
        out[key] = [sum(c) / len(c) if c else None for c in kept]
    return out


def number(t: datetime, seconds: int) -> int:
    return int((t - datetime(1970, 1, 1)).total_seconds()) // seconds


def grid(slot_values, seconds: int):
    """All machines with all bins between the first and the last, in order."""
    bins = [number(t, seconds) for _, t in slot_values]
    return [(m, b) for m in sorted({m for m, _ in slot_values}) for b in range(min(bins), max(bins) + 1)]


def binned(slot_values, seconds: int):
    members = defaultdict(list)
    for (m, t), values in sorted(slot_values.items()):
        members[m, number(t, seconds)].append(values)
    return members


def window(rows, cells, i, n, keyed):
    """The n trailing values at place i, or None if any is missing."""
    if i < n - 1 or (keyed and rows[i - n + 1][0] != rows[i][0]):
        return None
    values = [cells[r] for r in rows[i - n + 1 : i + 1]]
    return None if None in values else values


def roll(slot_values, seconds, n, keyed, fn):
    """Per measure, fn over the trailing n bins' first values, along the grid."""
    rows, members = grid(slot_values, seconds), binned(slot_values, seconds)
    width = len(next(iter(slot_values.values())))
    columns = []
    for k in range(width):
        first = {r: next((v[k] for v in members.get(r, []) if v[k] is not None), None) for r in rows}
        found = [window(rows, first, i, n, keyed) for i in range(len(rows))]
        columns.append([fn(v) if v is not None else None for v in found])
    return rows, [list(x) for x in zip(*columns)]


def end(b: int, seconds: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(seconds=(b + 1) * seconds)


def telemetry_features(telemetry, seconds, n, keyed):
    values = slots(telemetry)
    rows, means = roll(values, seconds, n, keyed, statistics.fmean)
    _, sds = roll(values, seconds, n, keyed, statistics.stdev)
    if not keyed:
        present = [s for s in sds if s[0] is not None]
        sds = present + [[None] * 4] * (len(rows) - len(present))
    members, out = binned(values, seconds), []
    for (m, b), mean, sd in zip(rows, means, sds):
        columns = [[v for v in c if v is not None] for c in zip(*members.get((m, b), []))] or [[]] * 4
        bin_mean = [sum(c) / len(c) if c else None for c in columns]
        bin_sd = [statistics.stdev(c) if len(c) > 1 else None for c in columns]
        row = (m, end(b, seconds), *bin_mean, *bin_sd, *mean, *sd)
        if None not in row:
            out.append(row)
    return out


def error_features(errors, telemetry, seconds, n, keyed):
    counts = {key: [0] * 5 for key in slots(telemetry)}
    for t, m, code in errors:
        if (m, t) in counts:
            counts[m, t][int(code[-1]) - 1] += 1
    rows, sums = roll(counts, seconds, n, keyed, sum)
    return [(m, end(b, seconds), *s) for (m, b), s in zip(rows, sums) if None not in s]


def maintenance_features(maint, telemetry, start_after, keyed):
    replaced = defaultdict(set)
    for t, m, comp in maint:
        replaced[m, t].add(int(comp[-1]) - 1)
    places = sorted([(m, t) for t, m, *_ in telemetry] + [k for k in replaced if k not in slots(telemetry)])
    if keyed:
        places = sorted(set(places))
    out, last, machine = [], [None] * 4, None
    for m, t in places:
        if keyed and m != machine:
            last = [None] * 4
        machine = m
        last = [t if c in replaced.get((m, t), ()) else last[c] for c in range(4)]
        if t > start_after:
            out.append((t, m, *[(t - x).total_seconds() / 86400 if x else None for x in last]))
    return out


def backfill(rows, limit, keyed):
    """rows: (machine, time, label) in order; label of the next ``limit`` rows if there is none."""
    out = []
    for i, (m, t, label) in enumerate(rows):
        ahead = [r for r in rows[i : i + limit + 1] if not keyed or r[0] == m]
        out.append((m, t, next((r[2] for r in ahead if r[2] is not None), None)))
    return out
