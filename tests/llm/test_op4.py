import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

from compare import connect, differences

from fleetlens.llm import op4_mix_sources as op4

SCHEMA = "doc_id long, source string, text string, size string, taken int"


def targets(sizes):
    """Share by weight, cut at three times the size, and share the excess again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: Fraction(rest * weight[s], sum(weight[x] for x in open_)) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s] or (share[s] == 3 * sizes[s] == 0)}
        if not over:
            return {s: float(3 * sizes[s] if s in full else share[s]) for s in names}
        full |= over
        if len(full) == len(names):
            return {s: float(3 * sizes[s]) for s in names}


def found(spark, rows, **kw):
    df = spark.createDataFrame([(i, s, t, "x", 1) for i, s, t in rows], SCHEMA)
    return op4.mix_sources(df, **kw).collect()


ROWS = [(k, f"s{k % 5}" if k % 11 else None, " ".join(["w"] * (k * 37 % 90))) for k in range(900)]
ROWS += [(k, "huge", "a b\tc\n" * 50) for k in range(900, 1300)] + [(2000, "empty", None), (2001, "empty", " "), (None, "s1", "one two"), (5, "s0", "x"), (5, "s0", "x")]


def test_sizes_targets_and_whole_copies(spark):
    rows = found(spark, ROWS)
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in ROWS)
    sizes, taken, largest = Counter(), Counter(), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3 * largest[s]


def test_blocks_do_not_change_the_result(spark):
    whole = Counter(map(tuple, found(spark, ROWS)))
    assert Counter(map(tuple, found(spark, ROWS, block=40))) == whole
    assert Counter(map(tuple, found(spark, ROWS[::-1]))) == whole


def test_one_source_takes_everything_once(spark):
    rows = found(spark, [(k, "only", "a b c") for k in range(50)])
    assert all(r.copies == 1 and r.target == 150.0 for r in rows)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert [(r.size, r.target, r.taken) for r in found(spark, [(1, None, None)])] == [(0, 0.0, 0)]


def test_offset_is_a_hash_of_seed_and_source(spark):
    row = spark.range(1).select(op4.hash_place(op4.F.lit("mix/0a")).alias("x")).first()
    assert row.x == int(hashlib.md5(b"mix/0a").hexdigest()[:15], 16)


def test_query_equals_sql(spark):
    con = connect("/root/testdata/sf0.001")
    assert differences(op4.op4_mix_sources(spark, "/root/testdata/sf0.001"), con, op4.SQL) == []
