import random
import re
from collections import Counter

import pytest
from compare import connect, differences

from fleetlens.llm import op7_minhash_dedup as op7
from fleetlens.llm.components import connected_components

SCHEMA = "doc_id long, text string, component_id string, kept int, keys string"


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[s:s + n]) for s in range(max(len(w) - n + 1, 1))} if w else set()


def brute(rows, n=5, percent=75):
    sets = [(i, shingles(t, n)) for i, t in rows]
    ids = sorted({i for i, _ in sets if i is not None})
    reach = {i: i for i in ids}

    def top(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                reach[y] = x
    return Counter((i, len(s), None if i is None else top(i), i is None or top(i) == i) for i, s in sets)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op7.near_duplicates(df, **kw).collect())


def edited(rng, words, share):
    return " ".join(f"n{rng.random()}" if rng.random() < share else w for w in words)


def test_equals_brute_force_on_edited_copies(spark):
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(120)]
        rows += [(len(rows) + k * 7 % 11, edited(rng, base, share)) for k, share in enumerate([0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0])]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, block=2) == brute(rows)


def test_edge_rows(spark):
    rows = [(5, None), (6, ""), (7, " \t"), (8, "one two"), (9, "ONE\ttwo"), (None, "one two"), (8, "one two"), (3, "a b c d e"),
            (3, "p q r s t u v"), (4, "A B C D E"), (12, "p q r s t u v"), (10, "x" * 300000 + " y"), (11, "x" * 300000 + "\ny"), (None, None)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == Counter()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(400, 440)] + [(500, k) for k in range(501, 540)]
    edges += [(None, 3), (7, None), (9, 9)]
    reach = {x: x for e in edges for x in e if x is not None}
    for _ in range(200):
        for a, b in edges:
            if a is not None and b is not None:
                reach[a] = reach[b] = min(reach[a], reach[b])
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: reach[x] for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}


def test_query_equals_sql(spark):
    con = connect("/root/testdata/sf0.001")
    assert differences(op7.op7_minhash_dedup(spark, "/root/testdata/sf0.001"), con, op7.SQL) == []


@pytest.mark.parametrize("percent", [50, 60])
def test_other_limits_and_fewer_minima(spark, percent):
    """Pairs a little above the limit, many of which a bound for 75 per cent would set aside."""
    rows, size = [], 400
    for k in range(30):
        common = round(size * 2 * (percent + 4) / (100 + percent + 4))
        own = [f"{s}{k}x{i}" for s in "ab" for i in range(size - common)]
        shared = [f"c{k}x{i}" for i in range(common)]
        rows += [(2 * k, " ".join(shared + own[: size - common])), (2 * k + 1, " ".join(shared + own[size - common :]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = op7.near_duplicates(df, percent=percent, shingle=1, rows=3, bands=72).filter("NOT kept").count()
    assert got >= 29
