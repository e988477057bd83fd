import random

import numpy as np
import pytest
from compare import connect, differences

from fleetlens.llm import op8_embedding_dedup as op8

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, id int"


def brute(rows, least=0.98):
    n = len(rows)
    unit = []
    for i, v, label in rows:
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        u = np.array(v, np.float32).astype(float) if ok else None
        unit.append(u / np.linalg.norm(u) if ok else None)
    links, top = [0] * n, {r[0]: r[0] for r in rows}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(n):
        for b in range(n):
            if a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[a] += 1
                x, y = sorted((root(rows[a][0]), root(rows[b][0])))
                top[y] = x
    return sorted((r[0], k, root(r[0]) if r[0] is not None else None) for r, k in zip(rows, links) if r[0] is not None)


def vectors(seed, dim=24, groups=25, size=8):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.standard_normal(dim)
        base /= np.linalg.norm(base)
        for _ in range(size):
            noise = rng.standard_normal(dim)
            v = base + noise / np.linalg.norm(noise) * rng.choice([0.0, 0.05, 0.12, 0.2])
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)], int(g % 3)))
    random.Random(seed).shuffle(rows)
    return rows


def found(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, k, "x", 3) for i, v, k in rows], SCHEMA)
    return op8.embedding_duplicates(df, **kw).collect()


@pytest.mark.parametrize("block", [1024, 3])
def test_equals_brute_force(spark, block):
    rows = vectors(1)
    got = found(spark, rows, block=block)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_edge_rows(spark):
    one, two = [1.0, 2.0, 2.0, 0.5], [2.0, 4.0, 4.0, 1.0]
    rows = [(1, one, 1), (2, two, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0] * 4, 1), (8, [float("nan")] * 4, 1),
            (9, [float("inf"), 1.0, 1.0, 1.0], 1), (10, [None, 1.0, 1.0, 1.0], 1), (11, one[:3], 1), (12, one, 1), (13, [-0.0, 1.0, 0.0, 0.0], 1),
            (14, [0.0, 1.0, 0.0, 0.0], 1), (15, [1e30, 2e30, 2e30, 5e29], 1)]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found(spark, rows)) == brute(rows)
    nameless = found(spark, [(None, one, 1), (1, one, 1)])
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in nameless), key=str) == [(1, 0, 1, True), (None, 0, None, True)]


def test_repeated_rows_are_links(spark):
    got = found(spark, [(3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.01], 1)])
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(3, 2, 3), (3, 2, 3), (4, 2, 3)]


def test_empty_table(spark):
    assert found(spark, []) == []


def test_list_decoding_finds_all_filters():
    rng = np.random.default_rng(5)
    code = op8.codes(12, 7, 1)
    units = rng.standard_normal((9, 12))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    owner, number = op8.list_decode(units, code, 0.6)
    parts = np.array_split(np.arange(12), 3)
    want = set()
    for v in range(9):
        score = [units[v, p] @ c.T for p, c in zip(parts, code)]
        want |= {(v, (a * 7 + b) * 7 + c) for a in range(7) for b in range(7) for c in range(7) if score[0][a] + score[1][b] + score[2][c] >= 0.6}
    assert set(zip(owner.tolist(), number.tolist())) == want


def test_recall_on_pairs_at_the_limit(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(1500):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist(), 0), (2 * k + 1, (0.9805 * a + np.sqrt(1 - 0.9805**2) * b).tolist(), 0)]
    got = found(spark, rows)
    assert sum(r.n_links for r in got) >= 0.99 * 3000


def test_query_equals_sql(spark):
    con = connect("/root/testdata/sf0.001")
    assert differences(op8.op8_embedding_dedup(spark, "/root/testdata/sf0.001"), con, op8.SQL) == []
