import hashlib
import re
from collections import Counter

import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pyarrow as pa

from fleetlens.llm import op11_fill_middle as op11

SCHEMA = "doc_id long, text string, n string, form int, output string, h1 long"


def brute(i, t, markers=op11.MARKERS, plain=10, spm=20, seed="1"):
    t = t or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    lo, hi = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if not t or any(x in t for x in markers) or h[2] % 100 >= 100 - plain:
        return (i, len(units), "plain", None, None, t, t)
    a, b, c = markers
    spm = h[3] % 100 < spm
    out = b + s + a + p + c + m if spm else a + p + b + s + c + m
    return (i, len(units), "spm" if spm else "psm", len(p), len(m), out, t)


def found(spark, rows, markers=op11.MARKERS, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)
    return Counter(map(tuple, op11.restore(op11.fill_middle(df, markers, **kw), markers).collect()))


ODD = ["", None, "a", "é", "\n", "<P>", "x<S>y", "<M", "P><P", "ab cd  é日本\U0001f600 z\x00q", "<", "<P", "S>", ">", "w" * 5000, "日" * 3000, "a1b2 " * 40000]


def test_equals_brute_force(spark):
    rows = [(k, t) for k in range(60) for t in ODD[:-1]] + [(k, ODD[-1]) for k in range(3)] + [(None, "no id here"), (None, None)] * 2 + [(-5, "minus five")] * 3
    assert found(spark, rows) == Counter(brute(i, t) for i, t in rows)


def test_other_markers_shares_and_seed(spark):
    rows = [(k, f"some words {k} é and more\n" * (k % 7)) for k in range(200)]
    markers = ("<|p|>", "[suffix]", "␟")
    kw = {"markers": markers, "seed": "s"}
    assert found(spark, rows, plain_percent=0, spm_percent=50, **kw) == Counter(brute(i, t, plain=0, spm=50, **kw) for i, t in rows)
    assert {r[2] for r in found(spark, rows, plain_percent=100)} == {"plain"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.text(st.sampled_from("ab <>PSM\né日"), max_size=30)), min_size=1, max_size=12))
def test_batches_go_and_come_back(rows):
    hashes = {f"h{k + 1}": [int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for i, _ in rows] for k in range(4)}
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows], **hashes})
    cut = list(op11.cut_rows(op11.MARKERS, 10, 20)([batch]))
    back = list(op11.restore_rows(op11.MARKERS)(cut))
    got = [tuple(r.values()) for b in back for r in b.to_pylist()]
    assert got == [brute(i, t) for i, t in rows]


def test_way_is_a_step_function():
    assert op11.way(np.array([0, 2, 2, 4]), np.array([5, 9, -1, 0]), 6).tolist() == [5, 5, -1, -1, 0, 0]


def test_empty_table(spark):
    assert found(spark, []) == Counter()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    assert differences(op11.op11_fill_middle(spark, f"/root/testdata/{sf}"), connect(f"/root/testdata/{sf}"), op11.SQL) == []
