import hashlib
import re
from collections import Counter

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from fleetlens.llm.op1_substring_dedup import SQL, op1_substring_dedup, substring_dedup

SCHEMA = "doc_id long, text string, n_words string, spans int, _th string"


def brute(rows, width):
    """(doc_id, n_words, n_removed, kept words) by comparing all windows as word lists."""
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    count = Counter(tuple(w[s:s + width]) for _, w in docs for s in range(len(w) - width + 1))
    out = []
    for i, w in docs:
        gone = {k for s in range(len(w) - width + 1) if count[tuple(w[s:s + width])] > 1 for k in range(s, s + width)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def words(n, seed):
    return " ".join(f"w{(k * 7919 + seed * 104729) % 9973}" for k in range(n))


CASES = {
    "edges": [(1, words(40, 1) + " x " + words(12, 2)), (2, "y " + words(12, 2) + " z"), (3, words(11, 2)), (4, words(9, 2))],
    "self": [(1, "the " * 60), (2, "a b c " * 20 + "q"), (3, "the")],
    "copies": [(i % 3, words(80, i % 2)) for i in range(9)] + [(None, words(80, 1)), (None, None)],
    "nulls": [(1, None), (2, ""), (3, " \t\n "), (None, "one two")],
    "overlap": [(1, words(100, 5)), (2, words(60, 5) + " cut " + words(55, 6)), (3, words(30, 9) + " " + words(70, 6)), (4, words(64, 5))],
    "odd": [(1, "é b c\x1cd \x0b" * 30), (2, "é b c\x1cd " * 12), (3, "long" * 50000 + " " + words(12, 2)), (4, words(12, 2))],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("width", [3, 12])
def test_equals_brute_force(spark, case, width):
    rows = CASES[case]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    got = substring_dedup(df, width).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert Counter(map(tuple, got)) == brute(rows, width)


def test_intervals_are_maximal(spark):
    df = spark.createDataFrame([(1, words(30, 1)), (2, "a " + words(30, 1) + " b")], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.removed] for r in substring_dedup(df, 10).collect()}
    assert got == {1: [(0, 30)], 2: [(1, 31)]}


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string"), 5).count() == 0


def test_query_equals_sql(spark):
    con = connect("/root/testdata/sf0.001")
    assert differences(op1_substring_dedup(spark, "/root/testdata/sf0.001"), con, SQL) == []


def test_hash_of_kept_text(spark):
    row = op1_substring_dedup(spark, "/root/testdata/sf0.001").filter(F.col("n_removed") == F.col("n_words")).first()
    assert row.kept_sha256 == hashlib.sha256(b"").hexdigest()
