import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import op12_spelling_variants as op12
from fleetlens.llm.words import distinct_ranges

SCHEMA = "doc_id long, text string, word string, n int, key long"


def brute_words(rows, least_length=5, least_count=3, garble=97):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % garble == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= least_length and n >= least_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(words, ratio=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def found(spark, words, **kw):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = op12.spelling_variants(df, **kw).collect()
    assert len(rows) == len(words)
    return set(map(tuple, rows))


def random_words(seed, letters, size):
    r = random.Random(seed)
    words = {"".join(r.choices(letters, k=r.randint(1, 9))) for _ in range(size)}
    for w in sorted(words)[: size // 2]:
        k = r.randrange(len(w) + 1)
        words |= {w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1:], w[:k] + w[k + 1:]} - {""}
    return {w: r.choice([3, 4, 6, 8, 16, 50, 1000]) for w in sorted(words)}


@pytest.mark.parametrize("letters", ["ab", "abcé", "ÿabcdefgh日"])
def test_equals_brute_force(spark, letters):
    words = random_words(len(letters), letters, 250)
    assert found(spark, words) == brute(words)


def test_long_chains_ties_and_ratio(spark):
    chain = {"abcdefgh"[:k] + "x" * (12 - k): 3 * 2**k for k in range(8)}
    words = chain | {"mouse": 10, "house": 10, "louse": 20, "louses": 20, "aaaaa": 4, "aaaaaa": 8, "aaaaaaa": 16}
    assert found(spark, words) == brute(words)
    assert found(spark, words, ratio=4) == brute(words, 4)
    assert {r[2] for r in found(spark, chain)} == {"abcdefgxxxxx"}


def test_many_words_of_one_chunk(spark):
    words = {"commonbeginning" + f"{a}{b}{c}": 3 + (ord(a) + ord(c)) % 20 for a in "abcdefgh" for b in "ijklmn" for c in "opqrs"}
    assert found(spark, words) == brute(words)


ROWS = [(k, "Encyclopaedia encyclopædia ÉCOLE école Ecole x×y őrület naïve naive " + "words " * (k % 5)) for k in range(300)]
ROWS += [(None, "nothing nothing nothing"), (None, None), (5, ""), (5, "repeated"), (5, "repeated"), (6, "repeated"), (7, "z" * 100000 + " tail-tail_tail9tail")] + [(8, "y" * 60)] * 3


def test_words_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in ROWS], SCHEMA)
    assert dict(map(tuple, op12.count_words(df).collect())) == brute_words(ROWS)
    got = dict(map(tuple, op12.count_words(df, least_length=2, least_count=1, garble=3).collect()))
    assert got == brute_words(ROWS, 2, 1, 3)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=70), min_size=1, max_size=20), st.integers(0, 2**32 - 1))
def test_checksums(texts, start):
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    before = np.full(len(texts), start, np.uint32)
    got = op12.checksums(np.frombuffer(b"".join(texts), np.uint8), starts, ends, before)
    assert got.tolist() == [zlib.crc32(t, start) for t in texts]


def test_distinct_ranges_with_equal_hashes(monkeypatch):
    from fleetlens.llm import words

    data = np.frombuffer(b"abcabdabcab", np.uint8)
    starts, ends = np.array([0, 3, 6, 9]), np.array([3, 6, 9, 11])
    for same in (False, True):
        if same:
            monkeypatch.setattr(words, "range_hashes", lambda d, a, b: np.ones(len(a), np.uint64))
        first, number = distinct_ranges(data, starts, ends)
        assert number[0] == number[2] and len(set(number.tolist())) == 3
        assert [data[starts[first[k]]:ends[first[k]]].tobytes() for k in number] == [b"abc", b"abd", b"abc", b"ab"]


def test_empty_table(spark):
    assert found(spark, {}) == set()
    assert op12.count_words(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_sql(spark):
    assert differences(op12.op12_spelling_variants(spark, "/root/testdata/sf0.001"), connect("/root/testdata/sf0.001"), op12.SQL) == []
