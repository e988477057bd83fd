import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetlens.llm import op13_packing as op13
from fleetlens.llm.byte_pairs import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH, remembered=50)
SCHEMA = "doc_id long, text string, ids string, start int, length int"

ODD = ["", " ", "\n", "\n\n x", "a\n b", "a\n\nb", "a  b", "a   b ", "it's we'll 'tis ' s", "x <|endoftext|> y  <|endoftext|>", "é naïve ÿ×÷ª", "日本 語　x",
       "a b   c", "tab\t here\r\n", " lead", "a1b22 3.4%", "\x00 \x1c \x1f z\x7f \x85", "  ​ w", "w" * 300, "a\nb\nc\n", "ok \n", "(x) [y] --> {z}"]


def library(texts):
    return [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def encoded(texts):
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, bounds = ENCODER.encode(np.frombuffer(data, np.uint8), offsets)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_ids_of_odd_texts():
    assert encoded(ODD) == library(ODD)
    assert encoded([]) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n'.,aAsélt1\t 日　 \x1c<|>") | st.characters(exclude_categories=["Cs"]), max_size=25), min_size=1, max_size=8))
def test_ids_equal_the_library(texts):
    assert encoded(texts) == library(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=9), st.integers(0, 60))
def test_fullest_equals_all_subsets(lengths, room):
    counts = sorted(Counter(lengths).items(), reverse=True)
    used = op13.fullest(counts, room)
    assert all(n <= dict(counts)[length] for length, n in used.items())
    sums = {sum(c) for k in range(len(lengths) + 1) for c in combinations(lengths, k)}
    assert sum(length * n for length, n in used.items()) == max(s for s in sums if s <= room)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=12), st.booleans())
def test_windows_use_every_item_once(counts, cut):
    left, slacks = Counter(counts), []
    for used, split, times in op13.windows(counts, 40, cut):
        left.subtract({length: n * times for length, n in used.items()})
        full = sum(length * n for length, n in used.items())
        if split:
            left.subtract({split[0]: times})
            left.update({split[0] - split[1]: times})
            full += split[1]
        assert full <= 40 and min(left.values()) >= 0 and times >= 1
        slacks += [40 - full] * times
    assert not +left
    if cut:
        assert all(s == 0 for s in slacks[:-1])


def check(spark, rows, least_share, **kw):
    """All ids of all rows are there once, side by side; returns pieces by sequence."""
    window = kw.get("window", op13.WINDOW)
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    pieces = op13.pack(df, PATH, **kw).collect()
    want = Counter((i, tuple([*ids, kw.get("end_id", 1)])) for (i, _), ids in zip(rows, library([t or "" for _, t in rows])))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_doc[p.doc_id, p.doc_tokens].append((p.start, ids))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    got = Counter()
    for (i, n), found in by_doc.items():
        texts = [ids for (j, ids), times in want.items() if j == i and len(ids) == n for _ in range(times)]
        # pieces of equal rows can't be told apart: every id of every copy must be there
        assert Counter((start + k, x) for start, ids in found for k, x in enumerate(ids)) == Counter(e for ids in texts for e in enumerate(ids))
        got.update((i, ids) for ids in texts)
    assert got == want
    for found in by_sequence.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= window
    total = sum(p.length for p in pieces)
    padded = sum(window for found in by_sequence.values() if (n := sum(length for _, length in found)) & (n - 1))
    padded += sum(n for found in by_sequence.values() if not (n := sum(length for _, length in found)) & (n - 1))
    assert not total or total / padded >= least_share
    return by_sequence


def text(r, n):
    return " ".join(r.choice(["alpha", "beta", "gamma,", "délta", "x1", "\n"]) for _ in range(n))


def test_round_trip(spark):
    r = random.Random(1)
    rows = [(k, text(r, r.choice([0, 3, 40, 400, 900]))) for k in range(300)]
    rows += [(None, None), (None, "no id"), (None, "no id"), (7, ""), (7, text(r, 20)), (7, text(r, 20)), (-1, text(r, 60000))] + [(k, t) for k, t in enumerate(ODD)]
    check(spark, rows, 0.98)
    check(spark, rows, 0.9, chunk_items=16, end_id=50256)  # a padded window for each small group
    check(spark, rows, 0.9, window=96, chunk_items=64)


def test_lengths_that_do_not_fit_are_cut(spark):
    rows = [(k, " a" * 1499) for k in range(200)]  # 1,500 ids each
    found = check(spark, rows, 0.99, chunk_items=256)
    assert len(found) <= 149


def test_only_empty_texts(spark):
    found = check(spark, [(k, None) for k in range(3000)], 0.7)
    assert sorted(len(v) for v in found.values())[-1] == 2048
    assert check(spark, [], 1) == {}


def test_query(spark):
    found = op13.op13_packing(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    ids = {row.doc_id: [*LIBRARY.encode(row.text or "", add_special_tokens=False).ids, 1] for row in rows}
    assert len(ids) == len(rows)
    covered, sequences = defaultdict(list), defaultdict(list)
    for p in found:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4").tobytes())
        covered[p.doc_id] += range(p.start, p.start + p.length)
        sequences[p.sequence_id].append((p.offset, p.length))
    assert {i: sorted(c) for i, c in covered.items()} == {i: list(range(len(x))) for i, x in ids.items()}
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 2048
    full = [sum(n for _, n in pieces) == 2048 for pieces in sequences.values()]
    assert full.count(False) <= 1


@pytest.mark.parametrize("length", [1, 2, 1024, 2047])
def test_equal_lengths(length):
    plans = list(op13.windows({length: 5000}, 2048, cut=True))
    assert len(plans) < 60
