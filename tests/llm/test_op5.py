import random
import re
from collections import Counter

from compare import connect, differences

from fleetlens.llm import op5_decontaminate as op5

SCHEMA = "doc_id long, text string, n_words string, spans int, items string"


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width):
    out = []
    parts = [(i, tokens(t)) for i, t in items]
    for d, t in docs:
        w = tokens(t)
        hit, names = set(), set()
        for i, x in parts:
            n = min(width, len(x))
            wins = {tuple(x[s:s + n]) for s in range(len(x) - n + 1)} if x else set()
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in wins:
                    hit |= set(range(s, s + n))
                    names.add(i)
        out.append((d, len(w), len(hit), tuple(sorted(names - {None})), bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def found(spark, docs, items, width, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], SCHEMA)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    rows = op5.judged(op5.benchmark_hits(df, bench, width, **kw)).collect()
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in rows)


def case(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcde")
    items = [(rng.choice([k, k // 2, None]), " ".join(word() for _ in range(rng.choice([0, 1, 3, 6, 9, 14])))) for k in range(12)]
    items += [(50, None), (51, "!!"), (3, items[3][1])]
    docs = [(rng.choice([k, None, 4]), rng.choice([", ", " ", "-"]).join(rng.choice(["A", "b", "C", "d", "e", "zz"]) for _ in range(rng.randrange(60)))) for k in range(30)]
    docs += [(1, None), (2, ""), (3, "..."), (60, "é" * 10 + " a"), (61, "q " * 40000 + (items[5][1] or "b"))] + docs[:4]
    return docs, items


def test_equals_brute_force(spark):
    for seed, width in ((1, 4), (2, 5), (3, 7)):
        docs, items = case(seed)
        assert found(spark, docs, items, width) == brute(docs, items, width)


def test_item_blocks_give_the_same(spark):
    docs, items = case(4)
    assert found(spark, docs, items, 4, block_words=20) == brute(docs, items, 4)


def test_copies_of_an_item_are_one_in_a_block(spark):
    text = " ".join(f"w{k}" for k in range(20))
    items = [(k, text) for k in range(3000)] + [(None, text), (9000, "other words here")]
    blocks = list(op5.item_blocks(spark.createDataFrame(items, "item_id long, text string"), 4, block_words=10_000))
    assert len(blocks) == 1 and sum(len(x) for x in blocks[0].items) == 23 and sorted(map(len, blocks[0].ids)) == [1, 3000]
    docs = [(1, "x " + text), (2, "other words here"), (2, "other words here"), (3, None)]
    assert found(spark, docs, items[:40] + items[-2:], 4, block_words=8) == brute(docs, items[:40] + items[-2:], 4)


def test_no_items_and_no_documents(spark):
    docs, items = case(5)
    assert found(spark, docs, [], 4) == brute(docs, [], 4)
    assert found(spark, [], items, 4) == Counter()


def test_query_equals_sql(spark):
    con = connect("/root/testdata/sf0.001")
    assert differences(op5.op5_decontaminate(spark, "/root/testdata/sf0.001"), con, op5.SQL) == []
