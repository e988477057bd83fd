import re
from collections import Counter

import pytest
from test_op1 import brute as repeated_words
from test_op5 import brute as hit_words
from test_op7 import brute as groups

import corpus_pipeline as cp
from fleetlens.llm import op2_language_id as op2

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _th string, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, s, len(t or ""), "x", 1) for i, t, g, s in rows], SCHEMA)


def prose(n, seed):
    return " ".join(f"w{(k * 7919 + seed * 104729) % 9973}" for k in range(n))


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_language_stage_keeps_all_with_letters(spark):
    rows = [(1, "hello there", "en", "a"), (2, None, "en", "a"), (3, "12 !", "en", "b"), (None, "bonjour", "fr", None), (4, "", None, "a"), (5, "hello there", "en", "a")]
    df = frame(spark, rows)
    out = cp.language_stage(spark, df, SF)
    assert out.schema == df.schema and texts(out) == Counter((i, t) for i, t, _, _ in rows if re.search(r"[^\W\d_]", t or ""))


def test_language_stage_without_labels_keeps_all_with_letters(spark):
    rows = [(1, "hello there", None, "a"), (2, None, None, "a"), (3, "12 !", None, "b"), (None, "bonjour", None, None)]
    assert texts(cp.language_stage(spark, frame(spark, rows), SF)) == Counter([(1, "hello there"), (None, "bonjour")])


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    base = prose(100, 1)
    rows = [(9, base, "en", "a"), (4, base + " more", "en", "b"), (4, base + " more", "en", "b"), (7, prose(80, 2), "en", None), (None, base, "en", "a"), (3, None, "en", "a")]
    df = frame(spark, rows)
    out = cp.near_duplicate_stage(spark, df, SF)
    kept = {i for i, _, _, k in groups([(i, t) for i, t, _, _ in rows]) if k and i is not None}
    assert out.schema == df.schema and Counter(r.doc_id for r in out.collect()) == Counter([*kept, None])


def test_substring_stage(spark):
    shared = prose(60, 3)
    rows = [(1, "a\nb " + shared + "  c", "en", "a"), (2, shared, "en", "a"), (3, "as  it \n is", "en", "b"), (4, None, "en", "a"), (None, "x " + shared, "en", None)]
    out = cp.substring_stage(spark, frame(spark, rows), SF)
    want = Counter()
    for i, n, gone, left in repeated_words([(i, t) for i, t, _, _ in rows], cp.PASSAGE_WORDS):
        own = next(t for j, t, _, _ in rows if j == i)
        if not gone or left:
            want[i, left if gone else own] += 1
    assert texts(out) == want
    assert all(r.n_chars == len(r.text or "") for r in out.collect())


def test_decontamination_stage(spark, tmp_path):
    item = prose(20, 5)
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    other = prose(900, 6).replace("w", "v")
    rows = [(1, "Begin, " + item + "; end", "en", "a"), (2, other + ", (" + item.upper() + ") - tail", "en", "a"), (3, "clean -- text", "en", "b"), (None, None, "en", None)]
    out = cp.decontamination_stage(spark, frame(spark, rows), str(tmp_path))
    bad = {i for i, _, _, _, c in hit_words([(i, t) for i, t, _, _ in rows], [(1, item)], 13) if c}
    assert bad == {1}
    assert texts(out) == Counter({(2, other + ", () - tail"): 1, (3, "clean -- text"): 1, (None, None): 1})


def test_mixing_stage(spark):
    rows = [(k, f"a b c {k}", "en", f"s{k % 2}") for k in range(40)] + [(100, "d e", "en", None), (100, "d e", "en", None), (100, "d e", "en", "s1")]
    df = frame(spark, rows)
    out = cp.mixing_stage(spark, df, SF)
    found = out.collect()
    assert out.columns == [*df.columns, "copy"] and len({(r.doc_id, r.source, r.copy) for r in found}) == len(found)
    copies = Counter((r.doc_id, r.source) for r in cp.op4.mix_sources(df).collect() for _ in range(r.copies))
    assert Counter((r.doc_id, r.source) for r in found) == copies


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES])
def test_empty_tables(spark, stage):
    assert stage(spark, frame(spark, []), SF).count() == 0


def test_run_gives_what_the_stages_give(spark):
    out = cp.run(spark, SF)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = out.collect()
    assert 0 < len(rows) and {r.doc_id for r in rows} <= set(docs)
    left = {r.doc_id: r.text for r in rows}
    for i, t in left.items():
        assert not Counter(re.findall(r"\S+", t)) - Counter(re.findall(r"\S+", docs[i].text)) or len(t) < len(docs[i].text)
    assert op2.held_out is not None and [n for n, _ in cp.STAGES] == ["language", "near-duplicates", "passages", "contamination", "mix"]
