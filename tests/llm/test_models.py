"""Classifier chains, conditional random fields and what is built on them."""

import itertools
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fleetlens.llm import crf
from fleetlens.llm import op6_toxicity as op6
from fleetlens.llm import op9_html_extract as op9
from fleetlens.llm import op10_quality as op10
from fleetlens.llm.linear import SparseRows, fit_logistic, minimise, predict_logistic

SF = "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id long, text string, lang string, score string, label int"


def dense(x):
    owner, column = np.nonzero(np.ones_like(x))
    return SparseRows(owner, column, x.shape[0], x.shape[1], x[owner, column])


def test_minimise_finds_the_bottom():
    a = np.diag([1.0, 10.0, 100.0])
    got = minimise(lambda x: (x @ a @ x / 2 - x.sum(), a @ x - 1), np.zeros(3), steps=200, tolerance=1e-14)
    assert np.allclose(got, [1, 0.1, 0.01], atol=1e-4)


def test_logistic_separates_and_has_no_slope_left():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 3))
    y = (x[:, 0] + 0.3 * rng.standard_normal(200) > 0).astype(float)
    w = fit_logistic(dense(x), y, 0.1)
    p = predict_logistic(dense(x), w)
    assert ((p > 0.5) == y).mean() > 0.9 and abs((p - y).sum()) < 0.5


def enumerated(emission, moves):
    paths = {}
    for path in itertools.product((0, 1), repeat=len(emission)):
        score = sum(e for e, k in zip(emission, path) if k) + sum(moves[a, b] for a, b in zip(path, path[1:]))
        paths[path] = score
    return paths


def test_chain_equals_all_paths():
    rng = np.random.default_rng(3)
    sizes = [4, 0, 1, 6, 2]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    emission, moves = rng.standard_normal(bounds[-1]), rng.standard_normal((2, 2))
    marginal, expected, norm = crf.forward_backward(emission, bounds, moves)
    best = crf.viterbi(emission, bounds, moves)
    all_norm, all_moves = 0.0, np.zeros((2, 2))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if lo == hi:
            continue
        paths = enumerated(emission[lo:hi], moves)
        z = math.log(sum(map(math.exp, paths.values())))
        all_norm += z
        for i in range(hi - lo):
            assert math.isclose(marginal[lo + i], sum(math.exp(s - z) for p, s in paths.items() if p[i]), rel_tol=1e-9)
        for p, s in paths.items():
            for a, b in zip(p, p[1:]):
                all_moves[a, b] += math.exp(s - z)
        assert tuple(best[lo:hi]) == max(paths, key=paths.get)
    assert math.isclose(norm, all_norm) and np.allclose(expected, all_moves)


def test_chain_learns_a_neighbour_rule():
    rng = np.random.default_rng(4)
    label = np.repeat(rng.integers(0, 2, 60), 5)
    x = np.column_stack([label + 0.8 * rng.standard_normal(300)])
    chain = crf.fit_chain(dense(x), np.arange(0, 301, 10), label, penalty=0.1)
    got = crf.viterbi(chain.emissions(dense(x)), np.arange(0, 301, 10), chain.moves)
    assert (got == label).mean() > ((x[:, 0] > 0.5) == label).mean()


# toxicity


def test_toxicity_of_held_out_documents(spark):
    got = op6.op6_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("toxic").alias("y")), "doc_id")
    rows = got.filter("held_out").collect()
    assert sum(r.predicted == r.y for r in rows) >= 0.9 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_chain_uses_earlier_categories_and_edge_rows(spark):
    rows = [(f"fine words number {k}", 0, 0) for k in range(60)] + [(f"you are a fool {k}", 1, 1) for k in range(30)] + [(f"utter rubbish {k}", 0, 1) for k in range(30)]
    labelled = spark.createDataFrame(rows + [("x", None, 1), (None, 0, 0)], "text string, rude int, bad int")
    chain = op6.fit_toxicity(labelled, ["rude", "bad"], "bad")
    assert [len(w) for w in chain.weights] == [len(chain.vocabulary) + 1, len(chain.vocabulary) + 2]
    docs = [(1, None), (2, ""), (3, "a FOOL"), (4, "rubbish"), (4, "rubbish"), (None, "zz qq " * 30000 + "fool")]
    got = op6.toxicity(spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], DOC_SCHEMA), chain).collect()
    assert Counter((r.doc_id, r.p_bad > 0.5) for r in got) == Counter({(1, False): 1, (2, False): 1, (3, True): 1, (4, True): 2, (None, True): 1})
    nothing = op6.fit_toxicity(labelled.filter("false"), ["rude", "bad"], "bad")
    assert op6.toxicity(spark.createDataFrame([(1, "a", "x", "y", 1)], DOC_SCHEMA), nothing).count() == 1
    assert op6.toxicity(spark.createDataFrame([], DOC_SCHEMA), chain).count() == 0


# quality


def test_quality_of_held_out_documents(spark):
    got = op10.op10_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), "doc_id")
    rows = got.filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_quality_edge_rows(spark):
    rows = [(k, f"Some good words stand here {k}.\nAnd more of them.", "x", "y", 1) for k in range(40)]
    rows += [(k, f"BUY!! NOW!! ### {k}\n$$$ %%% &&&", "x", "y", 0) for k in range(40, 80)]
    model = op10.fit_quality(spark.createDataFrame(rows, DOC_SCHEMA), "label")
    docs = [(1, None), (2, ""), (3, "\n \n"), (4, "Fine words are here.\n" * 20000), (5, "$$$ ###\nBUY!! NOW!!"), (5, "$$$ ###\nBUY!! NOW!!"), (None, "One more line, good.")]
    got = {(r.doc_id, r.n_lines, r.predicted) for r in op10.quality(spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], DOC_SCHEMA), model).collect()}
    assert got == {(1, 0, 1), (2, 0, 1), (3, 0, 1), (4, 20000, 1), (5, 2, 0), (None, 1, 1)}
    one = op10.fit_quality(spark.createDataFrame(rows[:5], DOC_SCHEMA), "label")
    assert one.chain is None and one.prior == 1
    assert op10.fit_quality(spark.createDataFrame([], DOC_SCHEMA), "label").prior == 0.5
    assert op10.quality(spark.createDataFrame([], DOC_SCHEMA), model).count() == 0


# pages


def test_blocks_of_odd_markup():
    page = ("<!DOCTYPE html><title>no</title><script>var a='</p><p>x'</script><style>p{}</style><p>A &amp; B&nbsp;c<br>d<p class='x'>two <b>bold</b> "
            "<a href='>'>link</a><!-- <p>no --><ul><li>one<li>two</ul>tail &lt;3 < 4<select><option>no</select><div>deep<div>er</div>out</div></p><p>last <a href=\"")
    assert [t for t, _, _ in op9.blocks(page)] == ["A & B c d", "two bold link", "one", "two", "tail <3 < 4", "deep", "er", "out", "last"]
    assert [len(op9.blocks(x)) for x in ("", "plain", "<p>", "<", "</", "<!--", "<script>x", "<p>a<script>b</script>c")] == [0, 1, 0, 1, 0, 0, 0, 1]
    for tag in ("<p title=\"5\" tall\">", "<p data-x=it's>", "<p title=\"5>", "<p a='1\">", "<p =\">", "<p a = \"x>y\" b=c'd>", "<p a=x=\">"):
        assert [t for t, _, _ in op9.blocks(f"<div>one</div>{tag}First part</p><p>last")] == ["one", "First part", "last"], tag
    assert [t for t, _, _ in op9.blocks('<p title="5" tall">First</p><p class="x">next</p>')] == ["First", "next"]
    assert [t for t, _, _ in op9.blocks("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>")] == ["so x=2 holds"]
    assert len(op9.blocks("<div>" * 20000 + "x")) == 1 and len(op9.blocks("<a \"" * 20000)) == 0


def texts_of(page):
    return [t for t, _, _ in op9.blocks(page)]


def test_empty_comments_and_open_drawings():
    for comment in ("<!-->", "<!--->", "<!---->", "<!-- x --!>", "<!-- a > b -->", "<!-- <p>no</p> -- > -->"):
        assert texts_of(f"<article><p>one</p>{comment}<p>two</p></article>") == ["one", "two"], comment
    whole = "<article><p>one</p>{}<p>two</p><p>three</p></article><p>after</p>"
    for drawing in ("<svg class=i />", "<svg/>", "<svg class='a'/>", "<svg><path d='M0'/><text>no</text></svg>", "<svg>no", "<svg><g><text>no", "<svg class=i/>no</svg>"):
        assert texts_of(whole.format(drawing)) == ["one", "two", "three", "after"], drawing
    assert texts_of("<div>a<svg><foreignObject><p>no</p></foreignObject></svg>b</div>") == ["a", "b"]
    assert texts_of("<p>a <svg><b>bold</b> c</p>") in (["a", "bold c"], ["a bold c"])


def test_sample_of_pages_does_not_depend_on_partitions(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    pages = pages.unionByName(pages).unionByName(pages.limit(1).withColumn("html", F.expr("repeat(html, 1000)")))
    fields = [op9.fit_extractor(p, sample_pages=7, count=40) for p in (pages, pages.orderBy(F.rand(3)).repartition(9))]
    assert (fields[0].moves == fields[1].moves).all() and (fields[0].weights == fields[1].weights).all()


def test_labelled_pages_keep_their_labels():
    for page, labels in op9.labelled_pages(["words to fill a page with, and some more of them to cut"], 150):
        assert len(op9.blocks(page)) == len(labels)


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    found = (" ".join(op9.html.unescape(x.replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1|b)>", inner))
    return "\n\n".join(x for x in found if x)


def test_main_text_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = op9.op9_html_extract(spark, SF).collect()
    assert len(got) == len(html)
    for r in got:
        assert r.text == article(html[r.page_id]) and r.n_chars == len(r.text)


def test_other_layouts(spark):
    chain = op9.fit_extractor(spark.read.parquet(f"{SF}/pages.parquet"))
    story = "A long enough paragraph of the story, with commas and an end."
    page = (f"<html><body><header class=site><div>Name</div></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class='cookie-notice'><p>We use cookies.</p></div>"
            f"<main><h1>Title</h1><p>{story}</p><aside class=related><p>Read more here</p></aside><p>{story}</p></main>"
            f"<section class=comments><div class=comment><p>Nice one, I say.</p></div></section><form><p>Sign in</p></form><footer><p>&copy; 2020</p></footer></body></html>")
    df = spark.createDataFrame([(1, "u", page), (None, None, None), (2, "v", ""), (2, "v", "")], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.text) for r in op9.extract_text(df, chain).collect()), key=str)
    assert got == [(1, f"Title\n\n{story}\n\n{story}"), (2, ""), (2, ""), (None, "")]
    assert op9.extract_text(df.filter("false"), chain).count() == 0
