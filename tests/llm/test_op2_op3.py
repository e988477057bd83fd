import math
import re
from collections import Counter, defaultdict

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import op2_language_id as op2
from fleetlens.llm import op3_lm_score as op3

SF = "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


# language


def phrases(text, symbols):
    """Longest matches with ``text``, by trying; a symbol that does not occur is a phrase."""
    count, at = 0, 0
    while at < len(symbols):
        size = 1
        while at + size < len(symbols) and symbols[at : at + size + 1] in text:
            size += 1
        count, at = count + 1, at + size
    return count


@pytest.mark.parametrize("letters", [46, 2])
def test_phrase_counts_equal_brute_force(monkeypatch, letters):
    monkeypatch.setattr(op2, "LETTERS", letters)  # with 2, most letters are looked up in the sorted list
    rng = np.random.default_rng(2)
    texts = {k: "".join(rng.choice(list("abcd e"), 400, p=p)) for k, p in {"x": [.4, .2, .1, .1, .1, .1], "y": [.1, .1, .2, .4, .1, .1]}.items()}
    model = op2.language_model(texts)
    samples = ["abca bcda  bee!!", "zzz q", "a", "ABBA dada " * 90, "", "--"]
    symbols, bounds = [], [0]
    for s in samples:
        own = op2.collapse(model.fold[op2.code_points(s)], np.zeros(1, np.int64))[0]
        symbols.append(own)
        bounds.append(bounds[-1] + len(own))
    got = op2.phrase_counts(model, np.concatenate(symbols), np.array(bounds))
    for k, lang in enumerate(model.languages):
        train = op2.collapse(model.fold[op2.code_points(texts[lang])], np.zeros(1, np.int64))[0].tobytes()
        for i, own in enumerate(symbols):
            raw = own.tobytes()
            assert got[i, k] == sum(phrases(train, raw[b : b + op2.BLOCK]) for b in range(0, len(raw), op2.BLOCK))


def test_two_languages_of_one_large_script(spark):
    """Each has 300 letters of its own and 300 in common, many more than the table of transitions has."""
    r = random.Random(6)
    han = [chr(0x4E00 + k) for k in range(900)]
    words = {lang: ["".join(r.choices(letters, k=3)) for _ in range(400)] for lang, letters in (("a", han[:300] + han[600:]), ("b", han[300:]))}

    def make(lang, n):
        return "".join(r.choice(words[lang]) for _ in range(n))

    others = {"en": "the quick brown fox jumps over the lazy dog and runs away " * 90, "ru": "съешь же ещё этих мягких французских булок да выпей чаю " * 90}
    model = op2.language_model({lang: make(lang, 1700) for lang in words} | others)
    assert len(set(han) & set(model.alphabet)) > 800 and model.width < 60
    rows = [(k, make("ab"[k % 2], 30), "ab"[k % 2]) for k in range(60)] + [(99, "the lazy fox", "en"), (98, "мягких булок", "ru")]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    assert {x.doc_id: x.lang_pred for x in op2.identify_language(df, model).collect()} == {i: lang for i, _, lang in rows}


def test_languages_of_held_out_documents(spark):
    got = op2.op2_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    row = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row.right > 0.98 and 0 <= row.low <= row.high <= 1


def test_language_edge_rows(spark):
    model = op2.language_model({"x": "hello there world", "y": "bonjour le monde"})
    rows = [(1, None), (2, ""), (3, "123 !!"), (None, "hello"), (4, "bonjour"), (4, "bonjour"), (5, "hello there " * 60000), (6, "жжж")]
    df = spark.createDataFrame([(i, t, "z", "p", "q") for i, t in rows], DOC_SCHEMA)
    got = Counter((r.doc_id, r.lang_pred) for r in op2.identify_language(df, model).collect())
    assert got == Counter({(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (None, "x"): 1, (4, "y"): 2, (5, "x"): 1, (6, "y"): 1})
    nothing = op2.fit_languages(df.filter("false"))
    assert {r.lang_pred for r in op2.identify_language(df, nothing).collect()} == {"und"}
    assert op2.identify_language(df.filter("false"), model).count() == 0


def test_language_of_a_sample_is_bounded_and_null_safe(spark):
    rows = [(1, "aaa bbb " * 50_000, "x"), (2, None, "x"), (3, "ccc", None), (4, "ddd eee", "y"), (4, "ddd eee", "y")]
    model = op2.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_chars=1000)
    assert model.languages == ["x", "y"] and len(model.step) < 4 * 1000 * model.width


# language model


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def coded(text):
    return b" ".join(w.encode() for w in tokens(text)) + b"\0"


class Brute:
    """The model written out: counts in dictionaries, a recursion over contexts."""

    def __init__(self, texts, order):
        self.order, self.count = order, [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            s = bytes(order) + coded(t)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.count[k][s[i - k : i]][s[i]] += 1

    def byte(self, before, symbol):
        excluded, score, first = set(), 0.0, True
        for k in range(self.order, -1, -1):
            seen = self.count[k].get(before[len(before) - k :])
            if not seen:
                continue
            total = sum(n for s, n in seen.items() if s not in excluded)
            if symbol in seen:
                return score + math.log10((seen[symbol] - op3.DISCOUNT) / total)
            if total:
                left = sum(n - op3.DISCOUNT for s, n in seen.items() if s not in excluded)
                score += math.log10((total - left) / total)
            excluded |= set(seen)
        return score + math.log10(1 / (257 - len(excluded)))

    def text(self, text):
        s = bytes(self.order) + coded(text)
        return sum(self.byte(s[i - self.order : i], s[i]) for i in range(self.order, len(s)))


@pytest.mark.parametrize("order", [2, 5, 7])
def test_scores_equal_the_model_written_out(spark, order):
    train = ["the cat sat on the mat", "The dog  sat\ton the log", None, "a cat", "été à la mer", "the cat sat on the mat"]
    rows = train + ["the cat ate", "", "zebra 中", "x" * 3000 + " the end", " the cat"]
    df = spark.createDataFrame([(i, t, "z", "p", "q") for i, t in enumerate(rows)], DOC_SCHEMA)
    got = {r.doc_id: r for r in op3.lm_scores(df, df.filter(F.col("doc_id") < len(train)), order=order).collect()}
    model, words = Brute(train, order), Counter(w for t in train for w in tokens(t))
    n, v = sum(words.values()) + len(train), len(words) + 1
    for i, t in enumerate(rows):
        r, own = got[i], tokens(t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own) + 1, sum(w in words for w in own) + 1, n)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own) + math.log10((len(train) + 1) / (n + v + 1))
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, model.text(t), rel_tol=1e-9)


def test_rare_words_are_joined_and_strings_are_cut(spark):
    df = spark.createDataFrame([(i, f"common w{i} common w{i // 2}", "z", "p", "q") for i in range(40)] + [(None, None, "z", "p", "q")], DOC_SCHEMA)
    whole = {(r.doc_id, round(r.base_score, 9), r.n_known) for r in op3.lm_scores(df, df).collect()}
    assert {(r.doc_id, round(r.base_score, 9), r.n_known) for r in op3.lm_scores(df, df, top_words=1).collect()} == whole
    cut = op3.lm_scores(df, df, max_strings=20).collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in cut)


@pytest.mark.parametrize("order", [2, 5, 7])
@pytest.mark.parametrize("max_strings", [0, 20])
def test_strings_beyond_the_broadcast_are_joined(spark, order, max_strings):
    train = ["the cat sat on the mat", "The dog  sat\ton the log", None, "a cat", "été à la mer", "the cat sat on the mat"]
    rows = train + ["the cat ate", "", "zebra 中", "the cat ate the end", "the cat ate"]
    df = spark.createDataFrame([(i, t, "z", "p", "q") for i, t in enumerate(rows)], DOC_SCHEMA)
    got = {r.doc_id: r.score for r in op3.lm_scores(df, df.filter(F.col("doc_id") < len(train)), order=order, max_strings=max_strings).collect()}
    model = Brute(train, order)
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        assert math.isclose(got[i], model.text(t), rel_tol=1e-9)


def test_cut_chances_sum_to_at_most_one(spark):
    df = spark.createDataFrame([(i, f"abc abd {chr(97 + i % 5)}x", "z", "p", "q") for i in range(60)], DOC_SCHEMA)
    model, _ = op3.fit_ppm(df, order=3, max_strings=30)
    for context in (b"\0\0a", b"abc", b" ab", b"zzz"):
        strings = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert 0.9 < (10 ** model.log_chance(strings)).sum() <= 1 + 1e-9


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b", "z", "p", "q"), (2, None, "z", "p", "q")], DOC_SCHEMA)
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, round(r.score, 6)) for r in op3.lm_scores(df, df.filter("false")).collect()}
    assert got == {1: (3, 0, 0, 0.0, round(-4 * math.log10(257), 6)), 2: (1, 0, 0, 0.0, round(-math.log10(257), 6))}
    assert op3.lm_scores(df.filter("false"), df).count() == 0


def test_model_beats_the_base_on_held_out_documents(spark):
    row = op3.op3_lm_score(spark, "/root/testdata/sf0.1").filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert row.s > row.b


@pytest.mark.parametrize("bits", [3, 20, 56, 64])
def test_distinct_strings_and_their_places(bits):
    rng = np.random.default_rng(bits)
    for rows in (0, 1, 2, 1000, 70_000):
        strings = rng.integers(0, 1 << bits, rows, np.uint64, endpoint=False) if bits < 64 else rng.integers(0, 1 << 64, rows, np.uint64)
        strings = np.concatenate([strings, strings[: rows // 2]])
        found, wanted = op3.distinct(strings), np.unique(strings, return_inverse=True)
        assert (found[0] == wanted[0]).all() and (found[1] == wanted[1]).all() and found[0].dtype == np.uint64


def test_counts_are_merged(monkeypatch):
    """Sorting all held keys again each time was half of the time of counting strings."""
    monkeypatch.setattr(op3, "HELD", 50)
    rng, counter, keys = np.random.default_rng(3), op3.Counter64(), []
    for rows in (40, 0, 30, 200, 1):
        keys.append(rng.integers(0, 90, rows, np.uint64) << np.uint64(57))
        counter.add(keys[-1])
    found, wanted = counter.take(), np.unique(np.concatenate(keys), return_counts=True)
    assert (found[0] == wanted[0]).all() and (found[1] == wanted[1]).all() and found[1].dtype == np.int64
    counter.add(np.zeros(0, np.uint64))
    assert [len(p) for p in counter.take()] == [0, 0]


def test_tables_of_strings_are_written_small(spark):
    """Strings written by snappy took more than the disk's budget."""
    strings = op3.fit_tables(spark.createDataFrame([(1, "a b abc " * 9), (2, "cab")], "doc_id long, text string"))[2]
    assert all(".zstd." in f for table in strings for f in table.inputFiles())


def test_the_room_for_strings_is_that_of_the_longest(spark):
    """Shorter strings took most of the room, though a string found among the longest needs none of them."""
    texts = ["the cat sat on the mat", "the cat ate", "The dog  sat\ton the log", None, "été à la mer"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    model, _, strings, contexts = op3.fit_tables(df, order=5, max_strings=70)
    whole, brute = op3.fit_tables(df, order=5)[0], Brute(texts, 5)
    wanted = {int.from_bytes(c + bytes([s]), "big"): (n, sum(seen.values())) for c, seen in brute.count[5].items() for s, n in seen.items()}
    assert {r.key: (r.n, r.total) for r in strings[-1].collect()} == wanted
    assert {r.context: (r.total, r.symbols) for r in contexts.filter("k = 5").collect()} == {
        int.from_bytes(c, "big"): (sum(seen.values()), len(seen)) for c, seen in brute.count[5].items()}
    assert 0 < len(model.frequent) <= 70 and len(model.frequent) > len(wanted) // 2
    chance, held = model.held_chance(model.frequent)
    assert held.all() and np.allclose(chance, whole.log_chance(model.frequent), rtol=1e-12)


@pytest.mark.parametrize("order", [0, 6, 7])
def test_distinct_strings_of_each_text(order):
    rng = np.random.default_rng(order)
    bounds = np.concatenate([[0], np.cumsum(rng.integers(1, 30, 700))])
    strings = rng.integers(0, 9, bounds[-1], np.uint64) << np.uint64(8 * order)
    keys, text, times = op3.distinct_by_text(strings, bounds, order)
    wanted = Counter(zip(strings.tolist(), np.repeat(np.arange(700), np.diff(bounds)).tolist()))
    assert dict(zip(zip(keys.tolist(), text.tolist()), times.tolist())) == wanted and len(keys) == len(wanted)


def test_counters_are_not_merged_for_each_few_keys(monkeypatch):
    monkeypatch.setattr(op3, "HELD", 1000)
    merged, combine = [], op3.Counter64.combine
    monkeypatch.setattr(op3.Counter64, "combine", lambda self: (merged.append(1), combine(self)))
    counter = op3.Counter64()
    for a in range(200):
        counter.add(np.arange(50, dtype=np.uint64) + np.uint64(a % 19 * 50))
    keys, n = counter.take()
    assert len(keys) == 950 and n.sum() == 10_000 and len(merged) <= 11
