"""Scoring by prediction by partial matching (PPM) over bytes, with a unigram word model as a base.

The model is a trie of byte contexts. Spark counts all strings of ``ORDER + 1`` bytes of the training
texts and derives the shorter ones from them level by level. A byte is predicted in the longest context
that was seen. If the context has not seen the byte, an escape is coded and the next shorter context is
asked, without the symbols that the longer one has already excluded. The escape gets what ``DISCOUNT``
per seen symbol leaves. Below the empty context every byte not excluded is as likely.

Counts go to Spark's shuffle as arrays of keys by class of context, so that all strings of a context meet
and are added up with its total in one go.

If there are at most ``MAX_STRINGS`` strings, they go to the executors as a trie. Otherwise the most frequent
of the longest go there, with their chances. All others of the scored texts are joined with the whole table of the
longest strings, and those it lacks are resolved by joins with the tables of shorter strings and contexts, so no
string is cut from the model.

Scoring works on the distinct strings of a batch, all at once, and adds up per text.

The base is a word model with counts over all training words. Counts of the ``TOP_WORDS`` most frequent
words go to the executors with the trie; the rest are joined by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.tables import bounded_batches, documents, keep, read, whole_groups
from fleetlens.llm.words import WHITE_SPACE, Words, mix, pieces, signed, split_words

ORDER, DISCOUNT, MAX_STRINGS, TOP_WORDS = 6, 0.5, 1_500_000, 500_000
PIECE = 1 << 20
#: A counter is emptied when it holds more than so many different keys.
HELD = 2_000_000
#: Counted keys are sent in so many classes (2 ** 12), each of which is added up in one task.
CLASS_BITS = 12
BLANK, END = 0x20, 0x00
#: Numbers of strings are bytes of text, of which zstd leaves two thirds of what snappy does, in the same time.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


_IS_LETTER = np.ones(256, bool)
_IS_LETTER[list(WHITE_SPACE)] = False


def coded_bytes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text joined by one blank, with one end byte, and the bounds of the texts."""
    size = words.ends - words.starts
    counts = words.counts
    # each word and each text without words takes one byte more than its letters
    before = np.concatenate([[0], np.cumsum(size + 1)])
    length = np.maximum(before[words.bounds[1:]] - before[words.bounds[:-1]], 1)
    bounds = np.concatenate([[0], np.cumsum(length)])
    out = np.full(bounds[-1], BLANK, np.uint8)
    is_letter = np.ones(len(out), bool)
    empty_before = np.concatenate([[0], np.cumsum(counts == 0)])[words.owner]
    is_letter[before[1:] - 1 + empty_before] = False
    is_letter[bounds[1:] - 1] = False
    out[is_letter] = words.data[_IS_LETTER[words.data]]
    out[bounds[1:] - 1] = END
    return out, bounds


def strings_at(coded: np.ndarray, bounds: np.ndarray, order: int) -> np.ndarray:
    """At each byte, it and the ``order`` bytes before it as one number, the byte lowest; zeros before a text."""
    value = coded.astype(np.uint64)
    for j in (1, 2, 4):  # numbers of 2, 4, 8 bytes
        value[j:] |= value[:-j] << np.uint64(8 * j)
    value &= np.uint64((1 << 64) - 1) >> np.uint64(64 - 8 * (order + 1))
    length = np.diff(bounds)
    for at in range(min(order, int(length.max(initial=0)))):
        value[bounds[:-1][length > at] + at] &= np.uint64((1 << 8 * (at + 1)) - 1)
    return value


def distinct(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different strings in rising order, and the place of each string among them.

    The lowest bits of a string are sorted as one number with its place, which takes half the time of
    sorting places by strings; the bits that are left then need one more, stable pass.
    """
    bits = np.uint64(max(len(strings).bit_length(), 1))
    order = (strings << bits) | np.arange(len(strings), dtype=np.uint64)
    order.sort()
    order = (order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    high = strings >> (np.uint64(64) - bits)
    if high.max(initial=0) < 1 << 16:
        high = high.astype(np.uint16)  # a radix sort
    order = order.take(np.argsort(high.take(order), kind="stable"))
    rising = strings.take(order)
    first = np.ones(len(strings), bool)
    np.not_equal(rising[1:], rising[:-1], out=first[1:])
    place = np.empty(len(strings), np.int64)
    place[order] = np.cumsum(first) - 1
    return rising[first], place


def distinct_by_text(strings: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different strings of each text as (string, text, times); those of one string follow each other.

    A string and its text are sorted as one number, as many texts at a time as the bits beside a string allow.
    """
    texts, bits = len(bounds) - 1, 64 - 8 * (order + 1)
    text = np.repeat(np.arange(texts, dtype=np.uint64), np.diff(bounds))
    if not bits:
        unique, place = distinct(strings)
        pairs, times = np.unique(place * texts + text.astype(np.int64), return_counts=True)
        return unique[pairs // max(texts, 1)], pairs % max(texts, 1), times
    found, step = [], 1 << bits
    for a in range(0, texts, step):
        mine = slice(bounds[a], bounds[min(a + step, texts)])
        both = (strings[mine] << np.uint64(bits)) | (text[mine] - np.uint64(a))
        both.sort()
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        both, times = both[first], np.diff(np.append(first, len(both)))
        found.append((both >> np.uint64(bits), (both & np.uint64(step - 1)).astype(np.int64) + a, times))
    return tuple(np.concatenate(part) for part in zip(*found))


class Counter64:
    """Counts of 64-bit keys, combined in memory up to a bound."""

    def __init__(self):
        self.waiting: list[np.ndarray] = []  # keys not counted yet
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        if sum(map(len, self.waiting)) > HELD:
            self.count()
            # half as many more than a counter may hold: it is not merged again for each few keys
            if self.held > HELD + HELD // 2:
                self.combine()

    @property
    def full(self) -> bool:
        return len(self.parts) == 1 and self.held > HELD

    def count(self) -> None:
        self.parts.append(np.unique(np.concatenate(self.waiting), return_counts=True))
        self.waiting = []
        self.held += len(self.parts[-1][0])

    def combine(self) -> None:
        keys, counts = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        order = np.argsort(keys, kind="stable")  # the parts are in rising order, so they are merged
        keys = keys.take(order)
        first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
        self.parts = [(keys[first], np.add.reduceat(counts.take(order), first) if len(keys) else counts)]
        self.held = len(first)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            self.count()
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.combine()
        out, self.parts, self.held = self.parts[0], [], 0
        return out


def counted_rows(order: int):
    """Rows (kind, class, keys, n): strings of bytes as kind 0, words as kind 1, as arrays; each task sends a key rarely more than once.

    A class is made by a hash of the key without its last byte, so all strings of a context are in one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = (Counter64(), Counter64())

        def rows(kind: int) -> Iterator[pa.RecordBatch]:
            keys, n = counters[kind].take()
            if not len(keys):
                return
            of_key = (mix(keys >> np.uint64(8)) >> np.uint64(64 - CLASS_BITS)).astype(np.uint16)
            dealt, sizes = np.argsort(of_key, kind="stable"), np.bincount(of_key)
            filled = np.flatnonzero(sizes)
            ends = pa.py_buffer(np.concatenate([[0], 8 * np.cumsum(sizes[filled])]).astype(np.int32))
            arrays = [pa.Array.from_buffers(pa.binary(), len(filled), [None, ends, pa.py_buffer(x.take(dealt))]) for x in (keys, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(filled), kind, np.int32)), pa.array(filled.astype(np.int32)), *arrays], names=["kind", "class", "keys", "n"])

        for batch in batches:
            for _, data, offsets in pieces(batch, size=PIECE):
                words = split_words(data, offsets, lower=True)
                counters[0].add(strings_at(*coded_bytes(words), order))
                counters[1].add(words.hashes)
                for kind, counter in enumerate(counters):
                    if counter.full:
                        yield from rows(kind)
        for kind in (0, 1):
            yield from rows(kind)

    return run


def merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, key, n, total, symbols) from rows of ``counted_rows`` in order of kind and class.

    ``total`` is that of the key's context, ``symbols`` their number there, on one row of each context and 0 on others.
    """
    for table in whole_groups(batches, ("kind", "class")):
        kinds = table.column("kind").to_numpy()
        for kind in np.unique(kinds):
            mine = table.filter(pa.array(kinds == kind))
            keys, n = (np.frombuffer(b"".join(mine.column(c).to_pylist()), t) for c, t in (("keys", np.uint64), ("n", np.int64)))
            rising = np.argsort(keys)
            keys = keys.take(rising)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, n = keys[first], np.add.reduceat(n.take(rising), first)
            context = keys >> np.uint64(8)
            begin = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            size, symbols = np.diff(np.append(begin, len(keys))), np.zeros(len(keys), np.int64)
            symbols[begin] = size
            total = np.repeat(np.add.reduceat(n, begin), size)
            for a in range(0, len(keys), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys[part]), kind, np.int32)), *[pa.array(x[part]) for x in (signed(keys), n, total, symbols)]],
                    names=["kind", "key", "n", "total", "symbols"])


@dataclass
class Level:
    """Contexts of one length, and their strings one byte longer, all in rising order."""

    strings: np.ndarray
    log_p: np.ndarray  # of a string's last byte, up to the denominator
    contexts: np.ndarray
    log_n: np.ndarray  # log10 of a context's count
    escape: np.ndarray  # log10 of the chance to leave the context
    log_n_shorter: np.ndarray  # the same of the context one byte shorter, without this one's symbols
    escape_shorter: np.ndarray


@dataclass
class PpmModel:
    order: int
    levels: list[Level]
    floor: float  # log10 of a byte that no context has seen
    words: np.ndarray
    word_counts: np.ndarray
    train_tokens: int
    vocabulary: int
    ends: int  # training texts: the count of the end token
    frequent: np.ndarray | None = None  # the most frequent of the longest strings, in rising order, if the levels lack some
    chances: np.ndarray | None = None  # log10 of their last bytes' chances

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.train_tokens + self.vocabulary + 1))

    def held_chance(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``log_chance`` by the model without cuts of the strings that can be found here, 0 for others, and which are found."""
        if self.frequent is None:
            return self.log_chance(strings), np.ones(len(strings), bool)
        if not len(self.frequent):
            return np.zeros(len(strings)), np.zeros(len(strings), bool)
        at = np.minimum(np.searchsorted(self.frequent, strings), len(self.frequent) - 1)
        held = self.frequent[at] == strings
        return np.where(held, self.chances[at], 0.0), held

    def log_chance(self, strings: np.ndarray) -> np.ndarray:
        """log10 of the chance of the last byte of each string, given the bytes before it."""
        out, left = np.zeros(len(strings)), np.arange(len(strings))
        above = np.full(len(strings), -1)  # the context asked before, one byte longer
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            if not len(left):
                break
            if not len(level.contexts):
                continue
            mine = strings[left] & np.uint64((1 << 8 * (k + 1)) - 1) if k < 7 else strings[left]
            context = mine >> np.uint64(8)
            at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
            known = level.contexts[at] == context
            entry = np.minimum(np.searchsorted(level.strings, mine), len(level.strings) - 1)
            seen = level.strings[entry] == mine
            first = above < 0
            longer = self.levels[k + 1] if k < self.order else level
            denominator, escape = level.log_n[at], level.escape[at]
            if not first.all():
                denominator = np.where(first, denominator, longer.log_n_shorter[above])
                escape = np.where(first, escape, longer.escape_shorter[above])
            out[left] += np.where(known, np.where(seen, level.log_p[entry] - denominator, escape), 0.0)
            above = np.where(known, at, -1)
            stay = ~seen
            left, above = left[stay], above[stay]
        out[left] += self.floor
        return out


def build_levels(order: int, strings: list[np.ndarray], counts: list[np.ndarray], contexts: list[np.ndarray], totals: list[np.ndarray]) -> tuple[list[Level], float]:
    """Escape and denominators of every context from the counts of kept strings and of whole contexts."""
    levels: list[Level] = []
    for k in range(order + 1):
        place = np.searchsorted(contexts[k], strings[k] >> np.uint64(8))
        symbols = np.bincount(place, minlength=len(contexts[k]))
        kept = np.bincount(place, counts[k] - DISCOUNT, len(contexts[k]))
        total = totals[k].astype(np.float64)
        with np.errstate(divide="ignore"):
            log_n, escape = np.log10(total), np.log10((total - kept) / total)
            rest, out = np.ones(len(total)), np.ones(len(total))
            if k:
                shorter = contexts[k] & np.uint64((1 << 8 * (k - 1)) - 1)
                up = np.searchsorted(contexts[k - 1], shorter)
                same = np.searchsorted(strings[k - 1], strings[k] & np.uint64((1 << 8 * k) - 1))
                excluded = np.bincount(place, counts[k - 1][same], len(total))
                rest = totals[k - 1][up] - excluded
                # what the shorter context keeps for symbols that are not excluded
                still = levels[k - 1].__dict__["kept"][up] - (excluded - DISCOUNT * symbols)
                out = np.where(rest > 0, (rest - still) / np.maximum(rest, 1e-300), 1.0)
            level = Level(strings[k], np.log10(counts[k] - DISCOUNT), contexts[k], log_n, escape,
                          np.log10(np.maximum(rest, 1e-300)), np.log10(np.clip(out, 1e-12, 1)))
        level.__dict__["kept"] = kept
        levels.append(level)
    for level in levels:
        del level.__dict__["kept"]
    return levels, float(np.log10(1 / max(257 - len(strings[0]), 1)))


def fit_ppm(training: DataFrame, order: int = ORDER, max_strings: int = MAX_STRINGS, top_words: int = TOP_WORDS, text: str = "text") -> tuple[PpmModel, DataFrame]:
    """A model of the ``max_strings`` most frequent strings, and the table (word, n) of all training words, which grows with the corpus."""
    return fit_tables(training, order, max_strings, top_words, text, cut=True)[:2]


def fit_tables(
    training: DataFrame, order: int = ORDER, max_strings: int = MAX_STRINGS, top_words: int = TOP_WORDS, text: str = "text", cut: bool = False
) -> tuple[PpmModel, DataFrame, list[DataFrame], DataFrame]:
    """The model as it is sent to executors, and the whole tables (word, n), (key, n) of strings by order and (k, context, total, symbols).

    The longest strings have the total of their context, too. With ``cut`` the model has levels of the most frequent strings
    where it can't hold all, instead of the most frequent of the longest strings.
    """
    bounded_batches(training.sparkSession)
    texts = training.select(F.col(text).alias("text"))
    sent = texts.mapInArrow(counted_rows(order), "kind int, class int, keys binary, n binary")
    merged = sent.repartition("kind", "class").sortWithinPartitions("kind", "class").mapInArrow(
        merged_rows, "kind int, key long, n long, total long, symbols long")
    counts = keep(merged, "counts", **PACKED)
    words = counts.filter("kind = 1").select(F.col("key").alias("word"), "n")
    longest = counts.filter("kind = 0").select("key", "n", "total", "symbols")
    level, shorter, strings = longest, None, [None] * order + [longest]
    for k in range(order - 1, -1, -1):
        level = keep(level.groupBy(F.col("key").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("key")).agg(F.sum("n").alias("n")), f"strings-{k}", **PACKED)
        strings[k] = level
        named = level.select(F.lit(k).alias("k"), "key", "n")
        shorter = named if shorter is None else shorter.unionByName(named)
    context = F.shiftrightunsigned("key", 8).alias("context")
    contexts = longest.filter("symbols > 0").select(F.lit(order).alias("k"), context, "total", "symbols")
    stacked = longest.select(F.lit(order).alias("k"), "key", "n")
    if shorter is not None:
        contexts = contexts.unionByName(keep(shorter.groupBy("k", context).agg(F.sum("n").alias("total"), F.count("*").alias("symbols")), "contexts", **PACKED))
        stacked = stacked.unionByName(shorter)
    whole = stacked.count() <= max_strings
    frequent = chances = None
    if not whole and not cut:
        stacked = stacked.limit(0)
        top = longest.filter(F.col("n") >= smallest_kept(longest, max_strings)).select(
            "key", (F.log10(F.col("n") - DISCOUNT) - F.log10("total")).alias("chance")).toArrow()  # bounded by max_strings
        frequent = top.column("key").to_numpy().view(np.uint64)
        rising = np.argsort(frequent)
        frequent, chances = frequent[rising], top.column("chance").to_numpy()[rising]
        del top
    elif not whole:
        stacked = stacked.filter(F.col("n") >= smallest_kept(stacked, max_strings))
    kept = stacked.toArrow()  # bounded by max_strings
    tops = contexts.join(stacked.select("k", context).distinct(), ["k", "context"]).select("k", F.col("context").alias("key"), F.col("total").alias("n")).toArrow()

    def by_level(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
        k, key, n = (table.column(c).to_numpy() for c in ("k", "key", "n"))
        keys, numbers = [], []
        for i in range(order + 1):
            mine = key[k == i].view(np.uint64)
            rising = np.argsort(mine)
            keys.append(mine[rising])
            numbers.append(n[k == i][rising])
        return keys, numbers

    levels, floor = build_levels(order, *by_level(kept), *by_level(tops))
    del kept, tops
    least_word = smallest_kept(words, top_words)
    top = words.filter(F.col("n") >= least_word).toArrow()  # bounded by top_words
    word = top.column("word").to_numpy().view(np.uint64)
    rising = np.argsort(word)
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = texts.count()
    # the end is a token of the vocabulary if there is a text to end
    model = PpmModel(
        order, levels, floor, word[rising], top.column("n").to_numpy()[rising], totals.n + ends, totals.v + (ends > 0), ends, frequent, chances)
    return model, words, strings, contexts


def joined_chances(asked: DataFrame, strings: list[DataFrame], contexts: DataFrame) -> DataFrame:
    """(key, chance) of distinct strings ``asked`` that are none of the longest strings: log10 of the chance of the last byte.

    From the longest order down, strings that are found leave and the others take the escape of their
    context. Tables of fewer than 1 << 17 possible rows are sent to the tasks.
    """
    none = F.lit(None).cast("double")
    rows, out = asked.select("key", F.lit(0.0).alias("chance"), none.alias("log_n"), none.alias("escape")), None

    def lowest(column: str, size: int) -> Column:  # so many bytes of a number
        return F.col(column).bitwiseAND(F.lit((1 << 8 * size) - 1)) if size < 8 else F.col(column)

    def of_order(k: int) -> DataFrame:
        mine = contexts.filter(F.col("k") == k).select("context", "total", "symbols")
        return F.broadcast(mine) if k < 3 else mine

    def string_table(k: int, n: str) -> DataFrame:
        mine = strings[k].select(F.col("key").alias("own"), F.col("n").alias(n))
        return F.broadcast(mine) if k < 2 else mine

    for k in range(len(strings) - 1, -1, -1):
        rows = rows.withColumn("own", lowest("key", k + 1))
        rows = rows.join(string_table(k, "n"), "own", "left") if k < len(strings) - 1 else rows.withColumn("n", F.lit(None).cast("long"))
        rows = rows.withColumn("context", F.shiftrightunsigned("own", 8)).join(of_order(k), "context", "left")
        has = F.log10(F.col("n") - DISCOUNT) - F.coalesce("log_n", F.log10("total"))
        leave = F.coalesce("escape", F.log10(DISCOUNT * F.col("symbols") / F.col("total")), F.lit(0.0))
        seen = F.col("n").isNotNull()
        rows = keep(rows.select(
            "key", (F.col("chance") + F.when(seen, has).otherwise(leave)).alias("chance"), seen.alias("seen"),
            *[F.when(~seen, F.col(c)).alias(c) for c in ("context", "symbols")]), f"asked-{k}", **PACKED)
        found = rows.filter("seen").select("key", "chance")
        out = found if out is None else out.unionByName(found)
        rows = rows.filter("NOT seen").drop("seen")
        if not k:
            break
        left = rows.filter("symbols IS NOT NULL").select("context", "symbols").distinct()
        inside = strings[k].select(F.shiftrightunsigned("key", 8).alias("context"), lowest("key", k).alias("own")).join(left, "context")
        excluded = inside.join(string_table(k - 1, "m"), "own").groupBy("context", "symbols").agg(F.sum("m").alias("excluded"))
        shorter = of_order(k - 1).select(F.col("context").alias("short"), F.col("total"), F.col("symbols").alias("all"))
        rest = F.col("total") - F.col("excluded")
        # the shorter context without this one's symbols; with none left nothing is found there and no escape is coded
        after = excluded.withColumn("short", lowest("context", k - 1)).join(F.broadcast(shorter) if k < 4 else shorter, "short").select(
            "context", F.when(rest > 0, F.log10(rest)).otherwise(F.lit(0.0)).alias("log_n"),
            F.when(rest > 0, F.log10(DISCOUNT * (F.col("all") - F.col("symbols")) / rest)).otherwise(F.lit(0.0)).alias("escape"))
        rows = rows.drop("symbols").join(after, "context", "left").drop("context")
    floor = float(np.log10(1 / max(257 - strings[0].count(), 1)))
    return out.unionByName(rows.select("key", (F.col("chance") + floor).alias("chance")))


def smallest_kept(counted: DataFrame, most: int) -> int:
    """The smallest n for which at most ``most`` rows have n or more; found by classes of n an eighth of a power of two wide."""
    step = F.floor(F.log2("n") * 8).cast("int")
    classes = counted.groupBy(step.alias("c")).agg(F.count("*").alias("rows"), F.min("n").alias("low")).collect()
    least, rows = None, 0
    for c in sorted(classes, key=lambda r: -r.c):
        rows += c.rows
        if rows > most:
            break
        least = c.low
    return least if least is not None else (max(c.low for c in classes) + 1 if classes else 1)


def scored_rows(model: PpmModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, size=PIECE):
                words = split_words(data, offsets, lower=True)
                coded, bounds = coded_bytes(words)
                keys, text, times = distinct_by_text(strings_at(coded, bounds, model.order), bounds, model.order)
                new = np.concatenate([[True], keys[1:] != keys[:-1]])
                place = np.cumsum(new) - 1
                chance, held = model.held_chance(keys[new])
                texts = len(bounds) - 1
                score = np.bincount(text, chance[place] * times, texts)
                # a string that a text asks for many times is sent once
                asked = np.flatnonzero(~held[place])
                owner = text[asked]
                asked = asked[np.argsort(owner.astype(np.uint16) if texts < 1 << 16 else owner, kind="stable")]
                ask_at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))]).astype(np.int32))
                counts = np.zeros(len(words.hashes), np.int64)
                if len(model.words):
                    at = np.minimum(np.searchsorted(model.words, words.hashes), len(model.words) - 1)
                    counts = np.where(model.words[at] == words.hashes, model.word_counts[at], 0)
                known = counts > 0
                sums = np.concatenate([[0], np.cumsum(np.where(known, model.base(counts), 0.0))])
                totals = np.concatenate([[0], np.cumsum(known)])
                ends_known = int(model.ends > 0)
                rare = words.hashes[~known]
                places = np.concatenate([[0], np.cumsum(~known)])[words.bounds].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.counts + 1), pa.array(totals[words.bounds[1:]] - totals[words.bounds[:-1]] + ends_known),
                     pa.array(sums[words.bounds[1:]] - sums[words.bounds[:-1]] + float(model.base(np.array(model.ends)))), pa.array(score),
                     pa.ListArray.from_arrays(pa.array(places), pa.array(signed(rare))),
                     pa.ListArray.from_arrays(ask_at, pa.array(signed(keys[asked]))),
                     pa.ListArray.from_arrays(ask_at, pa.array(times[asked].astype(np.int32)))],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score", "rare", "asked", "times"])

    return run


def lm_scores(docs: DataFrame, training: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words of lower-cased (A-Z) text, parted by space and tab to carriage return, and one end
    per text; a null text is an empty one, which is its end alone. ``score`` is the model's log10
    probability of the words joined by one blank and the end, ``base_score`` that of add-one word counts.
    Nothing to learn from: every byte is as likely and no token is known. Repeated rows give repeated
    rows. Extra columns are ignored.
    """
    model, words, strings, contexts = fit_tables(training, text=text, **parameters)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_strings and top_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scored_rows(sent.value)(batches)

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double, rare array<long>, asked array<long>, times array<int>"
    scored = documents(docs, doc_id, text).mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id())
    scored = keep(scored, "scored", **PACKED)  # row numbers are settled by writing them
    rare = scored.select("_row", F.explode("rare").alias("word")).groupBy("_row", "word").agg(F.count("*").alias("times"))
    whole = float(model.train_tokens + model.vocabulary + 1)
    n = F.coalesce("n", F.lit(0))
    rest = rare.join(words, "word", "left").groupBy("_row").agg(
        F.sum(F.col("times") * F.log10((n + 1) / F.lit(whole))).alias("rest"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("found"))
    joined = scored.drop("rare", "asked", "times").join(rest, "_row", "left")
    score = F.col("score")
    if model.frequent is not None:
        asked = scored.select("_row", F.explode(F.arrays_zip("asked", "times")).alias("a")).select("_row", F.col("a.asked").alias("key"), F.col("a.times").alias("times"))
        more = F.col("times") * (F.log10(F.col("n") - DISCOUNT) - F.log10("total"))
        seen = F.col("n").isNotNull()
        # a row for all strings of a text that are found, and one for each of the others
        looked = keep(asked.join(strings[-1].select("key", "n", "total"), "key", "left").select(
            "_row", F.when(~seen, F.col("key")).alias("key"), seen.alias("seen"), F.when(~seen, F.col("times")).alias("times"), more.alias("more"),
        ).groupBy("_row", "seen", "key").agg(F.sum("times").alias("times"), F.sum("more").alias("more")), "looked", **PACKED)
        lacking = looked.filter("NOT seen")
        chances = joined_chances(lacking.select("key").distinct(), strings, contexts)
        sums = looked.filter("seen").select("_row", "more").unionByName(
            lacking.join(chances, "key").select("_row", (F.col("times") * F.col("chance")).alias("more"))).groupBy("_row").agg(F.sum("more").alias("more"))
        joined, score = joined.join(sums, "_row", "left"), score + F.coalesce("more", F.lit(0.0))
    return joined.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), score.alias("score"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 7; a row without an id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scores = lm_scores(docs, docs.filter(~held_out() & F.col("doc_id").isNotNull()))
    return scores.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
