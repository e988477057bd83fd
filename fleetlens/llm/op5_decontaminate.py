"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

The automaton accepts every run of words of any item. A document's words are streamed through it: the
state and the length tell the longest run ending at each word that some item contains. A length of a
window's width or more means that a window of an item ends there, and the state names the items. Words
that no item uses end every match, so only stretches of known words of sufficient length are streamed.

Items are sent to the executors in blocks of at most ``block_words`` words; each block is one pass over
the documents without a shuffle, and what several blocks find is combined per document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.tables import bounded_batches, documents, keep, read
from fleetlens.llm.words import NOT_ALNUM, pieces, split_words

BLOCK_WORDS = 500_000


class ItemAutomaton:
    """Generalised suffix automaton of word sequences; items are numbered in the order given."""

    def __init__(self, items: Sequence[Sequence[int]], width: int):
        self.width = width
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.window_items: dict[int, set[int]] = {}
        whole: dict[int, list[tuple[int, int]]] = {}
        for i, words in enumerate(items):
            state, _ = 0, 0
            for at, word in enumerate(words):
                state = self.next[state][word]
                if at + 1 >= width:
                    state = self._of_length(state, width)
                    self.window_items.setdefault(state, set()).add(i)
            if 0 < len(words) < width:
                whole.setdefault(state, []).append((len(words), i))
        # short items that end wherever a state is reached: its own and those of all its suffixes
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[state] = (*whole.get(state, ()), *self.short[self.link[state]])

    def _of_length(self, state: int, width: int) -> int:
        """The suffix of ``state`` that holds the run of ``width`` words."""
        while self.length[self.link[state]] >= width:
            state = self.link[state]
        return state

    def _copy(self, state: int, length: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        self.link[state] = len(self.next) - 1
        return self.link[state]

    def _redirect(self, state: int, word: int, old: int, new: int) -> None:
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = new
            state = self.link[state]

    def _extend(self, last: int, word: int) -> int:
        if (there := self.next[last].get(word)) is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            copy = self._copy(there, self.length[last] + 1)
            self._redirect(last, word, there, copy)
            return copy
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            there = self.next[state][word]
            if self.length[there] == self.length[state] + 1:
                self.link[new] = there
            else:
                copy = self._copy(there, self.length[state] + 1)
                self._redirect(state, word, there, copy)
                self.link[new] = copy
        return new

    def stream(self, words: Sequence[int]) -> Iterator[tuple[int, int, Sequence[int]]]:
        """(first word, end, items) of every window or whole short item that occurs in ``words``."""
        state = length = 0
        for at, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word not in self.next[state]:
                continue
            state = self.next[state][word]
            length += 1
            if length >= self.width:
                found = self._of_length(state, self.width)
                yield at + 1 - self.width, at + 1, self.window_items[found]
            for size, item in self.short[state]:
                if size <= length:
                    yield at + 1 - size, at + 1, (item,)


class ItemBlock:
    """Items of a block with their vocabulary; built where it is first used."""

    def __init__(self, ids: Sequence[Sequence[int]], items: Sequence[np.ndarray], width: int):
        """``ids`` holds the ids of all items with the words at its place in ``items``."""
        self.ids, self.width = list(ids), width
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *items]))
        self.items = [np.searchsorted(self.vocabulary, x).astype(np.int32) for x in items]
        self.shortest = min((min(len(x), width) for x in items if len(x)), default=0)
        self._automaton: ItemAutomaton | None = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self) -> ItemAutomaton:
        if self._automaton is None:
            self._automaton = ItemAutomaton([x.tolist() for x in self.items], self.width)
        return self._automaton

    def known_stretches(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """(text, first word in the text, word numbers) of stretches of known words that can hold a match."""
        if not len(self.vocabulary) or not len(hashes):
            return
        number = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[number] == hashes
        begin, end = known.copy(), known.copy()
        begin[1:] &= ~known[:-1]
        end[:-1] &= ~known[1:]
        some = np.diff(bounds) > 0
        begin[bounds[:-1][some]] = known[bounds[:-1][some]]
        end[bounds[1:][some] - 1] = known[bounds[1:][some] - 1]
        first, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
        long = stop - first >= self.shortest
        first, stop = first[long], stop[long]
        owner = np.searchsorted(bounds, first, "right") - 1
        for t, a, b in zip(owner.tolist(), first.tolist(), stop.tolist()):
            yield t, a - int(bounds[t]), number[a:b].tolist()


_FOUND = "doc_id long, _th long, n_words long, spans array<struct<start: int, stop: int>>, items array<long>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1]["stop"]:
            out[-1]["stop"] = max(stop, out[-1]["stop"])
        else:
            out.append({"start": start, "stop": stop})
    return out


def found_rows(block: ItemBlock):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                words = split_words(data, offsets, NOT_ALNUM, lower=True)
                spans: list[list[tuple[int, int]]] = [[] for _ in range(part.num_rows)]
                items: list[set[int]] = [set() for _ in range(part.num_rows)]
                for t, at, numbers in block.known_stretches(words.hashes, words.bounds):
                    for start, stop, which in block.automaton.stream(numbers):
                        spans[t].append((at + start, at + stop))
                        items[t].update(which)
                names = [sorted({i for k in found for i in block.ids[k]}) for found in items]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_th"), pa.array(words.counts.astype(np.int64)),
                     pa.array([merged(s) for s in spans], _SPANS), pa.array(names, pa.list_(pa.int64()))],
                    names=["doc_id", "_th", "n_words", "spans", "items"],
                )

    return run


def _word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in pieces(batch):
            words = split_words(data, offsets, NOT_ALNUM, lower=True)
            each = [words.hashes[a:b].tobytes() for a, b in zip(words.bounds[:-1], words.bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id"), pa.array(words.counts.astype(np.int64)), pa.array(each, pa.binary())],
                names=["item_id", "n", "words"])


def item_blocks(items: DataFrame, width: int, block_words: int, item_id: str = "item_id", text: str = "text") -> Iterator[ItemBlock]:
    """Blocks of items of at most ``block_words`` words and ids, or of one longer item.

    Items of equal words are one, with all their ids, before they are dealt into blocks.
    """
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    hashed = rows.mapInArrow(_word_hashes, "item_id long, n long, words binary").filter("n > 0")
    hashed = keep(hashed.groupBy("words").agg(F.max("n").alias("n"), F.collect_set("item_id").alias("ids")), "items")
    total = hashed.agg(F.sum(F.col("n") + F.size("ids")).alias("n")).first()
    # dealt by a hash of their words; half the bound leaves room for uneven blocks
    count = max(1, -(-2 * (total.n or 0) // block_words))
    for b in range(count):
        part = hashed.filter(F.pmod(F.xxhash64("words"), F.lit(count)) == b).toArrow()
        if part.num_rows:
            yield ItemBlock(part.column("ids").to_pylist(), [np.frombuffer(x, np.uint64) for x in part.column("words").to_pylist()], width)


def benchmark_hits(
    docs: DataFrame, items: DataFrame, width: int = 13, block_words: int = BLOCK_WORDS, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, _th, n_words, spans (merged hit intervals in words), items (ids).

    Words are runs of ASCII letters and digits and all characters beyond ASCII, with A-Z lower-cased. A
    hit is a run of ``width`` words of an item, or a whole item of fewer words. A null or empty text has
    no words. An item without words hits nothing; an item without an id hits words but isn't listed;
    repeated items count once by their id. No items: no hits. Extra columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = documents(docs, doc_id, text)
    blocks = item_blocks(items, width, block_words)
    first, second = next(blocks, ItemBlock([], [], width)), next(blocks, None)
    if second is None:
        return texts.mapInArrow(found_rows(first), _FOUND)
    # one pass after the other is written, so that the driver never holds more than two blocks
    passes = (texts.mapInArrow(found_rows(block), _FOUND) for block in chain([first, second], blocks))
    blocks = [keep(found, "hits") for found in passes]
    every = reduce(DataFrame.unionByName, blocks)
    # each block has each row once; a row that is repeated k times is given back k times
    rows = every.groupBy("doc_id", "_th").agg(
        F.first("n_words").alias("n_words"), (F.count("*") / len(blocks)).cast("int").alias("times"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # spans in rising order merge to the intervals of their union
    joined = F.aggregate("spans", F.lit(None).cast("array<struct<start: int, stop: int>>"), lambda have, s: F.when(
        have.isNull(), F.array(s)).when(s.start <= F.element_at(have, -1).stop, F.concat(
            F.slice(have, 1, F.size(have) - 1), F.array(F.struct(
                F.element_at(have, -1).start.alias("start"), F.greatest(F.element_at(have, -1).stop, s.stop).alias("stop"))))
    ).otherwise(F.concat(have, F.array(s))))
    rows = rows.withColumn("spans", F.coalesce(joined, F.array().cast("array<struct<start: int, stop: int>>")))
    return rows.select("doc_id", "_th", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), "times"))).drop("col")


def judged(hits: DataFrame, percent: int = 5) -> DataFrame:
    """``hits`` with n_hit, and contaminated: some word is hit, and ``percent`` per cent of the words at least."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s.stop - s.start))
    return hits.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(benchmark_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(names.cast("binary"), 256).alias("items_sha256"), "contaminated")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[s:s + 12], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 11, 2))) AS s FROM items WHERE len(words) > 0)),
spots AS (SELECT doc_id, s, n, array_to_string(words[s:s + n - 1], ' ') AS w FROM (
  SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(words) >= n)),
hits AS (SELECT DISTINCT p.doc_id, p.s, p.n, wins.item_id FROM spots p JOIN wins ON p.w = wins.w AND p.n = wins.n),
hit_words AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(words) AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id
"""
