"""Removal of passages that repeat anywhere in a corpus, by Rabin-Karp hashes of word windows.

Every window of ``width`` consecutive words gets a rolling hash. Two equal windows hold the same smallest
hash of ``GRAM`` words (their anchor), so windows are counted by anchor and hash, 128 bits together:

1. A text is cut into runs of windows with one anchor place, about 14 windows each. A run is its anchor
   and the hash of all its words. Anchors are counted: one that occurs once has no repeated window.
2. Runs of the others are counted. A run that occurs twice repeats in all of its windows. This settles
   whole copies and the inside of shared passages.
3. What is left, runs that occur once at an anchor that occurs elsewhere too (the edges of shared
   passages), is counted window by window, with each distinct other run of that anchor.
4. Removed windows merge into intervals per document.

Counting combines before each shuffle; rows of one hot run, anchor or window are never gathered. Counts
are written before they are joined, so that the joins read plain shuffles, which Spark splits where one
anchor holds much of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.tables import bounded_batches, documents, keep, read, same_row
from fleetlens.llm.words import Words, mix, pieces, powers, signed, split_words, window_hashes

GRAM = 8


def anchors(hashes: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of every window, the hash at its anchor, and the place of the anchor (the leftmost smallest)."""
    starts, _ = window_hashes(hashes, bounds, width)
    if not len(starts):
        return starts, np.zeros(0, np.uint64), starts
    at, grams = window_hashes(hashes, bounds, gram)
    value = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    value[at] = grams
    place = np.arange(len(hashes))
    have, want = 1, width - gram + 1  # the smallest of ``have`` consecutive places, doubled up to ``want``
    while have < want:
        step = min(have, want - have)
        take = value[:-step] <= value[step:]
        value = np.where(take, value[:-step], value[step:])
        place = np.where(take, place[:-step], place[step:])
        have += step
    return starts, value[starts], place[starts]


def text_runs(hashes: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor and content hash of every run."""
    starts, value, place = anchors(hashes, bounds, width, gram)
    if not len(starts):
        return starts, starts, value, value
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(starts)))
    begin, end = starts[first], starts[first] + counts + width - 1
    up, down = powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=total[1:])
    content = mix((total[end] - total[begin]) * down[begin] + mix(counts.astype(np.uint64)))
    return begin, counts, value[first], content


_RUNS = "doc_id long, _th long, start int, windows int, anchor long, content long"


def run_rows(width: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                words = split_words(data, offsets)
                begin, counts, anchor, content = text_runs(words.hashes, words.bounds, width, gram)
                own = np.searchsorted(words.bounds, begin, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(own)), part.column("_th").take(pa.array(own)),
                     pa.array((begin - words.bounds[own]).astype(np.int32)), pa.array(counts.astype(np.int32)),
                     pa.array(signed(anchor)), pa.array(signed(content))],
                    names=["doc_id", "_th", "start", "windows", "anchor", "content"],
                )

    return rows


def window_rows(width: int):
    """Windows of the runs listed with each text; ``times`` is how often the run occurs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                words = split_words(data, offsets)
                starts, hashes = window_hashes(words.hashes, words.bounds, width)
                place = np.full(len(words.hashes) + 1, -1)
                place[starts] = np.arange(len(starts))
                runs = part.column("runs")
                flat = runs.flatten()
                own = np.repeat(np.arange(part.num_rows), runs.value_lengths().to_numpy())
                begin, counts, anchor, times = (flat.field(k).to_numpy() for k in ("start", "windows", "anchor", "times"))
                which = np.repeat(np.arange(len(own)), counts)
                inner = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = begin[which] + inner
                owner = own[which]
                h = hashes[place[words.bounds[owner] + start]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(owner)), part.column("_th").take(pa.array(owner)),
                     pa.array(start.astype(np.int32)), pa.array(anchor[which]), pa.array(signed(h)),
                     pa.array(times[which].astype(np.int64))],
                    names=["doc_id", "_th", "start", "anchor", "hash", "times"],
                )

    return rows


def repeated_spans(docs: DataFrame, width: int, gram: int = GRAM) -> DataFrame:
    """Per row with repeated windows: ``spans``, an array of (start, length) in words. They may overlap."""
    spark = docs.sparkSession
    bounded_batches(spark)
    gram = min(gram, width)
    # an anchor that occurs once has no repeated window; the runs are cheaper to find twice than to write
    runs = docs.filter("text IS NOT NULL").mapInArrow(run_rows(width, gram), _RUNS)
    often = keep(runs.groupBy("anchor").count().filter("count > 1").select("anchor"), "often")
    runs = keep(runs.join(often, "anchor", "left_semi"), "runs")
    contents = keep(runs.groupBy("anchor", "content").agg(F.count("*").alias("times"), F.min("doc_id").alias("first")), "contents")
    # "open" anchors have several different runs; one document of each is looked into
    kinds = keep(contents.groupBy("anchor").agg((F.count("*") > 1).alias("open")), "kinds")
    state = keep(contents.join(kinds, "anchor"), "state")
    marked = keep(runs.join(state, ["anchor", "content"]).filter("open OR times > 1").select(
        "doc_id", "_th", "start", "windows", "anchor", "times",
        (F.col("open") & F.col("first").eqNullSafe(F.col("doc_id"))).alias("counted")), "marked")
    listed = marked.filter("counted").groupBy("doc_id", "_th").agg(
        F.collect_list(F.struct("start", "windows", "anchor", "times")).alias("runs"))
    windows = keep(
        docs.alias("d").join(listed.alias("r"), same_row("d", "r")).select("d.doc_id", "d._th", "d.text", "r.runs")
        .mapInArrow(window_rows(width), "doc_id long, _th long, start int, anchor long, hash long, times long"), "windows")
    twice = keep(windows.groupBy("anchor", "hash").agg(F.sum("times").alias("total")).filter("total > 1").drop("total"), "twice")
    single = windows.filter("times = 1").join(twice, ["anchor", "hash"], "left_semi").select("doc_id", "_th", "start", F.lit(width).alias("length"))
    whole = marked.filter("times > 1").select("doc_id", "_th", "start", (F.col("windows") + (width - 1)).alias("length"))
    return whole.unionByName(single).groupBy("doc_id", "_th").agg(F.collect_list(F.struct("start", "length")).alias("spans"))


def removed_mask(bounds: np.ndarray, owner: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Words covered by spans: overlapping and touching spans merge into maximal intervals."""
    edges = np.zeros(bounds[-1] + 1, np.int64)
    np.add.at(edges, bounds[owner] + start, 1)
    np.add.at(edges, bounds[owner] + start + length, -1)
    return np.cumsum(edges)[:-1] > 0


def kept_texts(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> tuple[Words, list[bytes], list[np.ndarray]]:
    """Words of the texts of a piece, their kept words joined by one blank, and which words are removed, by text."""
    words = split_words(data, offsets)
    spans = part.column("spans")
    flat = spans.flatten()
    own = np.repeat(np.arange(part.num_rows), spans.value_lengths().fill_null(0).to_numpy())
    gone = removed_mask(words.bounds, own, flat.field("start").to_numpy(), flat.field("length").to_numpy())
    whole, kept, masks = words.data.tobytes(), [], []
    for lo, hi in zip(words.bounds[:-1], words.bounds[1:]):
        masks.append(gone[lo:hi])
        left = np.flatnonzero(~masks[-1]) + lo
        kept.append(b" ".join([whole[a:b] for a, b in zip(words.starts[left].tolist(), words.ends[left].tolist())]))
    return words, kept, masks


def strip_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in pieces(batch):
            words, kept, masks = kept_texts(part, data, offsets)
            intervals = []
            for mask in masks:
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                intervals.append([{"start": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)])
            n_removed = [int(mask.sum()) for mask in masks]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("_th"), pa.array(words.counts.astype(np.int64)), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(intervals, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                 part.column("text").is_valid()],
                names=["doc_id", "_th", "n_words", "n_removed", "kept_text", "removed", "had_text"],
            )


def substring_dedup(docs: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text, removed (word intervals), had_text.

    Words are maximal runs of other characters than space and tab to carriage return. A word is removed
    if a window of ``width`` words that covers it starts at another place too, in any row, judged on the
    input. A repeated row, also with the same id, counts as another place. A null or empty text has no
    words and an empty kept_text. Rows without an id are treated like others. Extra columns are ignored.
    """
    rows = documents(docs, doc_id, text)
    spans = repeated_spans(rows, width)
    joined = rows.alias("d").join(spans.alias("s"), same_row("d", "s"), "left").select("d.doc_id", "d._th", "d.text", "s.spans")
    return joined.mapInArrow(strip_rows, (
        "doc_id long, _th long, n_words long, n_removed long, kept_text string, "
        "removed array<struct<start: int, stop: int>>, had_text boolean")).drop("_th")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup(read(spark, sf_dir, "documents"), width=35)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS s FROM docs WHERE len(words) >= 35),
windows AS (SELECT doc_id, s, array_to_string(words[s:s + 34], ' ') AS w FROM places),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM windows WHERE w IN (SELECT w FROM twice)),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
kept AS (SELECT e.doc_id, count(*) AS n, string_agg(e.word, ' ' ORDER BY e.i) AS text
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
