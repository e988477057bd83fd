"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own look and that of the lines before and after it: shares of
letters, capitals, digits and symbols, length, repeated words, repetition of the line. Labels are known
per document, so while training each line has its document's label. A document's quality is the mean of
the lines' chances to be good (forward-backward marginals), weighted by their length.

Lines of all texts of a batch are measured at once from running sums over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.crf import Chain, fit_chain, forward_backward
from fleetlens.llm.linear import SparseRows
from fleetlens.llm.tables import bounded_batches, documents, labelled_sample, read
from fleetlens.llm.words import pieces, split_words

#: Bounds of the sample fitted on: texts, and lines of them all together.
SAMPLE_TEXTS, SAMPLE_LINES = 3000, 40_000
THRESHOLD, PENALTY = 0.3, 1.0
BINS = 10
#: Features of a line are its measures, each in one of ``BINS`` bins, for it and its two neighbours.
MEASURES = 11
OWN = MEASURES * BINS
#: Three times a line's own features, with one more per neighbour if there is none.
WIDTH = 3 * OWN + 2


def _class_bytes() -> np.ndarray:
    """Letter, capital, digit, symbol and stop of each byte."""
    table = np.zeros((5, 256), np.int8)
    for b in range(256):
        c = chr(b)
        table[0, b] = b >= 0x80 or c.isalpha()
        table[1, b] = "A" <= c <= "Z"
        table[2, b] = "0" <= c <= "9"
        table[4, b] = c in ".,;:?"
        table[3, b] = not (table[0, b] or table[2, b] or table[4, b] or c.isspace() or c in "'-\"()")
    return table


_CLASSES = _class_bytes()


@dataclass
class Lines:
    owner: np.ndarray  # text of each line
    size: np.ndarray  # bytes
    bins: np.ndarray  # line x measure
    bounds: np.ndarray  # lines of each text


def lines_of(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines with a word, in order, and their measures."""
    texts = len(offsets) - 1
    cuts = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([offsets[:-1], cuts + 1]))
    end = np.append(begin[1:], offsets[-1])
    words = split_words(data, offsets)
    first = np.searchsorted(words.starts, begin)
    count = np.searchsorted(words.starts, end) - first
    some = count > 0
    begin, end, first, count = begin[some], end[some], first[some], count[some]
    owner = np.searchsorted(offsets, begin, "right") - 1
    lines = len(begin)
    bounds = np.searchsorted(owner, np.arange(texts + 1))
    if not lines:
        return Lines(owner, end - begin, np.zeros((0, MEASURES), np.int64), bounds)
    sums = []
    for table in _CLASSES:
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        sums.append(total[end] - total[begin])
    letters, capitals, digits, symbols, stops = sums
    size = (words.ends[first + count - 1] - words.starts[first]).astype(np.int64)
    of_word = np.repeat(np.arange(lines), count)
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    hashes = words.hashes[at]
    order = np.lexsort((hashes, of_word))
    fresh = np.ones(len(at), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
    distinct = np.bincount(of_word[order], fresh, lines)
    again = np.zeros(len(at), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    repeats = np.bincount(of_word, again, lines)
    # a line's own hash: how many lines of the text are the same
    with np.errstate(over="ignore"):
        named = np.add.reduceat(hashes * (np.arange(len(hashes), dtype=np.uint64) - np.repeat(np.cumsum(count) - count, count).astype(np.uint64) + np.uint64(1)), np.cumsum(count) - count)
    _, kind, many = np.unique(np.stack([owner.astype(np.uint64), named]), axis=1, return_inverse=True, return_counts=True)
    same = many[kind.ravel()]
    last = data[np.maximum(words.ends[first + count - 1] - 1, 0)]
    head = data[words.starts[first]]
    share = lambda x: np.minimum((x / np.maximum(size, 1) * 20).astype(np.int64), BINS - 1)  # noqa: E731  half of a line is the top
    whole = lambda x: np.minimum((x * BINS).astype(np.int64), BINS - 1)
    bins = np.stack([
        whole(letters / np.maximum(size, 1)), share(capitals), share(digits), share(symbols), share(stops),
        np.minimum(np.log2(count).astype(np.int64), BINS - 1), np.minimum(size // np.maximum(count, 1) // 2, BINS - 1),
        whole(distinct / count), whole(repeats / count), np.minimum(np.log2(same).astype(np.int64), BINS - 1),
        np.isin(last, np.frombuffer(b".!?:", np.uint8)) + 2 * np.isin(head, np.arange(65, 91)) + 4 * _CLASSES[3][last].astype(np.int64),
    ], 1)
    return Lines(owner, size, bins, bounds)


def sparse(lines: Lines) -> SparseRows:
    """Feature rows of lines: their own bins and those of the lines before and after in the text."""
    n = len(lines.owner)
    own = lines.bins + np.arange(MEASURES) * BINS
    columns = [own]
    for k, shift in ((1, -1), (2, 1)):
        near = np.arange(n) + shift
        inside = (near >= 0) & (near < n)
        inside[inside] = lines.owner[near[inside]] == lines.owner[inside]
        columns.append(np.where(inside[:, None], own[np.where(inside, near, 0)] + k * OWN, 3 * OWN + k - 1))
    column = np.concatenate(columns, 1)
    return SparseRows(np.repeat(np.arange(n), column.shape[1]), column.ravel(), n, WIDTH)


@dataclass
class QualityModel:
    chain: Chain | None
    prior: float  # the score of a text without lines


def fit_quality(
    labelled: DataFrame, label: str = "quality", text: str = "text", sample_texts: int = SAMPLE_TEXTS,
    sample_lines: int = SAMPLE_LINES, penalty: float = PENALTY,
) -> QualityModel:
    """A model from texts with a 0/1 label; of more than ``sample_texts`` texts or ``sample_lines`` lines some are taken.

    Rows with a null label are left out. If only one label occurs, or no text has a line, the score is
    the share of label 1 for every text, and a half if there are no rows.
    """
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("long").alias("label")).filter("label IS NOT NULL")
    total, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = ones / total if total else 0.5
    sample = rows.withColumn("h", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                lines = lines_of(data, offsets)
                bounds = (lines.bounds * MEASURES).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("h"), part.column("label"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(lines.bins.ravel().astype(np.int32)))],
                    names=["h", "label", "bins"])

    found = sample.mapInArrow(run, "h long, label long, bins array<int>").filter(F.size("bins") > 0)
    found = found.dropDuplicates(["h", "label"]).limit(sample_texts).toArrow()
    if not found.num_rows:
        return QualityModel(None, prior)
    found = found.take(pa.array(np.lexsort((found.column("label").to_numpy(), found.column("h").to_numpy()))))
    sizes = found.column("bins").combine_chunks().value_lengths().to_numpy() // MEASURES
    upto = int(np.searchsorted(np.cumsum(sizes), sample_lines, "right"))
    found, sizes = found.slice(0, max(upto, 1)), sizes[: max(upto, 1)]
    label = found.column("label").to_numpy()
    if label.min() == label.max():
        return QualityModel(None, prior)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bins = found.column("bins").combine_chunks().flatten().to_numpy().reshape(-1, MEASURES).astype(np.int64)
    rows = sparse(Lines(owner, np.ones(len(owner)), bins, bounds))
    return QualityModel(fit_chain(rows, bounds, label[owner].astype(np.int64), penalty=penalty), prior)


def score_rows(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                lines = lines_of(data, offsets)
                score = np.full(part.num_rows, model.prior)
                if model.chain is not None and len(lines.owner):
                    good, _, _ = forward_backward(model.chain.emissions(sparse(lines)), lines.bounds, model.chain.moves)
                    weight = np.bincount(lines.owner, lines.size, part.num_rows)
                    mean = np.bincount(lines.owner, lines.size * good, part.num_rows) / np.maximum(weight, 1)
                    score = np.where(weight > 0, mean, score)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.clip(score, 0, 1)), pa.array(np.diff(lines.bounds).astype(np.int64))], names=["doc_id", "score", "n_lines"])

    return run


def quality(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted (score at least ``threshold``), n_lines.

    Lines end at a line feed; lines without a word are left out. A text without lines, also a null one,
    gets the share of label 1 in training. Whole texts count. Repeated rows give repeated rows. Extra
    columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = documents(docs, doc_id, text).mapInArrow(score_rows(model), "doc_id long, score double, n_lines long")
    return rows.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_lines")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 0 when divided by 5; a row without an id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").filter(~held_out())
    model = fit_quality(labelled_sample(docs, labels, "quality", SAMPLE_TEXTS, 10), label="label")
    return quality(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
