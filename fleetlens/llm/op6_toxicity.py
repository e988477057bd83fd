"""Toxicity by a classifier chain: categories are predicted one after another, each from words and the earlier chances.

The chain has a linear model (logistic regression) per category. Its features are words and beginnings
of words of the text, present or not, and the chances of the categories before it. While training, those
chances come from models that have not seen the row (out-of-fold predictions), as they will when the
chain is applied.

All fitting is on a bounded sample of labelled rows. Spark counts in how many of its texts of either
label each word or beginning occurs; those that tell most about the label become features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.linear import SparseRows, fit_logistic, predict_logistic
from fleetlens.llm.tables import bounded_batches, documents, labelled_sample, read
from fleetlens.llm.words import Words, mix, pieces, signed, split_words

#: Bounds: words used as features, and labelled rows of which words are chosen and models fitted.
FEATURES, SAMPLE_ROWS, FOLDS = 2000, 12_000, 5
LEAST_TEXTS, PENALTY, THRESHOLD = 4, 0.05, 0.4
STEMS = (4, 5, 6, 8)
NOT_LETTER = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

# Words that name a category of a text labelled toxic. A toxic text of none of them
# has the last category, "toxic", alone.
CATEGORIES = {
    "insult": ("idiot", "stupid", "moron", "clown"),
    "contempt": ("trash", "scum", "loser", "worthless"),
    "disgust": ("disgusting", "pathetic"),
}


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each word and of its beginnings of ``STEMS`` bytes, which inflected forms share."""
    owners, found = [words.owner], [words.hashes]
    size = words.ends - words.starts
    for n in STEMS:
        long = size >= n
        at, total = words.starts[long], np.zeros(int(long.sum()), np.uint64)
        for i in range(n):
            total = mix(total + words.data[at + i] + np.uint64(n))
        owners.append(owners[0][long])
        found.append(total)
    return np.concatenate(owners), np.concatenate(found)


def distinct_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of each distinct feature of each text."""
    owner, value = word_features(words)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], value[new]


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece: in how many texts, and in how many with label 1, each word occurs."""
    for batch in batches:
        for part, data, offsets in pieces(batch):
            owner, value = distinct_features(split_words(data, offsets, NOT_LETTER, lower=True))
            label = part.column("label").to_numpy(zero_copy_only=False)
            unique, place = np.unique(value, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(unique)), pa.array(np.bincount(place, minlength=len(unique))),
                 pa.array(np.bincount(place, label[owner], len(unique)).astype(np.int64))], names=["word", "n", "n1"])


def choose_words(labelled: DataFrame, label: str, count: int = FEATURES, least: int = LEAST_TEXTS) -> np.ndarray:
    """The ``count`` words with the largest chi-square value between presence and label, over the labelled texts."""
    total, ones = labelled.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
    rows = labelled.select("text", F.col(label).cast("long").alias("label"))
    counts = rows.mapInArrow(word_counts, "word long, n long, n1 long").groupBy("word").agg(
        F.sum("n").cast("double").alias("n"), F.sum("n1").cast("double").alias("n1")).filter((F.col("n") >= least) & (F.col("n") < total))
    n, n1 = F.col("n"), F.col("n1")
    spread = n * (total - n) * float(ones) * float(total - ones)
    chi = F.when(spread > 0, (n1 * (total - ones) - (n - n1) * float(ones)) ** 2 * float(total) / spread).otherwise(0.0)
    top = counts.orderBy(chi.desc(), "word").select("word").limit(count).collect()
    return np.sort(np.array([r.word for r in top], np.int64).view(np.uint64))


def features_of(words: Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, number) of the chosen features in each text, each once."""
    owner, value = word_features(words)
    if not len(vocabulary) or not len(value):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, value), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[at] == value)
    pair = np.unique(owner[hit] * len(vocabulary) + at[hit])
    return pair // len(vocabulary), pair % len(vocabulary)


def feature_rows(vocabulary: np.ndarray, carried: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                owner, column = features_of(split_words(data, offsets, NOT_LETTER, lower=True), vocabulary)
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in carried), pa.ListArray.from_arrays(pa.array(bounds), pa.array(column.astype(np.int32)))],
                    names=[*carried, "features"])

    return run


@dataclass
class ToxicityChain:
    vocabulary: np.ndarray
    categories: list[str]
    weights: list[np.ndarray]

    def chances(self, owner: np.ndarray, column: np.ndarray, rows: int) -> np.ndarray:
        """Chance of each category, a column each."""
        out = np.zeros((rows, 0))
        for w in self.weights:
            out = np.column_stack([out, predict_logistic(with_chances(owner, column, rows, len(self.vocabulary), out), w)])
        return out


def with_chances(owner: np.ndarray, column: np.ndarray, rows: int, width: int, chances: np.ndarray) -> SparseRows:
    """Word features with the earlier categories' chances as further columns."""
    k = chances.shape[1]
    return SparseRows(
        np.concatenate([owner, np.repeat(np.arange(rows), k)]), np.concatenate([column, np.tile(np.arange(width, width + k), rows)]),
        rows, width + k, np.concatenate([np.ones(len(owner)), chances.ravel()]))


def fit_chain_on(owner: np.ndarray, column: np.ndarray, labels: np.ndarray, width: int, folds: int, penalty: float) -> list[np.ndarray]:
    """One model per column of ``labels``, each fitted with the out-of-fold chances of those before it."""
    rows = len(labels)
    fold = np.arange(rows) % folds
    chances, weights = np.zeros((rows, 0)), []
    for k in range(labels.shape[1]):
        data = with_chances(owner, column, rows, width, chances)
        weights.append(fit_logistic(data, labels[:, k], penalty))
        if k + 1 < labels.shape[1]:
            own = np.zeros(rows)
            for f in range(folds):
                apart = fold == f
                if apart.any() and not apart.all():
                    own[apart] = predict_logistic(data.of(apart), fit_logistic(data.of(~apart), labels[~apart, k], penalty))
            chances = np.column_stack([chances, own])
    return weights


def fit_toxicity(
    labelled: DataFrame, categories: Sequence[str], main: str, features: int = FEATURES, sample_rows: int = SAMPLE_ROWS,
    folds: int = FOLDS, penalty: float = PENALTY,
) -> ToxicityChain:
    """A chain over the 0/1 columns ``categories`` of ``labelled`` (text and those columns); ``main`` chooses the words.

    Rows with a null label are left out. Of more than ``sample_rows`` rows some are taken.
    """
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.coalesce("text", F.lit("")).alias("text"), *[F.col(c).cast("long").alias(c) for c in categories]).na.drop("any")
    vocabulary = choose_words(rows, main, features)
    schema = "".join(f"{c} long, " for c in ("h", *categories)) + "features array<int>"
    table = rows.withColumn("h", F.xxhash64("text")).mapInArrow(feature_rows(vocabulary, ["h", *categories]), schema).limit(sample_rows).toArrow()
    table = table.take(pa.array(np.lexsort([table.column(c).to_numpy() for c in (*categories, "h")]))) if table.num_rows else table
    lists = table.column("features").combine_chunks()
    owner = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy()) if table.num_rows else np.zeros(0, np.int64)
    column = lists.flatten().to_numpy().astype(np.int64) if table.num_rows else np.zeros(0, np.int64)
    labels = np.stack([table.column(c).to_numpy().astype(float) for c in categories], 1)
    return ToxicityChain(vocabulary, list(categories), fit_chain_on(owner, column, labels, len(vocabulary), folds, penalty))


def score_rows(chain: ToxicityChain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                owner, column = features_of(split_words(data, offsets, NOT_LETTER, lower=True), chain.vocabulary)
                chances = chain.chances(owner, column, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(np.ascontiguousarray(chances[:, k])) for k in range(chances.shape[1]))],
                    names=["doc_id", *(f"p_{c}" for c in chain.categories)])

    return run


def toxicity(docs: DataFrame, chain: ToxicityChain, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and p_<category> for each category of the chain.

    A null or empty text has no words and the chances of such. Whole texts count, however long; a word
    counts once per text, so length alone changes nothing. Repeated rows give repeated rows. Extra
    columns are ignored. A chain learned from no rows gives every text the same chances.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id long" + "".join(f", p_{c} double" for c in chain.categories)
    return documents(docs, doc_id, text).mapInArrow(score_rows(chain), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 0 when divided by 5; those rows are not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def with_categories(rows: DataFrame) -> DataFrame:
    """Texts with their toxic label and the categories named by ``CATEGORIES``."""
    low = F.lower("text")
    return rows.select("text", *[
        F.when((F.col("label") == 1) & low.rlike(rf"\b({'|'.join(words)})\b"), 1).otherwise(0).alias(name)
        for name, words in CATEGORIES.items()], F.col("label").alias("toxic"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labelled = with_categories(labelled_sample(docs, read(spark, sf_dir, "labels").filter(~held_out()), "toxic", SAMPLE_ROWS, 6))
    names = [*CATEGORIES, "toxic"]
    scores = toxicity(docs, fit_toxicity(labelled, names, "toxic"))
    return scores.select("doc_id", held_out().alias("held_out"), *[f"p_{c}" for c in CATEGORIES], F.col("p_toxic").alias("score"),
                         (F.col("p_toxic") >= THRESHOLD).cast("int").alias("predicted"), (F.col("p_toxic") >= THRESHOLD).alias("toxic"))
