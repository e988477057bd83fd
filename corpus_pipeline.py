"""The corpus pipeline: language, near-duplicates, repeated passages, contamination, mix.

Each stage works on all that the one before kept, takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``docs``; the last adds ``copy``. Decisions are made on whole rows
where they stand, or joined by id and a hash of the text, so null and repeated ids are safe. Extra columns
are passed on. Null texts go in the first stage; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import op1_substring_dedup as op1
from fleetlens.llm import op2_language_id as op2
from fleetlens.llm import op4_mix_sources as op4
from fleetlens.llm import op5_decontaminate as op5
from fleetlens.llm import op7_minhash_dedup as op7
from fleetlens.llm.tables import bounded_batches, documents, keep, read
from fleetlens.llm.words import NOT_ALNUM, pieces, split_words

#: A passage of so many words that occurs twice is removed where it occurs.
PASSAGE_WORDS = 50
#: Joined columns begin like this, so that no column of the documents clashes with them.
_OWN = "_fleetlens_"


def _joined(docs: DataFrame, decisions: DataFrame, keys: Sequence[str] = ("doc_id",), how: str = "inner") -> DataFrame:
    """``docs`` with the columns of ``decisions`` (``keys``, ``_th`` and others), named with ``_OWN``."""
    named = decisions.select(*[F.col(c).alias(_OWN + c) for c in decisions.columns])
    marked = docs.withColumn(f"{_OWN}text", F.xxhash64("text"))
    same = marked[f"{_OWN}text"] == named[f"{_OWN}_th"]
    for k in keys:
        same &= marked[k].eqNullSafe(named[_OWN + k])
    return marked.join(named, same, how)


def _each_once(docs: DataFrame, decisions: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Rows of ``docs`` with their decision; rows that agree in ``keys`` and text, counted in ``times``, come once."""
    rows = _joined(docs, decisions, keys)
    once, many = rows.filter(F.col(f"{_OWN}times") == 1), rows.filter(F.col(f"{_OWN}times") > 1)
    return once.unionByName(many.dropDuplicates([*[_OWN + k for k in keys], f"{_OWN}_th"]))


def _with_texts(part: pa.RecordBatch, texts: Sequence[str | None]) -> pa.RecordBatch:
    """The rows with the texts that are given in place of their own; n_chars follows."""
    own = part.column("text")
    new = pa.array(texts, pa.string())
    columns = {name: part.column(name) for name in part.schema.names}
    columns["text"] = pa.compute.coalesce(new, own.cast(pa.string()))
    if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
        columns["n_chars"] = pa.compute.coalesce(pa.compute.utf8_length(new).cast(columns["n_chars"].type), columns["n_chars"])
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without a letter go, and no others, also if no language was learned.

    The model is learned from the documents given.
    """
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(op2.learned(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, size=op2.PIECE):
                if sent.value.languages:
                    stay = [x != "und" for x in op2.predictions(sent.value, data, offsets)[0]]
                else:
                    stay = op2.lettered(sent.value, data, offsets)[2]
                yield part.filter(pa.array(stay))

    return docs.mapInArrow(run, docs.schema)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Of rows that share that id the one with the smallest text hash stays, once. Rows without an id all stay.
    """
    kept = op7.near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    rows = documents(docs).select("doc_id", "_th")
    counted = rows.join(kept, "doc_id").groupBy("doc_id", "_th").agg(F.count("*").alias("times"))
    chosen = counted.groupBy("doc_id").agg(F.min(F.struct("_th", "times")).alias("c")).select("doc_id", "c._th", "c.times")
    nameless = rows.filter("doc_id IS NULL").distinct().withColumn("times", F.lit(1).cast("long"))
    return _each_once(docs, keep(chosen.unionByName(nameless), "chosen")).select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that repeat, as their other words joined by one blank; a text that loses all its words goes.

    A text without such passages stays as it is.
    """
    spans = op1.repeated_spans(documents(docs), PASSAGE_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                _, kept, gone = op1.kept_texts(part.select([f"{_OWN}spans"]).rename_columns(["spans"]), data, offsets)
                texts = [k.decode("utf-8") if g.any() else None for k, g in zip(kept, gone)]
                yield _with_texts(part.drop_columns([f"{_OWN}spans"]), texts).filter(pa.array([t != "" for t in texts]))

    return _joined(docs, spans, how="left").select(*docs.columns, f"{_OWN}spans").mapInArrow(run, docs.schema)


def _without_spans(whole: bytes, words, word: int, start: int, stop: int, spans: Sequence[dict[str, int]]) -> str:
    """A text without its spans of words and what stands between their words."""
    left, at = [], start
    for s in spans:
        left.append(whole[at : words.starts[word + s["start"]]])
        at = int(words.ends[word + s["stop"] - 1])
    return b"".join([*left, whole[at:stop]]).decode("utf-8")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the contaminated ones; from the others the words of benchmark passages are cut."""
    hits = op5.judged(op5.benchmark_hits(docs, read(spark, sf_dir, "benchmark"))).filter("n_hit > 0")
    hits = keep(hits.select("doc_id", "_th", "spans", "contaminated").dropDuplicates(["doc_id", "_th"]), "hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                words = split_words(data, offsets, NOT_ALNUM, lower=True)
                whole, texts = data.tobytes(), []
                for i, spans in enumerate(part.column(f"{_OWN}spans").to_pylist()):
                    texts.append(spans and _without_spans(whole, words, int(words.bounds[i]), int(offsets[i]), int(offsets[i + 1]), spans))
                yield _with_texts(part.drop_columns([f"{_OWN}spans"]), texts)

    rows = _joined(docs, hits, how="left").filter(~F.coalesce(F.col(f"{_OWN}contaminated"), F.lit(False)))
    return rows.select(*docs.columns, f"{_OWN}spans").mapInArrow(run, docs.schema)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered by ``copy`` from 1; of equal rows one stands for all."""
    keys = ["doc_id", "source"]
    taken = op4.mix_sources(docs).groupBy(*keys, "_th").agg(F.sum("copies").alias("copies"), F.count("*").alias("times")).filter("copies > 0")
    rows = _each_once(docs, keep(taken, "taken"), keys)
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{_OWN}copies").cast("int"))).alias("copy")
    return rows.select(*[c for c in docs.columns if c.lower() != "copy"], copies)


#: (name, function of (spark, docs, sf_dir)) in the order of the run.
STAGES = [
    ("language", language_stage),
    ("near-duplicates", near_duplicate_stage),
    ("passages", substring_stage),
    ("contamination", decontamination_stage),
    ("mix", mixing_stage),
]

#: The first stage decides by a trained model, which SQL can't express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``; each stage's result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
