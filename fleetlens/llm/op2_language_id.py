"""Language by cross-parsing: a text is cut into longest matches with labelled text of each language.

For every language a suffix automaton is built over a sample of its labelled text. A text is parsed into
phrases, each the longest piece that occurs in the language's sample; the automaton yields it letter by
letter. The fewer phrases, each weighted by the bits that name a place in the sample, the closer the
text is to the language. Case is folded, every letter of the sample is a symbol, letters that it lacks are
one more, and a run of other characters is one blank. Transitions by the ``LETTERS`` most frequent letters
stand in a table, those by all others, as in scripts of many letters, in a sorted list.

Parsing runs on all texts of a batch at once: texts are cut into blocks of ``BLOCK`` symbols, each parsed
by itself in each language, and one step advances every block by a symbol.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.tables import bounded_batches, documents, read
from fleetlens.llm.words import pieces

#: The sample's bound: so many characters of labelled text for all languages together.
SAMPLE_CHARS = 80_000
LETTERS, BLOCK, PIECE = 46, 256, 1 << 20


def suffix_transitions(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``, by symbol, for each state."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new, state = len(moves), last
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        while state >= 0 and c not in moves[state]:
            moves[state][c] = new
            state = link[state]
        if state >= 0:
            there = moves[state][c]
            if length[there] == length[state] + 1:
                link[new] = there
            else:
                copy = len(moves)
                moves.append(dict(moves[there]))
                link.append(link[there])
                length.append(length[state] + 1)
                while state >= 0 and moves[state].get(c) == there:
                    moves[state][c] = copy
                    state = link[state]
                link[there] = link[new] = copy
        last = new
    return moves


@dataclass
class LanguageModel:
    """Suffix automata of all languages, their states in a row.

    ``step[state * width + symbol]`` is twice the next state, plus 1 if a phrase begins, for symbols below
    ``width``. Of a rarer symbol ``begin[language, symbol - width]`` is the state where a phrase begins, and
    ``rare_to`` the next state after ``rare_keys``, state * number of symbols + symbol, in order.
    """

    languages: list[str]
    alphabet: str
    roots: np.ndarray
    bits: np.ndarray
    step: np.ndarray
    begin: np.ndarray
    rare_keys: np.ndarray
    rare_to: np.ndarray
    _fold: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_fold": None}

    @property
    def width(self) -> int:
        return min(len(self.alphabet), LETTERS) + 2  # blank, any letter that the sample lacks, the first of the alphabet

    @property
    def symbols(self) -> int:
        return len(self.alphabet) + 2

    @property
    def fold(self) -> np.ndarray:
        """Symbol of each code point."""
        if self._fold is None:
            number = {c: i + 2 for i, c in enumerate(self.alphabet)}
            fold = np.zeros(0x110000, np.min_scalar_type(self.symbols))
            for point in range(0x110000):
                c = chr(point)
                if c.isalpha():
                    fold[point] = number.get(c.lower(), 1)
            self._fold = fold
        return self._fold

    def next(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """As ``step``, for states (a row per language) at ``symbols``."""
        got = self.step[state * self.width + np.minimum(symbols, self.width - 1)]
        rare = np.flatnonzero(symbols >= self.width)
        if len(rare):
            symbol = symbols[rare].astype(np.int64)
            keys = state[:, rare] * self.symbols + symbol
            at = np.minimum(np.searchsorted(self.rare_keys, keys), len(self.rare_keys) - 1)
            goes_on = self.rare_keys[at] == keys
            got[:, rare] = np.where(goes_on, 2 * self.rare_to[at], 2 * self.begin[:, symbol - self.width] + 1)
        return got


def fit_languages(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """A model from rows with a text and a language.

    The sample is bounded: ``sample_chars`` characters, in equal shares per language, of rows chosen by
    a hash of their text; of a text longer than the share its first part. Rows with null are left out.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(r"lang IS NOT NULL AND text RLIKE '\\p{L}'")
    totals = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"), F.count("*").alias("n")).collect()  # a row per language
    share = sample_chars // max(len(totals), 1)
    # three times the rows that fill the share on average, and 20: enough whatever the hash picks
    parts = rows.sparkSession.createDataFrame([(t.lang, 3 * share / max(t.chars, 1) + 20 / t.n) for t in totals], "lang string, part double")
    picked = rows.join(F.broadcast(parts), "lang")  # as many rows as were just collected
    picked = picked.withColumn("h", F.xxhash64("text")).filter(
        F.pmod("h", F.lit(1 << 40)) < F.col("part") * float(1 << 40)).select("lang", "h", F.substring("text", 1, share).alias("text"))
    texts: dict[str, list[str]] = {t.lang: [] for t in totals}
    room = dict.fromkeys(texts, share)
    for row in sorted(picked.dropDuplicates(["lang", "h"]).collect(), key=lambda r: (r.lang, r.h)):
        texts[row.lang].append(row.text[: room[row.lang]])
        room[row.lang] -= len(texts[row.lang][-1])
    return language_model({k: " ".join(v) for k, v in texts.items()})


def language_model(texts: dict[str, str]) -> LanguageModel:
    languages = sorted(texts)
    letters = Counter(c for t in texts.values() for c in t.lower() if c.isalpha() and len(c.lower()) == 1)
    alphabet = "".join(sorted(letters, key=lambda c: (-letters[c], c)))
    none = np.zeros(0, np.int64)
    model = LanguageModel(languages, alphabet, np.zeros(len(languages), np.int64), np.zeros(len(languages)), none, none, none, none)
    width, tables, first = model.width, [], 0
    model.begin = np.zeros((len(languages), model.symbols - width), np.int64)
    rare: list[tuple[int, int]] = []
    for i, language in enumerate(languages):
        symbols = collapse(model.fold[code_points(texts[language])], np.zeros(1, np.int64))[0]
        moves = suffix_transitions(symbols.tolist())
        root = np.zeros(width, np.int64)  # where a phrase begins; the root itself for symbols it lacks
        for c, to in moves[0].items():
            if c < width:
                root[c] = to
            else:
                model.begin[i, c - width] = to
        model.begin[i] += first
        table = np.tile(2 * (root + first) + 1, (len(moves), 1))
        for state, by_symbol in enumerate(moves[1:], 1):
            for c, to in by_symbol.items():
                if c < width:
                    table[state, c] = 2 * (to + first)
                else:
                    rare.append(((state + first) * model.symbols + c, to + first))
        tables.append(table.astype(np.int32))
        model.roots[i], model.bits[i] = first, np.log2(len(symbols) + 1)
        first += len(moves)
    rare.sort()
    model.rare_keys, model.rare_to = np.array([k for k, _ in rare] or [-1], np.int64), np.array([to for _, to in rare] or [0], np.int64)
    model.step = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
    return model


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def collapse(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of blanks as one, and the starts of texts in what is left."""
    stay = np.ones(len(symbols), bool)
    stay[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    stay[starts[starts < len(symbols)]] = True
    place = np.concatenate([[0], np.cumsum(stay)])
    return symbols[stay], place[starts]


def phrase_counts(model: LanguageModel, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Phrases of each text in each language."""
    counts = np.diff(bounds)
    blocks = -(-counts // BLOCK)
    owner = np.repeat(np.arange(len(counts)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = bounds[owner] + nth * BLOCK
    size = np.minimum(bounds[owner + 1] - begin, BLOCK)
    order = np.argsort(-size, kind="stable")
    owner, begin, size = owner[order], begin[order], size[order]
    state = np.repeat(model.roots[:, None], len(owner), 1)
    phrases = np.zeros(state.shape, np.int64)
    live = np.searchsorted(-size, -np.arange(1, BLOCK + 1), "right")  # blocks with more than j symbols stand first
    for j in range(int(size[0]) if len(size) else 0):
        n = live[j]
        got = model.next(state[:, :n], symbols[begin[:n] + j])
        phrases[:, :n] += got & 1
        state[:, :n] = got >> 1
    return np.stack([np.bincount(owner, p, len(counts)) for p in phrases], 1) if len(phrases) else np.zeros((len(counts), 0))


def lettered(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of a piece, the bounds of its texts in them, and whether each text has a letter."""
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    symbols, bounds = collapse(model.fold[code_points(data.tobytes().decode("utf-8"))], lead[offsets])
    letters = np.concatenate([[0], np.cumsum(symbols != 0)])
    return symbols, bounds, letters[bounds[1:]] > letters[bounds[:-1]]


def predictions(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and least cost of each text of a piece."""
    symbols, bounds, has = lettered(model, data, offsets)
    if not model.languages:
        return ["und"] * len(has), np.zeros(len(has)), np.zeros(len(has))
    cost = phrase_counts(model, symbols, bounds) * model.bits / np.maximum(np.diff(bounds), 1)[:, None]
    first, best = cost.argmin(1), cost.min(1)
    rest = np.where(np.arange(cost.shape[1]) == first[:, None], np.inf, cost).min(1)
    score = np.where(has, 1 - best / np.maximum(rest, 1e-12), 0.0).clip(0, 1)
    return [model.languages[k] if h else "und" for k, h in zip(first.tolist(), has.tolist())], score, np.where(has, best, 0.0)


def predict_rows(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, size=PIECE):
                lang, score, cost = predictions(model, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_th"), pa.array(lang, pa.string()), pa.array(score), pa.array(cost)],
                    names=["doc_id", "_th", "lang_pred", "score", "cost"])

    return run


def identify_language(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, _th, lang_pred, score, cost.

    ``lang_pred`` is the language of least cost (phrase bits per symbol), the first by code point on a
    tie, and ``und`` for a null text, one without a letter, or if no language was learned; ``score`` is
    the share by which the cost of the next language is higher, 1 if there is none, 0 for ``und``.
    Repeated rows give repeated rows. Extra columns are ignored; ``_th`` is a hash of the text.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from predict_rows(sent.value)(batches)

    return documents(docs, doc_id, text).mapInArrow(run, "doc_id long, _th long, lang_pred string, score double, cost double")


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 when divided by 3; a row without an id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned(docs: DataFrame) -> LanguageModel:
    return fit_languages(docs.filter(~held_out() & F.col("doc_id").isNotNull()))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify_language(docs, learned(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
