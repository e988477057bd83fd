"""Grouping of spelling variants: words one edit apart, by asymmetric q-chunks.

A word of length L gives two disjoint chunks, its first L div 2 characters and the others. One edit falls
into one of them and leaves the other whole. So of two words one edit apart, the shorter (or smaller) one
gives its chunks and the other its positional grams of the chunks' lengths; they share a gram that is a
chunk, at most one place further. Pairs found this way are verified by their edit distance.

Chunks such as "ción" begin very many words. What a chunk leaves of a word is therefore cut into two
chunks again: the edit leaves one of these as well, so a key is a whole chunk with half of the rest. All
pairs are still found, and the words of one key stay few.

Every word points to its commonest neighbour, if that is much commoner. Roots of these pointers are found
by doubling: each round replaces a pointer by the pointer of its goal.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.tables import bounded_batches, keep, read
from fleetlens.llm.words import distinct_ranges, lower_ascii, pieces, range_places, split_words

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A run is misspelt if this divides its checksum.
GARBLE = 97
#: A word's form must be so many times as frequent.
RATIO = 2
_PIECE = 4 << 20
#: Checksums of longer runs (in bytes) are computed one by one.
_LONG = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of byte ranges that go on from the checksums ``before``, a byte of all ranges at a time."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order], lengths[order]
    state = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-left, -_LONG, "left"))
    for k in range(long):
        state[k] = zlib.crc32(data[at[k] : at[k] + left[k]].tobytes(), int(before[order[k]])) ^ 0xFFFFFFFF
    for j in range(int(left[long]) if long < len(left) else 0):
        stop = int(np.searchsorted(-left, -j, "left"))  # ranges longer than j
        part = state[long:stop]
        state[long:stop] = _CRC[(part ^ data[at[long:stop] + j]) & np.uint32(255)] ^ (part >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def letters_only(data: np.ndarray) -> np.ndarray:
    """A-Z lowered, and a blank for every byte that is in no character of A-Z, a-z, U+00C0 to U+00FF."""
    low = lower_ascii(data)
    latin = data == 0xC3  # U+00C0 to U+00FF are this byte and one more
    kept = ((low >= 97) & (low <= 122)) | latin
    kept[1:] |= latin[:-1]
    return np.where(kept, low, 32).astype(np.uint8)


def word_rows(least_length: int, garble: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, size=_PIECE):
                data = letters_only(data)
                words = split_words(data, offsets, b" ")
                lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                chars = lead[words.ends] - lead[words.starts]
                long = chars >= least_length
                starts, ends, chars, owner = words.starts[long], words.ends[long], chars[long], words.owner[long]
                ids = part.column("doc_id").cast(pa.string()).fill_null("").to_pylist()
                before = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
                crc = checksums(data, starts, ends, before[owner]).astype(np.int64)
                bad = crc % garble == 0
                misspelt: Counter[str] = Counter()
                for a, b, n, h in zip(starts[bad].tolist(), ends[bad].tolist(), chars[bad].tolist(), crc[bad].tolist()):
                    word = data[a:b].tobytes().decode()
                    if n > least_length:
                        misspelt[word[: h % n] + word[h % n + 1 :]] += 1
                starts, ends = starts[~bad], ends[~bad]
                first, number = distinct_ranges(data, starts, ends)
                times = np.bincount(number, minlength=len(first))
                lengths = ends[first] - starts[first]
                spelt = pa.StringArray.from_buffers(
                    len(first), pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)),
                    pa.py_buffer(np.ascontiguousarray(data[range_places(starts[first], lengths)])))
                yield pa.RecordBatch.from_arrays([spelt, pa.array(times.astype(np.int64))], names=["word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(misspelt), pa.string()), pa.array(list(misspelt.values()), pa.int64())], names=["word", "n"])

    return rows


def count_words(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, garble: int = GARBLE,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Rows (word, n): the words of at least ``least_length`` characters that occur at least ``least_count`` times.

    Runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lowered, are words. A run whose crc32 after the id and a
    colon is a multiple of ``garble`` loses the character at crc32 modulo its length. Words are counted per
    piece of a batch first, so a frequent one gives few rows. A null text has no words, a null id counts as
    an empty one; repeated rows count each. A very long text is one piece, with some 40 bytes per byte.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    counted = rows.mapInArrow(word_rows(least_length, garble), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def keys(longer: int) -> Column:
    """Keys of a word's grams that can be chunks of a word ``longer`` characters shorter; for 0, its own chunks.

    Four keys: either chunk, with either half of the rest. In a word one character longer a chunk lies at
    its place if the insertion is behind it, else one place further; a half of the rest likewise.
    """
    size = F.char_length("word") - longer
    half = (size / 2).cast("int")

    def gram(start: Column, stop: Column, shift: int) -> Column:
        return F.substring("word", start + (1 + shift), stop - start)

    zero, out = F.lit(0), []
    for kept, (begin, stop), (rest, rest_stop), shift in ((0, (zero, half), (half, size), 0), (1, (half, size), (zero, half), longer)):
        middle = rest + ((rest_stop - rest) / 2).cast("int")
        for part, (a, b), further in ((0, (rest, middle), 0), (1, (middle, rest_stop), longer)):
            out.append(F.xxhash64(size, F.lit(2 * kept + part), gram(begin, stop, shift), gram(a, b, further)))
    return F.array(*out)


def near_pairs(words: DataFrame) -> DataFrame:
    """Rows (word, n, near, near_n), both ways, of the words (word, n) that are one edit apart. Words are distinct."""
    chunks = words.select(F.explode(keys(0)).alias("key"), "word", "n")
    longer = words.filter(F.char_length("word") > 1).select(F.explode(keys(1)).alias("key"), "word", "n")
    grams = chunks.unionByName(longer).select(F.col("key").alias("gram"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    short_first = (F.char_length("word") < F.char_length("near")) | (F.col("word") < F.col("near"))
    # the distance is part of the join condition: pairs of one key that are no neighbours never become rows
    found = chunks.join(grams, (F.col("key") == F.col("gram")) & (F.abs(F.char_length("word") - F.char_length("near")) <= 1)
                        & short_first & (F.levenshtein("word", "near", 1) == 1))
    pairs = found.select("word", "n", "near", "near_n").distinct()
    return pairs.select(F.inline(F.array(
        F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))))


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) for pointers (word, form) without cycles: where the pointers lead in the end."""
    state = forms.select("word", F.col("form").alias("root"))
    while True:
        goals = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = keep(state.join(goals, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved = state.filter("moved").limit(1).count()
        state = state.drop("moved")
        if not moved:
            return state


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per row of ``words`` (word, n; distinct words): word, n, n_near, form, form_n, root.

    ``n_near`` counts the words exactly one inserted, deleted or replaced character away. ``form`` is the
    commonest of these (ties: the smallest in code-point order) if it occurs at least ``ratio`` (2 or
    more) times as often, else null; ``root`` is where forms lead in the end. An empty table gives no rows.
    """
    words = keep(words.select("word", "n"), "words")
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))))
    state = near_pairs(words).unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    formed = -F.col("best.minus") >= ratio * F.col("n")
    state = keep(state.select("word", "n", "n_near", F.when(formed, F.col("best.form")).alias("form"),
                              F.when(formed, -F.col("best.minus")).alias("form_n")), "forms")
    ends = roots(state.filter("form IS NOT NULL"))
    return state.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(read(spark, sf_dir, "documents")))


SQL = r"""
WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS w FROM documents WHERE text IS NOT NULL),
counted AS (SELECT id, w, count(*) AS n FROM runs WHERE length(w) >= 5 GROUP BY ALL),
hashed AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || w, ''),
  lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END))),
  lambda s, b: xor(t[CAST(xor(s, CAST(b AS BIGINT)) & 255 AS BIGINT) + 1], s >> 8))) AS h FROM counted, crc),
spelt AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
gaps AS (SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS gap FROM places),
pairs AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word, n),
forms AS (SELECT word, near AS form, near_n AS form_n FROM best WHERE near_n >= 2 * n),
path AS (SELECT word, form AS root FROM forms UNION ALL SELECT p.word, f.form FROM path p JOIN forms f ON p.root = f.word),
ends AS (SELECT word, root FROM path p WHERE root NOT IN (SELECT word FROM forms))
SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b ON w.word = b.word LEFT JOIN forms f ON w.word = f.word LEFT JOIN ends e ON w.word = e.word
"""
