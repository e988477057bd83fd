"""Fill-in-the-middle: texts cut in three and written as prefix, suffix, middle, by displacement scatter.

A batch of texts is one byte array. Two cuts per text, at token starts found by one scan, part it into
prefix, middle and suffix. Each part moves as a whole, so the shift of all bytes of a batch is a step
function: its steps go into a difference array, whose running sum is every byte's way from input to
output, and one scatter writes all outputs. Going back, the parts are found by the markers in the output,
the steps are those of the inverse way, and one gather restores all texts. No loop runs over texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.tables import bounded_batches, read
from fleetlens.llm.words import pieces

#: Before the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SEED = "1"
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")

_CUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def found(data: np.ndarray, offsets: np.ndarray, marker: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold the marker, and its first place in each of them."""
    m = len(marker)
    if len(data) < m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hit = data[: len(data) - m + 1] == marker[0]
    for k in range(1, m):
        hit &= data[k : len(data) - m + 1 + k] == marker[k]
    at = np.flatnonzero(hit)
    own = np.searchsorted(offsets, at, "right") - 1
    inside = at + m <= offsets[own + 1]
    own, first = np.unique(own[inside], return_index=True)
    return own, at[inside][first]


def way(places: np.ndarray, shifts: np.ndarray, n: int) -> np.ndarray:
    """The shift of each of n bytes, from the places (in order) where parts begin and the shifts of the parts."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, places, np.diff(shifts, prepend=0))
    return np.cumsum(steps)[:n]


def token_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens (runs of ASCII letters, or single other characters) begin, and which bytes begin a character."""
    lead = (data & 0xC0) != 0x80
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    begin = lead.copy()
    begin[1:] &= ~(letter[1:] & letter[:-1])
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begin), lead


def places(form: np.ndarray, prefix: np.ndarray, middle: np.ndarray, suffix: np.ndarray, sizes: Sequence[int]) -> tuple[np.ndarray, ...]:
    """Places in a text's output of its prefix, middle and suffix; a part's marker stands before it."""
    p, s, m = sizes
    psm = (p + 0 * prefix, p + prefix + s + suffix + m, p + prefix + s)
    spm = (s + suffix + p, s + suffix + p + prefix + m, s + 0 * prefix)
    plain = (0 * prefix, prefix, prefix + middle)
    return tuple(np.choose(form, (a, b, c)) for a, b, c in zip(plain, psm, spm))


def cut_rows(markers: Sequence[str], plain_percent: int, spm_percent: int):
    marks = [m.encode() for m in markers]
    sizes = [len(m) for m in marks]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                h1, h2, h3, h4 = (part.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4))
                begin, end = offsets[:-1], offsets[1:]
                tokens, lead = token_starts(data, offsets)
                bounds = np.searchsorted(tokens, offsets)
                n = np.diff(bounds)
                tokens = np.append(tokens, len(data))
                first, second = np.sort([h1 % (n + 1), h2 % (n + 1)], axis=0)
                one, two = tokens[bounds[:-1] + first], tokens[bounds[:-1] + second]
                form = np.where(h3 % 100 >= 100 - plain_percent, PLAIN, np.where(h4 % 100 < spm_percent, SPM, PSM))
                form[n == 0] = PLAIN
                for mark in marks:
                    form[found(data, offsets, mark)[0]] = PLAIN
                at = places(form, one - begin, two - one, end - two, sizes)
                out_offsets = np.zeros(part.num_rows + 1, np.int64)
                np.cumsum(end - begin + np.where(form == PLAIN, 0, sum(sizes)), out=out_offsets[1:])
                base = out_offsets[:-1]
                starts = np.stack([begin, one, two], 1).ravel()
                targets = np.stack([base + at[0], base + at[1], base + at[2]], 1).ravel()
                out = np.zeros(out_offsets[-1], np.uint8)
                out[np.arange(len(data)) + way(starts, targets - starts, len(data))] = data
                moved = form != PLAIN
                for mark, to in zip(marks, (at[0], at[2], at[1])):
                    for k, byte in enumerate(mark):
                        out[(base + to)[moved] - len(mark) + k] = byte
                chars = np.concatenate([[0], np.cumsum(lead)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(FORMS).take(pa.array(form)),
                     pa.array(chars[one] - chars[begin], mask=~moved), pa.array(chars[two] - chars[one], mask=~moved),
                     strings(out, out_offsets)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    return pa.StringArray.from_buffers(len(offsets) - 1, buffers[1], buffers[2])


def restore_rows(markers: Sequence[str]):
    marks = [m.encode() for m in markers]
    sizes = [len(m) for m in marks]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "output"):
                form = pa.compute.index_in(part.column("form"), pa.array(FORMS)).to_numpy()
                at = np.zeros((3, part.num_rows), np.int64)
                for k, mark in enumerate(marks):
                    own, where = found(data, offsets, mark)
                    at[k, own] = where - offsets[own]
                p, s, m = at
                whole = np.diff(offsets)
                prefix = np.choose(form, (whole, s - p - sizes[0], m - p - sizes[0]))
                suffix = np.choose(form, (0 * whole, m - s - sizes[1], p - s - sizes[1]))
                middle = np.choose(form, (0 * whole, whole - m - sizes[2], whole - m - sizes[2]))
                out_offsets = np.zeros(part.num_rows + 1, np.int64)
                np.cumsum(prefix + middle + suffix, out=out_offsets[1:])
                base, source = out_offsets[:-1], places(form, prefix, middle, suffix, sizes)
                starts = np.stack([base, base + prefix, base + prefix + middle], 1).ravel()
                origins = np.stack([offsets[:-1] + x for x in source], 1).ravel()
                n = int(out_offsets[-1])
                out = data[np.arange(n) + way(starts, origins - starts, n)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, strings(out, out_offsets)], names=[*part.schema.names, "restored"])

    return rows


def hash_parts(value: Column) -> list[Column]:
    """The first four groups of eight hexadecimal digits of the SHA-256 of a string, as unsigned integers."""
    digest = F.sha2(value, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_middle(
    docs: DataFrame, markers: Sequence[str] = MARKERS, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
    seed: str = SEED, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    Cuts and form follow from the SHA-256 of ``seed``, a colon and the id (nothing for a null id), so rows
    of one id and text have one result, also repeated ones. A null text counts as empty. An empty text,
    or one that holds a marker, stays plain, its two lengths null; so do ``plain_percent`` of a hundred
    others. Of the rest ``spm_percent`` of a hundred begin with the suffix. A very long text is one piece
    of a batch: its bytes and about 30 more for each are held in a task. An empty table gives no rows.
    Extra columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *hash_parts(key))
    return rows.mapInArrow(cut_rows(markers, plain_percent, spm_percent), _CUT)


def restore(cut: DataFrame, markers: Sequence[str] = MARKERS) -> DataFrame:
    """``cut`` with ``restored``, the text rebuilt from the columns ``output`` and ``form`` alone."""
    bounded_batches(cut.sparkSession)
    return cut.mapInArrow(restore_rows(markers), ", ".join(f"{c} {t}" for c, t in cut.dtypes) + ", restored string")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = restore(fill_middle(read(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
hashed AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1,
  CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM docs),
cuts AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo,
  greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
  OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (SELECT *, coalesce(array_to_string(u[1:lo], ''), '') AS p, coalesce(array_to_string(u[lo + 1:hi], ''), '') AS m,
  coalesce(array_to_string(u[hi + 1:], ''), '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM parts
"""
