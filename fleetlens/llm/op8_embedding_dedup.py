"""Near-duplicate embeddings by spherical-cap filters from structured random product codes.

A filter is a direction; a vector passes it if their inner product exceeds a threshold, that is, if the
vector lies in the cap around the direction. Directions are products: the dimensions are cut into three
parts, each with a code of random unit vectors, and a filter takes one from each. List decoding finds all
filters that a vector passes without trying them all: sums of two parts that the best of the third
can't lift over the threshold are dropped first. Vectors that share a filter and a label are compared.

* Equal vectors of a label are one class; its members are linked with each other without being paired.
* Filters grow in number with the vectors, and the threshold with them, so that a vector passes
  ``passes`` filters on average and few unlike vectors share one. For a vector that passes fewer than
  ``LEAST_FILTERS`` the caps are widened: of random pairs right at the limit of 0.98 all were found
  in 24 and 64 dimensions, two thirds without this.
* A filter's vectors are compared in cells of two blocks of ``block`` vectors, by one matrix product in
  double precision. A pair is counted in the first filter it shares. A cell returns counts per vector and
  each vector's local component, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.components import connected_components
from fleetlens.llm.tables import group_bounds, keep, read, spread, whole_groups

PARTS, PASSES, LEAST_FILTERS, BLOCK = 3, 16, 12, 1024
#: A cap that is passed too seldom is widened by this part of the threshold at a time.
WIDEN = 0.05


def codes(dim: int, size: int, seed: int) -> list[np.ndarray]:
    """For each part of the dimensions, ``size`` random unit vectors."""
    rng = np.random.default_rng([seed, dim])
    out = []
    for part in np.array_split(np.arange(dim), min(PARTS, dim)):
        draw = rng.standard_normal((size, len(part)))
        out.append(draw / np.linalg.norm(draw, axis=1, keepdims=True))
    return out


def code_size(vectors: int) -> int:
    """Words per part, so that there is about a filter for each vector."""
    return max(16, math.ceil(max(vectors, 1) ** (1 / PARTS)))


def threshold(dim: int, size: int, passes: float) -> float:
    """The sum of inner products that a random unit vector reaches for ``passes`` filters on average."""
    parts = min(PARTS, dim)
    filters = size**parts
    return NormalDist().inv_cdf(1 - min(passes / filters, 0.5)) * math.sqrt(parts / dim)


def list_decode(units: np.ndarray, code: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """(vector, filter) of every filter passed, in rising order."""
    size, dim = len(code[0]), units.shape[1]
    scores = [units[:, p] @ c.T for p, c in zip(np.array_split(np.arange(dim), len(code)), code)]
    owner, number, total = np.arange(len(units)), np.zeros(len(units), np.int64), np.zeros(len(units))
    for i, score in enumerate(scores):
        hope = sum((s.max(1) for s in scores[i + 1 :]), np.zeros(len(units)))
        sums = total[:, None] + score[owner]
        row, word = np.nonzero(sums >= (least - hope)[owner][:, None])
        owner, number, total = owner[row], number[row] * size + word, sums[row, word]
    return owner, number


def passed_filters(units: np.ndarray, code: list[np.ndarray], least: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(vector, filter) of the filters each vector passes; for one that passes fewer than ``count``, of wider caps."""
    count = min(count, len(code[0]) ** len(code))
    left, step, found = np.arange(len(units)), WIDEN * max(least, 0.1), []
    while len(left):
        owner, number = list_decode(units[left], code, least)
        enough = np.bincount(owner, minlength=len(left)) >= count
        found.append((left[owner[enough[owner]]], number[enough[owner]]))
        left, least = left[~enough], least - step
    owner, number = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((number, owner))
    return owner[order], number[order]


def unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; those that can't be compared are left out."""
    for batch in batches:
        column = batch.column("embedding")
        flat = column.flatten()
        value = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component is NaN
        ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
        keep_row, raw = [], []
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            v = value[a:b]
            if b > a and np.isfinite(v).all() and v.any():
                keep_row.append(i)
                raw.append((v + 0.0).tobytes())  # minus zero equals zero
        at = pa.array(keep_row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(at), batch.column("label").take(at), pa.array(raw, pa.binary())],
            names=["vec_id", "label", "vector"])


def _units(raw: list[bytes]) -> np.ndarray:
    """Unit vectors; scaling by the largest component first keeps squares in range."""
    v = np.stack([np.frombuffer(x, np.float64) for x in raw])
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def filter_rows(size: int, passes: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                raw = batch.column("vector").to_pylist()
                dims = np.array([len(x) // 8 for x in raw])
                for dim in np.unique(dims).tolist():
                    mine = np.flatnonzero(dims == dim)
                    owner, number = passed_filters(
                        _units([raw[i] for i in mine]), codes(dim, size, seed), threshold(dim, size, passes), LEAST_FILTERS)
                    counts = np.bincount(owner, minlength=len(mine))
                    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    part = batch.take(pa.array(mine))
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in ("id", "label", "times", "vector")), pa.array(np.full(len(mine), dim, np.int64)),
                         pa.ListArray.from_arrays(pa.array(bounds), pa.array(number))],
                        names=["id", "label", "times", "vector", "dim", "filters"])

    return run


_CELL = ["label", "dim", "filter", "row_", "column_"]


def cell_rows(least: float):
    """Counts and local components of the linked vectors of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _CELL):
            table = table.combine_chunks()
            bounds = group_bounds(table, _CELL)
            col = {c: table.column(c).to_numpy() for c in ("id", "times", "filter", "row_", "column_", "part")}
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if hi - lo < 2:
                    continue
                at = np.arange(lo, hi)
                left = at[col["part"][lo:hi] == col["row_"][lo]] - lo
                right = at[col["part"][lo:hi] == col["column_"][lo]] - lo
                unit = _units(table.column("vector").slice(lo, hi - lo).to_pylist())
                linked = unit[left] @ unit[right].T >= least
                linked &= left[:, None] != right[None, :]
                if not linked.any():
                    continue
                some = np.unique(np.concatenate([left[linked.any(1)], right[linked.any(0)]]))
                lists = table.column("filters").slice(lo, hi - lo).combine_chunks().take(pa.array(some))
                owner = np.repeat(np.arange(len(some)), lists.value_lengths().to_numpy())
                name, kind = np.unique(lists.flatten().to_numpy(), return_inverse=True)
                earlier = name[kind] < col["filter"][lo]
                passed = np.zeros((hi - lo, max(len(name), 1)), np.float32)
                passed[some[owner[earlier]], kind[earlier]] = 1
                new = linked & (passed[left] @ passed[right].T == 0)  # not counted in an earlier filter
                counts = np.zeros(hi - lo, np.int64)
                times = col["times"][lo:hi]
                np.add.at(counts, left, new @ times[right])
                if col["row_"][lo] != col["column_"][lo]:
                    np.add.at(counts, right, new.T @ times[left])
                # the smallest number reachable within the cell, by passing it along links
                ids = col["id"][lo:hi]
                order = np.argsort(ids, kind="stable")
                low = np.empty(hi - lo, np.int64)
                low[order] = np.arange(hi - lo)
                while True:
                    was = low.copy()
                    np.minimum.at(low, left, np.where(linked, low[right][None, :], hi).min(1))
                    np.minimum.at(low, right, np.where(linked, low[left][:, None], hi).min(0))
                    if (low == was).all():
                        break
                found.append((ids[some], counts[some], ids[order[low[some]]]))
            out = [np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ()))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["id", "links", "with_id"])

    return run


def embedding_duplicates(
    vectors: DataFrame, least: float = 0.98, passes: float = PASSES, block: int = BLOCK, seed: int = 7,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null, whole-number labels and equal length are linked if their cosine is
    ``least`` or more. Null, empty, zero or not wholly finite vectors and rows without an id or label
    link with nothing; a row without an id has no component and is kept. A repeated row is another
    vector: it counts as a link. An empty table gives no rows. Extra columns are ignored.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).cast("long").alias("label"))
    able = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    usable = keep(spread(able).mapInArrow(unit_rows, "vec_id long, label long, vector binary"), "vectors")
    classes = keep(usable.groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("times")), "classes")
    member = usable.join(classes, ["label", "vector"]).select("vec_id", "id", "times")
    size = code_size(classes.count())
    schema = "id long, label long, times long, vector binary, dim long, filters array<long>"
    decoded = keep(spread(classes).mapInArrow(filter_rows(size, passes, seed), schema), "filters")
    passed = decoded.select("*", F.explode("filters").alias("filter"))
    sizes = keep(passed.groupBy("label", "dim", "filter").agg(F.ceil(F.count("*") / block).alias("parts"), F.count("*").alias("n"))
                 .filter("n > 1").drop("n"), "filter-sizes")
    parted = passed.join(sizes, ["label", "dim", "filter"]).withColumn("part", F.pmod(F.xxhash64("id", "filter"), F.col("parts")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    cells = parted.select("*", other).select(
        "id", "times", "vector", "filters", "label", "dim", "filter", "part",
        F.least("part", "other").alias("row_"), F.greatest("part", "other").alias("column_"))
    found = keep(cells.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInArrow(
        cell_rows(least), "id long, links long, with_id long"), "linked")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    member = keep(member.join(links, "id", "left").select(
        "vec_id", "id", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "members")
    edges = found.select(F.col("id").alias("a"), F.col("with_id").alias("b"))
    joined = member.select(F.col("vec_id").alias("a"), F.col("id").alias("b"))  # an id in two classes ties them
    of = connected_components(edges.unionByName(joined)).withColumnRenamed("id", "vec_id")
    # rows of one id may differ: each has its own links, all have the id's component
    counted = rows.select("vec_id").join(
        member.groupBy("vec_id").agg(F.max("n_links").alias("n_links")), "vec_id", "left").join(of, "vec_id", "left")
    return counted.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(read(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = v.vec_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = v.vec_id
"""
