"""Near-duplicate documents by MinHash: universal hash minima, banding, verification, connected components.

1. Every document gets the minima of ``rows * bands`` universal hash functions over its set of word
   shingles, folded to one key per band, and a 128-bit hash of the whole set.
2. Documents with equal sets form a class; from here on only the class's smallest id is used.
3. Classes that share a band key form a bucket. Each is compared with the bucket's smallest id: first by
   signature, then by the full sets. Links give first components.
4. A bucket whose members are in one component by then is done. In the others every member outside the
   component of the smallest id is compared with all members, block by block: signatures first, which
   name the members worth a look, then full sets. Tasks see two blocks of bounded size and emit links
   only, so no pairs are listed and no group is gathered.
5. Components of all links, by large-star and small-star.

With 5 rows and 43 bands a pair of similarity 0.75 shares a bucket but for one case in 100,000; a pair of
0.8 but for one in 10 million. Signatures set a pair aside only below 0.6, five standard deviations off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.components import connected_components
from fleetlens.llm.tables import bounded_batches, documents, group_bounds, keep, read, whole_groups
from fleetlens.llm.words import Words, mix, pieces, powers, signed, split_words, window_hashes

SHINGLE, ROWS, BANDS = 5, 5, 43
BLOCK = 2048


def universal(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of ``count`` hash functions x -> (a * x + c) modulo 2**64."""
    draws = np.random.default_rng(seed).integers(0, 1 << 63, (2, count), dtype=np.uint64)
    return (draws[0] << np.uint64(1)) | np.uint64(1), draws[1]


def shingle_sets(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text in rising order, and the bounds of the texts' sets."""
    starts, hashes = window_hashes(words.hashes, words.bounds, shingle)
    owners = [np.searchsorted(words.bounds, starts, "right") - 1]
    found = [hashes]
    for n in range(1, shingle):  # a text of fewer words is one shingle
        starts, hashes = window_hashes(words.hashes, words.bounds, n)
        own = np.searchsorted(words.bounds, starts, "right") - 1
        short = words.counts[own] == n
        owners.append(own[short])
        found.append(mix(hashes[short] + np.uint64(n)))
    owner, value = np.concatenate(owners), np.concatenate(found)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(words.bounds)))


def signatures(value: np.ndarray, bounds: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Minima of each hash function over each set, as 32-bit numbers; zeros for an empty set."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, count), np.uint32)
    if len(full):
        for i, (a, c) in enumerate(zip(*universal(count, seed))):
            out[full, i] = np.minimum.reduceat(((value * a + c) >> np.uint64(32)).astype(np.uint32), bounds[:-1][full])
    return out


def band_keys(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    keys = np.empty((len(signature), bands), np.uint64)
    up, _ = powers(rows + 1)
    for b in range(bands):
        part = signature[:, b * rows : (b + 1) * rows].astype(np.uint64)
        keys[:, b] = mix(mix((part + np.uint64(1)) * up[1:]).sum(1) + np.uint64(b))
    return keys


def feature_rows(shingle: int, rows: int, bands: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                value, bounds = shingle_sets(split_words(data, offsets, lower=True), shingle)
                keys = band_keys(signatures(value, bounds, rows * bands, seed), rows, bands)
                sums = []
                for salt in (1, 2):  # two independent sums over the set name it by 128 bits
                    total = np.zeros(len(value) + 1, np.uint64)
                    np.cumsum(mix(value + np.uint64(salt << 60)), out=total[1:])
                    sums.append(total[bounds[1:]] - total[bounds[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(bounds)), pa.array(signed(sums[0])), pa.array(signed(sums[1])),
                     pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), pa.array(signed(keys.ravel())))],
                    names=["doc_id", "n_shingles", "s1", "s2", "keys"],
                )

    return run


def set_rows(shingle: int, count: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                value, bounds = shingle_sets(split_words(data, offsets, lower=True), shingle)
                signature = signatures(value, bounds, count, seed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([s.tobytes() for s in signature], pa.binary()),
                     pa.array([value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    names=["doc_id", "signature", "shingles"],
                )

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``percent`` per cent at least."""
    small, large = sorted((x, y), key=len)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def least_agreement(percent: int, count: int) -> float:
    """Share of ``count`` minima below which a pair is set aside: five deviations below that of a pair at the limit."""
    share = percent / 100
    return share - 5 * (share * (1 - share) / count) ** 0.5


def verified_rows(percent: int, least: float):
    """Of pairs with both signatures and sets, those that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = [np.stack([np.frombuffer(x, np.uint32) for x in batch.column(c).to_pylist()]) for c in ("sig_a", "sig_b")]
            likely = np.flatnonzero((sig[0] == sig[1]).mean(1) >= least)
            a, b = batch.column("set_a"), batch.column("set_b")
            linked = [i for i in likely.tolist() if similar(
                np.frombuffer(a[i].as_py(), np.uint64), np.frombuffer(b[i].as_py(), np.uint64), percent)]
            yield batch.select(["a", "b"]).take(pa.array(linked, pa.int64()))

    return run


_CELL = ["key_", "row_", "column_"]


def _likely_pairs(table: pa.Table, lo: int, hi: int, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each outsider of a cell the members of other components with a signature close enough."""
    role = table.column("outsider").to_numpy()[lo:hi]
    comp = table.column("component").to_numpy()[lo:hi]
    sig = np.stack([np.frombuffer(x, np.uint32) for x in table.column("signature").slice(lo, hi - lo).to_pylist()])
    members = np.flatnonzero(~role)
    for i in np.flatnonzero(role):
        others = members[comp[members] != comp[i]]
        close = others[(sig[others] == sig[i]).mean(1) >= least]
        if len(close):
            yield i + lo, close + lo


def likely_rows(least: float):
    """The rows of each cell that have a likely partner in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _CELL):
            table = table.combine_chunks()
            bounds, wanted = group_bounds(table, _CELL), np.zeros(table.num_rows, bool)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                for i, close in _likely_pairs(table, lo, hi, least):
                    wanted[i] = True
                    wanted[close] = True
            yield from table.drop_columns(["signature"]).filter(pa.array(wanted)).to_batches()

    return run


def cell_links(percent: int, least: float):
    """Links between an outsider and members of other components; one per outsider and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, _CELL):
            table = table.combine_chunks()
            bounds, links = group_bounds(table, _CELL), []
            ids, comp = table.column("doc_id").to_numpy(), table.column("component").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                for i, close in _likely_pairs(table, lo, hi, least):
                    linked: set[int] = set()
                    for j in close.tolist():
                        if comp[j] not in linked and similar(sets[i], sets[j], percent):
                            linked.add(comp[j])
                            links.append((ids[i], ids[j]))
            pairs = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def _cells(members: DataFrame, components: DataFrame, block: int) -> DataFrame:
    """Mixed buckets cut into cells: a block of outsiders against a block of members."""
    inside = members.join(components, "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    inside = keep(inside, "members")
    of = inside.groupBy("key").agg(
        F.min(F.struct("doc_id", "component")).getField("component").alias("main"),
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"),
        # buckets with the same members, as those of a few near copies are in most bands, are one
        F.bit_xor(F.xxhash64("doc_id")).alias("x1"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("x2"))
    of = of.filter("low <> high").groupBy("n", "x1", "x2").agg(F.min(F.struct("key", "main")).alias("b")).select("b.key", "b.main", "n")
    rows = keep(inside.join(of, "key"), "mixed")
    out = rows.filter("component <> main").groupBy("key").agg(F.count("*").alias("n_out"))
    rows = rows.join(out, "key").withColumns({
        "n_row": F.ceil(F.col("n_out") / block), "n_column": F.ceil(F.col("n") / block), "h": F.xxhash64("doc_id")})
    asking = rows.filter("component <> main").select(
        "key", "doc_id", "component", F.lit(True).alias("outsider"), F.pmod("h", "n_row").alias("row_"),
        F.explode(F.sequence(F.lit(0), F.col("n_column") - 1)).alias("column_"))
    asked = rows.select(
        "key", "doc_id", "component", F.lit(False).alias("outsider"),
        F.explode(F.sequence(F.lit(0), F.col("n_row") - 1)).alias("row_"), F.pmod("h", "n_column").alias("column_"))
    names = [F.col("key").alias("key_"), F.col("row_").cast("long"), F.col("column_").cast("long"), "doc_id", "component", "outsider"]
    return asking.select(*names).unionByName(asked.select(*names))


def near_duplicates(
    docs: DataFrame, percent: int = 75, shingle: int = SHINGLE, rows: int = ROWS, bands: int = BANDS,
    block: int = BLOCK, seed: int = 7, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are compared as sets of word shingles after lower-casing A-Z; a text of fewer words is one
    shingle; a null, empty or wordless text has no set and links with nothing. Rows of one id count as
    one document: what links one of them links all. A row without an id links with nothing, has no
    component and is kept. Repeated rows give repeated rows. Extra columns are ignored.
    """
    texts, least = documents(docs, doc_id, text), least_agreement(percent, rows * bands)
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>"
    features = keep(texts.mapInArrow(feature_rows(shingle, rows, bands, seed), schema), "features")
    linkable = features.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("first"))
    placed = linkable.join(classes, ["n_shingles", "s1", "s2"])
    copies = placed.filter("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    banded = keep(placed.filter("doc_id = first").select("doc_id", F.explode("keys").alias("key")), "bands")
    buckets = banded.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    members = keep(banded.join(buckets.select("key", "low"), "key").distinct(), "buckets")
    alias = texts.alias("t").join(members.select("doc_id").distinct().alias("m"), F.col("t.doc_id") == F.col("m.doc_id"))
    sets = keep(alias.select("t.doc_id", "t.text").mapInArrow(
        set_rows(shingle, rows * bands, seed), "doc_id long, signature binary, shingles binary"), "sets")
    stars = members.filter("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct()
    for side in "ab":
        stars = stars.join(sets.select(
            F.col("doc_id").alias(side), F.col("signature").alias(f"sig_{side}"), F.col("shingles").alias(f"set_{side}")), side)
    links = keep(stars.mapInArrow(verified_rows(percent, least), "a long, b long"), "links")
    first = connected_components(links).withColumnRenamed("id", "doc_id")
    cell_type = "key_ long, row_ long, column_ long, doc_id long, component long, outsider boolean"
    cells = _cells(members.drop("low"), first, block).join(sets.select("doc_id", "signature"), "doc_id")
    wanted = keep(cells.repartition(*_CELL).sortWithinPartitions(*_CELL).select(*cell_type.replace(" long", "").replace(" boolean", "").split(", "), "signature")
                  .mapInArrow(likely_rows(least), cell_type), "likely")
    more = wanted.join(sets, "doc_id").repartition(*_CELL).sortWithinPartitions(*_CELL).mapInArrow(cell_links(percent, least), "a long, b long")
    found = connected_components(copies.unionByName(links).unionByName(more)).withColumnRenamed("id", "doc_id")
    return features.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[s:s + 4], ' ') AS x
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS s FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS both FROM shingles l JOIN shingles r ON l.x = r.x AND l.doc_id <> r.doc_id GROUP BY ALL) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b WHERE 100 * p.both >= 75 * (m.n + n.n - p.both)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""
