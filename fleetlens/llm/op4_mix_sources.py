"""Mixing sources to target weights by systematic sampling.

Sizes are summed per source and targets set once: each source gets its weight's share of all sizes; a
source whose share exceeds ``most`` times its own size stops there, and what it leaves goes to the others
by weight. A document of a source is expected ``target / size of the source`` times. Within a source the
documents are laid in a row, expected copies are summed along it, one random offset is added, and a
document is taken once for every integer boundary that its stretch crosses. Documents stand in order of
size (two leading digits), so any stretch of the row has the sizes of the whole, and the words taken come
near the target.

The row is never sorted in one task. It is cut into blocks by size class and by ranges of a hash of the
id; as many ranges as it takes for ``block`` documents in each, however large a source or class is. A
document's place is its rank in the block plus the documents of the blocks before, summed in two levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.tables import keep, read

BLOCK = 100_000
#: Weights by rank of the source, repeating.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix"
_BITS = 60


def word_count(text: str) -> Column:
    """Number of maximal runs of characters other than space and tab to carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def size_class(size: Column) -> Column:
    """Number of digits and the two leading ones; the sizes of a class differ by a tenth at most."""
    digits = size.cast("string")
    return F.concat(F.lpad(F.length(digits).cast("string"), 2, "0"), F.substring(digits, 1, 2))


def hash_place(value: Column) -> Column:
    """60 bits of an MD5 as a long."""
    return F.conv(F.substring(F.md5(value), 1, _BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Rows (source_key, source_size) with weight and target.

    Sources in order of size per weight: those that stop at ``most`` times their size come first. One
    stops if even its share of what those before it leave, by the weights from it on, is more. This
    gives at once what repeated sharing of the excess comes to. Rows are one per source.
    """
    all_rows = (Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = (Window.unboundedPreceding, -1)
    rank = F.row_number().over(Window.orderBy("source_key")) - 1
    ranked = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod(rank, F.lit(len(weights))) + 1))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "source_key")
    left = {
        name: F.sum(column).over(by_room.rowsBetween(*all_rows)) - times * F.coalesce(F.sum(column).over(by_room.rowsBetween(*earlier)), F.lit(0))
        for name, column, times in (("rest", "source_size", most), ("rest_weight", "weight", 1))
    }
    marked = ranked.withColumns(left).withColumn(
        "full", F.col("rest") * F.col("weight") >= most * F.col("source_size") * F.col("rest_weight"))
    # the first source that does not stop has the most weight left of those
    first = F.max(F.when(~F.col("full"), F.struct("rest_weight", "rest"))).over(by_room.rowsBetween(*all_rows))
    shared = (F.col("weight") * first["rest"]).cast("double") / first["rest_weight"].cast("double")
    target = F.when(F.col("full"), (most * F.col("source_size")).cast("double")).otherwise(shared)
    return marked.select("source_key", "source_size", "weight", target.alias("target"))


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED, block: int = BLOCK,
    doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, _th, size, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the row, ``taken`` its words times copies. Null is a source of
    its own, the last by rank. A null or wordless text has size 0 and counts as a document of its source,
    but gives no words. A source without words has target 0 and is not taken. The result depends on ids,
    sources, sizes, texts and ``seed`` only; rows that agree in all of these stand for one another, also
    if they are repeated. Rows without an id are placed as if it were empty. An empty table gives no
    rows. Extra columns are ignored. ``_th`` is a hash of the text.
    """
    key = F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))  # null comes last
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), key.alias("source_key"),
        word_count(text).alias("size"), F.xxhash64(text).alias("_th"))
    rows = keep(rows.withColumns({
        "class": size_class(F.col("size")), "place": hash_place(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))}), "sizes")
    ranges = max(1, -(-rows.count() // block))
    rows = rows.withColumn("range", F.expr(f"place div {-(-(1 << _BITS) // ranges)}L"))
    where = ["source_key", "class", "range"]
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*where).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    classes = blocks.groupBy("source_key", "class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    before_class = classes.select("source_key", "class", F.coalesce(
        F.sum("n").over(earlier(Window.partitionBy("source_key").orderBy("class"))), F.lit(0)).alias("before_class"))
    before_range = blocks.select(*where, F.coalesce(
        F.sum("n").over(earlier(Window.partitionBy("source_key", "class").orderBy("range"))), F.lit(0)).alias("before_range"))
    targets = source_targets(classes.groupBy("source_key").agg(F.sum("words").alias("source_size")), weights, most)
    offset = hash_place(F.concat(F.lit(f"{seed}/"), "source_key")).cast("double") / float(1 << _BITS)
    blocks = before_range.join(before_class, ["source_key", "class"]).join(targets, "source_key").select(
        *where, (F.col("before_class") + F.col("before_range")).alias("before"), "source_size", "target", offset.alias("offset"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*where).orderBy("place", "doc_id", "_th")))
    placed = ranked.join(blocks, where)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(0.0)
    last = (F.col("before") + F.col("rank")).cast("double")
    crossed = F.floor(F.col("offset") + rate * last) - F.floor(F.col("offset") + rate * (last - 1.0))
    return placed.withColumn("copies", crossed).select(
        "doc_id", "source", "_th", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce('0' || source, '1') AS k,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size, list_value(1, 2, 3)[(row_number() OVER (ORDER BY k) - 1) % 3 + 1] AS w FROM docs GROUP BY k),
room AS (SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0) AS BIGINT) AS rest,
  CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS BIGINT) AS rest_w FROM sources
  WINDOW b AS (ORDER BY CAST(source_size AS DOUBLE) / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
state AS (SELECT *, rest * w >= 3 * source_size * rest_w AS full_up FROM room),
targets AS (SELECT k, source_size, CASE WHEN full_up THEN CAST(3 * source_size AS DOUBLE)
  ELSE CAST(w * (SELECT arg_max(rest, rest_w) FROM state WHERE NOT full_up) AS DOUBLE) / (SELECT max(rest_w) FROM state WHERE NOT full_up) END AS target,
  CAST(CAST('0x' || substr(md5('{SEED}/' || k), 1, 15) AS BIGINT) AS DOUBLE) / {float(1 << _BITS)} AS offs FROM state),
placed AS (SELECT d.doc_id, d.size, t.*, CAST(row_number() OVER (PARTITION BY d.k ORDER BY
  lpad(CAST(length(CAST(size AS VARCHAR)) AS VARCHAR), 2, '0') || substr(CAST(size AS VARCHAR), 1, 2),
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT), doc_id) AS DOUBLE) AS r,
  CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM docs d JOIN targets t ON d.k = t.k)
SELECT doc_id, size, source_size, target, CAST(floor(offs + rate * r) - floor(offs + rate * (r - 1)) AS BIGINT) * size AS taken FROM placed
"""
