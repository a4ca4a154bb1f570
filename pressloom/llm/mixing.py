"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected target / source size times.  Along the
source's order the expected copies add up to a running sum; one random offset per
source shifts it, and a document is emitted once per integer that its stretch
crosses.  So a document's copies differ from the expected number by less than one,
and the order by size keeps the emitted words close to the target.

The running sum needs no task that holds a source: cells of a source (size class,
then a salt) are counted, the cells' counts are summed up in order, and rows are
ranked within their cell.  Sources and cells are small tables; rows shuffle once.

Rows: a null text has size 0; a null source is a source of its own, the last;
copies of the same row are rows of their own.  No sizes at all: all targets are 0.
Columns of the input are kept; those named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.stages import free_name

WEIGHTS = (1, 2, 3)
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column | str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _digest_number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, cap: float = 3.0) -> DataFrame:
    """``sizes`` (_source, source_size; one row a source) with ``target``.

    Sources by code point, null last, take the weights in turn.  Targets share
    ``share`` of all sizes by weight and stop at ``cap`` times their source's size;
    the excess goes to the others.  Ordered by cap per weight, the stopped sources
    come first, so one pass over the sources finds the level of the rest.
    """
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy("_source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int")).cast("double")
    out = sizes.withColumns({"_weight": weight, "_cap": F.lit(cap) * F.col("source_size")})
    out = out.withColumns({"_ratio": F.col("_cap") / F.col("_weight"), "_all": F.sum("source_size").over(everything) * F.lit(share)})
    upto = Window.orderBy("_ratio", "_source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    on = Window.orderBy("_ratio", "_source").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("_all") - (F.sum("_cap").over(upto) - F.col("_cap"))) / F.sum("_weight").over(on)
    out = out.withColumn("_level", level)
    lowest = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_source", "_level"))).over(everything)["_level"]
    target = F.when(lowest.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), lowest * F.col("_weight")))
    return out.select("_source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, cap: float = 3.0, seed: str = "mix", salts: int = 32) -> DataFrame:
    """``docs`` with size, source_size, target, copies (how often the mix emits the row) and taken (words it takes)."""
    rows = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    source, mark, of_size, salt, rank, before, each, offset, held, words = (
        free_name(docs, n) for n in ("_source", "_mark", "_class", "_salt", "_rank", "_before", "_each", "_offset", "_rows", "_words")
    )
    # code points of UTF-8 strings sort as their bytes do; '0' before a source, '1' for none
    name = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    rows = rows.withColumns({"size": word_count("text"), source: name})
    text = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed), F.coalesce("text", F.lit("")))
    rows = rows.withColumn(mark, F.md5(text.cast("binary")))
    bits = F.bin("size")
    rows = rows.withColumns(
        {
            of_size: F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 4)),
            salt: (F.conv(F.substring(mark, 1, 8), 16, 10).cast("long") % salts).cast("int"),
        }
    )
    cell = [source, of_size, salt]
    cells = rows.groupBy(*cell).agg(F.count("*").alias(held), F.sum("size").alias(words))
    sizes = cells.groupBy(F.col(source).alias("_source")).agg(F.sum(words).alias("source_size"))
    targets = source_targets(sizes, weights, share, cap).withColumnRenamed("_source", source).withColumns(
        {
            each: F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)),
            offset: _digest_number(F.concat_ws("|", F.lit(seed), F.col(source))) / F.lit(4294967296.0),
        }
    )
    running = F.sum(held).over(Window.partitionBy(source).orderBy(of_size, salt)) - F.col(held)
    places = cells.withColumn(before, running).drop(held, words).join(targets, source)
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("size", mark))
    out = rows.withColumn(rank, place).join(places, cell).withColumn(rank, F.col(rank) + F.col(before))
    crossed = F.floor(F.col(rank) * F.col(each) + F.col(offset)) - F.floor((F.col(rank) - 1) * F.col(each) + F.col(offset))
    out = out.withColumn("copies", crossed.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*[c for c in docs.columns if c.lower() not in ADDED], *ADDED)


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as its ``copies`` say, without the added columns."""
    copy = free_name(mixed, "_copy")
    often = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return mixed.filter("copies > 0").withColumn(copy, often).drop(copy, *ADDED)


SQL = """
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS s,
         md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), 'mix', coalesce(text, ''))) AS mark
  FROM documents),
t AS (SELECT s, sum(size)::BIGINT AS source_size FROM d GROUP BY s),
w AS (SELECT *, ((row_number() OVER (ORDER BY s) - 1) % 3 + 1)::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap,
             sum(source_size) OVER ()::DOUBLE AS everything FROM t),
l AS (SELECT *, cap / weight AS ratio,
             (everything - (sum(cap) OVER (ORDER BY cap / weight, s ROWS UNBOUNDED PRECEDING) - cap))
             / sum(weight) OVER (ORDER BY cap / weight, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
m AS (SELECT *, (SELECT lev FROM l WHERE lev <= ratio ORDER BY ratio, s LIMIT 1) AS lowest FROM l),
g AS (SELECT s, source_size, CASE WHEN lowest IS NULL THEN cap ELSE least(cap, lowest * weight) END AS target,
             ('0x' || substr(md5('mix|' || s), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY lpad(length(bin(size))::VARCHAR, 2, '0') || substr(bin(size), 1, 4),
             ('0x' || substr(mark, 1, 8))::BIGINT % 32, size, mark) AS k FROM d)
SELECT doc_id, size, source_size, target,
       (size * (floor(k * (CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) + shift)
              - floor((k - 1) * (CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) + shift)))::BIGINT AS taken
FROM r JOIN g USING (s)
"""
