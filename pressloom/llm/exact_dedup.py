"""Exact deduplication by a 128-bit content hash, with the bytes compared inside its groups.

Texts are equal when they are the same after all ASCII white space is taken out.  Of
equal texts the row with the most code points in its original text stays; of these the
one with the smallest doc_id, and of rows alike in both the first one.

DataFrame functions only.  Rows get a number and their hashes and are written once; all
passes read the columns that they need.  Rows are grouped by hash and text, so the bytes
decide which rows of a hash are equal and a collision never joins two texts.  Each task
first merges its own equal rows: a group of any size sends one row per task.  Groups are
named by both hashes (MD5 and SHA-256) from there on; texts no longer travel.

The few groups that hold a large share of all rows are broadcast (``join_groups``); rows of
all others meet their group by a join.

Rows: a null or empty text counts as empty, and all empty texts are equal.  A null
doc_id comes after all others.  Repeated rows are rows of their own, of which one stays.
Other columns are passed on; those named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.stages import free_name, join_groups, staged

BLANKS = "[\\x20\\x09-\\x0D]"
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column | str) -> Column:
    """A text without white space; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def mark_copies(docs: DataFrame, content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """``docs`` with keep_id (doc_id of the row that stays), group_size (long), kept and text_sha256 (of the normalised text).

    ``content_hash`` makes the group's hash of the normalised text's bytes.
    """
    own = [c for c in docs.columns if c.lower() not in ADDED]
    names = docs.select(*own)
    key, sha, row, points, plain, best, size = (free_name(names, n) for n in ("_key", "_sha", "_row", "_points", "_plain", "_best", "_size"))
    rows = names.withColumn(plain, normalised("text"))
    rows = rows.select(
        *own,
        content_hash(F.col(plain).cast("binary")).alias(key),
        F.sha2(F.col(plain).cast("binary"), 256).alias(sha),
        F.coalesce(F.length("text"), F.lit(0)).alias(points),
        F.monotonically_increasing_id().alias(row),
    )
    rows = staged(rows, "hashed")

    # the first of a group in this order stays
    order = F.struct((-F.col(points)).alias("points"), F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    groups = rows.groupBy(key, sha, normalised("text").alias(plain)).agg(F.count("*").alias(size), F.min(order).alias(best))
    groups = staged(groups.select(key, sha, size, best), "groups")
    out = join_groups(rows, groups.filter(F.col(size) > 1), [key, sha], size)

    alone = F.col(size).isNull()
    return out.select(
        *own,
        F.when(alone, F.col("doc_id")).otherwise(F.col(f"{best}.id")).alias("keep_id"),
        F.coalesce(F.col(size), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col(f"{best}.row") == F.col(row))).alias("kept"),
        F.col(sha).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps."""
    marked = mark_copies(docs)
    return marked.filter("kept").drop(*ADDED)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
k AS (SELECT doc_id, plain, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS k,
             count(*) OVER (PARTITION BY plain) AS group_size
      FROM d WINDOW w AS (PARTITION BY plain ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(plain) AS text_sha256 FROM k
"""
