"""Global numbers without a global task: row numbers, contiguous shards, chunks."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.session import staged

# monotonically_increasing_id: the task above this bit, the place within it below.
PLACE_BITS = 33
# Offsets, one per task of a ranged sort, that a plan may hold as a literal.
MOST_OFFSETS = 20_000


def number_rows(df: DataFrame, *order: str | Column, name: str = "no", start: int = 1) -> DataFrame:
    """Number the rows of ``df`` in ``order`` from ``start``; sort by the number where order is needed.

    A ranged sort spreads the rows over all tasks and is written to the shared
    folder; each task's rows are then counted and its offset added.  No task sees
    all rows, and none moves after the sort: the offsets, one per task of the sort, are
    read from a literal array.  With more than MOST_OFFSETS tasks they are joined.
    ``order`` must be unique, or equal rows are numbered in no fixed order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(ranged.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_task", F.shiftright("_id", PLACE_BITS))
    counts = placed.groupBy("_task").agg(F.count("*").alias("_rows"))  # one row per task of the sort
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    held = {r["_task"]: r["_rows"] for r in counts.limit(MOST_OFFSETS + 1).collect()}
    if len(held) <= MOST_OFFSETS:
        sizes = [held.get(task, 0) for task in range(max(held, default=-1) + 1)]
        before = [0, *accumulate(sizes)]
        # one string, taken apart while the plan is made: a literal per number would be slow to plan
        offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<long>")
        numbered = placed.withColumn("_number", (F.get(offsets, F.col("_task").cast("int")) + place + F.lit(start)).cast("long"))
    else:
        before = counts.select("_task", (F.sum("_rows").over(Window.orderBy("_task")) - F.col("_rows")).alias("_before"))
        numbered = placed.join(before, "_task").withColumn("_number", (F.col("_before") + place + F.lit(start)).cast("long"))
    return numbered.select(F.col("_number").alias(name), *df.columns)


def shard_rows(df: DataFrame, shards: int, *order: str | Column, name: str = "shard") -> DataFrame:
    """Contiguous, even shards of the ordered rows: shard i holds rows [N*i/c, N*(i+1)/c)."""
    numbered = number_rows(df, *order, name="_r", start=0)
    total = numbered.agg(F.max("_r") + 1).scalar()  # of the written rows: the input is not read again
    shard = F.floor(((F.col("_r") + 1) * F.lit(shards) - 1) / total)
    return numbered.withColumn(name, shard.cast("long")).drop("_r")


def chunk_ids(df: DataFrame, id_col: str, size: int) -> DataFrame:
    """Distinct ids in order, in arrays of ``size`` (the last may be shorter)."""
    ids = df.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
    numbered = number_rows(ids, id_col, name="_r", start=0)
    return (
        numbered.withColumn("chunk_no", F.floor(F.col("_r") / size).cast("long"))
        .groupBy("chunk_no")
        .agg(F.array_sort(F.collect_list(id_col)).alias("ids"))
    )
