"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Had all rows been shuffled and dealt out, the number of rows that partition i
sends to shard j would follow a multivariate hypergeometric law.  So that matrix is
drawn first, with row sums = the partitions' sizes and column sums = the shards'
sizes.  Each partition permutes its rows and cuts them by its row of the matrix;
the rows are exchanged; each shard permutes what it got.  The result is a uniform
permutation, and shard sizes are exact: at most one row apart.

The matrix is drawn in two levels, groups of partitions and then the partitions of
a group, each group in a task of its own.  The second permutation splits a shard
into random buckets of about ``bucket_rows`` rows, so no task holds a shard; a
bucket's rows take consecutive slots.

Rows: nothing but their number matters, so nulls, empty and long texts, repeated rows
and ids are rows like any other.  An empty table gives empty shards.  Input columns are
kept; those named like a result column are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.stages import free_name, staged

GROUP = 1024  # partitions whose rows of the matrix one task draws
ROW_BITS = 33  # of monotonically_increasing_id: the place within a partition


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Number of good ones among n of good + bad, drawn by inversion outwards from the mode.

    Takes about one step per standard deviation and has no bound on the population.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    log_c = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    up = down = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    mode = up
    p_up = p_down = total = math.exp(log_c(good, mode) + log_c(bad, n - mode) - log_c(good + bad, n))
    u = rng.random()
    while total < u:
        if up == high and down == low:
            return mode
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            total += p_up
            if total >= u:
                return up
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            total += p_down
            if total >= u:
                return down
    return mode


def communication_rows(rng: np.random.Generator, sizes: list[int], room: list[int]) -> list[list[int]]:
    """Counts from each of some senders to each shard; ``room``: what the shards take in all (the senders' total)."""
    room, out = list(room), []
    for size in sizes:
        left, row = size, []
        for j, good in enumerate(room):
            row.append(hypergeometric(rng, good, sum(room[j + 1 :]), left))
            left -= row[-1]
        room = [a - b for a, b in zip(room, row)]
        out.append(row)
    return out


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 1, bucket_rows: int = 50_000) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard), sizes at most one row apart."""
    keep = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    # the local permutation; written, so that counting and dealing out see the same rows in the same order
    key, row = free_name(docs, "_key"), free_name(docs, "_row")
    permuted = docs.select(*keep).withColumn(key, F.rand(seed)).sortWithinPartitions(key).drop(key)
    rows = staged(permuted.withColumn(row, F.monotonically_increasing_id()), "shards")
    place = rows.select(F.col(row).alias("_row"), F.shiftright(row, ROW_BITS).alias("_part"), F.col(row).bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_at"))

    parts = place.groupBy("_part").agg(F.count("*").alias("n"))
    groups = parts.withColumn("_group", F.floor(F.col("_part") / GROUP))
    totals = sorted((r["_group"], r["n"]) for r in groups.groupBy("_group").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in totals)
    sizes = [total * (j + 1) // shards - total * j // shards for j in range(shards)]
    rng = np.random.default_rng(seed)
    to_shards = dict(zip((g for g, _ in totals), communication_rows(rng, [n for _, n in totals], sizes)))

    def draw(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("_part")
        group = int(some["_group"].iloc[0])
        matrix = communication_rows(np.random.default_rng([seed, group]), some["n"].tolist(), to_shards[group])
        return pd.DataFrame({"_part": some["_part"], "_ends": [np.cumsum(row).tolist() for row in matrix]})

    matrix = groups.groupBy("_group").applyInPandas(draw, "_part long, _ends array<long>")
    # the shard is the number of ends that the row's place has passed
    shard = F.size(F.filter("_ends", lambda end: end <= F.col("_at")))
    dealt = place.join(matrix, "_part").select("_row", shard.alias("shard"))
    buckets = max(1, math.ceil(total / shards / bucket_rows))
    dealt = dealt.withColumns({"_bucket": F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(buckets)), "_key": F.xxhash64("_row", F.lit(seed + 1))})
    held = dealt.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    first = held.select("shard", "_bucket", (F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_key", "_row")) - 1
    slots = dealt.withColumn("_rank", rank).join(first, ["shard", "_bucket"]).select("_row", "shard", (F.col("_first") + F.col("_rank")).cast("long").alias("slot"))
    return rows.join(slots.withColumnRenamed("_row", row), row).select(*keep, "shard", "slot")


def shard_digests(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    out = shuffle_into_shards(docs.select("doc_id", "text"), shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
