"""Connected components of links, as table jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.stages import staged


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to ``node, component`` (the smallest node reachable); only nodes with a link to another have rows.

    Alternates two steps until nothing changes: every node's larger neighbours are
    tied to its smallest neighbour, then every node's smaller neighbours are.  The
    rounds grow with the logarithm of the longest chain; each is written to the
    shared folder, so a lost executor costs one round at most.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = staged(edges, "links")
    seen = _print(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        ties = large.join(low, F.col("a") == F.col("u")).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = staged(ties.select("e.a", "e.b").filter("a <> b").distinct(), "links")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    lows = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(lows)
