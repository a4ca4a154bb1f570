"""Diagnostic aggregates of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: share of rows that may use the model fallback.
FALLBACK_LIMIT = 0.5


def publisher_profile(df: DataFrame, publisher: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(publisher).alias("n_unique"),
        F.count_if(F.col(publisher).isNull()).alias("n_null"),
    )


def stage_counts(fetched: DataFrame, enriched: DataFrame, official: str = "official") -> DataFrame:
    """Rows fetched, before the official-level filter, dropped by it, kept."""
    total = fetched.select(F.lit("fetched").alias("stage")).groupBy("stage").agg(F.count("*").alias("n"))
    parts = enriched.agg(
        F.count("*").alias("before_filter"),
        F.count_if(F.col(official).isNull()).alias("dropped"),
        F.count_if(F.col(official).isNotNull()).alias("kept"),
    )
    return total.unionByName(parts.unpivot([], ["before_filter", "dropped", "kept"], "stage", "n"))


def fallback_ratio(runs: DataFrame, run: str, used: Column | str, limit: float = FALLBACK_LIMIT) -> DataFrame:
    """Share of processed rows that used the fallback, per run, and whether more may."""
    hit = F.col(used) if isinstance(used, str) else used
    ratio = F.avg(F.coalesce(hit, F.lit(False)).cast("int"))
    return runs.groupBy(run).agg(
        F.count("*").alias("processed"), F.count_if(hit).alias("used"),
        ratio.alias("ratio"), (ratio < limit).alias("allowed"),
    )
