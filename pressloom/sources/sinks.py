"""Sinks: part tables, the sheet, create-only writes, article JSON, the step log.

All are plain distributed writes: partitions are the parts, and nothing is
gathered into one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOM = "\ufeff"

# The typed columns of the step log, in order.
STEP_LOG = [
    ("run_id", "string"), ("url", "string"), ("step", "string"), ("status", "string"), ("reason", "string"),
    ("content_len", "bigint"), ("published", "timestamp"), ("ts", "timestamp"), ("http_status", "bigint"),
    ("bytes_in", "bigint"), ("parser_version", "string"), ("duplicate_of", "string"), ("via", "string"),
]


def write_parts(df: DataFrame, path: str, mode: str = "append") -> None:
    """Intermediate shards as Parquet, which keeps NULL and '' apart and ids as text."""
    df.write.mode(mode).parquet(path)


def write_sheet(df: DataFrame, path: str, *order: str) -> None:
    """The sheet as CSV parts with header and byte order mark.

    Rows are range-sorted by ``order``, so part names follow the sheet's order;
    concatenating the parts gives the single file, whatever its size.
    """
    marked = df.orderBy(*order) if order else df
    marked = marked.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    marked.write.mode("errorifexists").option("header", "true").option("emptyValue", "").option(
        "escape", '"'
    ).csv(path)


def read_sheet(spark, path: str, schema: str) -> DataFrame:
    """Read a written sheet back with the given schema (multi-line cells allowed)."""
    return (
        spark.read.schema(schema).option("header", "true").option("multiLine", "true").option("escape", '"')
        .option("enforceSchema", "true").csv(path)
    )


def write_once(df: DataFrame, path: str, format: str = "parquet", stamp: str | None = None) -> str:
    """Create-only write: an existing target is left alone and a stamped neighbour is written.

    Returns the path that was written.
    """
    try:
        df.write.mode("errorifexists").format(format).save(path)
        return path
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    other = f"{path}__dup_{stamp}"
    df.write.mode("errorifexists").format(format).save(other)
    return other


def write_json(df: DataFrame, path: str) -> None:
    """Articles (or raw rows) as JSON lines; NULL fields are written."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", "true").option("escape", '"').csv(path)


def conform_step_log(*frames: DataFrame) -> DataFrame:
    """Union of step records in the typed log schema; missing columns are NULL, extra ones dropped."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first.select(*[
        (F.col(n).try_cast(t) if n in first.columns else F.lit(None).cast(t)).alias(n) for n, t in STEP_LOG
    ])


def append_step_log(path: str, *frames: DataFrame) -> None:
    conform_step_log(*frames).write.mode("append").partitionBy("run_id").parquet(path)
