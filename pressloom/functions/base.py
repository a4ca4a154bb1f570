"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither NULL nor empty; the last one is returned as it is."""
    *head, last = [col(c) for c in cols]
    return F.coalesce(*[blank_to_null(c) for c in head], last) if head else last


def is_filled(c: Column | str) -> Column:
    return F.coalesce(F.length(F.trim(col(c))) > 0, F.lit(False))


def strip(c: Column | str) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def count_of(c: Column, piece: str) -> Column:
    """Occurrences of a one-character string."""
    return F.length(c) - F.length(F.replace(c, F.lit(piece)))


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Table of values written in the program; Spark knows its size and chooses the join by it."""
    return spark.createDataFrame(list(rows), schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it as often as ``body`` likes."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first(values: Column, test: Callable[[Column], Column] | None = None) -> Column:
    """First element that passes ``test`` (by default: is not NULL)."""
    return F.get(F.filter(values, test or (lambda v: v.isNotNull())), F.lit(0))
