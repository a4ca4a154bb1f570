"""Report query: filter, group, sum, sort and page a fact table by a declarative spec.

The spec is a dict with the keys ``startTime``, ``endTime`` (epoch ms, both ends
inclusive), ``timeZone``, ``page``, ``pageSize``, ``filters``, ``groupBys``,
``projections`` and ``sorts``; every step is one DataFrame call, so Catalyst
pushes time and dimension filters into the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions.base import col
from pressloom.functions.urls import host_suffixes
from pressloom.operators.feed import dedup_feed
from pressloom.operators.numbering import number_rows
from pressloom.session import staged

# Dimension names the spec treats specially, and histogram steps.
LINK_DIMENSION = "PERMALINK"
MESSAGE_DIMENSION = "ES_MESSAGE_ID"
TOPIC_DIMENSION = "TOPIC_IDS"
QUERY_DIMENSION = "QUERY"
INTERVALS = {"1d": "DAY", "1w": "WEEK"}
PAGE_SIZE = 20
ROW_NUMBER = "_row_no"



def _instant(df: DataFrame, time_col: str, millis: int) -> Column:
    moment = dt.datetime.fromtimestamp(millis / 1000, dt.timezone.utc)
    if isinstance(df.schema[time_col].dataType, T.TimestampNTZType):
        return F.lit(moment.replace(tzinfo=None)).cast("timestamp_ntz")
    return F.timestamp_millis(F.lit(millis))


def time_range(df: DataFrame, time_col: str, start_ms: int | None, end_ms: int | None) -> DataFrame:
    """Rows inside the range, both ends included; NTZ columns are read as UTC."""
    if start_ms is not None:
        df = df.filter(F.col(time_col) >= _instant(df, time_col, start_ms))
    if end_ms is not None:
        df = df.filter(F.col(time_col) <= _instant(df, time_col, end_ms))
    return df


def in_filter(df: DataFrame, dimension: Column | str, values: Iterable | DataFrame) -> DataFrame:
    """Keep rows whose dimension is in ``values``; an empty list keeps every row.

    A list becomes an expression, whatever its length or type.  Values that are a
    table already (one column) are joined; an empty table keeps no row.
    """
    if isinstance(values, DataFrame):
        wanted = values.toDF("_value")
        return df.withColumn("_dim", col(dimension)).join(wanted, F.col("_dim") == F.col("_value"), "left_semi").drop("_dim")
    values = [v for v in values if v not in (None, "")]
    return df.filter(col(dimension).isin(values)) if values else df


def topic_filter(df: DataFrame, topic: Column | str, ids: Iterable) -> DataFrame:
    """Topic ids in one pass; splitting them into batches would give the same rows."""
    return in_filter(df, topic, ids)


def exclude_sites(df: DataFrame, host: str, sites: Iterable[str] | DataFrame) -> DataFrame:
    """Drop rows whose host is an excluded site or below one.

    A list becomes an expression without a join.  A table (one column) is joined
    to the distinct hosts first, then the excluded hosts are anti-joined.
    """
    if not isinstance(sites, DataFrame):
        sites = list(sites)
        hit = F.exists(host_suffixes(host), lambda s: s.isin(sites))
        return df.filter(~F.coalesce(hit, F.lit(False)))
    banned = sites.toDF("_site")
    hosts = df.select(F.col(host).alias("_host")).distinct()
    hit = (
        hosts.withColumn("_suffix", F.explode(host_suffixes("_host")))
        .join(banned, F.col("_suffix") == F.col("_site"), "left_semi")
        .select("_host").distinct()
    )
    return df.join(hit, F.col(host) == F.col("_host"), "left_anti")


def date_bucket(time: Column | str, zone: str, interval: str) -> Column:
    """First day of the day or week (weeks start on Monday) in ``zone``, as DATE."""
    if interval not in INTERVALS:
        raise ValueError(f"interval {interval!r} is not one of {sorted(INTERVALS)}")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), col(time).cast("timestamp_ntz"))
    return F.date_trunc(INTERVALS[interval], local).cast("date")


def group_columns(
    spec: Mapping, dimensions: Mapping[str, Column | str], add_message_id: bool = False
) -> list[Column]:
    """Group-by columns under their headings; the permalink is always among them."""
    groups = [dict(g) for g in spec.get("groupBys") or []]
    names = {g["dimensionName"] for g in groups}
    wanted = [LINK_DIMENSION] + ([MESSAGE_DIMENSION] if add_message_id else [])
    groups += [{"dimensionName": d, "groupType": "FIELD", "heading": d} for d in wanted if d not in names]
    out = []
    for g in groups:
        value = col(dimensions[g["dimensionName"]])
        if g.get("groupType") == "DATE_HISTOGRAM":
            interval = g.get("interval") or (g.get("details") or {}).get("interval", "1d")
            value = date_bucket(value, spec.get("timeZone") or "UTC", interval)
        out.append(value.alias(g.get("heading") or g["dimensionName"]))
    return out


def sum_columns(spec: Mapping, measures: Mapping[str, Column | str]) -> list[Column]:
    out = []
    for p in spec.get("projections") or []:
        if p.get("aggregateFunction", "SUM") != "SUM":
            raise ValueError(f"only SUM is known, not {p['aggregateFunction']!r}")
        out.append(F.sum(col(measures[p["measurementName"]])).alias(p.get("heading") or p["measurementName"]))
    return out


def sort_columns(spec: Mapping, columns: list[str], ties: list[str]) -> list[Column]:
    """Sort keys of the spec, then the tie-break columns.

    A sort heading reads ``MEASURE__SUM__REPORT`` (or with single underscores) while
    the output column has its own heading, so the measure's name decides.
    """
    order = []
    for s in spec.get("sorts") or []:
        target = None
        for p in spec.get("projections") or []:
            name, agg = p["measurementName"], p.get("aggregateFunction", "SUM")
            if s["heading"].startswith((f"{name}__{agg}", f"{name}_{agg}")) or s["heading"] == p.get("heading"):
                target = p.get("heading") or name
        if target is None and s["heading"] in columns:
            target = s["heading"]
        if target is None:
            raise ValueError(f"sort heading {s['heading']!r} names no output column")
        order.append(F.desc(target) if s.get("order", "DESC").upper() == "DESC" else F.asc(target))
    return order + [F.asc(t) for t in ties]


def page_of(df: DataFrame, order: list[Column], page: int, size: int) -> DataFrame:
    """One page (from 0) of the sorted rows; plans as a bounded top-k."""
    return df.orderBy(*order).offset(page * size).limit(size)


def report_query(
    df: DataFrame,
    spec: Mapping,
    dimensions: Mapping[str, Column | str],
    measures: Mapping[str, Column | str],
    *,
    time_col: str,
    host_col: str | None = None,
    excluded_sites: Iterable[str] | DataFrame = (),
    stream_fields: Mapping[str, Column | str] | None = None,
    first_by: str | None = None,
    add_message_id: bool = False,
    page: int | None = None,
) -> DataFrame:
    """Evaluate ``spec``, its sorts included.  All pages by default; ``page`` asks for a single one
    of the spec's ``pageSize``.  Where several pages are read, take :func:`report_pages`: it
    sorts once.

    ``stream_fields`` adds one representative value per group, that of the row
    with the smallest ``first_by``.
    """
    df = time_range(df, time_col, spec.get("startTime"), spec.get("endTime"))
    for f in spec.get("filters") or []:
        if f["dimensionName"] != QUERY_DIMENSION:
            df = in_filter(df, dimensions[f["dimensionName"]], f.get("values") or [])
    if host_col:
        df = exclude_sites(df, host_col, excluded_sites)
    groups = group_columns(spec, dimensions, add_message_id)
    extra = [
        F.min_by(col(value), F.col(first_by)).alias(name) for name, value in (stream_fields or {}).items()
    ]
    aggregates = sum_columns(spec, measures) + extra
    keyed = df.groupBy(*groups)
    out = keyed.agg(*aggregates) if aggregates else df.select(*groups).distinct()
    ties = out.columns[: len(groups)]
    if page is None:
        return out.orderBy(*sort_columns(spec, out.columns, ties)) if spec.get("sorts") else out
    return page_of(out, sort_columns(spec, out.columns, ties), page, int(spec.get("pageSize", PAGE_SIZE)))


@dataclass(frozen=True)
class Pages:
    """A sorted report, written once in numbered rows; any page is read without sorting again."""

    rows: DataFrame   # the report's columns after ROW_NUMBER, written in that order
    n_rows: int
    size: int
    first: int        # the spec's ``page``

    @property
    def count(self) -> int:
        """Pages in all, those before the spec's ``page`` included."""
        return -(-self.n_rows // self.size)

    def page(self, number: int) -> DataFrame:
        """One page, from 0.  The range of numbers reaches the scan, which passes over all other parts."""
        low = number * self.size
        return self.rows.filter(F.col(ROW_NUMBER).between(low, low + self.size - 1))

    def rest(self) -> DataFrame:
        """All rows from the spec's page on, which is what asking for page after page gives."""
        return self.rows.filter(F.col(ROW_NUMBER) >= self.first * self.size)


def report_pages(df: DataFrame, spec: Mapping, dimensions: Mapping[str, Column | str], measures: Mapping[str, Column | str], **options) -> Pages:
    """The pages of a spec: ``page`` and ``pageSize`` count, the options are those of :func:`report_query`.

    Rows stand in the order of the spec's sorts, ties by the group columns.
    """
    size = int(spec.get("pageSize", PAGE_SIZE))
    if size < 1:
        raise ValueError("pageSize must be at least 1")
    out = report_query(df, {**spec, "sorts": []}, dimensions, measures, **options)
    ties = [c.get("heading") or c["dimensionName"] for c in spec.get("groupBys") or []]
    ties += [c for c in out.columns if c not in ties and c in (LINK_DIMENSION, MESSAGE_DIMENSION)]
    numbered = number_rows(out, *sort_columns(spec, out.columns, ties), name=ROW_NUMBER, start=0)
    written = staged(numbered, "report")
    return Pages(written, written.count(), size, int(spec.get("page") or 0))


def report_feed(pages: Pages, key: Column | None = None) -> DataFrame:
    """The report's rows as a feed: from the spec's page on, the first row of each key, in order of ``arrival``.

    ``key`` defaults to the identity of a feed row.
    """
    rows = pages.rest().withColumnRenamed(ROW_NUMBER, "arrival")
    return dedup_feed(rows, "arrival", key)
