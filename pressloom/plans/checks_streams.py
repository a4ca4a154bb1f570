"""Checks of the stream forms and of extractor results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pressloom.operators.results import extractor_records
from pressloom.plans.registry import check
from pressloom.session import shared_folder
from pressloom.sources.tables import table
from pressloom.streaming import forms

EVENTS = "event_id long, user_id long, ts timestamp, event_type string"


def _parts(spark, folder):
    """The events as a stream over part files."""
    path = shared_folder(spark, "event-parts")
    table(spark, folder, "events").select(
        F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"),
        F.col("ts").cast("timestamp").alias("ts"), "event_type").write.parquet(path)
    return forms.stream_parts(spark, path, EVENTS)


@check("stream_parts", "SELECT event_id::BIGINT AS event_id, user_id::BIGINT AS user_id, event_type FROM events")
def stream_parts(spark, folder):
    return forms.run_to_table(_parts(spark, folder), "parts").select("event_id", "user_id", "event_type")


# a first row drops its user's events of the next five days; decided is what lies two days back
@check("stream_dedup", """
WITH RECURSIVE e AS (SELECT event_id::BIGINT AS event_id, user_id::BIGINT AS user_id, event_type, ts,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k,
    count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 5 DAYS FOLLOWING) + 1 AS next
  FROM events WHERE ts IS NOT NULL),
firsts AS (SELECT * FROM e WHERE k = 1
  UNION ALL SELECT e.* FROM firsts f JOIN e ON e.user_id = f.user_id AND e.k = f.next)
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM firsts
WHERE date_trunc('millisecond', ts) < (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY FROM events)""")
def stream_dedup(spark, folder):
    firsts = forms.stream_dedup(_parts(spark, folder), "user_id", "ts", dt.timedelta(days=2), dt.timedelta(days=5), "event_id")
    out = forms.run_to_table(firsts, "dedup")
    return out.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


# a day is complete once two further days have been seen
@check("stream_histogram", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events
WHERE date_trunc('day', ts) + INTERVAL 3 DAY <= (SELECT max(ts) FROM events) GROUP BY ALL""")
def stream_histogram(spark, folder):
    stream = _parts(spark, folder).select("ts", "event_type")
    out = forms.run_to_table(forms.stream_histogram(stream, "ts", "1 day", "2 days", "event_type"), "histogram")
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@check("stream_histogram_days", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def stream_histogram_days(spark, folder):
    out = forms.whole_histogram(_parts(spark, folder).select("ts", "event_type"), "histogram-days", "ts", "1 day", "2 days", "event_type")
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@check("udf_result_shapes", """
SELECT doc_id::VARCHAR AS url, CASE WHEN doc_id % 5 IN (1, 2) THEN 'T' || doc_id ELSE '' END AS title,
       CASE WHEN doc_id % 5 = 1 THEN '2025-07-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') END AS published,
       CASE doc_id % 5 WHEN 4 THEN '' ELSE lang || ' ' || source END AS content FROM documents""")
def udf_result_shapes(spark, folder):
    said = F.concat_ws(" ", "lang", "source")
    title = F.concat(F.lit("T"), F.col("doc_id").cast("string"))
    day = F.concat(F.lit("2025-07-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))
    shapes = [
        said,
        F.to_json(F.struct(title.alias("title"), day.alias("published"), said.alias("content"))),
        F.to_json(F.array(F.struct(title.alias("title"), said.alias("body")))),
        F.concat(F.lit("<p>"), said, F.lit("</p>")),
        F.lit("[]"),
    ]
    result = F.element_at(F.array(*shapes), (F.col("doc_id") % 5 + 1).cast("int"))
    return extractor_records(table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("url"), result.alias("result")))
