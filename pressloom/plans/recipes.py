"""Inputs of the checks, derived from the given tables: Spark form and SQL form.

The SQL texts are common table expressions, so that each check reads
``WITH <recipe> SELECT ...``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.urls import url_host
from pressloom.sources.tables import table

_HOST_SQL = "regexp_replace(regexp_extract(lower({0}), '^[a-z]+://([^/?#]*)', 1), '^www[.]', '')"

MESSAGES_SQL = f"""
messages AS (
  SELECT d.doc_id AS arrival,
         CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE concat('u', CAST(d.doc_id % 700 AS VARCHAR)) END AS universal_message_id,
         CASE WHEN d.doc_id % 10 = 0 THEN NULL ELSE concat('s', CAST(d.doc_id % 300 AS VARCHAR)) END AS sn_msg_id,
         CASE WHEN d.doc_id % 20 = 0 THEN '' ELSE p.url END AS permalink,
         p.url AS url, p.page_id AS page_id,
         d.text AS message,
         concat('T', CAST(d.doc_id % 11 AS VARCHAR)) AS title,
         CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE {_HOST_SQL.format('p.url')} END AS publisher_name,
         d.lang AS country,
         CASE d.doc_id % 4 WHEN 0 THEN 'NEWS' WHEN 1 THEN 'BLOG' WHEN 2 THEN '' ELSE NULL END AS media_type,
         e.ts AS created_ts,
         e.value AS reach
  FROM documents d
  JOIN pages p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages)
  JOIN events e ON e.event_id = d.doc_id)
"""

MASTER_SQL = f"""
media_master AS (
  SELECT page_id AS ord, url, {_HOST_SQL.format('url')} AS host,
         CASE WHEN page_id % 17 = 0 THEN NULL ELSE concat('L', CAST(page_id % 3 AS VARCHAR)) END AS official,
         concat('C', CAST(page_id % 7 AS VARCHAR)) AS country,
         concat('S', CAST(page_id % 4 AS VARCHAR)) AS source
  FROM pages
  WHERE NOT regexp_matches(url, '^[a-z]+://[^/?#]*[.]net([/?#]|$)'))
"""


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Feed rows with missing ids, repeated keys, publisher hosts and times (flat form)."""
    docs = table(spark, folder, "documents")
    pages = table(spark, folder, "pages")
    events = table(spark, folder, "events")
    n_pages = pages.agg(F.count("*")).scalar()
    d = F.col("doc_id")
    return (
        docs.select("doc_id", "text", "lang").withColumn("page_id", d % n_pages)
        .join(pages.select("page_id", "url"), "page_id")
        .join(events.select(F.col("event_id").alias("doc_id"), "ts", "value"), "doc_id")
        .select(
            d.alias("arrival"),
            F.when(d % 5 != 0, F.concat(F.lit("u"), (d % 700).cast("string"))).alias("universal_message_id"),
            F.when(d % 10 != 0, F.concat(F.lit("s"), (d % 300).cast("string"))).alias("sn_msg_id"),
            F.when(d % 20 == 0, F.lit("")).otherwise(F.col("url")).alias("permalink"),
            "url", "page_id",
            F.col("text").alias("message"),
            F.concat(F.lit("T"), (d % 11).cast("string")).alias("title"),
            F.when(d % 13 != 0, url_host("url")).alias("publisher_name"),
            F.col("lang").alias("country"),
            F.when(d % 4 == 0, "NEWS").when(d % 4 == 1, "BLOG").when(d % 4 == 2, "").alias("media_type"),
            F.col("ts").alias("created_ts"),
            F.col("value").alias("reach"),
        )
    )


def feed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The messages as nested feed rows, with their arrival number."""
    m = messages(spark, folder)
    es = F.struct(
        F.col("universal_message_id").alias("universalMessageId"),
        F.col("sn_msg_id").alias("snMsgId"),
        F.lit("WEB").alias("snType"),
        F.lit("1").alias("messageType"),
        F.col("permalink"),
        F.col("message"),
        F.date_format("created_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("snCreatedTime"),
        F.date_format("created_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("snModifiedTime"),
        F.struct(
            F.col("publisher_name").alias("screenName"), F.col("publisher_name").alias("publisherName")
        ).alias("senderProfile"),
        F.when(F.col("media_type").isNotNull(), F.array(F.struct(F.col("media_type").alias("type"))))
        .otherwise(F.array().cast("array<struct<type:string>>")).alias("mediaList"),
        F.struct(F.lit("NEUTRAL").alias("sentiment")).alias("workflowProperties"),
    )
    return m.select(
        "arrival",
        es.alias("ES_MESSAGE_ID_0"),
        F.col("title").alias("WEB_TITLE_ES_MESSAGE_ID_2"),
        F.col("title").alias("WEB_TITLE_ES_MESSAGE_ID_3"),
        F.col("publisher_name").alias("MEDIA_SOURCE_NAME_3"),
        F.col("permalink").alias("PERMALINK_1"),
        F.col("url").alias("PERMALINK_4"),
        F.col("country").alias("COUNTRY_5"),
    )


def media_master(spark: SparkSession, folder: str) -> DataFrame:
    """Media master with repeated hosts; outlets below ``.net`` are not listed."""
    p = table(spark, folder, "pages").select("page_id", "url")
    pid = F.col("page_id")
    return p.filter(~F.col("url").rlike(r"^[a-z]+://[^/?#]*[.]net([/?#]|$)")).select(
        pid.alias("ord"), "url", url_host("url").alias("host"),
        F.when(pid % 17 != 0, F.concat(F.lit("L"), (pid % 3).cast("string"))).alias("official"),
        F.concat(F.lit("C"), (pid % 7).cast("string")).alias("country"),
        F.concat(F.lit("S"), (pid % 4).cast("string")).alias("source"),
    )


# One date source per page, by page number: none, meta, two metas, JSON-LD, page properties, text.
DATE_MARKS = [
    ("<head>", '<head><meta property="article:published_time" content="2025-07-15T09:00:00+09:00">'),
    ("<head>", '<head><meta name="date" content="2025-07-16"><meta property="og:updated_time" content="2025-07-17T00:00:00Z">'),
    ("<head>", '<head><script type="application/ld+json">{"@graph":[{"datePublished":"2025-07-18"}]}</script>'),
    ("<head>", '<head><script id="__NEXT_DATA__" type="application/json">'
               '{"props":{"pageProps":{"publication_date":"2025-07-19"}}}</script>'),
    ("<article>", "<article><p>2025年7月20日</p>"),
]
DATED_SQL = "dated AS (SELECT page_id, url, CASE page_id % 6 " + " ".join(
    f"WHEN {i} THEN replace(html, '{a}', '{b}')" for i, (a, b) in enumerate(DATE_MARKS, 1)) + " ELSE html END AS html FROM pages)"
DATE_OF_SQL = (
    "CASE page_id % 6 WHEN 1 THEN '2025-07-15 00:00:00' WHEN 2 THEN '2025-07-17 00:00:00' WHEN 3 THEN '2025-07-18 00:00:00' "
    "WHEN 4 THEN '2025-07-19 00:00:00' WHEN 5 THEN '2025-07-20 00:00:00' END"
)


def dated_pages(spark: SparkSession, folder: str) -> DataFrame:
    html = F.col("html")
    for i, (a, b) in enumerate(DATE_MARKS, 1):
        html = F.when(F.col("page_id") % 6 == i, F.replace("html", F.lit(a), F.lit(b))).otherwise(html)
    return table(spark, folder, "pages").withColumn("html", html)
