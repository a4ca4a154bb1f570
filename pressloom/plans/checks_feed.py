"""Checks of feed rows, joins, aggregates and numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressloom.operators import feed, lookups, numbering
from pressloom.operators.counts import fallback_ratio, publisher_profile, stage_counts
from pressloom.plans import recipes as r
from pressloom.plans.registry import check
from pressloom.sources.tables import table

FLAT_SQL = f"""WITH {r.MESSAGES_SQL}, flat AS (
  SELECT arrival, 'WEB' AS snType, sn_msg_id AS snMsgId, '1' AS messageType, universal_message_id AS universalMessageId,
         coalesce(nullif(permalink, ''), url) AS permalink, title, message, publisher_name AS publisherName,
         country, strftime(created_ts, '%Y-%m-%dT%H:%M:%SZ') AS snCreatedTime, media_type AS type,
         'NEUTRAL' AS sentiment, reach, page_id, url,
         coalesce(nullif(universal_message_id, ''), nullif(sn_msg_id, ''), nullif(permalink, ''),
                  concat_op.k, 'row') AS key
  FROM messages, LATERAL (SELECT title || '||' || publisher_name AS k) concat_op)"""

# DuckDB's arg_max skips NULL values, so the last row is picked by a window instead.
MASTER_LAST_SQL = f"""{r.MASTER_SQL}, last_master AS (
  SELECT host, official, country AS m_country, source FROM (
    SELECT *, row_number() OVER (PARTITION BY host ORDER BY ord DESC) AS rn FROM media_master) m WHERE rn = 1)"""


@check("flatten_feed", FLAT_SQL + """
SELECT snType, snMsgId, messageType, universalMessageId, permalink, title AS WEB_TITLE_ES_MESSAGE_ID_3, message,
       publisherName AS screenName, publisherName, country AS COUNTRY_5, snCreatedTime,
       snCreatedTime AS snModifiedTime, type, sentiment FROM flat""")
def flatten_feed(spark, folder):
    return feed.flatten_feed(r.feed_rows(spark, folder))


# rows without any key fall back to the whole row, which the SQL side names 'row'
@check("row_key", FLAT_SQL + "SELECT arrival, key FROM flat")
def row_key(spark, folder):
    df = r.feed_rows(spark, folder)
    key = feed.row_key(df, ignore=("arrival",))
    return df.select("arrival", F.when(key.startswith("{"), F.lit("row")).otherwise(key).alias("key"))


@check("dedup_feed", FLAT_SQL + """, keyed AS (
  SELECT *, CASE WHEN key = 'row' THEN concat('row', CAST(arrival AS VARCHAR)) ELSE key END AS k FROM flat)
SELECT arrival, universalMessageId, permalink FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY arrival) AS rn FROM keyed) t WHERE rn = 1""")
def dedup_feed(spark, folder):
    df = feed.dedup_feed(r.feed_rows(spark, folder), "arrival")
    return feed.flatten_feed(df, "arrival").select("arrival", "universalMessageId", "permalink")


@check("prefilter_dump", FLAT_SQL + """
SELECT snType, snMsgId, messageType, universalMessageId, permalink, title AS WEB_TITLE_ES_MESSAGE_ID_3, publisherName,
       country AS COUNTRY_5, snCreatedTime, snCreatedTime AS snModifiedTime, type, sentiment FROM flat""")
def prefilter_dump(spark, folder):
    return feed.prefilter_dump(feed.flatten_feed(r.feed_rows(spark, folder)))


@check("notes_column", FLAT_SQL + """
SELECT arrival, (CASE WHEN arrival % 3 = 0 THEN '[page]' ELSE '[feed]' END)
       || coalesce(',' || nullif(publisherName, ''), '') || coalesce(',' || nullif(country, ''), '')
       || coalesce(',' || nullif(type, ''), '') || coalesce(',' || nullif(snMsgId, ''), '') AS notes FROM flat""")
def notes_column(spark, folder):
    df = feed.flatten_feed(r.feed_rows(spark, folder), "arrival")
    source = F.when(F.col("arrival") % 3 == 0, F.lit("page")).otherwise(F.lit("feed"))
    return df.select("arrival", feed.notes(source, "publisherName", "COUNTRY_5", "type", "snMsgId").alias("notes"))


def _flat(spark, folder):
    return feed.flatten_feed(r.feed_rows(spark, folder), "arrival")


@check("enrich_master", f"WITH {r.MESSAGES_SQL}, {MASTER_LAST_SQL}" + """
SELECT arrival, publisher_name AS publisherName, official, m_country AS country, source
FROM messages LEFT JOIN last_master ON lower(publisher_name) = host""")
def enrich_master(spark, folder):
    out = lookups.enrich_master(_flat(spark, folder), r.media_master(spark, folder))
    return out.select("arrival", "publisherName", "official", "country", "source")


@check("official_only", f"WITH {r.MESSAGES_SQL}, {MASTER_LAST_SQL}" + """
SELECT arrival, publisher_name AS publisherName, official
FROM messages JOIN last_master ON lower(publisher_name) = host WHERE official IS NOT NULL""")
def official_only(spark, folder):
    out = lookups.enrich_master(_flat(spark, folder), r.media_master(spark, folder), how="inner")
    return out.select("arrival", "publisherName", "official")


@check("unmatched_publishers", f"WITH {r.MESSAGES_SQL}, {MASTER_LAST_SQL}" + """
SELECT arrival, publisher_name AS publisherName
FROM messages LEFT JOIN last_master ON lower(publisher_name) = host WHERE official IS NULL""")
def unmatched_publishers(spark, folder):
    out = lookups.unmatched_publishers(_flat(spark, folder), r.media_master(spark, folder))
    return out.select("arrival", "publisherName")


@check("top_unmatched", f"WITH {r.MESSAGES_SQL}, {MASTER_LAST_SQL}" + """
SELECT lower(coalesce(publisher_name, 'none')) AS publisher, count(*) AS n
FROM messages LEFT JOIN last_master ON lower(publisher_name) = host WHERE official IS NULL
GROUP BY 1 ORDER BY n DESC, publisher LIMIT 20""")
def top_unmatched(spark, folder):
    return lookups.top_unmatched(lookups.unmatched_publishers(_flat(spark, folder), r.media_master(spark, folder)))


@check("last_wins_map", f"WITH {MASTER_LAST_SQL} SELECT host, official, m_country AS country, source FROM last_master")
def last_wins_map(spark, folder):
    return lookups.last_wins(r.media_master(spark, folder), "host", "ord", "official", "country", "source")


@check("publisher_profile", f"WITH {r.MESSAGES_SQL}" + """
SELECT count(*) AS n_rows, count(DISTINCT publisher_name) AS n_unique,
       CAST(sum(CASE WHEN publisher_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM messages""")
def publisher_profile_check(spark, folder):
    return publisher_profile(_flat(spark, folder), "publisherName")


@check("stage_counts", FLAT_SQL + f""", {MASTER_LAST_SQL}, keyed AS (
  SELECT *, CASE WHEN key = 'row' THEN concat('row', CAST(arrival AS VARCHAR)) ELSE key END AS k FROM flat),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY arrival) AS rn FROM keyed) t WHERE rn = 1),
joined AS (SELECT official FROM first LEFT JOIN last_master ON lower(publisherName) = host)
SELECT 'fetched' AS stage, count(*) AS n FROM flat
UNION ALL SELECT 'before_filter', count(*) FROM joined
UNION ALL SELECT 'dropped', count(*) FROM joined WHERE official IS NULL
UNION ALL SELECT 'kept', count(*) FROM joined WHERE official IS NOT NULL""")
def stage_counts_check(spark, folder):
    rows = r.feed_rows(spark, folder)
    unique = feed.flatten_feed(feed.dedup_feed(rows, "arrival"))
    return stage_counts(rows, lookups.enrich_master(unique, r.media_master(spark, folder)))


@check("number_rows", """
SELECT row_number() OVER (ORDER BY ts, event_id) AS no, event_id FROM events""")
def number_rows(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return numbering.number_rows(events, "ts", "event_id").select("no", "event_id")


@check("shard_rows", """
SELECT event_id, CAST(floor((row_number() OVER (ORDER BY event_id) * 20 - 1) / (SELECT count(*) FROM events)) AS BIGINT)
       AS shard FROM events""")
def shard_rows(spark, folder):
    return numbering.shard_rows(table(spark, folder, "events").select("event_id"), 20, "event_id")


@check("chunk_ids", """
SELECT chunk_no, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS ids FROM (
  SELECT user_id, CAST(floor((row_number() OVER (ORDER BY user_id) - 1) / 10) AS BIGINT) AS chunk_no
  FROM (SELECT DISTINCT user_id FROM events) u) t GROUP BY chunk_no""")
def chunk_ids(spark, folder):
    out = numbering.chunk_ids(table(spark, folder, "events"), "user_id", 10)
    return out.select("chunk_no", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@check("union_batches", """
SELECT event_id AS id, event_type AS kind, NULL AS lang FROM events
UNION ALL SELECT doc_id AS id, NULL AS kind, lang FROM documents
UNION ALL SELECT page_id AS id, 'page' AS kind, NULL AS lang FROM pages""")
def union_batches(spark, folder):
    return feed.union_batches(
        table(spark, folder, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind")),
        table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang"),
        table(spark, folder, "pages").select(F.col("page_id").alias("id"), F.lit("page").alias("kind")),
    )


@check("distinct_list", """
SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(ws), lambda w:
         {'p': list_position(ws, w), 'w': w})), lambda s: s.w), ' ') AS words
FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents) t""")
def distinct_list(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.array_join(F.array_distinct(F.split("text", " ")), " ").alias("words"))


@check("article_source", f"WITH {r.MESSAGES_SQL}" + """
SELECT arrival, CASE WHEN arrival % 3 = 0 AND length(trim(message)) > 0 THEN 'feed' WHEN arrival % 3 = 1 THEN 'page'
       WHEN arrival % 5 = 0 THEN 'feed' ELSE '' END AS source FROM messages""")
def article_source(spark, folder):
    m = r.messages(spark, folder)
    a = F.col("arrival")
    source = feed.article_source(
        F.when(a % 3 == 0, F.col("message")), F.when(a % 3 == 1, F.col("url")), F.when(a % 5 == 0, F.col("title"))
    )
    return m.select("arrival", source.alias("source"))


@check("fallback_ratio", """
SELECT conv_id AS run_id, count(*) AS processed, CAST(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS BIGINT) AS used,
       round(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) / count(*), 6) AS ratio,
       sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) / count(*) < 0.5 AS allowed
FROM conversations GROUP BY conv_id""")
def fallback_ratio_check(spark, folder):
    runs = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("run_id"), (F.col("role") == "assistant").alias("used")
    )
    return fallback_ratio(runs, "run_id", "used").withColumn("ratio", F.round("ratio", 6))


# synthetic translations: a text is translated where its document is French or Spanish
@check("attach_translations", f"WITH {r.MESSAGES_SQL}" + """, tr AS (
  SELECT text, min('ja:' || lang || ':' || CAST(length(text) AS VARCHAR)) AS ja FROM documents WHERE lang IN ('fr', 'es')
  GROUP BY text)
SELECT arrival, coalesce(a.ja, '') AS body_ja, coalesce(b.ja, '') AS title_ja
FROM messages LEFT JOIN tr a ON a.text = message LEFT JOIN tr b ON b.text = title""")
def attach_translations(spark, folder):
    docs = table(spark, folder, "documents").filter(F.col("lang").isin("fr", "es"))
    tr = docs.select(
        "text", F.concat(F.lit("ja:"), "lang", F.lit(":"), F.length("text").cast("string")).alias("translated")
    )
    out = lookups.attach_translations(r.messages(spark, folder).select("arrival", "message", "title"), tr,
                                      {"message": "body_ja", "title": "title_ja"})
    return out.select("arrival", "body_ja", "title_ja")
