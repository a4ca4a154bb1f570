"""Checks of recovery, the final columns and the whole news sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



from pressloom.functions.text import html_to_text
from pressloom.operators import sheet as sh
from pressloom.operators.articles import articles
from pressloom.plans import recipes as r
from pressloom.plans.checks_feed import FLAT_SQL, MASTER_LAST_SQL
from pressloom.plans.checks_pages import ARTICLES_SQL, AS_OF, TEST_RULES
from pressloom.plans.checks_text import LINES_SQL, NL, PLAIN_SQL, labelled
from pressloom.plans.registry import check
from pressloom.sources.tables import table


def page_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with answers a model could give: the whole text as one body line.

    For every third page with an article the answer holds no body line.
    """
    pages = r.dated_pages(spark, folder).withColumn("plain", html_to_text("html"))
    found = articles(pages, AS_OF, TEST_RULES)

    def answer(text: str, label):
        line = F.struct(F.col(text).alias("text"), label.alias("label"), F.lit(0.95).alias("confidence"),
                        F.lit(0).alias("index"))
        return F.to_json(F.array(line))

    label = F.when(F.col("page_id") % 3 == 0, "nav").otherwise("body")
    return sh.page_bodies(found.withColumns({
        "article_raw": answer("content", label), "plain_raw": answer("plain", F.lit("body"))}))


BODIES_SQL = f"""{ARTICLES_SQL},
plain AS (SELECT url, {PLAIN_SQL} AS text FROM dated),
bodies AS (SELECT f.url AS url, f.content <> '' AS has_article,
  CASE WHEN f.content <> '' THEN CASE WHEN page_id % 3 = 0 THEN '' ELSE f.content END END AS page_body,
  CASE WHEN f.content = '' THEN plain.text END AS plain_body FROM final f JOIN plain ON plain.url = f.url)"""
# the extraction steps call their own intermediate 'bodies'
BODIES_SQL = BODIES_SQL.replace("bodies AS (\n  SELECT *, nullif", "rule_bodies AS (\n  SELECT *, nullif").replace(
    "FROM bodies)", "FROM rule_bodies)")

# every fourth message has no body of its own
RECOVER_SQL = f"""WITH {r.MESSAGES_SQL}, {BODIES_SQL}
SELECT arrival, CASE WHEN arrival % 4 <> 0 THEN message ELSE coalesce(page_body, plain_body, '') END AS body,
       CASE WHEN arrival % 4 <> 0 THEN 'feed' WHEN page_body <> '' THEN 'page' WHEN plain_body <> '' THEN 'feed' ELSE '' END
       AS article_source FROM messages LEFT JOIN bodies ON bodies.url = permalink"""


@check("recover_empty", RECOVER_SQL)
def recover_empty(spark, folder):
    m = r.messages(spark, folder)
    rows = m.select("arrival", "permalink", F.when(F.col("arrival") % 4 != 0, F.col("message")).otherwise("").alias("body"))
    out = sh.recover_empty(rows, page_bodies(spark, folder))
    return out.select("arrival", "body", "article_source")


@check("final_sheet", f"""WITH {r.MESSAGES_SQL}
SELECT row_number() OVER (ORDER BY arrival) AS no, country, '' AS source, '' AS official, '' AS date_label, title, '' AS title_ja,
       url, message AS body, '' AS body_ja, '' AS keywords, coalesce(publisher_name, '') AS notes FROM messages""")
def final_sheet(spark, folder):
    m = r.messages(spark, folder).select(
        "arrival", "country", "title", "url", F.col("message").alias("body"), F.col("publisher_name").alias("notes"))
    return sh.final_sheet(sh.number_rows(m, "arrival", name="no"))


@check("news_sheet", FLAT_SQL + f""", {MASTER_LAST_SQL}, {LINES_SQL}, {BODIES_SQL},
keyed AS (SELECT *, CASE WHEN key = 'row' THEN concat('row', CAST(arrival AS VARCHAR)) ELSE key END AS k FROM flat),
uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY arrival) AS rn FROM keyed) t WHERE rn = 1),
own AS (SELECT doc_id, string_agg(line, {NL} || {NL} ORDER BY idx) AS body FROM kept_own GROUP BY doc_id),
joined AS (
  SELECT u.arrival, u.title, u.permalink, u.publisherName, u.country, u.type, u.snMsgId, u.snCreatedTime, m.official, m.m_country, m.source,
         coalesce(own.body, '') AS own_body, coalesce(page_body, plain_body, '') AS other_body, page_body
  FROM uniq u JOIN last_master m ON lower(u.publisherName) = m.host AND m.official IS NOT NULL
  LEFT JOIN own ON own.doc_id = u.arrival LEFT JOIN bodies ON bodies.url = u.permalink),
full_rows AS (SELECT *, CASE WHEN own_body <> '' THEN own_body ELSE other_body END AS body,
         CASE WHEN own_body = '' AND page_body <> '' THEN '[page]' ELSE '[feed]' END AS tag FROM joined),
tr AS (SELECT text, min('ja:' || lang || ':' || CAST(length(text) AS VARCHAR)) AS ja FROM (
  SELECT text, lang FROM documents UNION ALL SELECT 'T' || CAST(doc_id % 11 AS VARCHAR), lang FROM documents) d GROUP BY text)
SELECT row_number() OVER (ORDER BY arrival) AS no, m_country AS country, source, official,
       CAST(month(strptime(snCreatedTime, '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 9 HOUR) AS VARCHAR) || '月'
       || CAST(day(strptime(snCreatedTime, '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 9 HOUR) AS VARCHAR) || '日' AS date_label, title,
       coalesce(t.ja, '') AS title_ja, permalink AS url, body, coalesce(b.ja, '') AS body_ja, '' AS keywords,
       tag || coalesce(',' || nullif(publisherName, ''), '') || coalesce(',' || nullif(full_rows.country, ''), '')
       || coalesce(',' || nullif(type, ''), '') || coalesce(',' || nullif(snMsgId, ''), '') AS notes
FROM full_rows LEFT JOIN tr t ON t.text = title LEFT JOIN tr b ON b.text = body""".replace(
    "kept AS (SELECT * FROM norm WHERE", "kept_own AS (SELECT * FROM norm WHERE").replace(
    "AND NOT (title <> '' AND ln = tn)", ""))
def news_sheet(spark, folder):
    """The flagship: feed, master, model answers, pages and translations to one sheet."""
    docs = table(spark, folder, "documents")
    titles = docs.select(F.concat(F.lit("T"), (F.col("doc_id") % 11).cast("string")).alias("text"), "lang")
    tr = docs.select("text", "lang").unionByName(titles).select("text", F.concat(
        F.lit("ja:"), "lang", F.lit(":"), F.length("text").cast("string")).alias("translated"))
    answers = labelled(spark, folder).select(F.col("doc_id").alias("arrival"), "raw")
    return sh.news_sheet(
        r.feed_rows(spark, folder), r.media_master(spark, folder), answers, page_bodies(spark, folder), tr)
