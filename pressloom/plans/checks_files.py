"""Checks of sources and sinks.  Written data goes to the shared folder and is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressloom.plans import recipes as r
from pressloom.plans.registry import check
from pressloom.session import shared_folder
from pressloom.sources import feed, files, sinks
from pressloom.sources.tables import table

SHAPES = ["rows", "tableData", "items", "result"]


def _answers(spark, folder):
    """Answers of up to 20 events each, cycling through the accepted shapes by page number."""
    e = table(spark, folder, "events")
    row = F.struct("event_id", "event_type", "value")
    page = e.groupBy(
        F.floor(F.col("event_id") / 2000).cast("long").alias("batch_id"),
        F.floor(F.col("event_id") % 2000 / 20).cast("long").alias("page_no"),
    ).agg(F.sort_array(F.collect_list(F.when(~((F.col("event_type") == "error") & (F.col("value") > 100)), row)))
          .alias("r"))
    n = F.col("page_no") % 6
    body = F.when(n == 0, F.to_json(F.struct(F.struct(
        F.col("r").alias("data"), (F.col("page_no") < 60).alias("hasMore")).alias("data"))))
    for i, key in enumerate(SHAPES, 1):
        body = body.when(n == i, F.to_json(F.struct(F.col("r").alias(key))))
    body = body.otherwise(F.to_json(F.struct(F.col("batch_id").alias("message"))))
    return page.select("batch_id", "page_no", body.alias("body"))


ANSWERS_SQL = """
WITH e AS (SELECT *, event_id // 2000 AS batch_id, event_id % 2000 // 20 AS page_no FROM events),
pg AS (SELECT DISTINCT batch_id, page_no FROM e),
kept AS (SELECT * FROM e WHERE NOT (event_type = 'error' AND value > 100) AND page_no % 6 <> 5)"""


@check("scan_envelopes", ANSWERS_SQL + """
SELECT batch_id, page_no, row_number() OVER (PARTITION BY batch_id, page_no ORDER BY event_id) - 1 AS pos, event_id,
       event_type, NULL AS message FROM kept
UNION ALL SELECT batch_id, page_no, 0, NULL, NULL, CAST(batch_id AS VARCHAR) FROM pg WHERE page_no % 6 = 5""")
def scan_envelopes(spark, folder):
    rows = feed.scan_envelopes(_answers(spark, folder))
    get = lambda path, kind: F.try_variant_get("feed_row", path, kind)
    return rows.select(
        "batch_id", "page_no", F.col("pos").cast("long").alias("pos"), get("$.event_id", "bigint").alias("event_id"),
        get("$.event_type", "string").alias("event_type"), get("$.message", "string").alias("message"),
    )


@check("feed_pages", ANSWERS_SQL + """
, counted AS (SELECT batch_id, page_no, count(event_id) AS n_rows,
       CASE WHEN page_no % 6 = 0 THEN page_no < 60 END AS has_more
  FROM pg LEFT JOIN kept USING (batch_id, page_no) GROUP BY batch_id, page_no),
ends AS (SELECT batch_id, min(CASE WHEN coalesce(NOT has_more, page_no % 6 = 5 OR n_rows < 20) THEN page_no END) AS stop
  FROM counted GROUP BY batch_id)
SELECT batch_id, page_no, CASE WHEN page_no % 6 <> 5 THEN n_rows END AS n_rows, has_more
FROM counted JOIN ends USING (batch_id) WHERE (stop IS NULL OR page_no <= stop) AND page_no < 50""")
def feed_pages(spark, folder):
    pages = feed.answer_pages(_answers(spark, folder)).drop("body")
    return feed.truncate_feed(pages, page_size=20, max_pages=50)


@check("media_master_scan", f"""WITH {r.MASTER_SQL}
SELECT url, host, official, country, source, row_number() OVER (ORDER BY ord) AS place FROM media_master""")
def media_master_scan(spark, folder):
    from pressloom.operators.numbering import number_rows

    path = shared_folder(spark, "master")
    m = r.media_master(spark, folder)
    out = m.orderBy("ord").select(
        F.col("url").alias(files.MASTER_URL), F.col("official").alias(files.MASTER_OFFICIAL),
        F.col("country").alias(files.MASTER_COUNTRY), F.col("source").alias(files.MASTER_SOURCE),
    )
    sinks.write_csv(out, path)
    return number_rows(files.read_media_master(spark, path), "ord", name="place").drop("ord")


@check("url_list", """
SELECT url FROM pages UNION ALL SELECT 'https://extra.example.com/a' UNION ALL SELECT 'http://extra.example.org/b'""")
def url_list(spark, folder):
    path = shared_folder(spark, "urls")
    lines = table(spark, folder, "pages").select(
        F.explode(F.array(F.concat(F.lit("  "), "url", F.lit(" ")), F.lit("   "))).alias("value")
    )
    lines.write.text(path)
    return files.read_url_list(spark, [path], ["https://extra.example.com/a ", "http://extra.example.org/b", "no url"])


@check("scan_parts", "SELECT event_id, event_type, value FROM events")
def scan_parts(spark, folder):
    path = shared_folder(spark, "parts")
    e = table(spark, folder, "events")
    sinks.write_parts(e.filter(F.col("event_type") == "click").select("event_id", "event_type", "value"), path)
    sinks.write_parts(e.filter(F.col("event_type") != "click").select("event_id", "event_type", "value"), path)
    return feed.part_scan(spark, path)


CHARSETS_SQL = """CASE page_id % 7 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'utf-8' WHEN 2 THEN 'iso-8859-1'
                  WHEN 3 THEN 'utf-16' WHEN 5 THEN 'iso-8859-1' ELSE 'utf-8' END"""
META = '<meta charset="utf-8">'


@check("decode_pages", f"""
SELECT page_id, {CHARSETS_SQL} AS charset, md5(CASE WHEN page_id % 7 >= 5 THEN replace(html, '{META}', '') ELSE html END) AS digest FROM pages""")
def decode_pages(spark, folder):
    """The header's charset, the page's, and none at all: a text is Latin-1 then, anything else UTF-8."""
    kind = F.col("page_id") % 7
    html = F.when(kind >= 5, F.replace("html", F.lit(META), F.lit(""))).otherwise(F.col("html"))
    pages = table(spark, folder, "pages").select(
        "page_id",
        F.when(kind.isin(2, 5), F.encode(html, "ISO-8859-1")).when(kind == 3, F.encode(html, "UTF-16"))
        .otherwise(F.encode(html, "UTF-8")).alias("raw"),
        F.when(kind == 0, "text/html; charset=UTF-8").when(kind == 2, "text/html;charset = ISO-8859-1")
        .when(kind == 3, "text/html; charset=utf-16").when(kind == 4, "").when(kind == 5, "text/html").when(kind == 6, "application/xhtml+xml").alias("content_type"),
    )
    return files.decode_pages(pages).select("page_id", "charset", F.md5(F.col("html").cast("binary")).alias("digest"))


@check("write_parts", "SELECT doc_id, nullif(lang, 'de') AS lang, CASE WHEN lang = 'fr' THEN '' ELSE text END AS text FROM documents")
def write_parts(spark, folder):
    path = shared_folder(spark, "shards")
    docs = table(spark, folder, "documents").select(
        "doc_id", F.nullif(F.col("lang"), F.lit("de")).alias("lang"),
        F.when(F.col("lang") == "fr", "").otherwise(F.col("text")).alias("text"),
    )
    sinks.write_parts(docs, path)
    return spark.read.parquet(path)


@check("write_sheet", "SELECT doc_id AS no, lang AS country, text AS body FROM documents")
def write_sheet(spark, folder):
    path = shared_folder(spark, "sheet")
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("no"), F.col("lang").alias("country"), F.col("text").alias("body")
    )
    sinks.write_sheet(docs, path, "no")
    return sinks.read_sheet(spark, path, "no bigint, country string, body string")


@check("write_once", """
SELECT 'first' AS target, count(*) AS n FROM nation UNION ALL SELECT 'second', count(*) FROM region""")
def write_once(spark, folder):
    path = shared_folder(spark, "once")
    a = sinks.write_once(table(spark, folder, "nation"), path)
    b = sinks.write_once(table(spark, folder, "region"), path, stamp="1")
    read = lambda p, name: spark.read.parquet(p).select(F.lit(name).alias("target"))
    return read(a, "first").unionByName(read(b, "second")).groupBy("target").agg(F.count("*").alias("n"))


@check("write_json", "SELECT url, html AS content, CAST(NULL AS VARCHAR) AS published FROM pages")
def write_json(spark, folder):
    path = shared_folder(spark, "articles")
    pages = table(spark, folder, "pages")
    sinks.write_json(pages.select("url", F.col("html").alias("content"), F.lit(None).cast("string").alias("published")), path)
    return spark.read.schema("url string, content string, published string").json(path)


@check("step_log", """
SELECT 'r' || CAST(page_id % 2 AS VARCHAR) AS run_id, url, 'fetch' AS step, 'ok' AS status, '' AS reason,
       length(html) AS content_len, 200 AS http_status, CAST(NULL AS VARCHAR) AS via FROM pages
UNION ALL
SELECT 'r2', CAST(doc_id AS VARCHAR), 'label', 'skip', lang, NULL, NULL, source FROM documents""")
def step_log(spark, folder):
    path = shared_folder(spark, "steps")
    a = table(spark, folder, "pages").select(
        F.concat(F.lit("r"), (F.col("page_id") % 2).cast("string")).alias("run_id"), "url", F.lit("fetch").alias("step"),
        F.lit("ok").alias("status"), F.lit("").alias("reason"), F.length("html").alias("content_len"),
        F.lit(200).alias("http_status"), F.lit("2024-01-01T00:00:00").alias("ts"),
    )
    b = table(spark, folder, "documents").select(
        F.lit("r2").alias("run_id"), F.col("doc_id").cast("string").alias("url"), F.lit("label").alias("step"),
        F.lit("skip").alias("status"), F.col("lang").alias("reason"), F.col("source").alias("via"),
        F.lit(1).alias("not_logged"),
    )
    sinks.append_step_log(path, a, b)
    out = spark.read.parquet(path)
    return out.select("run_id", "url", "step", "status", "reason", "content_len", F.col("http_status").cast("int").alias("http_status"), "via")
