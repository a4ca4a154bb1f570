"""Checks of page shredding, titles, dates and article extraction."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pressloom.functions import bodies, dates, titles
from pressloom.functions import cleanup as cl
from pressloom.functions import japan_time as jt
from pressloom.functions import nodes as nd
from pressloom.functions.rules import SITE_RULES, SiteRule
from pressloom.functions.sqltext import F as S
from pressloom.functions.sqltext import column
from pressloom.functions.urls import scrape_domain, url_path
from pressloom.operators import articles as ar
from pressloom.operators.rules import pick_site_rule
from pressloom.operators.shred import shred
from pressloom.plans import recipes as r
from pressloom.plans.checks_text import NL, POST_SQL, UNESCAPE_SQL, docs, pages
from pressloom.plans.registry import check
from pressloom.sources.tables import table

AS_OF = dt.datetime(2025, 12, 31)
WS = "' ' || chr(9) || chr(10) || chr(13)"
NODES = "nodes"


def shredded(df):
    return df.select("page_id", "url", shred("html").alias(NODES))


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def quiet_sql(html: str) -> str:
    """HTML without comments, doctype, scripts and styles."""
    return (
        f"regexp_replace(regexp_replace(regexp_replace({html}, '(?s)<!--.*?-->|<!DOCTYPE[^>]*>', '<!>', 'g'), "
        "'(?is)<script\\b.*?</script>', '<!>', 'g'), '(?is)<style\\b.*?</style>', '<!>', 'g')"
    )


def texts_sql(html: str) -> str:
    """List of trimmed, non-empty texts between tags."""
    return (
        f"list_filter(list_transform(string_split_regex({html}, '<[^>]*>'), lambda s: trim({UNESCAPE_SQL.format('s')}, {WS})), "
        "lambda s: s <> '')"
    )


ARTICLE_SQL = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"


def paragraphs_sql(html: str, min_chars: int = 25) -> str:
    """Texts of the ``<p>`` elements of some article HTML."""
    pieces = f"list_transform(string_split({html}, '<p>')[2:], lambda p: array_to_string({texts_sql("split_part(p, '</p>', 1)")}, ' '))"
    return f"list_filter({pieces}, lambda t: length(t) >= {min_chars})"


# ---- nodes -------------------------------------------------------------------------------------

@check("shred_pages", f"""
SELECT page_id, tag, count(*) AS n FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages) t GROUP BY page_id, tag""")
def shred_pages(spark, folder):
    n = shredded(pages(spark, folder)).select("page_id", F.explode(NODES).alias("n"))
    return n.filter(F.col("n.tag") != "#text").groupBy("page_id", F.col("n.tag").alias("tag")).agg(F.count("*").alias("n"))


@check("visible_text", f"SELECT page_id, array_to_string({texts_sql(quiet_sql('html'))}, ' ') AS text FROM pages")
def visible_text(spark, folder):
    return shredded(pages(spark, folder)).select("page_id", nd.visible_text(F.col(NODES), " ").alias("text"))


CHROMELESS_SQL = (
    f"regexp_replace(regexp_replace(regexp_replace({quiet_sql('html')}, '(?s)<nav>.*?</nav>', '<!>', 'g'), "
    "'(?s)<footer>.*?</footer>', '<!>', 'g'), '(?s)<div class=\"ad\">.*?</div>', '<!>', 'g')"
)


@check("prune_chrome", f"SELECT page_id, array_to_string({texts_sql(CHROMELESS_SQL)}, {NL}) AS text FROM pages")
def prune_chrome(spark, folder):
    clean = nd.prune(F.col(NODES), nd.prune_struct(["nav", "footer", ".ad", "script, style"]))
    df = shredded(pages(spark, folder)).withColumn("clean", clean)
    return df.select("page_id", nd.visible_text(F.col("clean"), "\n").alias("text"))


@check("pick_container", f"SELECT page_id, 1 AS rank, array_to_string({texts_sql(ARTICLE_SQL)}, {NL}) AS text FROM pages")
def pick_container(spark, folder):
    box = nd.select_first(F.col(NODES), nd.selector_array(["main, #content", "article", "body"]))
    out = shredded(pages(spark, folder)).withColumn("box", box)
    return out.select("page_id", "box.rank", nd.node_text(F.col(NODES), F.col("box"), "\n").alias("text"))


@check("collect_paragraphs", f"""
SELECT page_id, array_to_string({paragraphs_sql(ARTICLE_SQL)}, {NL}) AS text FROM pages""")
def collect_paragraphs(spark, folder):
    box = nd.select_first(F.col(NODES), nd.selector_array(["article"]))
    df = shredded(pages(spark, folder)).withColumn("box", box)
    ps = nd.paragraphs(F.col(NODES), F.col("box"), S.array("p"), 25, S.empty())
    return df.select("page_id", F.array_join(ps, "\n").alias("text"))


@check("largest_block", f"""
WITH b AS (SELECT page_id, array_to_string({texts_sql(ARTICLE_SQL)}, ' ') AS a,
                  array_to_string({texts_sql("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")}, ' ') AS d FROM pages),
m AS (SELECT page_id, CASE WHEN length(d) > length(a) THEN d ELSE a END AS t FROM b),
p AS (SELECT page_id, t, list_filter(list_transform(string_split_regex(t, '\\n+|\\s{{2,}}'), lambda x: trim(x, {WS})),
                                     lambda x: length(x) >= 25) AS parts FROM m)
SELECT page_id, CASE WHEN length(t) > 120 AND len(parts) >= 2 THEN array_to_string(parts, {NL}) END AS text FROM p""")
def largest_block(spark, folder):
    return shredded(pages(spark, folder)).select("page_id", nd.largest_block(F.col(NODES)).alias("text"))


RAW_TITLE_SQL = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"


@check("script_json_body", f"""
WITH b AS (SELECT page_id, trim({UNESCAPE_SQL.format(RAW_TITLE_SQL)}, {WS}) || {NL} || url || {NL} || url || {NL} || url AS t FROM pages)
SELECT page_id, CASE WHEN page_id % 2 = 0 AND length(t) >= 160 THEN t END AS text FROM b""")
def script_json_body(spark, folder):
    title = F.replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit('"'), F.lit("&quot;"))
    value = F.concat(F.lit("<p>"), title, F.lit(r"<\/p><p>"), "url", F.lit(r"<\/p><p>"), "url",
                     F.lit(r"<\/p><p>"), "url", F.lit(r"<\/p>"))
    script = F.concat(F.lit('<head><script>window.state={"id":1,"contentHtml":"'), value, F.lit(
        '","note":"' + "-" * 100 + '"}</script>'))
    html = F.when(F.col("page_id") % 2 == 0, F.replace("html", F.lit("<head>"), script)).otherwise(F.col("html"))
    return shredded(pages(spark, folder).withColumn("html", html)).select(
        "page_id", bodies.script_json_body(F.col(NODES)).alias("text"))


@check("meta_description", "SELECT page_id, CASE WHEN page_id % 5 < 4 THEN 'D ' || url END AS text FROM pages")
def meta_description(spark, folder):
    marks = ['<meta property="og:description" content=" D {}">', '<meta name="twitter:description" content="D {} ">',
             '<meta name="description" content="D {}">', '<script type="application/ld+json">[{{"description":"D {}"}}]</script>']
    html = F.col("html")
    for i, mark in enumerate(marks):
        a, b = mark.format("\x00").split("\x00")
        new = F.concat(F.lit("<head>" + a), "url", F.lit(b))
        html = F.when(F.col("page_id") % 5 == i, F.replace("html", F.lit("<head>"), new)).otherwise(html)
    return shredded(pages(spark, folder).withColumn("html", html)).select(
        "page_id", bodies.descriptions(F.col(NODES), twitter=True).alias("text"))


@check("text_after_anchor", f"""
WITH syn AS (SELECT page_id, CASE WHEN page_id % 2 = 0
    THEN '<h1>' || replace({ARTICLE_SQL}, '<h1>', '') END AS body FROM pages)
SELECT page_id, array_to_string({texts_sql('body')}, {NL}) AS text FROM syn""")
def text_after_anchor(spark, folder):
    """An audio frame before the headline; ``AUDIO INFO`` ends the text in front of the footer."""
    html = F.replace(F.replace("html", F.lit("<h1>"), F.lit('<iframe src="/audio/embed/1"></iframe><h1>')),
                     F.lit("</article>"), F.lit("<div>Audio Info</div><p>more</p></article>"))
    html = F.when(F.col("page_id") % 2 == 0, html).otherwise(F.col("html"))
    out = shredded(pages(spark, folder).withColumn("html", html))
    return out.select("page_id", F.array_join(bodies.audio_chunks(F.col(NODES)), "\n").alias("text"))


# ---- lines of stories ----------------------------------------------------------------------------

@check("cut_at_marker", f"""
SELECT doc_id, trim(CASE WHEN doc_id % 3 = 2 THEN text ELSE text || ' ' END, {WS}) AS text FROM documents""")
def cut_at_marker(spark, folder):
    k = F.col("doc_id") % 3
    t = F.when(k == 0, F.concat("text", F.lit("\nNews  INFO "), "text")).when(
        k == 1, F.concat("text", F.lit(" audio info: "), "text")).otherwise(F.col("text"))
    df = docs(spark, folder).select("doc_id", t.alias("t"))
    t = F.col("t")
    cut = F.when(k == 0, cl.before_marker(t, cl.NEWS_INFO)).otherwise(cl.before_marker(t, cl.AUDIO_INFO))
    return df.select("doc_id", cut.alias("text"))


DOC_LINES_SQL = f"list_filter(list_transform(string_split(text, {NL}), lambda x: trim(x, {WS})), lambda x: x <> '')"


def doc_lines():
    return cl.lines_of(F.col("text"))


@check("skip_after_byline", f"""
WITH l AS (SELECT doc_id, list_transform({DOC_LINES_SQL}, lambda x, i: CASE WHEN i % 5 IN (1, 2) THEN 'By ' || x ELSE x END) AS ls
           FROM documents)
SELECT doc_id, array_to_string(list_reduce(ls, lambda a, x: {{
    'skip': CASE WHEN a.skip > 0 THEN a.skip - 1 WHEN regexp_matches(x, '(?i)^(Story by|By)\\b') THEN 2 ELSE 0 END,
    'kept': CASE WHEN a.skip = 0 AND NOT regexp_matches(x, '(?i)^(Story by|By)\\b') THEN list_append(a.kept, x) ELSE a.kept END}},
  {{'skip': 0, 'kept': CAST([] AS VARCHAR[])}}).kept, {NL}) AS text FROM (
  SELECT doc_id, list_transform(ls, lambda x: x) AS ls FROM l) t""")
def skip_after_byline(spark, folder):
    marked = F.transform(doc_lines(), lambda x, i: F.when(i % 5 < 2, F.concat(F.lit("By "), x)).otherwise(x))
    df = docs(spark, folder).select("doc_id", marked.alias("marked"))
    return df.select("doc_id", F.array_join(cl.skip_after_byline(F.col("marked")), "\n").alias("text"))


@check("drop_lines", f"""
WITH l AS (SELECT doc_id, list_transform({DOC_LINES_SQL}, lambda x, i: CASE (i - 1) % 9 WHEN 1 THEN x || ' courtesy photo' WHEN 2 THEN 'FORT TOWN'
    WHEN 3 THEN x || ' 05.26.2025' WHEN 4 THEN 'Web Views: 3' WHEN 5 THEN 'read more' WHEN 6 THEN '(a) ' || x || ')' ELSE x END) AS ls FROM documents)
SELECT doc_id, array_to_string(list_filter(ls, lambda s: NOT (s = 'Title' OR regexp_matches(s, '(?i)\\bCourtesy Photo\\b')
   OR regexp_matches(s, '^(MANILA|[A-Z][A-Z ,\\-]+)$') OR regexp_matches(s, '\\b\\d{{2}}[.]\\d{{2}}[.]\\d{{4}}\\b')
   OR regexp_matches(s, '(?i)^(Subscribe\\b|✔|✗|Web Views:|Downloads:|PUBLIC DOMAIN)') OR s IN ('read more', 'View Image Page', '50')
   OR contains(s, 'works best with JavaScript enabled')
   OR (length(s) > 200 AND contains(s, '(') AND s LIKE '%)' AND NOT contains(s, ' — ')))), {NL}) AS text FROM l""")
def drop_lines(spark, folder):
    k = lambda i: i % 9
    marked = F.transform(doc_lines(), lambda x, i: F.when(k(i) == 1, F.concat(x, F.lit(" courtesy photo")))
                         .when(k(i) == 2, F.lit("FORT TOWN")).when(k(i) == 3, F.concat(x, F.lit(" 05.26.2025")))
                         .when(k(i) == 4, F.lit("Web Views: 3")).when(k(i) == 5, F.lit("read more"))
                         .when(k(i) == 6, F.concat(F.lit("(a) "), x, F.lit(")"))).otherwise(x))
    df = docs(spark, folder).select("doc_id", marked.alias("marked"))
    kept = S.filter(S.col("marked"), lambda s: ~cl.is_dropped_line(s, "Title"))
    return df.select("doc_id", column(S.array_join(kept, "\n")).alias("text"))


@check("start_at_dateline", f"""
WITH l AS (SELECT doc_id, list_transform({DOC_LINES_SQL}, lambda x, i: CASE WHEN doc_id % 2 = 0 AND i = 3 THEN 'MANILA, Philippines — ' || x
    WHEN i = 1 THEN regexp_replace(x, '[.!?]+$', '') ELSE x END) AS ls FROM documents),
p AS (SELECT doc_id, ls, list_position(list_transform(ls, lambda s: contains(s, ' — ') AND contains(split_part(s, ' — ', 1), ',')), true) AS a,
   list_position(list_transform(ls, lambda s: regexp_matches(s, '[.!?]$') OR (contains(s, '—') AND length(s) > 40) OR length(s) > 140), true) AS b FROM l)
SELECT doc_id, array_to_string(ls[coalesce(nullif(a, 0), nullif(b, 0), 1):], {NL}) AS text FROM p""")
def start_at_dateline(spark, folder):
    even = F.col("doc_id") % 2 == 0
    marked = F.transform(doc_lines(), lambda x, i: F.when(even & (i == 2), F.concat(F.lit("MANILA, Philippines — "), x))
                         .when(i == 0, F.regexp_replace(x, r"[.!?]+$", "")).otherwise(x))
    df = docs(spark, folder).select("doc_id", marked.alias("marked"))
    return df.select("doc_id", F.array_join(cl.start_at_dateline(F.col("marked")), "\n").alias("text"))


@check("caption_pattern", """
SELECT doc_id, nullif(regexp_extract(t, '(U\\.S\\..+?)(?:\\s*\\(U\\.S\\. .*?video by .+?\\)|U\\.S\\. .*?video by .+?\\))', 0), '') AS caption
FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'See U.S. ' || replace(text, chr(10), ' ')
             || ' (U.S. Army video by Jane Doe) and more' ELSE text END AS t FROM documents) d""")
def caption_pattern(spark, folder):
    t = F.when(F.col("doc_id") % 2 == 0, F.concat(
        F.lit("See U.S. "), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(" (U.S. Army video by Jane Doe) and more"))
    ).otherwise(F.col("text"))
    df = docs(spark, folder).select("doc_id", t.alias("t"))
    return df.select("doc_id", cl.caption_pattern(F.col("t")).alias("caption"))


# ---- titles ---------------------------------------------------------------------------------------

DOMAIN_SQL = "replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'www.', '')"
TOKENS_SQL = f"""tokens AS (
  SELECT page_id, url, html, dom, list_sort(list_distinct(list_filter([dom, replace(dom, '.', ' '), replace(dom, '-', ' '),
    split_part(dom, '.', 1), replace(split_part(dom, '.', 1), '-', ' '), split_part(dom, '.', 1) || '.com',
    split_part(dom, '.', 1) || '.net', split_part(dom, '.', 1) || '.org'], lambda t: t <> ''))) AS toks
  FROM (SELECT page_id, url, html, lower({DOMAIN_SQL}) AS dom FROM src) q)"""


def strip_brand_sql(title: str) -> str:
    parts = f"string_split_regex(trim({title}, {WS}), '\\s*(?:\\||–|—|•|·|-)\\s*')"
    brand = (
        "(trim(p) <> '' AND (len(list_filter(toks, lambda k: contains(k, lower(trim(p))) OR contains(lower(trim(p)), k))) > 0 "
        "OR regexp_matches(lower(trim(p)), '^(news|world|opinion|politics|military(?:\\s*news)?|ニュース|軍事ニュース|ゲルマンニュース)$')))"
    )
    keep = f"list_max(list_transform({parts}, lambda p, i: CASE WHEN i = 1 OR NOT {brand} THEN i ELSE 0 END))"
    joined = f"trim(array_to_string(({parts})[1:{keep}], ' - '), {WS})"
    return f"regexp_replace(regexp_replace({joined}, '\\s*(?:\\||–|—|•|·|-)\\s*$', ''), '\\s{{2,}}', ' ', 'g')"


@check("brand_tokens", f"WITH src AS (SELECT * FROM pages), {TOKENS_SQL} SELECT page_id, array_to_string(toks, '|') AS tokens FROM tokens")
def brand_tokens(spark, folder):
    toks = titles.brand_tokens(F.col("domain"), F.col(NODES))
    return shredded(pages(spark, folder)).withColumn("domain", scrape_domain("url")).select("page_id", F.array_join(F.array_sort(toks), "|").alias("tokens"))


H1_SQL = f"array_to_string({texts_sql("regexp_extract(html, '(?s)<article>.*?<h1>(.*?)</h1>', 1)")}, ' ')"
DECLARED_SQL = f"array_to_string({texts_sql(RAW_TITLE_SQL)}, ' ')"
TITLE_SQL = f"""titled AS (
  SELECT *, CASE WHEN length(h1) >= 6 AND NOT list_contains(toks, lower(h1)) THEN h1 ELSE {strip_brand_sql('declared')} END AS title
  FROM (SELECT *, {H1_SQL} AS h1, {DECLARED_SQL} AS declared FROM tokens) h)"""


@check("page_title", f"""
WITH src AS (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN replace(replace(html, '<h1>', '<h3>'), '</title>', ' | ' || {DOMAIN_SQL} || '</title>')
             ELSE html END AS html FROM pages), {TOKENS_SQL}, {TITLE_SQL} SELECT page_id, title FROM titled""")
def page_title(spark, folder):
    new = F.replace(F.replace("html", F.lit("<h1>"), F.lit("<h3>")), F.lit("</title>"),
                    F.concat(F.lit(" | "), scrape_domain("url"), F.lit("</title>")))
    html = F.when(F.col("page_id") % 3 == 0, new).otherwise(F.col("html"))
    df = shredded(pages(spark, folder).withColumn("html", html)).withColumn("domain", scrape_domain("url"))
    toks = titles.brand_tokens(F.col("domain"), F.col(NODES))
    return df.withColumn("toks", toks).select("page_id", titles.page_title(F.col(NODES), F.col("toks")).alias("title"))


LONG_TITLE_SQL = f"""{DECLARED_SQL} || CASE page_id % 4 WHEN 0 THEN ' - ' || {DOMAIN_SQL} || ' | News' WHEN 1 THEN ' · World'
   WHEN 2 THEN ' — F-35 — ' || split_part({DOMAIN_SQL}, '.', 1) ELSE '' END"""


@check("strip_brand", f"""
WITH src AS (SELECT * FROM pages), {TOKENS_SQL}, t AS (SELECT *, {LONG_TITLE_SQL} AS long_title FROM tokens)
SELECT page_id, {strip_brand_sql('long_title')} AS title FROM t""")
def strip_brand(spark, folder):
    k, dom = F.col("page_id") % 4, scrape_domain("url")
    tail = (F.when(k == 0, F.concat(F.lit(" - "), dom, F.lit(" | News"))).when(k == 1, F.lit(" · World"))
            .when(k == 2, F.concat(F.lit(" — F-35 — "), F.get(F.split(dom, r"\."), F.lit(0)))).otherwise(F.lit("")))
    df = shredded(pages(spark, folder)).withColumn("domain", dom)
    df = df.withColumns({"toks": titles.brand_tokens(F.col("domain"), F.col(NODES)),
                         "long": F.concat(nd.first_tag_text(F.col(NODES), "title"), tail)})
    return df.select("page_id", titles.strip_brand(F.col("long"), F.col("toks")).alias("title"))


# One page in eleven per title source: site, what is changed, and the SQL of the title that the source then gives.
H4 = [("<h1>", "<h4>"), ("</h1>", "</h4>")]
HEAD = "<head>"
TITLE_CASES = [
    ("rfi.fr", [(HEAD, '<head><meta property="og:title" content="OG headline #">')], "'OG headline ' || page_id"),
    ("rfi.fr", [*H4, (HEAD, '<head><meta name="twitter:title" content="TW headline #">')], "'TW headline ' || page_id"),
    ("ct.moreover.com", [(HEAD, '<head><meta name="title" content="MT headline #">')], "'MT headline ' || page_id"),
    ("ct.moreover.com", [], "h1"),
    ("idahostatesman.com", H4, "declared"),
    ("cankaoxiaoxi.com", [("<article>", '<article><p class="subject">The longest # of the lines that look like a heading here, longer than any headline of the page, by far and without a doubt</p>')],
     "'The longest ' || page_id || ' of the lines that look like a heading here, longer than any headline of the page, by far and without a doubt'"),
    ("shobserver.com", [("<body>", "<body><h1>Outside #</h1>")], "h1"),
    ("shobserver.com", [*H4, ("<article>", '<article><p class="x news-title y">Classed headline #</p>')], "'Classed headline ' || page_id"),
    ("bj.crntt.com", [*H4, ("<title>", "<i>"), ("</title>", "</i>"), ("<article>", "<article><h2>H#</h2>")], None),
    ("www.crntt.com", [*H4, ("<title>", "<i>"), ("</title>", "</i>"), (HEAD, "<head><div>〖 大 中 小 〗</div><div>Line of #</div>")], None),
    ("elsewhere.example", [], "h1"),
]
# the late sources are not stripped of brands
LATE_SQL = {8: "'H' || page_id", 9: "'Line of ' || page_id"}


@check("site_title", f"""
WITH src AS (SELECT page_id, 'https://' || CASE page_id % 11 {' '.join(f"WHEN {i} THEN '{s}'" for i, (s, *_) in enumerate(TITLE_CASES))} END || '/x' AS url,
                    html FROM pages),
{TOKENS_SQL}, h AS (SELECT *, {H1_SQL} AS h1, {DECLARED_SQL} AS declared FROM tokens),
s AS (SELECT *, CASE page_id % 11 {' '.join(f"WHEN {i} THEN {t}" for i, (_, _, t) in enumerate(TITLE_CASES) if t)} ELSE '' END AS t FROM h)
SELECT page_id, CASE page_id % 11 {' '.join(f"WHEN {i} THEN {t}" for i, t in LATE_SQL.items())} ELSE {strip_brand_sql('t')} END AS title FROM s""")
def site_title(spark, folder):
    """Every title source decides one page in eleven; ``#`` stands for the page's number."""
    pid = F.col("page_id")
    html, domain = F.col("html"), F.lit("")
    for i, (site, changes, _) in enumerate(TITLE_CASES):
        new = F.col("html")
        for old, put in changes:
            new = F.replace(new, F.lit(old), F.replace(F.lit(put), F.lit("#"), pid.cast("string")))
        html = F.when(pid % len(TITLE_CASES) == i, new).otherwise(html)
        domain = F.when(pid % len(TITLE_CASES) == i, F.lit(site)).otherwise(domain)
    df = shredded(pages(spark, folder).withColumn("html", html)).withColumn("domain", F.replace(domain, F.lit("www."), F.lit("")))
    df = df.withColumn("toks", titles.brand_tokens(F.col("domain"), F.col(NODES)))
    return df.select("page_id", titles.site_title(F.col(NODES), F.col("domain"), F.col("toks")).alias("title"))


@check("title_prefix", f"""
SELECT page_id, CASE WHEN page_id % 5 < 4 THEN ltrim({DECLARED_SQL}, ' -|–—') ELSE {DECLARED_SQL} END AS title FROM pages""")
def title_prefix(spark, folder):
    k = F.col("page_id") % 5
    title = F.col("declared")
    for i, p in enumerate(titles.LISTING_PREFIXES):
        title = F.when(k == i, F.concat(F.lit(p + " – "), "declared")).otherwise(title)
    df = shredded(pages(spark, folder)).withColumn("declared", nd.first_tag_text(F.col(NODES), "title"))
    return df.withColumn("title", title).select("page_id", titles.trim_prefix(F.col("title")).alias("title"))


# ---- dates -----------------------------------------------------------------------------------------

STYLES = [
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%S", "Z"), ("yyyy/MM/dd HH:mm", "%Y-%m-%d %H:%M", ""),
    ("MMMM d, yyyy", "%Y-%m-%d", ""), ("d MMM yyyy HH:mm", "%Y-%m-%d %H:%M", ""), ("yyyy年M月d日", "%Y-%m-%d", ""),
    ("MM-dd-yyyy HH:mm", "%Y-%m-%d %H:%M", ""), ("'on' yyyy.M.d 'at night'", "%Y-%m-%d", ""),
    ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "%Y-%m-%d %H:%M:%S", ""), ("'no date' HH", None, ""),
    ("yyyy-MM-dd'T'HH:mm:ss'+09:00'", "%Y-%m-%dT%H:%M:%S", "-9"),
]


@check("parse_dates", "SELECT event_id, CASE event_id % 10 " + " ".join(
    f"WHEN {i} THEN strftime(date_trunc('{'second' if '%S' in (p or '') else 'minute' if '%M' in (p or '') else 'day'}', ts)"
    f"{' - INTERVAL 9 HOUR' if z == '-9' else ''}, '%Y-%m-%d %H:%M:%S')" for i, (_, p, z) in enumerate(STYLES) if p
) + " END AS at FROM events")
def parse_dates(spark, folder):
    raw = F.lit(None).cast("string")
    for i, (fmt, *_) in enumerate(STYLES):
        raw = F.when(F.col("event_id") % 10 == i, F.date_format("ts", fmt)).otherwise(raw)
    df = table(spark, folder, "events").select("event_id", raw.alias("raw"))
    return df.select("event_id", stamp(dates.parse_date(F.col("raw"))).alias("at"))


def dated(spark, folder):
    return shredded(r.dated_pages(spark, folder))


def date_sql(*kinds: int) -> str:
    return f"SELECT page_id, CASE WHEN page_id % 6 IN {kinds + (-1,)} THEN {r.DATE_OF_SQL} END AS published FROM pages"


@check("date_from_meta", date_sql(1, 2))
def date_from_meta(spark, folder):
    return dated(spark, folder).select("page_id", stamp(dates.date_from_meta(F.col(NODES))).alias("published"))


@check("date_from_next_data", date_sql(4))
def date_from_next_data(spark, folder):
    return dated(spark, folder).select("page_id", stamp(dates.date_from_next_data(F.col(NODES))).alias("published"))


@check("date_from_jsonld", date_sql(3))
def date_from_jsonld(spark, folder):
    return dated(spark, folder).select("page_id", stamp(dates.date_from_jsonld(F.col(NODES))).alias("published"))


@check("date_from_text", date_sql(5))
def date_from_text(spark, folder):
    df = dated(spark, folder).withColumn("text", nd.visible_text(F.col(NODES), " "))
    return df.select("page_id", stamp(dates.date_from_text(F.col("text"))).alias("published"))


@check("published_date", date_sql(1, 2, 3, 4, 5))
def published_date(spark, folder):
    df = dated(spark, folder).withColumn("text", nd.visible_text(F.col(NODES), " "))
    return df.select("page_id", stamp(dates.recovered_date(F.col(NODES), F.col("text"), AS_OF)).alias("published"))


@check("latest_text_date", """
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '2025-03-04 00:00:00' WHEN 1 THEN '2025-11-09 10:30:00' END AS latest FROM documents""")
def latest_text_date(spark, folder):
    k = F.col("doc_id") % 3
    t = F.when(k == 0, F.concat(F.lit("2025年3月4日 "), "text", F.lit(" March 1, 2025 and 2026-01-05"))).when(
        k == 1, F.concat("text", F.lit(" 2025/11/09 10:30 ("), F.lit("2024.1.2)"))).otherwise(F.col("text"))
    df = docs(spark, folder).select("doc_id", t.alias("t"))
    return df.select("doc_id", stamp(dates.latest_text_date(F.col("t"), AS_OF)).alias("latest"))


DATE_SITES = [
    ("https://www.dvidshub.net/image/1", "<p>Date Posted: 05.26.2025 13:10</p>", "2025-05-26 13:10:00"),
    ("https://bj.crntt.com/doc/1", None, "2025-06-02 08:09:10"),
    ("https://www.vietnam.vn/a", "<p>25/07/2025</p>", "2025-07-25 00:00:00"),
    ("https://ct.moreover.com/?a=1", "<p>seen 3 Aug 2025 10:11</p>", "2025-08-03 10:11:00"),
    ("https://cankaoxiaoxi.com/#/detail/1/2025-09-04 15:55", "", "2025-09-04 15:55:00"),
    ("https://www.france24.com/x", '<p data-iso-date="2025-10-05T06:07:08Z">x</p>', "2025-10-05 06:07:08"),
    ("https://other.example.com/x", "", "2025-11-12 13:14:15"),
]


@check("date_fallbacks", "SELECT page_id, CASE page_id % 7 " + " ".join(
    f"WHEN {i} THEN '{d}'" for i, (_, _, d) in enumerate(DATE_SITES)) + " END AS published FROM pages")
def date_fallbacks(spark, folder):
    pid = F.col("page_id")
    url, html = F.lit(""), F.col("html")
    for i, (u, mark, _) in enumerate(DATE_SITES):
        here = pid % 7 == i
        url = F.when(here, F.lit(u)).otherwise(url)
        new = (F.replace("html", F.lit("<head>"), F.lit("<p>2025-06-02 08:09:10 CRNTT</p><head>")) if mark is None
               else F.replace("html", F.lit("<article>"), F.lit("<article>" + mark)))
        html = F.when(here, new).otherwise(html)
    header = F.when(pid % 7 == 6, F.lit("Wed, 12 Nov 2025 13:14:15 GMT"))
    df = pages(spark, folder).select("page_id", url.alias("url"), html.alias("html"), header.alias("last_modified"))
    df = df.withColumns({"domain": scrape_domain("url"), "path": url_path("url")})
    df = pick_site_rule(df, SITE_RULES).withColumn(NODES, shred("html"))
    df = df.withColumn("text", nd.visible_text(F.col(NODES), " "))
    found = F.coalesce(bodies.site_date(F.col(NODES), F.col("rule")), bodies.late_date(
        F.col(NODES), F.col("text"), F.col("rule"), F.col("url"), F.col("last_modified")))
    return df.select("page_id", stamp(found).alias("published"))


@check("jst_epoch_ms", """
SELECT event_id, CAST(epoch_ms(date_trunc(CASE event_id % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'minute' ELSE 'second' END, ts)
       - INTERVAL 9 HOUR) AS BIGINT) AS ms FROM events""")
def jst_epoch_ms(spark, folder):
    k = F.col("event_id") % 3
    text = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd")).when(
        k == 1, F.date_format("ts", "yyyy-MM-dd HH:mm")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, folder, "events").select("event_id", jt.jst_epoch_ms(text).alias("ms"))


@check("jst_day_label", """
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN CAST(month(ts + INTERVAL 9 HOUR) AS VARCHAR) || '月'
       || CAST(day(ts + INTERVAL 9 HOUR) AS VARCHAR) || '日' END AS label FROM events""")
def jst_day_label(spark, folder):
    text = F.when(F.col("event_id") % 9 == 0, F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, folder, "events").select("event_id", jt.jst_day_label(text, is_text=True).alias("label"))


# ---- articles ----------------------------------------------------------------------------------------

TEST_RULES = [
    SiteRule("farm", "spam-farm.example.org", "text", containers=("article",), no_fallback=True),
    SiteRule("pills", "cheap-pills.example.com", "blocks", path_prefix="/en/", containers=("article",), min_chars=25, priority=60),
    SiteRule("pills:any", "cheap-pills.example.com", "video", priority=40),
    SiteRule("pills:none", "cheap-pills.example.com", "text", path_regex="^/nowhere/", containers=("article",), priority=90),
]
RULE_SQL = f"""CASE WHEN {DOMAIN_SQL} = 'spam-farm.example.org' THEN 'farm' WHEN {DOMAIN_SQL} = 'cheap-pills.example.com'
  THEN CASE WHEN regexp_matches(url, '^[a-z]+://[^/]*/en/') THEN 'pills' ELSE 'pills:any' END END"""


@check("pick_site_rule", f"SELECT page_id, {RULE_SQL} AS rule FROM pages")
def pick_site_rule_check(spark, folder):
    df = pages(spark, folder).select("page_id", scrape_domain("url").alias("domain"), url_path("url").alias("path"))
    return pick_site_rule(df, TEST_RULES).select("page_id", F.col("rule.name").alias("rule"))


PARTS_SQL = f"""parts AS (
  SELECT page_id, url, html, page_id % 6 <> 0 AS has_date, {RULE_SQL} AS rule,
         array_to_string({texts_sql(ARTICLE_SQL)}, {NL}) AS whole_text,
         array_to_string({paragraphs_sql(ARTICLE_SQL)}, {NL}) AS ps FROM dated),
bodies AS (
  SELECT *, nullif(CASE rule WHEN 'farm' THEN whole_text WHEN 'pills' THEN ps END, '') AS own,
         CASE WHEN length(ps) >= 200 AND has_date THEN ps END AS generic FROM parts),
extracted AS (
  SELECT page_id, url, html, rule, has_date, CASE WHEN own IS NOT NULL THEN own WHEN rule = 'farm' THEN NULL ELSE generic END AS content,
         generic FROM bodies)"""


@check("accept_fallback", f"WITH {r.DATED_SQL}, {PARTS_SQL} SELECT page_id, generic AS content FROM bodies")
def accept_fallback(spark, folder):
    df = dated(spark, folder).withColumn("text", nd.visible_text(F.col(NODES), " "))
    df = df.withColumn("d", dates.recovered_date(F.col(NODES), F.col("text"), AS_OF))
    return df.select("page_id", ar.accept_fallback(bodies.generic_body(F.col(NODES)), F.col("d")).alias("content"))


@check("extract_articles", f"WITH {r.DATED_SQL}, {PARTS_SQL} SELECT page_id, rule, content FROM extracted")
def extract_articles(spark, folder):
    out = ar.extract_articles(r.dated_pages(spark, folder), AS_OF, TEST_RULES)
    return out.select("page_id", "rule", "content")


ARTICLES_SQL = f"""{r.DATED_SQL}, {PARTS_SQL}, src AS (SELECT page_id, url, html FROM dated), {TOKENS_SQL}, {TITLE_SQL},
final AS (
  SELECT e.page_id, e.url, e.html, CASE WHEN f IS NULL THEN '' WHEN title <> '' AND starts_with(f, title)
         THEN ltrim(substr(f, length(title) + 1), ' :' || {NL}) ELSE f END AS content, title, has_date, rule
  FROM (SELECT page_id, url, html, has_date, rule, replace(replace({POST_SQL.replace('(t, ', '(content, ')}, '\\n', ''), {NL}, '') AS f FROM extracted) e
  JOIN (SELECT page_id, {strip_brand_sql('title')} AS title FROM titled) t USING (page_id))"""


@check("articles", f"""WITH {ARTICLES_SQL}
SELECT page_id, url, rule, title, content, CASE WHEN content <> '' THEN 'ok' ELSE 'empty' END AS status,
       CASE WHEN rule IS NOT NULL OR content <> '' THEN {r.DATE_OF_SQL} END AS published FROM final""")
def articles(spark, folder):
    out = ar.articles(r.dated_pages(spark, folder), AS_OF, TEST_RULES)
    return out.select("page_id", "url", "rule", "title", "content", "status", stamp("published").alias("published"))


# One page in eighteen per site rule: the rule, a URL of its, what is changed in the page (``#`` stands for its
# number), and the SQL of the body that the rule's kind then finds.  Every article ends with MORE.
MORE = "One more paragraph stands at the end of every article, so that none of them is too short to be taken for a body of its own " \
       "kind, whatever its site asks for at the least, and that is more than two hundred characters."
MORE_SQL = f"({ARTICLE_SQL} || '<p>{MORE}</p>')"
OPEN, SHUT = "<article>", "</article>"
STORY = "MANILA, Philippines — A story of the wire service that goes on until it holds more than the one hundred and twenty " \
        "characters that a story needs, and ends."
FILM = "U.S. Marines train with allies at the range (U.S. Marine Corps video by Sgt. Jane Doe)"
PHOTO = "Photo of page # shows allied ships during an exercise at sea."
PARAGRAPHS, TEXTS, PAGE = "array_to_string(ps, chr(10))", "array_to_string(ts, chr(10))", "array_to_string(ws, chr(10))"
LINES_HEAD = [(HEAD, "<head><div>Line of title</div><div>2025-06-02 CRNTT</div>")]


def _boxed(start: str, end: str) -> list[tuple[str, str]]:
    return [(OPEN, start), (SHUT, end)]


KIND_CASES = [
    ("shobserver", "https://www.shobserver.com/a/#", [(OPEN, OPEN + '<div class="share">Share this with all of your friends</div>')], PARAGRAPHS),
    ("shobserver:detail", "https://www.shobserver.com/staticsg/res/html/web/newsDetail.html?id=#",
     _boxed('<div id="newsDetail"><div class="newsContent">', "</div><p>This is no part of the body of the page</p></div>"), PARAGRAPHS),
    ("defensenews", "https://www.defensenews.com/a/#", _boxed('<div class="article-body"><div class="tags">Some tags</div>', "</div>"), TEXTS),
    ("dvids:image", "https://www.dvidshub.net/image/#", _boxed('<div class="caption">', "</div>"), "array_to_string(ts, ' ')"),
    ("dvids:video", "https://www.dvidshub.net/video/#", [(OPEN, f"{OPEN}<p>{FILM}</p>")], f"'{FILM}'"),
    ("dvids:audio", "https://www.dvidshub.net/audio/#",
     [("<h1>", '<iframe src="/audio/embed/1"></iframe><h1>'), (SHUT, f"<div>Audio Info</div><p>more</p>{SHUT}")], TEXTS),
    ("dvids:news", "https://www.dvidshub.net/news/#", [("</h1>", f"</h1><p>{STORY}</p><p>News Info</p>")], f"'{STORY}'"),
    ("dvids:generic", "https://www.dvidshub.net/feature/#", _boxed('<div class="page-content">', "</div>"), TEXTS),
    ("defense:igphoto", "https://www.defense.gov/Multimedia/Photos/igphoto/#",
     [(OPEN, f"{OPEN}<figure><figcaption><p>{PHOTO} Download: full size</p></figcaption></figure>")], f"replace('{PHOTO}', '#', page_id::VARCHAR)"),
    ("defense:generic", "https://www.defense.gov/News/#", _boxed("<b>", "</b>"), PAGE),
    ("crntt", "https://www.crntt.com/doc/#", LINES_HEAD, PAGE),
    ("crntt:bj", "https://bj.crntt.com/doc/#", LINES_HEAD, PAGE),
    ("vietnam.vn", "https://www.vietnam.vn/#", [], "regexp_replace(array_to_string(ts[2:], chr(10)), '\\s{2,}', ' ', 'g')"),
    ("rfi", "https://www.rfi.fr/#", _boxed('<article><div class="article__content">', f"</div><p>tail</p>{SHUT}"), TEXTS),
    ("france24", "https://www.france24.com/#", _boxed('<article><div class="t-content__body">', f"</div><p>This is no part of the body</p>{SHUT}"), PARAGRAPHS),
    ("moreover:ct", "https://ct.moreover.com/?a=#", [(OPEN, f'{OPEN}<div class="meta">By somebody at some place on some day</div>')], PARAGRAPHS),
    ("idahostatesman", "https://www.idahostatesman.com/#", _boxed('<article><div class="article-body">', f"</div><p>Read more of the same on the next pages</p>{SHUT}"), PARAGRAPHS),
    ("cankaoxiaoxi", "https://www.cankaoxiaoxi.com/#", _boxed('<article><div class="detail-content">', f'<div class="comment-box">Some comment by some reader of this</div></div>{SHUT}'), PARAGRAPHS),
]


@check("article_kinds", f"""
WITH a AS (SELECT page_id, {paragraphs_sql(MORE_SQL)} AS ps, {texts_sql(MORE_SQL)} AS ts,
                  {texts_sql(quiet_sql(f"replace(html, '{SHUT}', '<p>{MORE}</p>{SHUT}')"))} AS ws FROM pages)
SELECT page_id, CASE page_id % 18 {' '.join(f"WHEN {i} THEN '{n}'" for i, (n, *_) in enumerate(KIND_CASES))} END AS rule,
       CASE page_id % 18 {' '.join(f"WHEN {i} THEN {t}" for i, (*_, t) in enumerate(KIND_CASES))} END AS content FROM a""")
def article_kinds(spark, folder):
    """The registered rules, each on pages of the shape that its site has: all kinds of body."""
    pid, number = F.col("page_id"), F.col("page_id").cast("string")
    url, html = F.lit(""), F.lit("")
    whole = F.replace(F.col("html"), F.lit(SHUT), F.lit(f"<p>{MORE}</p>{SHUT}"))
    for i, (_, address, changes, _) in enumerate(KIND_CASES):
        new = whole
        for old, put in changes:
            new = F.replace(new, F.lit(old), F.replace(F.lit(put), F.lit("#"), number))
        url = F.when(pid % len(KIND_CASES) == i, F.replace(F.lit(address), F.lit("#"), number)).otherwise(url)
        html = F.when(pid % len(KIND_CASES) == i, new).otherwise(html)
    out = ar.extract_articles(pages(spark, folder).select("page_id", url.alias("url"), html.alias("html")), AS_OF)
    return out.select("page_id", "rule", "content")


@check("custom_rule", f"""
SELECT page_id, CASE WHEN {DOMAIN_SQL} = 'spam-farm.example.org' THEN 'mine' END AS rule,
       CASE WHEN {DOMAIN_SQL} = 'spam-farm.example.org' THEN nullif(array_to_string(list_filter([{H1_SQL}], lambda x: length(x) >= 6), {NL}), '') END
       AS content FROM pages""")
def custom_rule(spark, folder):
    """A rule a user adds: headlines of one domain as its body."""
    mine = SiteRule("mine", "spam-farm.example.org", containers=("article",), tags=("h1",), min_chars=6, priority=99)
    df = pages(spark, folder).withColumns({"domain": scrape_domain("url"), "path": url_path("url")})
    df = pick_site_rule(df, [*SITE_RULES, mine]).withColumn(NODES, shred("html"))
    df = df.withColumn("content", bodies.rule_body(F.col(NODES), F.col("rule"), ["blocks"]))
    return df.select("page_id", F.col("rule.name").alias("rule"), "content")


@check("best_rendering", """
SELECT url, CASE WHEN page_id % 3 = 0 THEN html ELSE html || 'x' END AS content,
       CASE WHEN page_id % 4 = 0 THEN NULL WHEN page_id % 4 = 1 THEN '2025-01-02 00:00:00' ELSE '2025-01-01 00:00:00' END AS published FROM pages""")
def best_rendering(spark, folder):
    pid = F.col("page_id")
    when = lambda c, d: F.when(c, F.lit(dt.datetime(2025, 1, d)).cast("timestamp"))
    a = pages(spark, folder).select("url", F.lit(0).alias("attempt"), F.col("html").alias("content"),
                                    when(pid % 4 >= 2, 1).alias("published"))
    b = pages(spark, folder).select(
        "url", F.lit(1).alias("attempt"), F.when(pid % 3 != 0, F.concat("html", F.lit("x"))).alias("content"),
        when(pid % 4 >= 1, 2).alias("published"))
    return ar.best_rendering(a.unionByName(b)).select("url", "content", stamp("published").alias("published"))
