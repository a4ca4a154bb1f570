"""The article sheet: recovery of empty rows, final columns, the whole pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.base import is_filled, strip
from pressloom.functions.japan_time import jst_day_label
from pressloom.functions.lines import body_from_labels
from pressloom.functions.text import html_title, html_to_text
from pressloom.operators import feed as fd
from pressloom.operators.lookups import attach_translations, enrich_master, spread_left_join
from pressloom.operators.numbering import number_rows
from pressloom.session import staged

# The sheet's columns in order, with their headings.
SHEET = {
    "no": "NO.", "country": "国（地域）", "source": "反応主体", "official": "オフィシャル度", "date_label": "日付",
    "title": "タイトル（原語）", "title_ja": "タイトル（日本語）", "url": "URL", "body": "本文", "body_ja": "和訳",
    "keywords": "キーワード", "notes": "備考欄",
}


def final_sheet(df: DataFrame, headings: bool = False) -> DataFrame:
    """The 12 columns in order; absent ones and NULL cells are ''.  ``headings`` uses the printed names."""
    def cell(name: str) -> Column:
        if name not in df.columns:
            return F.lit("")
        return F.col(name) if name == "no" else F.coalesce(F.col(name).cast("string"), F.lit(""))

    return df.select(*[cell(n).alias(h if headings else n) for n, h in SHEET.items()])


def page_bodies(found: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Per URL what recovery needs: ``url, has_article, page_body, plain_body``.

    ``found(url, title, content)`` are extracted articles.  ``article_raw`` and
    ``plain_raw`` are the model's answers about the article and about the page's
    plain text; they are columns of ``found`` or of ``answers(url, ...)``.
    """
    both = found if answers is None else found.join(answers, "url", "left")
    has = F.col("content") != ""
    # one answer counts per page, so one column is parsed
    both = both.select("url", "title", "content", F.when(has, F.col("article_raw")).otherwise(F.col("plain_raw")).alias("_raw"))
    # extraction ends here: what follows is planned on plain columns and never repeats it
    both = staged(both, "articles")
    both = body_from_labels(both, "_raw", "title", "_body").withColumn("_body", strip("_body"))
    return both.select(
        "url", has.alias("has_article"),
        F.when(has, F.col("_body")).alias("page_body"), F.when(~has, F.col("_body")).alias("plain_body"),
    )


def plain_texts(pages: DataFrame) -> DataFrame:
    """Title and plain text of each page, the input of the model for pages without article."""
    return pages.select("url", html_title("html").alias("title"), html_to_text("html").alias("text"))


def recover_empty(rows: DataFrame, bodies: DataFrame, url: str = "permalink", body: str = "body") -> DataFrame:
    """Fill empty bodies from their pages and add ``article_source``.

    A page with an article gives its labelled body, even if that is empty; a page
    without one gives the labelled plain text, which still counts as feed.  Rows
    with a body take no part in the look-up.
    """
    empty = ~is_filled(body)
    joined = spread_left_join(rows, bodies.withColumnRenamed("url", "_url"), F.when(empty, F.col(url)), "_url")
    source = fd.article_source(body, "page_body", "plain_body")
    filled = F.when(empty, F.coalesce("page_body", "plain_body", F.lit(""))).otherwise(F.col(body))
    return joined.withColumns({"article_source": source, body: filled}).drop(
        "_url", "has_article", "page_body", "plain_body")


def news_sheet(
    feed: DataFrame, master: DataFrame, labels: DataFrame, bodies: DataFrame, translations: DataFrame,
    arrival: str = "arrival",
) -> DataFrame:
    """Feed rows to the numbered sheet.

    ``feed`` holds nested rows with an arrival number, ``labels(arrival, raw)`` the
    model's answers about the messages, ``bodies`` the result of
    :func:`page_bodies`, ``translations(text, translated)`` supplied translations.

    The publisher filter is an inner join written first, so Python stages and the
    wide joins see official publishers only.
    """
    unique = fd.dedup_feed(feed, arrival)
    rows = enrich_master(fd.flatten_feed(unique, arrival), master, how="inner")
    rows = rows.join(labels.select(F.col(arrival).alias("_arrival"), "raw"), F.col(arrival) == F.col("_arrival"), "left")
    rows = body_from_labels(rows, "raw", "WEB_TITLE_ES_MESSAGE_ID_3", "body").drop("raw", "_arrival", "message")
    rows = recover_empty(rows, bodies)
    rows = rows.withColumnRenamed("WEB_TITLE_ES_MESSAGE_ID_3", "title").withColumnRenamed("permalink", "url")
    rows = attach_translations(rows, translations, {"body": "body_ja", "title": "title_ja"})
    rows = rows.withColumns({
        "date_label": jst_day_label("snCreatedTime", is_text=True),
        "notes": fd.notes("article_source", "publisherName", "COUNTRY_5", "type", "snMsgId"),
    })
    return final_sheet(number_rows(rows, arrival, name="no"))
