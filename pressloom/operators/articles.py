"""Pages to articles: one projection per page after shredding, no shuffle.

Stages are columns on the page's own row: domain and rule, nodes, title, date,
body.  Python runs once per page (the shredder); all else is expressions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import bodies, dates
from pressloom.functions.nodes import visible_text
from pressloom.functions.rules import SITE_RULES, SiteRule
from pressloom.functions.text import MIN_ARTICLE_CHARS, flatten_body, postprocess_body
from pressloom.functions.titles import brand_tokens, site_title
from pressloom.functions.urls import scrape_domain, url_path
from pressloom.operators.rules import pick_site_rule
from pressloom.operators.shred import shred

# Status of a record, and the title of a page that could not be read.
OK, EMPTY, NO_PAGE = "ok", "empty", "no_page"
FETCH_ERROR = "FETCH ERROR"


def accept_fallback(body: Column, published: Column, limit: int = MIN_ARTICLE_CHARS) -> Column:
    """A generic body counts only when it is long enough and the page has a date."""
    return F.when((F.length(body) >= limit) & published.isNotNull(), body)


def shredded(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with their node array in place of the HTML text."""
    return pages.withColumn("nodes", shred(html)).drop(html)


def extract_articles(
    pages: DataFrame, as_of: dt.datetime, rules: Iterable[SiteRule] = tuple(SITE_RULES)
) -> DataFrame:
    """``pages(url, html, ...)`` plus ``rule``, ``title``, ``published`` and the raw ``content``.

    The rule's body wins if it is long enough; a short one still beats the generic
    body, which is used only for pages with a date and never for ``no_fallback`` rules.
    """
    if "last_modified" not in pages.columns:
        pages = pages.withColumn("last_modified", F.lit(None).cast("string"))
    kept = [c for c in pages.columns if c not in ("html", "last_modified")]
    rules = list(rules)
    kinds = sorted({r.kind for r in rules})
    nodes, rule, text = F.col("nodes"), F.col("rule"), F.col("text")
    keyed = pages.withColumns({
        "domain": scrape_domain("url"), "path": url_path("url"), "had_page": F.length("html") > 0})
    step = shredded(pick_site_rule(keyed, rules)).withColumn("text", visible_text(nodes, " "))
    step = step.withColumns({
        "tokens": brand_tokens(F.col("domain"), nodes),
        "dated": dates.published_date(nodes, text, as_of),
        "own_body": bodies.rule_body(nodes, rule, kinds),
        "own_date": bodies.site_date(nodes, rule),
    })
    step = step.withColumns({
        "recovered": F.coalesce("dated", dates.recovered_only(nodes, text)),
        "needs_more": F.coalesce(F.length("own_body") < MIN_ARTICLE_CHARS, F.lit(True))
        & ~F.coalesce(rule.getField("no_fallback"), F.lit(False)),
    })
    step = step.withColumns({
        "title": site_title(nodes, F.col("domain"), F.col("tokens")),
        "fallback": F.when(F.col("needs_more"), accept_fallback(bodies.generic_body(nodes), F.col("recovered"))),
    })
    published = F.coalesce(
        F.when(rule.isNotNull(), F.coalesce("own_date", "dated")),
        F.when(F.col("fallback").isNotNull(), F.col("recovered")),
        bodies.late_date(nodes, text, rule, F.col("url"), F.col("last_modified")),
    )
    had_page = F.coalesce("had_page", F.lit(False))
    return step.select(
        *kept,
        rule.getField("name").alias("rule"),
        F.when(had_page, F.col("title")).otherwise(F.lit(FETCH_ERROR)).alias("title"),
        published.alias("published"),
        F.coalesce("own_body", "fallback").alias("content"),
        F.when(had_page, F.lit(OK)).otherwise(F.lit(NO_PAGE)).alias("status"),
    )


def articles(
    pages: DataFrame, as_of: dt.datetime, rules: Iterable[SiteRule] = tuple(SITE_RULES)
) -> DataFrame:
    """The whole job: exactly one clean record per page.

    A date after ``as_of`` is not believed; it is given, so that reruns agree.

    ``status`` is ``ok``, ``empty`` (no body found) or ``no_page`` (no HTML given).
    """
    raw = extract_articles(pages, as_of, rules)
    body = F.coalesce(flatten_body(postprocess_body("content"), "title"), F.lit(""))
    clean = raw.withColumn("content", body)
    return clean.withColumn("status", F.when(
        (F.col("status") == OK) & (F.col("content") == ""), F.lit(EMPTY)).otherwise(F.col("status")))


def best_rendering(renderings: DataFrame, key: str = "url") -> DataFrame:
    """One row per URL: the longest content, with the earliest date found in any rendering.

    ``renderings(url, attempt, content, published)``; ties go to the earlier attempt.
    """
    size = F.coalesce(F.length("content"), F.lit(0))
    order = F.struct(size.alias("n"), (-F.col("attempt")).alias("a"))
    dated = F.when(F.col("published").isNotNull(), F.col("attempt"))
    return renderings.groupBy(key).agg(
        F.max_by("content", order).alias("content"), F.min_by("published", dated).alias("published"))
