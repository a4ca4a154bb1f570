"""Joins: media master, translations, registered domains, redirects, page variants.

No size hint is given for data that can grow: Spark broadcasts a side only below
``autoBroadcastJoinThreshold`` and otherwise shuffles, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.base import col, literal_table
from pressloom.functions.urls import amp_candidates, host_suffixes, resolve_url, scrape_domain
from pressloom.session import staged

# Page checks of the fetch stage.
BLOCKED_PAGE = r"(?i)(blocked|access denied|just a moment|cf-chl|cloudflare|perimeterx|you are being redirected)"
THIN_PAGE_CHARS = 2000
SHELL_DOMAIN = "shobserver.com"
OFFLINE_TEXT = "此文章不存在或已下线"
VARIANT_MIN_CHARS = 1200
META_REFRESH = (
    r"""(?i)<meta[^>]+http-equiv=["']?refresh["']?[^>]+content=["']?[^"'>]*url=([^"';>]+)"""
)
ESCAPED_META_REFRESH = (
    r"""(?i)&lt;meta[^&gt;]+http-equiv=["']?refresh["']?[^&gt;]+content=["']?[^"'>]*url=([^"';&gt;]+)"""
)
SCRIPT_REDIRECT = r"""(?i)location(?:\.href|\.replace)\s*=\s*["']([^"']+)["']"""


def is_blocked(html: Column | str) -> Column:
    return F.coalesce(col(html).rlike(BLOCKED_PAGE), F.lit(False))


def is_thin(html: Column | str) -> Column:
    return F.length(col(html)) < THIN_PAGE_CHARS


def is_template_shell(url: Column | str, html: Column | str, domain: str = SHELL_DOMAIN) -> Column:
    """Page of ``domain`` whose template was never filled, or that says it is offline."""
    shell = col(html).rlike(r"\{\{[^}]+\}\}") | F.contains(col(html), F.lit(OFFLINE_TEXT))
    return F.coalesce((scrape_domain(url) == domain) & shell, F.lit(False))


def last_wins(df: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """One row per key, the values of its last row; a NULL there wins too."""
    row = F.max_by(F.struct(*values), F.col(order))
    return df.groupBy(key).agg(row.alias("_row")).select(key, *[F.col(f"_row.{v}").alias(v) for v in values])


def enrich_master(
    feed: DataFrame, master: DataFrame, publisher: str = "publisherName", how: str = "left"
) -> DataFrame:
    """Add the master's ``official``, ``country`` and ``source`` by lower-cased publisher.

    ``how='inner'`` also drops publishers without an official level: writing the
    filter into the join keeps it ahead of the Python stages that follow.
    """
    lookup = last_wins(
        master.select(F.col("host").alias("_host"), "ord", "official", "country", "source"),
        "_host", "ord", "official", "country", "source",
    )
    if how == "inner":
        lookup = lookup.filter(F.col("official").isNotNull())
    return feed.join(lookup, F.lower(F.col(publisher)) == F.col("_host"), how).drop("_host")


def unmatched_publishers(feed: DataFrame, master: DataFrame, publisher: str = "publisherName") -> DataFrame:
    """Feed rows whose publisher has no official level (NULL publishers included)."""
    known = last_wins(master.select(F.col("host").alias("_host"), "ord", "official"), "_host", "ord", "official")
    known = known.filter(F.col("official").isNotNull())
    return feed.join(known, F.lower(F.col(publisher)) == F.col("_host"), "left_anti")


def top_unmatched(unmatched: DataFrame, publisher: str = "publisherName", n: int = 20) -> DataFrame:
    """The ``n`` most frequent unmatched publishers, NULL counted as the text ``none``."""
    name = F.lower(F.coalesce(F.col(publisher), F.lit("none"))).alias("publisher")
    return unmatched.groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc("publisher")).limit(n)


def attach_translations(df: DataFrame, translations: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Add translated columns from a table ``(text, translated)``; missing ones are ``''``.

    However many columns there are, they take one join with the lookup: the rows are
    written once with a number, their texts go out as (row, column, digest) and
    the translations that were found come back per row.  Texts are told apart by a
    128-bit digest and their length; the texts themselves stay where they are.
    Repeated texts of the lookup count once, the smallest translation wins.
    """
    row, rest = free_names(df, "_row", "_found")
    keep = [c for c in df.columns if c not in pairs.values()]
    rows = staged(df.withColumn(row, F.monotonically_increasing_id()), "untranslated")
    texts = F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("string").alias("t")) for i, c in enumerate(pairs)])
    wanted = rows.select(row, F.explode(F.filter(texts, lambda x: F.length(F.trim(x["t"])) > 0)).alias("x"))
    digest = lambda t: [F.md5(t.cast("binary")).alias("_digest"), F.length(t).alias("_length")]
    wanted = wanted.select(row, F.col("x.k").alias("_k"), *digest(F.col("x.t")))
    lookup = translations.select(*digest(F.col("text")), F.col("translated").alias("_ja"))
    lookup = lookup.groupBy("_digest", "_length").agg(F.min("_ja").alias("_ja")).filter(F.col("_ja").isNotNull())
    found = wanted.join(lookup, ["_digest", "_length"]).groupBy(row).agg(
        F.map_from_entries(F.collect_list(F.struct("_k", "_ja"))).alias(rest))  # an entry per column at most
    out = rows.join(found, row, "left")
    made = {target: F.coalesce(F.col(rest)[F.lit(i)], F.lit("")) for i, target in enumerate(pairs.values())}
    return out.select(*keep, *[v.alias(t) for t, v in made.items()])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it (case is ignored)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def spread_left_join(df: DataFrame, right: DataFrame, key: Column, right_key: str) -> DataFrame:
    """Left join on a text ``key`` that many rows may lack.

    The rows meet on a 64-bit hash, and the texts decide.  A row without key
    gets a hash of the whole row instead: it matches nothing, and such rows spread
    over all tasks rather than pile up on NULL.
    """
    left = df.withColumn("_key", key).withColumn("_hash", F.coalesce(
        F.when(F.col("_key").isNotNull(), F.xxhash64("_key")), F.xxhash64(*df.columns)))
    hashed = right.withColumn("_right_hash", F.xxhash64(right_key))
    same = (F.col("_hash") == F.col("_right_hash")) & (F.col("_key") == F.col(right_key))
    return left.join(hashed, same, "left").drop("_key", "_hash", "_right_hash")


def registered_domains(hosts: DataFrame, host: str, suffixes: Iterable[str] | DataFrame) -> DataFrame:
    """``(host, domain)``: the longest public suffix plus one label, else the host itself.

    Only the distinct hosts are exploded; callers join the result back.
    """
    if not isinstance(suffixes, DataFrame):
        suffixes = literal_table(hosts.sparkSession, sorted({(s,) for s in suffixes}), "_suffix string")
    table = suffixes.toDF("_suffix")
    names = hosts.select(F.col(host)).filter(F.col(host) != "").distinct()
    tails = names.select(host, F.posexplode(host_suffixes(host)).alias("_pos", "_tail"))
    best = (
        tails.join(table, F.col("_tail") == F.col("_suffix"), "left_semi")
        .groupBy(host).agg(F.min("_pos").alias("_cut"))
    )
    labels = F.split(F.col(host), r"\.")
    domain = F.when(
        F.col("_cut") >= 1, F.array_join(F.slice(labels, F.col("_cut"), F.size(labels)), ".")
    ).otherwise(F.col(host))
    return names.join(best, host, "left").select(host, domain.alias("domain"))


def redirect_target(url: Column | str, html: Column | str) -> Column:
    """Absolute target of a redirect page (meta refresh, else script), or NULL."""
    html = col(html)
    found = F.coalesce(
        *[F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in
          (ESCAPED_META_REFRESH, META_REFRESH, SCRIPT_REDIRECT)]
    )
    return F.when(found.isNotNull(), resolve_url(url, found))


def follow_redirects(pages: DataFrame, corpus: DataFrame) -> DataFrame:
    """Replace a redirect page's HTML by its target's when that is longer.

    ``pages(page_id, url, html)``, ``corpus(url, html)`` with distinct URLs.  Only
    redirect pages take part in the join; all others pass straight through.
    """
    marked = pages.withColumn("_to", redirect_target("url", "html"))
    target = corpus.select(F.col("url").alias("_url"), F.col("html").alias("_html"))
    longer = F.coalesce(F.length("_html") > F.length("html"), F.lit(False))
    moved = (
        marked.filter(F.col("_to").isNotNull())
        .join(target, F.col("_to") == F.col("_url"), "left")
        .withColumns({"html": F.when(longer, F.col("_html")).otherwise(F.col("html")), "followed": longer})
    )
    kept = marked.filter(F.col("_to").isNull()).withColumn("followed", F.lit(False))
    names = [*pages.columns, "followed"]
    return moved.select(*names).unionByName(kept.select(*names))


def amp_variants(pages: DataFrame, corpus: DataFrame) -> DataFrame:
    """First usable light-weight variant of each page: ``(page_id, amp_url, amp_html)``.

    ``corpus(url, html)`` has distinct URLs.  Its pages are tested once, which leaves the
    usable URLs; the choice is made on these alone.  A second read fetches the winners'
    HTML by URL and tests nothing.
    """
    usable = corpus.filter(~is_blocked("html") & (F.length("html") >= VARIANT_MIN_CHARS))
    wanted = pages.select("page_id", F.posexplode(amp_candidates("url")).alias("_pos", "_cand"))
    best = (
        wanted.join(usable.select(F.col("url").alias("_url")), F.col("_cand") == F.col("_url"))
        .groupBy("page_id").agg(F.min_by("_url", "_pos").alias("amp_url"))
    )
    best = staged(best, "variants")  # few and narrow; the test is not repeated for the second read
    html = corpus.select(F.col("url").alias("_url"), F.col("html").alias("amp_html"))
    return best.join(html, F.col("amp_url") == F.col("_url")).select("page_id", "amp_url", "amp_html")
