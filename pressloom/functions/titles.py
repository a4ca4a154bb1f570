"""Titles: the generic choice, brand stripping, and per-site source orders."""

from __future__ import annotations

from pressloom.functions.nodes import (
    _inside, attr, longest, matches, meta_content, node_text, selector_array, select_first, visible_text,
)
from pressloom.functions.sqltext import F, Sql, column_function, filled, first, let, strip

NO_TITLE = "NO TITLE"
MIN_HEADING = 6

# Separators between headline and site name, and section names at a title's end.
SEPARATOR = r"(?U)\s*(?:\||–|—|•|·|-)\s*"
SPACED_SEPARATOR = r"(?U)\s+(?:\||–|—|•|·|-)\s+"
SECTION_NAME = r"(?U)^(news|world|opinion|politics|military(?:\s*news)?|ニュース|軍事ニュース|ゲルマンニュース)$"
LISTING_PREFIXES = ["DVIDS - Video - ", "DVIDS - Images - ", "DVIDS - News - ", "DVIDS - Audio - "]

# Title sources of single sites, in order.
SITE_TITLES = {
    "vietnam.vn": ["og", "h1", "title"],
    "rfi.fr": ["og", "h1", "twitter", "title"],
    "ct.moreover.com": ["og", "twitter", "meta", "h1", "title"],
    "idahostatesman.com": ["og", "twitter", "meta", "h1", "title"],
    "cankaoxiaoxi.com": ["og", "twitter", "meta", "longest", "title"],
    "shobserver.com": ["og", "twitter", "meta", "boxed", "classed", "title"],
}
# Only a missing title, or one that names the site, is replaced here.
WEAK_ONLY = {"vietnam.vn": "Vietnam.vn"}
LATE_TITLES = {"crntt.com": ["og", "meta", "heading", "line"]}
LATE_MIN = 4


@column_function
def brand_tokens(domain: Sql, nodes: Sql) -> Sql:
    """Lower-case spellings of the site's name: host, first label, declared names, common endings."""
    host = F.replace(domain, F.lit("www."), F.lit(""))
    names = F.array(
        host, F.get(F.split(host, ":"), F.lit(0)),
        F.when(F.contains(host, F.lit(".")), F.get(F.split(host, r"\."), F.lit(0))),
        meta_content(nodes, "property", "og:site_name"), meta_content(nodes, "name", "application-name"),
    )

    def spellings(t: Sql) -> Sql:
        t = F.lower(t)
        plain = F.array(t, *[F.replace(t, F.lit(c), F.lit(" ")) for c in ".-_"])
        ended = F.array(*[F.concat(t, F.lit(e)) for e in (".com", ".net", ".org")])
        trimmed = F.transform(plain, strip)
        return F.when(F.contains(t, F.lit(".")), trimmed).otherwise(F.concat(trimmed, ended))

    known = F.filter(names, lambda t: F.coalesce(t != "", F.lit(False)))
    return F.filter(F.array_distinct(F.flatten(F.transform(known, spellings))), lambda t: t != "")


@column_function
def strip_brand(title: Sql, tokens: Sql, strict: bool = False) -> Sql:
    """Drop site and section names from a title's right end.

    Hyphens inside words separate too, so ``F-35`` comes out as ``F - 35``;
    ``strict`` splits at separators with white space around them only.
    """
    def is_brand(part: Sql) -> Sql:
        low = F.lower(strip(part))
        related = F.exists(tokens, lambda t: F.contains(t, low) | F.contains(low, t))
        return (low != "") & (related | low.rlike(SECTION_NAME))

    def cut(parts: Sql) -> Sql:
        kept = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: (i == 0) | ~is_brand(F.get(parts, i)))
        return F.slice(parts, 1, F.array_max(kept) + 1)

    parts = F.split(strip(title), SPACED_SEPARATOR if strict else SEPARATOR)
    joined = strip(F.array_join(let(parts, cut), " - "))
    return F.regexp_replace(F.regexp_replace(joined, SEPARATOR + "$", ""), r"(?U)\s{2,}", " ")


HEADINGS = ["article h1", "main article h1", "main h1", "h1", "article h2", "h2"]
TITLE_CLASS = "title|headline|subject"


def title_nodes(nodes: Sql) -> Sql:
    """The few nodes that titles come from: headings, ``<title>``, metas, elements of a title-like class."""
    return F.filter(nodes, lambda n: F.coalesce(
        n.getField("tag").isin("h1", "h2", "h3", "title", "meta") | attr(n, "class").rlike(TITLE_CLASS), F.lit(False)))


def _text(nodes: Sql, node: Sql) -> Sql:
    return let(node, lambda n: node_text(nodes, n))


def _headings(nodes: Sql, marked: Sql) -> list[Sql]:
    """First heading text per place, best place first."""
    def heading(css: str) -> Sql:
        return _text(nodes, first(marked, lambda n: matches(nodes, n, F.get(selector_array([css]), 0))))

    return [heading(css) for css in HEADINGS]


@column_function
def page_title(nodes: Sql, tokens: Sql) -> Sql:
    """A real heading, else a title meta, else ``<title>``; the last two without brand; NULL when none."""
    return let(title_nodes(nodes), lambda marked: _page_title(nodes, marked, tokens))


def _page_title(nodes: Sql, marked: Sql, tokens: Sql) -> Sql:
    def accepted(text: Sql) -> Sql:
        return let(text, lambda t: F.when(
            (F.length(t) >= MIN_HEADING) & ~F.array_contains(tokens, F.lower(strip(t))), t))

    declared = F.coalesce(
        meta_content(marked, "property", "og:title"), meta_content(marked, "name", "twitter:title"),
        meta_content(marked, "name", "title"), _tag_text(nodes, marked, "title"),
    )
    return F.coalesce(*[accepted(h) for h in _headings(nodes, marked)], strip_brand(declared, tokens))


def _tag_text(nodes: Sql, marked: Sql, *tags: str) -> Sql:
    return filled(_text(nodes, first(marked, lambda n: n.getField("tag").isin(*tags))))


@column_function
def trim_prefix(title: Sql) -> Sql:
    """Remove one listing prefix and the separators after it."""
    return F.regexp_replace(title, rf"^(?:{'|'.join(LISTING_PREFIXES)})[ \-|–—]*", "")


def _title_candidates(nodes: Sql, marked: Sql) -> Sql:
    """Longest heading-like text of at least six characters that is not the shell's ``<title>``."""
    heads = F.filter(marked, lambda n: F.coalesce(
        n.getField("tag").isin("h1", "h2", "h3") | attr(n, "class").rlike(TITLE_CLASS), F.lit(False)))
    texts = F.transform(heads, lambda n: node_text(nodes, n))
    return let(_tag_text(nodes, marked, "title"), lambda title: longest(F.filter(
        texts, lambda t: (F.length(t) >= MIN_HEADING) & F.coalesce(t != title, F.lit(True)))))


def _boxed_heading(nodes: Sql, marked: Sql) -> Sql:
    """First ``h1`` inside the detail box, the article or the main part."""
    boxes = F.transform(F.array(*map(selector_array, [["#newsDetail"], ["article"], ["main article"], ["main"]])),
                        lambda s: select_first(nodes, s))
    heads = F.transform(boxes, lambda box: _text(
        nodes, first(marked, lambda n: (n.getField("tag") == "h1") & _inside(n, box))))
    return first(heads, lambda t: t != "")


def _classed_heading(nodes: Sql, marked: Sql) -> Sql:
    named = F.filter(marked, lambda n: F.coalesce(
        F.arrays_overlap(F.split(attr(n, "class"), r"\s+"), F.array("title", "news-title", "article-title"))
        | F.contains(attr(n, "class"), F.lit("headline")), F.lit(False)))
    return first(F.transform(named, lambda n: node_text(nodes, n)), lambda t: t != "")


# Lines that are no title: interface tokens, print link, time row, site name.
NO_TITLE_LINE = r"〖[^〗]+〗|打印|\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}|(?i:CRNTT)"


def _first_line(nodes: Sql, marked: Sql) -> Sql:
    """First visible line that may be a title."""
    lines = F.filter(F.transform(F.split(visible_text(nodes, "\n"), "\n"), strip), lambda t: (t != "") & ~t.rlike(NO_TITLE_LINE))
    return F.get(lines, F.lit(0))


# Every source reads the page's title nodes; the page itself only for the text of one it has chosen.
TITLE_SOURCES = {
    "og": lambda n, marked: meta_content(marked, "property", "og:title"),
    "twitter": lambda n, marked: meta_content(marked, "name", "twitter:title"),
    "meta": lambda n, marked: meta_content(marked, "name", "title"),
    "h1": lambda n, marked: _tag_text(n, marked, "h1"),
    "title": lambda n, marked: _tag_text(n, marked, "title"),
    "longest": _title_candidates,
    "boxed": _boxed_heading,
    "classed": _classed_heading,
    "heading": lambda n, marked: _tag_text(n, marked, "h1", "h2"),
    "line": _first_line,
}


def _by_order(nodes: Sql, marked: Sql, order: Sql) -> Sql:
    """First source of ``order`` (an array of source names) that yields a title."""
    def value(name: Sql) -> Sql:
        out = F.nothing()
        for source, expression in TITLE_SOURCES.items():
            out = F.when(name == source, expression(nodes, marked)).otherwise(out)
        return out

    return first(F.transform(order, value))


def _order_of(domain: Sql, site_titles: dict[str, list[str]]) -> Sql:
    order = F.nothing("array<string>")
    for site, sources in LATE_TITLES.items():
        order = F.when(domain.endswith(site), F.array(*sources)).otherwise(order)
    for site, sources in site_titles.items():
        order = F.when(domain == site, F.array(*sources)).otherwise(order)
    return order


@column_function
def site_title(
    nodes: Sql, domain: Sql, tokens: Sql, site_titles: dict[str, list[str]] | None = None
) -> Sql:
    """Final title of a page: generic choice, prefix trim, site order, brand strip, late site order."""
    order = _order_of(domain, SITE_TITLES if site_titles is None else site_titles)
    is_late = F.lit(False)
    for site in LATE_TITLES:
        is_late |= domain.endswith(site)

    def choose(t: Sql, o: Sql) -> Sql:
        allowed = ~is_late
        for site, name in WEAK_ONLY.items():
            allowed &= (domain != site) | (t == NO_TITLE) | F.contains(t, F.lit(name))
        early = strip_brand(F.coalesce(F.when(allowed, o), t), tokens)
        return let(early, lambda e: F.when(
            is_late & ((e == NO_TITLE) | (F.length(e) < LATE_MIN)), F.coalesce(o, e)).otherwise(e))

    def both(marked: Sql) -> Sql:
        generic = trim_prefix(F.coalesce(filled(_page_title(nodes, marked, tokens)), F.lit(NO_TITLE)))
        return F.struct(generic.alias("generic"), _by_order(nodes, marked, order).alias("own"))

    return let(let(title_nodes(nodes), both), lambda b: choose(b.getField("generic"), b.getField("own")))
