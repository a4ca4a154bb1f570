"""Site rules: data that tells, per domain and path, how a page's body is found.

A rule names a ``kind`` (one of the expressions in ``bodies``) and its
parameters.  Users add rules by extending the list; no code changes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pressloom.functions.nodes import PRUNE, SELECTOR, UI_TOKENS, prune_sets, selectors


@dataclass(frozen=True)
class SiteRule:
    name: str
    domain: str                                # without www.
    kind: str = "blocks"
    path_prefix: str | None = None
    path_regex: str | None = None
    no_fallback: bool = False                  # keep a short result rather than the generic body
    priority: int = 50                         # higher first
    page_prune: tuple[str, ...] = ()           # removed from the page before the container is chosen
    containers: tuple[str, ...] = ()           # ranked; the page when none matches
    prune: tuple[str, ...] = ()                # removed inside the container
    bodies: tuple[str, ...] = ()               # ranked, inside the container; the container when none matches
    tags: tuple[str, ...] = ("p",)
    wrappers: tuple[str, ...] = ()             # div/span holding one of these is no paragraph
    min_chars: int = 1
    min_total: int = 1
    skip_like: tuple[str, ...] = ()            # elements with one of these in class or id are no paragraphs
    climb: int = 4                             # steps up from the headline to the box around its text, at most


# ---- fixed values: selector lists and rules of the known sites ------------------------------

_CHROME = ("header", "nav", "footer", "aside", "form", "script", "style")
_SHARE = (".share", ".share-tools", ".share-buttons", "[class*='share']")
_TAGS = (".tags", ".post-tags", ".entry-tags")
_META = (".meta", ".post-meta", ".entry-meta", ".byline")
_COMMENTS = (".comments", "#comments", ".comment", ".comment-list", ".comment-form")
_LETTERS = (".newsletter", ".subscribe", ".subscription")
_ADS = (".ad", ".advertisement", "[id*='ad-']", "[class*='ad-']")
# What several sites' article templates hold besides the text.
_TEMPLATE = (
    "header", "nav", "footer", "aside", "form", "script", "style",
    ".breadcrumbs", ".breadcrumb", ".toolbar",
    ".share", ".share-tools", ".share-buttons", "[class*='share']",
    ".tags", ".tag-list", ".post-tags", ".entry-tags", ".byline", ".author", ".meta", ".post-meta", ".entry-meta",
    ".related", ".related-stories", ".more-stories", ".article-related", ".recommendations",
    ".comments", "#comments", ".comment", ".comment-list", ".comment-form",
    ".newsletter", ".subscribe", ".subscription",
    ".inline-video", ".video-player", ".audio-player", ".gallery", ".slideshow",
    "figure", "figcaption", "iframe", "noscript",
    ".ad", ".advertisement", "[id*='ad-']", "[class*='ad-']",
)
_HUB_CHROME = (
    *_CHROME, ".site-header", ".site-footer", ".navbar", ".nav", ".menu", ".global-header", ".global-footer",
    ".breadcrumbs", "#header", "#footer", "#nav", ".topbar", ".top-nav", ".toolbar", "ul.nav",
)
_HUB = "dvidshub.net"
_GENERIC_BOX = ("div.page-content", "div.main-content", "article")

SITE_RULES = [
    SiteRule(
        "shobserver", "shobserver.com", containers=(
            "#newsDetail", "article", "main article", "[role='main'] article", "main"),
        prune=_TEMPLATE, bodies=(
            "#newsContent, #newscontent, [id*='news-content']", ".newsContent, .news-content, .news_content",
            "[itemprop='articleBody']",
            ".article-content, .article__content, .content__article, .content__body, .detail-content, .detail__content, .content"),
        tags=("p", "div", "li"), wrappers=("div", "section", "article", "figure", "ul", "ol"), min_chars=25, min_total=160),
    SiteRule("defensenews", "defensenews.com", "text", containers=("div.article-body", "article"), prune=(
        ".author-name", ".tags", "script", "style", "aside", "figure", ".related", ".article__related", ".share-links",
        "div[data-qa='article-related']", "footer"), min_total=1),
    SiteRule("dvids:image", _HUB, "image", "/image/", priority=90,
             containers=("div.caption, div#caption, div.image-details",)),
    SiteRule("dvids:video", _HUB, "video", "/video/", priority=90),
    SiteRule("dvids:audio", _HUB, "audio", "/audio/", priority=90, page_prune=_HUB_CHROME, climb=3, bodies=(
        "div.field-name-body", "div[itemprop='description']", "div.description", "article .description", "article")),
    SiteRule("dvids:news", _HUB, "news", "/news/", priority=90, page_prune=_HUB_CHROME, bodies=(
        "div.field-name-body", "article .field--name-body", "div[itemprop='articleBody']", "article")),
    SiteRule("dvids:generic", _HUB, "text_or_page", priority=40, containers=_GENERIC_BOX),
    SiteRule("defense:igphoto", "defense.gov", "photo", "/Multimedia/Photos/igphoto/", no_fallback=True, priority=95),
    SiteRule("defense:generic", "defense.gov", "text_or_page", priority=40, containers=_GENERIC_BOX),
    SiteRule("crntt", "crntt.com", "lines", priority=60),
    SiteRule("crntt:bj", "bj.crntt.com", "lines", priority=60),
    SiteRule(
        "vietnam.vn", "vietnam.vn", "headline_box", priority=60, climb=6,
        page_prune=(*_CHROME, ".site-header", ".site-footer", ".navbar", ".breadcrumbs", ".breadcrumb", ".topbar",
                    ".top-nav", ".toolbar"),
        containers=("article", "main", "div.entry-content", "div.post-content", "div.single-content", "div.content"),
        prune=(*_SHARE, ".shares", ".sharing", ".social", ".social-share", "[class*='social']", ".follow",
               "[class*='follow']", *_TAGS, "[class*='tag-']", *_META, ".related", ".related-posts", ".post-related",
               ".post-navigation", ".nav-links", ".pagination", *_COMMENTS, ".single-post-footer", ".post-footer",
               "footer", ".credit", ".credits", ".attribution", ".source", ".sources")),
    SiteRule(
        "rfi", "rfi.fr", "text_or_blocks", priority=60,
        containers=("article", "[itemtype*='Article']", "main article", "main", "[role='main']"),
        prune=(*_CHROME, *_SHARE, ".shares", ".sharing", ".social", ".social-share", "[class*='social']", *_TAGS,
               "[class*='tag-']", *_META, ".related", ".related-posts", ".post-related", ".article-related",
               ".read-more", ".nav-links", ".pagination", *_COMMENTS, *_LETTERS, ".player", ".audio-player",
               ".video-player"),
        bodies=("[itemprop='articleBody']",
                ".article__content, .article-content, .content__body, .article-body, .t-content__body, "
                "[class*='articleBody'], [class*='article-body']"),
        tags=("p", "h2", "h3")),
    SiteRule(
        "france24", "france24.com", "lead", priority=60,
        containers=("article", "main article, .t-content, [role='article']"),
        bodies=(".t-content__body", ".article__content", "[class*='content__body']", "[itemprop='articleBody']",
                ".o-article__content", ".c-article__content"),
        min_chars=25, min_total=161),
    SiteRule(
        "moreover:ct", "ct.moreover.com", priority=60,
        page_prune=(*_CHROME, "[role='banner']", "[role='navigation']", "[role='complementary']", ".breadcrumbs",
                    ".breadcrumb", ".toolbar"),
        containers=("article", "[itemprop='articleBody']", "[role='main'] article", "main article", "main",
                    "#main, #content, .content, .article, .entry-content, [class*='article__content'], "
                    "[class*='content__body']"),
        prune=(".related", ".related-posts", ".post-related", ".article-related", *_COMMENTS, *_TAGS, *_META, *_SHARE,
               "figure", "figcaption", ".gallery", ".lightbox", ".slideshow", "iframe", "noscript"),
        tags=("p", "div"), wrappers=("p", "div", "figure", "section", "article"), min_chars=25, min_total=120),
    SiteRule(
        "idahostatesman", "idahostatesman.com", priority=60, page_prune=(*_TEMPLATE, ".paywall"),
        containers=("article", "main article", "[role='main'] article", "[itemtype*='Article']"),
        bodies=("div.article-body", "[class*='article__body']", "[class*='story-body']",
                "[data-qa='article-body'], [data-qa='story-body']", "[itemprop='articleBody']"),
        tags=("p", "li"), min_chars=25, min_total=160),
    SiteRule(
        "cankaoxiaoxi", "cankaoxiaoxi.com", "blocks_or_script", priority=60,
        containers=("article", "main article", "[role='main'] article", "#app main", "main",
                    "[id*='detail'], [class*='detail']", "[id*='content'], [class*='content']"),
        prune=(*_TEMPLATE, ".social", ".social-share", ".read-more", ".paywall"),
        bodies=("[itemprop='articleBody']", "[class*='article__body']", "[class*='story-body']",
                "[class*='detail-content'], [class*='detail__content'], [class*='detailBody']",
                "[class*='article-content'], [class*='article__content'], [class*='content__article']",
                "[class*='rich'], [class*='text'], [class*='txt'], [class*='content']"),
        tags=("p", "li", "div", "span"), wrappers=("section", "article", "figure", "ul", "ol"), min_chars=25,
        min_total=160, skip_like=UI_TOKENS),
]
# the same page under its direct address
SITE_RULES.append(replace(SITE_RULES[0], name="shobserver:detail", path_prefix="/staticsg/res/html/web/newsDetail.html", priority=80))

# The body of any other page: the paragraphs of its main container, without chrome.
GENERIC = SiteRule(
    "generic", "*", page_prune=(*_CHROME, "noscript", "iframe", *_ADS, *_COMMENTS, *_SHARE),
    containers=("article", "[itemprop='articleBody']", "main", "[role='main']", "#content, .content, .entry-content", "body"),
    tags=("p",), min_chars=25,
)

RULE = (
    "struct<name:string,kind:string,path_prefix:string,path_regex:string,no_fallback:boolean,"
    f"page_prune:{PRUNE},containers:array<{SELECTOR}>,prune:{PRUNE},bodies:array<{SELECTOR}>,"
    "tags:array<string>,wrappers:array<string>,min_chars:int,min_total:int,skip_like:array<string>,climb:int>"
)


def _prune_row(css: Iterable[str]) -> tuple:
    sets = prune_sets(css)
    return (sets["tags"], sets["classes"], sets["ids"], sets["class_like"], sets["id_like"], selectors(sets["other"]))


def rule_row(r: SiteRule) -> tuple:
    return (
        r.name, r.kind, r.path_prefix, r.path_regex, r.no_fallback, _prune_row(r.page_prune), selectors(r.containers),
        _prune_row(r.prune), selectors(r.bodies), list(r.tags), list(r.wrappers), r.min_chars, r.min_total, list(r.skip_like),
        r.climb,
    )
