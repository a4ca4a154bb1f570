"""Body and date expressions of pages, one per kind of site rule."""

from __future__ import annotations

from collections.abc import Iterable

from pressloom.functions import cleanup as cl
from pressloom.functions import dates
from pressloom.functions.nodes import (
    attr, chunks_after, climb, inside, largest_block, meta_content, node_text, paragraphs, prune, prune_struct,
    script_texts, select_first, selector_array, texts_of, visible_text, whole,
)
from pressloom.functions.rules import GENERIC, SiteRule, rule_row
from pressloom.functions.sqltext import F, Sql, column_function, filled, first, let, strip
from pressloom.functions.urls import FRAGMENT

# Keys of bodies inside scripts, and limits.
SCRIPT_BODY = r'(?s)"(?:content|contentHtml|articleContent|body|newsContent|detail(?:Text|Html)?)"\s*:\s*"(.*?)"'
MIN_SCRIPT, MIN_SCRIPT_BODY = 100, 160
FALLBACK_TAIL = r"(?isU)\b(Tags?|Related|Share)\b.*$"


def rule_literal(rule: SiteRule) -> Sql:
    """A rule as a constant struct column."""
    strings = lambda v: F.array(*v).cast("array<string>")
    name, kind, prefix, regex, nofb, *_ = rule_row(rule)
    return F.struct(
        F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.lit(prefix).cast("string").alias("path_prefix"),
        F.lit(regex).cast("string").alias("path_regex"), F.lit(nofb).alias("no_fallback"),
        prune_struct(rule.page_prune).alias("page_prune"), selector_array(rule.containers).alias("containers"),
        prune_struct(rule.prune).alias("prune"), selector_array(rule.bodies).alias("bodies"),
        strings(rule.tags).alias("tags"), strings(rule.wrappers).alias("wrappers"),
        F.lit(rule.min_chars).alias("min_chars"), F.lit(rule.min_total).alias("min_total"),
        strings(rule.skip_like).alias("skip_like"), F.lit(rule.climb).alias("climb"),
    )


# ---- body expressions ----------------------------------------------------------------------

def _at_least(text: Sql, limit: Sql) -> Sql:
    return let(text, lambda t: F.when(F.length(t) >= limit, t))


def _boxed(nodes: Sql, rule: Sql) -> Sql:
    """``struct<clean, box, body>``: the pruned nodes, the container, and the body box inside it or NULL."""
    def inner(page: Sql, box: Sql) -> Sql:
        return let(prune(page, rule.getField("prune")), lambda clean: F.struct(
            clean.alias("clean"), box.alias("box"), select_first(inside(clean, box), rule.getField("bodies")).alias("body")))

    return let(prune(nodes, rule.getField("page_prune")), lambda page: let(
        F.coalesce(select_first(page, rule.getField("containers")), whole(page)), lambda box: inner(page, box)))


def _joined(clean: Sql, box: Sql, rule: Sql) -> Sql:
    return F.array_join(paragraphs(
        clean, box, rule.getField("tags"), rule.getField("min_chars"), rule.getField("wrappers"),
        skip_like=rule.getField("skip_like")), "\n")


BOXED_KINDS = ("blocks", "text", "text_or_page", "text_or_blocks", "lead", "blocks_or_script")


def boxed_body(nodes: Sql, rule: Sql, kinds: Iterable[str]) -> Sql:
    """Body of the kinds that read a container.  Pruning, container and paragraphs are one expression that all share.

    ``blocks``: paragraphs of the body box (or container), NULL when together shorter than
    ``min_total``.  ``blocks_or_script``: else the largest block, else a script's body.
    ``text``: visible text of the container, one piece per line, NULL without one.
    ``text_or_page``: else that of the page.  ``text_or_blocks``: text of the body box, else the
    container's paragraphs, else its text.  ``lead``: paragraphs of a proper body box, else
    a description, else the lead text.
    """
    kind = rule.getField("kind")

    def by_kind(b: Sql) -> Sql:
        clean, box, body = (b.getField(k) for k in ("clean", "box", "body"))
        needed = (
            kind.isin("blocks", "blocks_or_script") | ((kind == "lead") & body.isNotNull())
            | ((kind == "text_or_blocks") & body.isNull())
        )
        text = F.when(box.getField("rank") >= 0, filled(node_text(clean, box, "\n")))
        lead = let(select_first(nodes, selector_array(LEAD_BOXES)), lambda x: F.when(
            x.isNotNull(), strip(F.regexp_replace(node_text(nodes, x, "\n"), FALLBACK_TAIL, ""))))

        def choose(joined: Sql) -> Sql:
            long = F.when(F.length(joined) >= rule.getField("min_total"), joined)
            cases = {
                "blocks": lambda: long,
                "blocks_or_script": lambda: F.coalesce(long, largest_block(nodes), script_json_body(nodes)),
                "text": lambda: text,
                "text_or_page": lambda: F.coalesce(text, visible_text(nodes, "\n")),
                "text_or_blocks": lambda: F.when(body.isNotNull(), node_text(clean, body, "\n")).otherwise(
                    F.coalesce(filled(joined), node_text(clean, box, "\n"))),
                "lead": lambda: F.coalesce(F.when(body.isNotNull(), long), descriptions(nodes), filled(lead)),
            }
            out = F.nothing()
            for k in kinds:
                out = F.when(kind == k, cases[k]()).otherwise(out)
            return out

        return let(F.when(needed, _joined(clean, F.coalesce(body, box), rule)), choose)

    return let(_boxed(nodes, rule), by_kind)


def headline_box_body(nodes: Sql, rule: Sql) -> Sql:
    """Text around the first ``h1``: the topmost box it sits in, without the headline."""
    def around(page: Sql) -> Sql:
        h1 = F.get(F.filter(page, lambda n: n.getField("tag") == "h1"), F.lit(0))
        span = lambda n: F.struct(F.lit(0).alias("rank"), n.getField("id").alias("id"), n.getField("end").alias("end"))
        up = let(h1, lambda h: F.when(h.isNotNull(), let(climb(page, h, ["article", "section", "div", "main"], rule.getField("climb")), span)))
        box = F.coalesce(up, select_first(page, rule.getField("containers")), whole(page))
        title = F.coalesce(let(h1, lambda h: node_text(page, h)), F.lit(""))
        clean = prune(page, rule.getField("prune"))
        text = let(box, lambda b: let(clean, lambda c: node_text(c, b, "\n")))
        body = let(text, lambda t: let(title, lambda ti: cl.drop_leading(t, ti)))
        return _at_least(F.regexp_replace(body, r"(?U)\s{2,}", " "), F.lit(81))

    return let(prune(nodes, rule.getField("page_prune")), around)


@column_function
def descriptions(nodes: Sql, twitter: bool = False) -> Sql:
    """``og:description``, (``twitter:description``,) ``description``, then JSON-LD ``description``."""
    paths = ["$.description", "$['@graph'].description", "$['@graph'][0].description", "$[0].description"]
    stated = F.transform(dates.jsonld(nodes), lambda v: F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths]))
    metas = [meta_content(nodes, "property", "og:description")]
    if twitter:
        metas.append(meta_content(nodes, "name", "twitter:description"))
    return F.coalesce(*metas, meta_content(nodes, "name", "description"),
                      first(F.transform(stated, strip), lambda t: t != ""))


# Boxes of lead texts and of captions.
LEAD_BOXES = [
    "[itemprop='description']", "article .article__lead, article .o-article__lead", ".article__summary, .t-content__body",
    "article",
]


@column_function
def script_json_body(nodes: Sql) -> Sql:
    """Text of the first HTML-bearing value under a body key in any script, at least 160 characters."""
    long_scripts = F.filter(script_texts(nodes), lambda t: F.length(t) >= MIN_SCRIPT)
    values = F.flatten(F.transform(long_scripts, lambda t: F.regexp_extract_all(t, F.lit(SCRIPT_BODY), F.lit(1))))
    bearing = F.filter(values, lambda v: v.rlike(r"<p|&lt;p|\\u003Cp"))

    def plain(v: Sql) -> Sql:
        for code, char in ((r"(?i)\\u003c", "<"), (r"(?i)\\u003e", ">"), (r"(?i)\\u0026", "&"), (r"\\n", "\n"),
                           (r"\\t", "\t"), (r"\\r", "\n"), (r"\\/", "/")):
            v = F.regexp_replace(v, code, char)
        v = dates.common_entities(F.replace(v, F.lit('\\"'), F.lit('"')))
        pieces = F.transform(F.split(F.regexp_replace(v, r"<[^>]+>", "\x1f"), "\x1f"), strip)
        return F.array_join(F.filter(pieces, lambda p: p != ""), "\n")

    return first(F.transform(bearing, plain), lambda t: F.length(t) >= MIN_SCRIPT_BODY)


def image_body(nodes: Sql, rule: Sql) -> Sql:
    """The declared description, else the caption box."""
    box = select_first(nodes, rule.getField("containers"))
    return F.coalesce(meta_content(nodes, "property", "og:description"),
                      let(box, lambda b: F.when(b.isNotNull(), filled(node_text(nodes, b)))))


def video_body(nodes: Sql, rule: Sql) -> Sql:
    return cl.caption_pattern(visible_text(nodes, " "))


# Places of photo captions.
CAPTION_PARAGRAPHS = ["figure figcaption", ".image__caption", ".image-caption", ".photo__caption", ".photo-caption",
                      ".figure__caption", ".caption"]


def photo_body(nodes: Sql, rule: Sql) -> Sql:
    """Photo caption: descriptions, caption paragraphs, caption boxes, first long paragraph, whole text."""
    box = select_first(nodes, selector_array(["figure figcaption", ", ".join(CAPTION_PARAGRAPHS[1:])]))

    def in_box(longer_than: int, css: list[str]) -> Sql:
        ps = select_first(nodes, selector_array(css))
        return let(ps, lambda b: F.when(b.isNotNull(), F.get(
            paragraphs(nodes, b, F.array(F.lit("p")), F.lit(longer_than + 1), F.empty()), F.lit(0))))

    caption = F.coalesce(
        meta_content(nodes, "property", "og:description"), meta_content(nodes, "name", "twitter:description"),
        in_box(20, [", ".join(CAPTION_PARAGRAPHS)]),
        let(box, lambda b: F.when(b.isNotNull(), filled(node_text(nodes, b)))),
        in_box(40, ["article"]), in_box(40, ["main"]),
    )
    return F.coalesce(let(caption, cl.photo_caption), let(visible_text(nodes, "\n"), cl.photo_caption))


def _heading(page: Sql) -> Sql:
    return F.get(F.filter(page, lambda n: n.getField("tag").isin("h1", "h2")), F.lit(0))


def news_body(nodes: Sql, rule: Sql) -> Sql:
    """Story text around the heading, else that of a common body box."""
    def story(page: Sql) -> Sql:
        title = F.coalesce(let(_heading(page), lambda h: node_text(page, h)), F.lit(""))
        near = let(_heading(page), lambda h: F.when(h.isNotNull(), let(
            climb(page, h, ["div", "section", "article"], rule.getField("climb")), lambda b: node_text(page, b, "\n"))))
        box = let(select_first(page, rule.getField("bodies")), lambda b: F.when(
            b.isNotNull(), node_text(page, b, "\n")))
        return let(title, lambda t: F.coalesce(
            let(near, lambda x: cl.story_body(x, t)), let(box, lambda x: cl.story_body(x, t))))

    return let(prune(nodes, rule.getField("page_prune")), story)


def transcript(texts: Sql) -> Sql:
    """Transcript from the chunks after an audio frame: chrome lines dropped, from the welcome on."""
    usable = F.filter(texts, lambda t: ~F.contains(t, F.lit(cl.EMBED_HELP[0])) & ~F.contains(t, F.lit(cl.EMBED_HELP[1])))
    kept = F.filter(cl.lines_of(F.array_join(usable, "\n")), lambda s: ~s.rlike(cl.AUDIO_CHROME))
    text = F.array_join(kept, "\n")
    return let(let(text, lambda t: F.coalesce(filled(F.regexp_extract(t, r"(?isU)\bWELCOME\b.*", 0)), t)),
               lambda t: F.when(F.length(t) > 80, t))


@column_function
def audio_chunks(nodes: Sql) -> Sql:
    return chunks_after(nodes, lambda n: F.coalesce(
        (n.getField("tag") == "iframe") & F.contains(attr(n, "src"), F.lit("/audio/embed/")), F.lit(False)), cl.AUDIO_INFO)


def audio_body(nodes: Sql, rule: Sql) -> Sql:
    """Transcript after the frame, text around the heading, transcript box, description box, descriptions, page."""
    before = lambda t: cl.before_marker(t, cl.AUDIO_INFO)

    def parts(page: Sql) -> Sql:
        near = let(_heading(page), lambda h: F.when(h.isNotNull(), let(
            climb(page, h, ["div", "section", "article"], rule.getField("climb")), lambda b: let(before(node_text(page, b, "\n")), lambda t: F.when(
                F.length(t) > 80, _at_least(F.regexp_replace(
                    cl.drop_leading(t, node_text(page, h)), r"(?s)^.*?Advanced Embed Example.*?\z", ""), F.lit(81)))))))
        named = F.filter(page, lambda n: F.coalesce(
            F.contains(attr(n, "class"), F.lit("transcript")) | F.contains(attr(n, "id"), F.lit("transcript")), F.lit(False)))
        scripted = F.get(F.filter(F.transform(named, lambda n: node_text(page, n, "\n")), lambda t: F.length(t) > 80), F.lit(0))
        box = let(select_first(page, rule.getField("bodies")), lambda b: F.when(
            b.isNotNull(), filled(before(node_text(page, b, "\n")))))
        return F.coalesce(
            transcript(audio_chunks(page)), near, scripted, box,
            meta_content(page, "property", "og:description"), meta_content(page, "name", "description"),
            filled(before(visible_text(page, "\n"))))

    return let(prune(nodes, rule.getField("page_prune")), parts)


def lines_of_page(nodes: Sql) -> Sql:
    """Lines of a page without size switches and code prompts, up to the related-news block."""
    raw = F.regexp_replace(visible_text(nodes, "\n"), r"〖[^〗]*〗", "")
    raw = F.regexp_replace(raw, r"(?s)扫描二维码.*?(?=相关新闻|\z)", "")
    return cl.lines_of(cl.before_marker(raw, cl.RELATED_NEWS))


def lines_body(nodes: Sql, rule: Sql) -> Sql:
    """Lines after the title line and the site and date row."""
    day, site = r"\d{4}-\d{2}-\d{2}", "(?i)CRNTT"
    is_row = lambda t: F.coalesce(t.rlike(day) | t.rlike(site), F.lit(False))

    def rest(lines: Sql) -> Sql:
        skip = F.when(is_row(F.get(lines, F.lit(1))), 2).when(is_row(F.get(lines, F.lit(0))), 1).otherwise(0)
        return filled(strip(F.array_join(F.slice(lines, skip + 1, F.greatest(F.size(lines), F.lit(1))), "\n")))

    return let(lines_of_page(nodes), rest)


def lines_raw(nodes: Sql) -> Sql:
    """Date and time in one of the first six lines."""
    shape = r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}"
    return F.regexp_extract(first(F.slice(lines_of_page(nodes), 1, 6), lambda s: s.rlike(shape)), shape, 0)


BODIES = {
    "headline_box": headline_box_body, "image": image_body, "video": video_body, "photo": photo_body, "news": news_body,
    "audio": audio_body, "lines": lines_body,
}


@column_function
def rule_body(nodes: Sql, rule: Sql, kinds: Iterable[str] | None = None) -> Sql:
    """Body by the rule's kind; NULL without a rule.  Only the rule's own branch is evaluated."""
    kinds = [*BOXED_KINDS, *BODIES] if kinds is None else list(kinds)
    boxed = [k for k in kinds if k in BOXED_KINDS]
    out = F.nothing()
    for kind in kinds:
        if kind not in BOXED_KINDS:
            out = F.when(rule.getField("kind") == kind, BODIES[kind](nodes, rule)).otherwise(out)
    if boxed:
        out = F.when(rule.getField("kind").isin(*boxed), boxed_body(nodes, rule, boxed)).otherwise(out)
    return filled(out)


@column_function
def generic_body(nodes: Sql) -> Sql:
    return let(rule_literal(GENERIC), lambda rule: filled(boxed_body(nodes, rule, ["blocks"])))


# ---- dates of single sites --------------------------------------------------------------------

@column_function
def site_date(nodes: Sql, rule: Sql) -> Sql:
    """The dates only single sites show: labelled rows, header lines, attributes."""
    dated = lambda key, *tags: attr(first(nodes, lambda n: attr(n, key).isNotNull() & (
        n.getField("tag").isin(*tags) if tags else F.lit(True))), key)
    kind = rule.getField("kind")
    raws = (
        F.when(kind.isin("image", "video"), F.array(dates.labelled_raw(texts_of(nodes))))
        .when(kind == "lines", F.array(lines_raw(nodes)))
        .when(kind == "lead", F.array(dated("data-iso-date"), dated("datetime", "time")))
        .when(kind == "text_or_page", F.array(release_raw(nodes)))
    )
    return dates.first_parsed(raws)


def release_raw(nodes: Sql) -> Sql:
    """``.release-date``, else ``time[datetime]``, else ``span.date``: its attribute, else its text."""
    hit = select_first(nodes, selector_array([".release-date", "time[datetime]", "span.date"]))
    return let(hit, lambda b: F.when(b.isNotNull(), let(F.get(nodes, b.getField("id")), lambda n: F.coalesce(
        attr(n, "datetime"), node_text(nodes, n, "")))))


@column_function
def late_date(nodes: Sql, text: Sql, rule: Sql, url: Sql, last_modified: Sql) -> Sql:
    """Sources tried when the page itself gave no date: site habits, then the HTTP header."""
    # fixed values: how single sites print a date
    name = rule.getField("name")
    slashed = F.regexp_extract(text, r"(?U)\b\d{1,2}/\d{1,2}/\d{4}\b", 0)
    spelled = F.regexp_extract(text, r"(?U)\b\d{1,2}\s+[A-Z][a-z]{2}\s+\d{4}(?:\s+\d{1,2}:\d{2})?\b", 0)
    classed = F.filter(nodes, lambda n: F.coalesce(
        attr(n, "class").rlike("time|date") | attr(n, "id").rlike("time|date"), F.lit(False)))
    in_url = F.regexp_extract(F.regexp_extract(url, FRAGMENT, 1), r"\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2})?)?", 0)
    own = (
        F.when(name == "vietnam.vn", F.array(slashed))
        .when(name == "moreover:ct", F.array(spelled))
        .when(name.startswith("shobserver"), F.transform(classed, lambda n: node_text(nodes, n)))
        .when(name == "cankaoxiaoxi", F.concat(F.coalesce(
            dates.script_raws(nodes), F.empty()), F.array(in_url)))
    )
    return dates.first_parsed(F.concat(F.coalesce(own, F.empty()), F.array(last_modified)))


