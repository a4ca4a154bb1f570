"""Dates: parsing, page date sources, text scans.

A parsed date is a TIMESTAMP; text without zone is read as UTC.  Only complete
dates count: missing parts are never filled from today.
"""

from __future__ import annotations

from pressloom.functions.nodes import attr, script_texts
from pressloom.functions.sqltext import F, Sql, column_function, first, let

# Where pages state their date, best source first: (tag, attribute, value, read from).
DATE_META = [
    ("meta", "property", "article:published_time", "content"),
    ("meta", "name", "pubdate", "content"),
    ("meta", "name", "timestamp", "content"),
    ("meta", "itemprop", "datePublished", "content"),
    ("meta", "name", "DC.date", "content"),
    ("meta", "name", "dcterms.date", "content"),
    ("meta", "property", "og:published_time", "content"),
    ("meta", "property", "og:updated_time", "content"),
    ("meta", "property", "article:modified_time", "content"),
    ("meta", "name", "date", "content"),
    ("meta", "name", "lastmod", "content"),
    ("meta", "name", "DC.date.issued", "content"),
    ("meta", "property", "og:video:release_date", "content"),
    ("meta", "itemprop", "uploadDate", "content"),
    ("time", "datetime", None, "datetime"),
]
NEXT_DATA_KEYS = ["uploadDate", "publication_date", "datePublished"]
JSONLD_KEYS = ["datePublished", "dateCreated"]
WALK_KEYS = ["publication_date", "date", "published", "datepublished"]
TEXT_DATE = (
    r"(?U)\b(\d{4}[./-]\d{1,2}[./-]\d{1,2}(?:[T\s]\d{2}:\d{2}(?::\d{2})?)?"
    r"|[A-Z][a-z]+\s+\d{1,2},\s+\d{4}"
    r"|\d{4}年\d{1,2}月\d{1,2}日(?:\d{1,2}:\d{2})?)\b"
)
RECOVERY_DATES = [
    r"(?U)\b\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{2}(?::\d{2})?)?\b",
    r"\d{4}年\d{1,2}月\d{1,2}日",
    r"(?U)\b\d{1,2}\s+[A-Z][a-z]{2}\s+\d{4}(?:\s+\d{1,2}:\d{2})?\b",
]
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
MONTH_NAME = (
    r"(Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?"
    r"|Nov(?:ember)?|Dec(?:ember)?)"
)
CLOCK = r"(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)"
ZONE = r"(Z|UTC|GMT|[+-]\d{2}:?\d{2})"

# Date shapes and the groups that hold year, month, day, clock, zone.
SHAPES = [
    (rf"(?<!\d)(\d{{4}})[-./](\d{{1,2}})[-./](\d{{1,2}})(?!\d)(?:[T\s]+{CLOCK}\s*{ZONE}?)?", (1, 2, 3, 4, 5)),
    (rf"(\d{{4}})年(\d{{1,2}})月(\d{{1,2}})日(?:\s*{CLOCK}\s*{ZONE}?)?", (1, 2, 3, 4, 5)),
    (rf"(?i)\b{MONTH_NAME}\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\b(?:,?\s+{CLOCK}\s*{ZONE}?)?", (3, 1, 2, 4, 5)),
    (rf"(?i)(?<!\d)(\d{{1,2}})\s+{MONTH_NAME}\.?,?\s+(\d{{4}})\b(?:,?\s+{CLOCK}\s*{ZONE}?)?", (3, 2, 1, 4, 5)),
    (rf"(?<!\d)(\d{{1,2}})[-./](\d{{1,2}})[-./](\d{{4}})(?!\d)(?:[T\s]+{CLOCK}\s*{ZONE}?)?", (3, 1, 2, 4, 5)),
    (rf"(?<!\d)(\d{{1,2}})[-./](\d{{1,2}})[-./](\d{{4}})(?!\d)(?:[T\s]+{CLOCK}\s*{ZONE}?)?", (3, 2, 1, 4, 5)),
]


def _timestamp(fields: Sql) -> Sql:
    """TIMESTAMP of ``[year, month (number or name), day, clock, zone]``, NULL when out of range."""
    year, month, day, clock, zone = [F.get(fields, F.lit(i)) for i in range(5)]
    place = F.instr(F.lit(MONTHS), F.lower(F.substring(month, 1, 3)))
    number = F.when(month.rlike(r"^\d"), month).otherwise(F.floor((place + 3) / 4).cast("string"))
    seconds = F.regexp_replace(clock, r"^(\d{1,2}:\d{2})$", "$1:00")
    offset = F.regexp_replace(F.regexp_replace(zone, "(?i)GMT", "UTC"), r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.concat(year, F.lit("-"), number, F.lit("-"), day, F.lit(" "), seconds, offset)


@column_function
def parse_date(raw: Sql) -> Sql:
    """First complete date in a short text, by the shapes in order; NULL when there is none.

    Day and month numbers alone are read month first, then day first.
    """
    def by_shape(text: Sql) -> Sql:
        found = F.array(*[
            F.when(text.rlike(p), F.regexp_replace(
                text, f"(?s)^.*?{p}.*$", "\t".join(f"${g}" for g in groups)))
            for p, groups in SHAPES
        ])
        fields = F.transform(F.filter(found, lambda f: f.isNotNull()), lambda f: F.split(f, "\t"))
        stamps = F.transform(fields, lambda f: F.trim(_timestamp(f)).try_cast("timestamp"))
        return first(stamps)

    return let(raw, lambda text: F.when(text.rlike(r"\d{4}"), by_shape(text)))


# ---- page sources ------------------------------------------------------------------------
# Each source yields its raw texts in order; they are parsed together, once.

@column_function
def first_parsed(raws: Sql) -> Sql:
    return first(F.transform(raws, parse_date))


def meta_raws(nodes: Sql) -> Sql:
    """Date texts of meta and time elements, best source first, document order within a source."""
    def ranked(n: Sql) -> Sql:
        rank = F.nothing("int")
        for i, (tag, key, value, _) in reversed(list(enumerate(DATE_META))):
            hit = attr(n, key).isNotNull() if value is None else attr(n, key) == value
            rank = F.when((n.getField("tag") == tag) & hit, F.lit(i)).otherwise(rank)
        raw = F.when(n.getField("tag") == "time", attr(n, "datetime")).otherwise(attr(n, "content"))
        return F.struct(rank.alias("rank"), n.getField("id").alias("id"), raw.alias("raw"))

    dated = F.filter(nodes, lambda n: n.getField("tag").isin("meta", "time"))
    sources = F.filter(F.transform(dated, ranked), lambda s: s.getField("rank").isNotNull() & s.getField("raw").isNotNull())
    return F.transform(F.array_sort(sources), lambda s: s.getField("raw"))


def _script(nodes: Sql, key: str, value: str) -> Sql:
    return F.filter(nodes, lambda n: (n.getField("tag") == "script") & (attr(n, key) == value))


def next_data(nodes: Sql) -> Sql:
    return F.get(_script(nodes, "id", "__NEXT_DATA__"), F.lit(0)).getField("text")


def next_data_raws(nodes: Sql) -> Sql:
    """Dates among the page properties of a ``__NEXT_DATA__`` script."""
    return let(F.try_parse_json(next_data(nodes)), lambda v: F.array(*[
        F.try_variant_get(v, f"$.props.pageProps.{k}", "string") for k in NEXT_DATA_KEYS]))


def jsonld(nodes: Sql) -> Sql:
    """Parsed JSON-LD scripts."""
    texts = F.transform(_script(nodes, "type", "application/ld+json"), lambda n: n.getField("text"))
    return F.filter(F.transform(texts, lambda t: F.try_parse_json(common_entities(t))), lambda v: v.isNotNull())


def jsonld_raws(nodes: Sql) -> Sql:
    """``datePublished``, else ``dateCreated``, of each JSON-LD object."""
    def of_script(v: Sql) -> Sql:
        one = lambda e: first(F.array(*[F.try_variant_get(e, f"$.{k}", "string") for k in JSONLD_KEYS]), lambda t: t != "")
        graph = F.coalesce(F.try_variant_get(v, "$['@graph']", "variant"), v)
        return let(graph, lambda g: F.transform(
            F.coalesce(F.try_variant_get(g, "$", "array<variant>"), F.array(g)), one))

    return F.flatten(F.transform(jsonld(nodes), of_script))


def common_entities(text: Sql) -> Sql:
    # inside arrays no Arrow function can run; scripts only ever escape these
    for name, char in (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


@column_function
def date_from_meta(nodes: Sql) -> Sql:
    return first_parsed(meta_raws(nodes))


@column_function
def date_from_next_data(nodes: Sql) -> Sql:
    return first_parsed(next_data_raws(nodes))


@column_function
def date_from_jsonld(nodes: Sql) -> Sql:
    return first_parsed(jsonld_raws(nodes))


@column_function
def date_from_text(text: Sql) -> Sql:
    """The first date-shaped piece of a text."""
    return parse_date(F.regexp_extract(text, TEXT_DATE, 1))


@column_function
def latest_text_date(text: Sql, as_of: Sql) -> Sql:
    """The latest date in a text that is not after ``as_of``."""
    found = F.transform(F.regexp_extract_all(text, F.lit(TEXT_DATE), F.lit(1)), parse_date)
    return F.array_max(F.filter(found, lambda d: d <= as_of))


@column_function
def published_date(nodes: Sql, text: Sql, as_of: Sql) -> Sql:
    """Meta, page properties, JSON-LD, first date in the text, latest date in the text."""
    none = F.empty()
    stated = F.concat(*[F.coalesce(r, none) for r in (meta_raws(nodes), next_data_raws(nodes), jsonld_raws(nodes))])
    return F.coalesce(first_parsed(stated), date_from_text(text), latest_text_date(text, as_of))


@column_function
def recovered_only(nodes: Sql, text: Sql) -> Sql:
    """Further sources: any dated key of ``__NEXT_DATA__``, ``<time>``, more text shapes."""
    walk = rf"""(?i)"(?:{'|'.join(WALK_KEYS)})"\s*:\s*"([^"]+)\""""
    times = first(nodes, lambda n: (n.getField("tag") == "time") & attr(n, "datetime").isNotNull())
    none = F.empty()
    return first_parsed(F.concat(
        F.coalesce(F.regexp_extract_all(next_data(nodes), F.lit(walk), F.lit(1)), none),
        F.array(attr(times, "datetime"), *[F.regexp_extract(text, p, 0) for p in RECOVERY_DATES])))


@column_function
def recovered_date(nodes: Sql, text: Sql, as_of: Sql) -> Sql:
    """:func:`published_date`, then :func:`recovered_only`."""
    return F.coalesce(published_date(nodes, text, as_of), recovered_only(nodes, text))


def script_raws(nodes: Sql) -> Sql:
    """Date texts under one of four keys in any script."""
    pattern = r'"(?:datePublished|publishTime|releaseTime|time)"\s*:\s*"([^"]{10,})"'
    return F.transform(script_texts(nodes), lambda t: F.regexp_extract(t, pattern, 1))


def labelled_raw(texts: Sql) -> Sql:
    """``MM.dd.yyyy [HH:mm]`` of the first text that begins with a posting label."""
    shape = r"\d{2}\.\d{2}\.\d{4}(?:\s+\d{2}:\d{2})?"
    return F.regexp_extract(first(
        texts, lambda t: t.rlike(r"^(Date Posted:|Date Taken:)") & t.rlike(shape)), shape, 0)
