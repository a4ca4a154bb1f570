"""URL columns, all plain regular expressions (``parse_url`` raises on bad input)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.base import col

# Suffixes under which sites publish light-weight page variants.
AMP_SUFFIXES = ["/amp", "/amp/", "?amp", "?amp=1", ".amp", ".amp.html", "?mode=amp"]
AMP_HTML_HOST = "nytimes.com"

FRAGMENT = r"#(.*)$"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_AUTHORITY = _SCHEME + r"//([^/?#]*)"


def authority(url: Column | str) -> Column:
    return F.regexp_extract(col(url), _AUTHORITY, 1)


def url_host(url: Column | str) -> Column:
    """Lower-case authority without one leading ``www.``; '' for NULL or bad input."""
    return F.coalesce(F.regexp_replace(F.lower(authority(url)), r"^www\.", ""), F.lit(""))


def scrape_domain(url: Column | str) -> Column:
    """Authority with every ``www.`` removed, case kept: the key of the rule table."""
    return F.replace(authority(url), F.lit("www."), F.lit(""))


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(col(url), _SCHEME + r"//[^/?#]*([^?#]*)", 1)


def url_fragment(url: Column | str) -> Column:
    return F.regexp_extract(col(url), FRAGMENT, 1)


def is_web_url(url: Column | str) -> Column:
    return F.coalesce(col(url).rlike(r"^https?://"), F.lit(False))


def host_suffixes(host: Column | str) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``."""
    labels = F.split(col(host), r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def _drop_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(
            part == "..",
            F.when(F.size(acc) > 1, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(acc),
        )
        .when(part == ".", acc)
        .otherwise(F.concat(acc, F.array(part))),
    )
    joined = F.array_join(kept, "/")
    joined = F.when(last.isin(".", "..") & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), joined).otherwise(path)


def resolve_url(base: Column | str, ref: Column | str) -> Column:
    """Resolve ``ref`` against ``base``: absolute, ``//host``, ``/path``, ``?query``, ``#part`` or relative."""
    base, ref = col(base), col(ref)
    scheme = F.regexp_extract(base, _SCHEME, 0)
    origin = F.regexp_extract(base, _SCHEME + r"//[^/?#]*", 0)
    path = url_path(base)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"^(.*/)[^/]*$", 1))
    ref_path = F.regexp_extract(ref, r"^[^?#]*", 0)
    ref_tail = F.regexp_extract(ref, r"[?#].*$", 0)
    return (
        F.when(ref.rlike(_SCHEME), ref)
        .when(ref == "", base)
        .when(ref.startswith("//"), F.concat(scheme, ref))
        .when(ref.startswith("/"), F.concat(origin, _drop_dot_segments(ref_path), ref_tail))
        .when(ref.startswith("?"), F.concat(origin, path, ref))
        .when(ref.startswith("#"), F.concat(origin, path, query, ref))
        .otherwise(F.concat(origin, _drop_dot_segments(F.concat(folder, ref_path)), ref_tail))
    )


def amp_candidates(url: Column | str) -> Column:
    """Ordered candidate URLs of a page's light-weight variant, without repeats."""
    url = col(url)
    origin = F.regexp_extract(url, _SCHEME + r"//[^/?#]*", 0)
    path = url_path(url)
    base = F.concat(origin, F.regexp_replace(path, r"/+$", ""))
    common = F.array(*[F.concat(base, F.lit(suffix)) for suffix in AMP_SUFFIXES])
    special = F.array(
        F.concat(origin, F.replace(path, F.lit(".html"), F.lit(".amp.html"))),
        F.concat(base, F.lit("?outputType=amp")),
    )
    both = F.when(
        authority(url).endswith(AMP_HTML_HOST) & path.endswith(".html"), F.concat(special, common)
    ).otherwise(common)
    return F.array_distinct(both)
