"""Text columns: normal form, fences, segmentation, clean-up, noise lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.base import col, count_of, strip
from pressloom.functions.unicode import nfkc, unescape

# A line break goes before each of these.
SEGMENT_SENTINELS = [
    r"관련\s*기사", r"관련\s*키워드", r"関連記事", r"関連\s*キーワード",
    r"기자\b", r"記者\b", r"사진[:：]", r"제공\)?$",
    r"Photo\s*:\s*", r"Image\s*:\s*", r"Credit\s*:\s*",
]
DENSE_MAX_BREAKS = 2
DENSE_MIN_CHARS = 300

# Lines that are captions, credits or navigation.
NOISE_PATTERNS = [
    r"^\s*関連記事\s*$", r"^\s*関連キーワード\s*$", r"提供\)?$", r"^\s*写真[:：]", r"記者\s*$",
    r"관련\s*기사", r"관련\s*키워드", r"제공\)?$", r"사진[:：]?", r"기자\s*$",
    r"^\s*Related\s+Articles?\s*$", r"^\s*Related\s*$", r"Photo\s*:\s*", r"Image\s*:\s*", r"Credit\s*:\s*",
    r"^\s*(Subscribe|Recommended|Trending|Advertisement|Sponsored)\b",
]
NOISE_MAX_CHARS = 3

# The article ends where one of these begins; order matters.
BODY_SENTINELS = [
    "## IMAGE INFO", "## AUDIO INFO", "## NEWS INFO", "## GALLERY", "## MORE LIKE THIS", "About ",
    "Share:", "PUBLIC DOMAIN", "Tags:",
    "相关新闻", "相关阅读",
]
INFO_HEADER = r"(?iU)\b(?:AUDIO|NEWS|IMAGE)\s*INFO\b"
AUTHOR_LINE = r"(?md)^(By|BY|by)\s+.+$"
COPYRIGHT_TAIL = r"(?md)©.*?$"
TOGGLE_TEXT = "see less|"
MIN_ARTICLE_CHARS = 200

TAG = r"<[^>]+>"


def letters_only(text: Column) -> Column:
    """Letters and digits of an NFKC text, lower case."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))


def norm_key(text: Column | str) -> Column:
    """Comparison form: NFKC, no white space, punctuation or ``_``, lower case; '' for NULL."""
    return F.coalesce(letters_only(nfkc(col(text))), F.lit(""))


def strip_fence(text: Column | str) -> Column:
    return F.coalesce(F.regexp_replace(strip(text), r"(?U)^```(?:json)?\s*|\s*```$", ""), F.lit(""))


def _is_dense(text: Column) -> Column:
    return (count_of(text, "\n") < DENSE_MAX_BREAKS) & (F.length(text) > DENSE_MIN_CHARS)


def presegment(text: Column | str) -> Column:
    """Put caption and navigation marks on lines of their own; break dense text after sentences."""
    marked = F.regexp_replace(strip(text), f"(?iuU)(?:{'|'.join(SEGMENT_SENTINELS)})", "\n$0")
    broken = F.regexp_replace(marked, "([。！？])", "$1\n")
    broken = F.regexp_replace(broken, r"(?U)([.!?])\s+", "$1\n")
    broken = F.regexp_replace(broken, r"\n{3,}", "\n\n")
    return F.coalesce(F.when(_is_dense(marked), broken).otherwise(marked), F.lit(""))


def segment_mode(text: Column | str) -> Column:
    """``sentence`` for dense text (after segmentation), else ``paragraph``."""
    return F.when(_is_dense(col(text)), F.lit("sentence")).otherwise(F.lit("paragraph"))


def fill_prompt(template: str, body: Column | str, title: Column | str, mode: Column | str) -> Column:
    """Template with ``{body}``, then ``{title}``, then the mode line filled in.

    The title goes in second, so a ``{title}`` inside the body is replaced too.
    """
    out = F.replace(F.lit(template), F.lit("{body}"), strip(body))
    out = F.replace(out, F.lit("{title}"), F.coalesce(col(title), F.lit("")))
    return F.replace(out, F.lit('mode: "paragraph"'), F.concat(F.lit('mode: "'), col(mode), F.lit('"')))


def is_noise(line: Column | str) -> Column:
    """Blank or very short lines, captions, credits and navigation."""
    t = strip(line)
    pattern = f"(?iuU)(?:{'|'.join(NOISE_PATTERNS)})"
    return F.coalesce((F.length(t) <= NOISE_MAX_CHARS) | t.rlike(pattern), F.lit(True))


def postprocess_body(text: Column | str) -> Column:
    """Drop author lines and copyright tails, cut at info headers, then at each sentinel in turn."""
    t = F.regexp_replace(col(text), AUTHOR_LINE, "")
    t = F.regexp_replace(t, COPYRIGHT_TAIL, "")
    t = F.replace(t, F.lit(TOGGLE_TEXT), F.lit(""))
    t = F.get(F.split(t, INFO_HEADER, 2), F.lit(0))
    for sentinel in BODY_SENTINELS:
        t = F.substring_index(t, sentinel, 1)
    return strip(F.regexp_replace(t, r"\n{2,}", "\n"))


def flatten_body(content: Column | str, title: Column | str) -> Column:
    """One line without a leading copy of the title."""
    title = col(title)
    flat = F.replace(F.replace(col(content), F.lit("\\n"), F.lit("")), F.lit("\n"), F.lit(""))
    rest = F.substring(flat, F.length(title) + 1, F.length(flat))
    doubled = (F.length(title) > 0) & flat.startswith(title)
    return F.when(doubled, F.regexp_replace(rest, r"^[ :\n]+", "")).otherwise(flat)


def long_enough(content: Column | str, limit: int = MIN_ARTICLE_CHARS) -> Column:
    """The content, or NULL when it is shorter than an article."""
    return F.when(F.length(col(content)) >= limit, col(content))


def html_title(html: Column | str) -> Column:
    """Text of the first ``<title>``; '' when there is none."""
    inner = F.regexp_extract(col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.coalesce(strip(unescape(F.regexp_replace(inner, TAG, ""))), F.lit(""))


def html_to_text(html: Column | str) -> Column:
    """Plain text of a page: no scripts or styles, block ends as blank lines, entities resolved."""
    s = F.regexp_replace(col(html), r"(?is)<script\b.*?</script>", " ")
    s = F.regexp_replace(s, r"(?is)<style\b.*?</style>", " ")
    s = F.regexp_replace(s, r"(?iU)<br\s*/?>", "\n")
    s = F.regexp_replace(s, r"(?i)</(p|div|section|article|li|h[1-6]|blockquote|header|footer)>", "\n\n")
    s = unescape(F.regexp_replace(s, TAG, " "))
    s = F.regexp_replace(s, r"[ \t\r\f\x0B]+", " ")
    return F.coalesce(strip(F.regexp_replace(s, r"\n{3,}", "\n\n")), F.lit(""))


def min_fields(df, url: str = "url"):
    """Every record has its URL, trimmed non-NULL title and content, ``published`` as ISO text."""
    return df.withColumns({
        "url": F.col(url),
        "title": F.coalesce(strip("title"), F.lit("")),
        "content": F.coalesce(strip("content"), F.lit("")),
        "published": F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss"),
    })
