"""Line-level clean-up of captions, news stories and photo pages."""

from __future__ import annotations

from pressloom.functions.sqltext import F, Sql, column_function, filled, let, strip

# Markers and line patterns of the wire-service pages.
NEWS_INFO = r"(?iU)\bNEWS\s*INFO\b"
AUDIO_INFO = r"(?iU)\bAUDIO\s*INFO\b"
SHARE_LABEL = r"(?iU)share\s*:\s*"
RELATED_NEWS = r"(?U)相关新闻\s*[:：]"
BYLINE = r"(?i)^(Story by|By)\b"
COURTESY = r"(?i)\bCourtesy Photo\b"
ALL_CAPS = r"^(MANILA|[A-Z][A-Z ,\-]+)$"
DAY_ROW = r"\b\d{2}\.\d{2}\.\d{4}\b"
UI_LINE = r"(?i)^(Subscribe\b|✔|✗|Web Views:|Downloads:|PUBLIC DOMAIN)"
UI_WORDS = ["read more", "View Image Page", "50"]
SCRIPT_NOTICE = "works best with JavaScript enabled"
HUB_NOTICE = "DVIDS Hub works best with JavaScript enabled"
TOGGLE = "see less|"
DATELINE = r"[A-Z][A-Za-z .'()/-]+,\s*[A-Za-z .'()/-]+(?:,\s*[A-Za-z .'()/-]+)?\s—\s"
COURTESY_BLOCK = r"(?is)Courtesy Photo\b.*?(?:see less\||read more|View Image Page|\z)"
CAPTION = r"(U\.S\..+?)(?:\s*\(U\.S\. .*?video by .+?\)|U\.S\. .*?video by .+?\))"
AUDIO_CHROME = r"(?i)^(show more|UNITED STATES|Audio by|Subscribe\b|\d{2}\.\d{2}\.\d{4}|Defense Media Activity)"
EMBED_HELP = ["Advanced Embed Example", "video size:"]
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
SKIP_AFTER_BYLINE = 2
LONG_CAPTION, LONG_LINE, DASH_LINE, MIN_STORY = 200, 140, 40, 120


@column_function
def before_marker(text: Sql, marker: str) -> Sql:
    """Text before the first match of ``marker``, trimmed; the whole text when there is none."""
    return strip(F.get(F.split(text, marker, 2), F.lit(0)))


@column_function
def lines_of(text: Sql) -> Sql:
    """Trimmed, non-blank lines."""
    return F.filter(F.transform(F.split(text, LINE_BREAK), strip), lambda s: s != "")


@column_function
def skip_after_byline(lines: Sql) -> Sql:
    """A byline drops itself and the next two lines; dropped lines start no new skip."""
    start = F.struct(F.lit(0).alias("skip"), F.empty().alias("kept"))

    def step(acc: Sql, line: Sql) -> Sql:
        skip, kept = acc.getField("skip"), acc.getField("kept")
        left = F.when(skip > 0, skip - 1).when(line.rlike(BYLINE), F.lit(SKIP_AFTER_BYLINE)).otherwise(F.lit(0))
        keep = (skip == 0) & ~line.rlike(BYLINE)
        return F.struct(left.alias("skip"), F.when(keep, F.concat(kept, F.array(line))).otherwise(kept).alias("kept"))

    return F.aggregate(lines, start, step).getField("kept")


@column_function
def is_dropped_line(line: Sql, title: Sql) -> Sql:
    """Title copies, courtesy and date rows, capital place names, interface words, long captions."""
    caption = (F.length(line) > LONG_CAPTION) & F.contains(line, F.lit("(")) & line.endswith(")") & ~F.contains(
        line, F.lit(" — "))
    return (
        F.coalesce(line == title, F.lit(False)) | line.rlike(COURTESY) | line.rlike(ALL_CAPS) | line.rlike(DAY_ROW)
        | line.rlike(UI_LINE) | line.isin(UI_WORDS) | F.contains(line, F.lit(SCRIPT_NOTICE)) | caption
    )


@column_function
def start_at_dateline(lines: Sql) -> Sql:
    """Lines from the first dateline, else from the first sentence-like line, else all."""
    dateline = lambda s: F.contains(s, F.lit(" — ")) & F.contains(F.substring_index(s, " — ", 1), F.lit(","))
    sentence = lambda s: (
        s.rlike(r"[.!?]$") | (F.contains(s, F.lit("—")) & (F.length(s) > DASH_LINE)) | (F.length(s) > LONG_LINE)
    )
    first = lambda test: F.nullif(F.array_position(F.transform(lines, test), True), F.lit(0).cast("bigint"))
    place = F.coalesce(first(dateline), first(sentence), F.lit(1).cast("bigint")).cast("int")
    return F.slice(lines, place, F.greatest(F.size(lines), F.lit(1)))


def drop_leading(text: Sql, title: Sql) -> Sql:
    """Text without a copy of the title in front and the colons, blanks or breaks after it."""
    rest = F.regexp_replace(F.substring(text, F.length(title) + 1, F.length(text)), r"^[ :\n]+", "")
    return F.when(F.coalesce((F.length(title) > 0) & text.startswith(title), F.lit(False)), rest).otherwise(text)


@column_function
def story_body(raw: Sql, title: Sql) -> Sql:
    """Body of a wire-service story, or NULL when it is too short to be one."""
    def without_courtesy(t: Sql) -> Sql:
        place = F.instr(t, " — ")
        head = F.when(place > 0, F.substring(t, F.lit(1), place - 1)).otherwise(t)
        tail = F.when(place > 0, F.substring(t, place, F.length(t))).otherwise(F.lit(""))
        return F.concat(F.regexp_replace(head, COURTESY_BLOCK, ""), tail)

    t = let(before_marker(raw, NEWS_INFO), lambda x: drop_leading(x, title))
    t = F.replace(F.replace(t, F.lit(HUB_NOTICE), F.lit("")), F.lit(TOGGLE), F.lit(" "))
    t = let(t, without_courtesy)
    t = let(t, lambda x: F.coalesce(filled(F.regexp_extract(x, f"(?s){DATELINE}.*", 0)), x))
    kept = F.filter(skip_after_byline(lines_of(t)), lambda s: ~is_dropped_line(s, title))
    joined = strip(F.array_join(let(kept, start_at_dateline), "\n"))
    return let(joined, lambda b: F.when(F.length(b) > MIN_STORY, b))


@column_function
def photo_caption(text: Sql) -> Sql:
    """Photo caption without share labels, download links and trailing bars."""
    t = before_marker(F.replace(text, F.lit("\u00a0"), F.lit(" ")), SHARE_LABEL)
    t = F.regexp_replace(t, r"(?iU)\b(?:Download|Downloads?)\s*:\s*.*$", "")
    t = F.regexp_replace(t, r"(?iU)\bFull\s*Size\b\s*\([^)]*\)", "")
    return filled(strip(F.regexp_replace(t, r"(?U)\s*\|\s*$", "")))


@column_function
def caption_pattern(text: Sql) -> Sql:
    """Video caption with its credit, found by pattern in the whole text; NULL when there is none."""
    return filled(F.regexp_extract(text, CAPTION, 0))
