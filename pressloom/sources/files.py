"""File sources: media master CSV, URL lists, raw page bytes."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions.base import col, literal_table
from pressloom.functions.urls import is_web_url, url_host

# Header names of the media master.
MASTER_URL, MASTER_OFFICIAL, MASTER_COUNTRY, MASTER_SOURCE = "URL", "オフィシャル度", "国", "資料源"
MASTER_SCHEMA = f"`{MASTER_URL}` string, `{MASTER_OFFICIAL}` string, `{MASTER_COUNTRY}` string, `{MASTER_SOURCE}` string"

# Where a page's own charset is looked for by default: its first bytes.
CHARSET_SCAN_BYTES = 2048
# Fixed values.
UTF8_NAMES = ["utf-8", "utf8", "us-ascii", "ascii"]
LATIN1_NAMES = ["iso-8859-1", "latin-1", "latin1", "iso8859-1", "iso_8859-1"]


def read_media_master(spark: SparkSession, path: str) -> DataFrame:
    """The master as ``ord, url, host, official, country, source``.

    ``ord`` orders rows as the files do: file, block start, then position, which
    the scan numbers in rising order inside each block.
    """
    raw = spark.read.schema(MASTER_SCHEMA).option("header", "true").option("multiLine", "false").csv(path)
    order = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return raw.select(
        order.alias("ord"),
        F.col(f"`{MASTER_URL}`").alias("url"),
        url_host(f"`{MASTER_URL}`").alias("host"),
        F.col(f"`{MASTER_OFFICIAL}`").alias("official"),
        F.col(f"`{MASTER_COUNTRY}`").alias("country"),
        F.col(f"`{MASTER_SOURCE}`").alias("source"),
    )


def read_url_list(
    spark: SparkSession, paths: Iterable[str] = (), urls: Iterable[str] = (), default: str | None = None
) -> DataFrame:
    """One trimmed, non-blank URL per row from text files and literal URLs; ``default`` when none is given."""
    paths, urls = list(paths), [u.strip() for u in urls]
    if not paths and not urls:
        urls = [default] if default else []
    parts = []
    if paths:
        line = F.trim(F.regexp_replace("value", r"\r$", ""))
        parts.append(spark.read.text(paths).select(line.alias("url")).filter(F.col("url") != ""))
    if urls or not parts:
        parts.append(literal_table(spark, [(u,) for u in urls], "url string").filter(is_web_url("url")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def header_guess(content_type: Column | str) -> Column:
    """What HTTP holds of a text without a charset: ISO-8859-1.  NULL for other types."""
    return F.when(F.contains(F.lower(col(content_type)), F.lit("text")), F.lit("iso-8859-1"))


def bytes_guess(raw: Column | str) -> Column:
    """By the byte order mark, else UTF-8 where the bytes are valid as that, else NULL."""
    raw = col(raw)
    mark = F.hex(F.substring(raw, 1, 3))
    marked = F.when(mark == "EFBBBF", F.lit("utf-8-sig")).when(mark.startswith("FFFE") | mark.startswith("FEFF"), F.lit("utf-16"))
    return F.coalesce(marked, F.when(F.is_valid_utf8(raw.cast("string")), F.lit("utf-8")))


def page_charset(raw: Column | str, content_type: Column | str, guess: Column | None = None, scan_bytes: int = CHARSET_SCAN_BYTES) -> Column:
    """Charset of a page: the header's, else the one in its first ``scan_bytes``, else a guess, else UTF-8.

    The guess is the header's by default; ``bytes_guess`` looks at the page instead.
    """
    head = F.decode(F.substring(col(raw), 1, scan_bytes), "ISO-8859-1")
    header = F.regexp_extract(col(content_type), r"(?i)charset\s*=\s*([A-Za-z0-9_\-]+)", 1)
    inside = F.regexp_extract(head, r"""(?i)charset=['"]?\s*([A-Za-z0-9_\-]+)""", 1)
    guess = header_guess(content_type) if guess is None else guess
    return F.lower(F.coalesce(F.nullif(header, F.lit("")), F.nullif(inside, F.lit("")), guess, F.lit("utf-8")))


@F.pandas_udf(T.StringType())
def _decode_other(raw: pd.Series, charset: pd.Series) -> pd.Series:
    """Charsets Spark's ``decode`` does not take; unknown names fall back to UTF-8."""

    def one(data: bytes | None, name: str) -> str | None:
        if data is None:
            return None
        try:
            return bytes(data).decode(name, errors="replace")
        except LookupError:
            return bytes(data).decode("utf-8", errors="replace")

    return pd.Series([one(d, n) for d, n in zip(raw, charset)], dtype=object)


def decode_pages(pages: DataFrame, raw: str = "raw", content_type: str = "content_type", guess: Column | None = None) -> DataFrame:
    """Add ``charset`` and ``html``; bytes that do not decode become U+FFFD.  ``guess``: see ``page_charset``.

    One scan.  UTF-8 and Latin-1 are decoded in the JVM; of such pages Python gets no bytes.
    """
    named = pages.withColumn("charset", page_charset(raw, content_type, guess))
    common = F.col("charset").isin(UTF8_NAMES + LATIN1_NAMES)
    named = named.withColumn("_other", _decode_other(F.when(~common, F.col(raw)), "charset"))
    html = F.when(F.col("charset").isin(LATIN1_NAMES), F.decode(raw, "ISO-8859-1")).when(
        F.col("charset").isin(UTF8_NAMES), F.make_valid_utf8(F.col(raw).cast("string"))
    )
    return named.withColumn("html", html.otherwise(F.col("_other"))).drop("_other")
