"""Feed normalisation: keys, first-wins deduplication, flattening, notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.base import blank_to_null, first_filled, is_filled

# Where a row's identity is looked for, in order.
MESSAGE_KEYS = ["ES_MESSAGE_ID_0", "ES_MESSAGE_ID"]
ID_FIELDS = ["universalMessageId", "snMsgId"]
LINK_KEYS = ["PERMALINK", "PERMALINK_1"]
TITLE_KEYS = ["WEB_TITLE_ES_MESSAGE_ID_2", "WEB_TITLE_ES_MESSAGE_ID"]
SOURCE_KEYS = ["MEDIA_SOURCE_NAME_3", "MEDIA_SOURCE_NAME"]

# Columns of the diagnostic dump, in order.
DUMP_COLUMNS = [
    "snType", "snMsgId", "messageType", "universalMessageId", "permalink", "WEB_TITLE_ES_MESSAGE_ID_3",
    "publisherName", "COUNTRY_5", "snCreatedTime", "snModifiedTime", "type", "sentiment",
]


def _any_of(df: DataFrame, names: list[str]) -> Column:
    present = [blank_to_null(n) for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def row_key(df: DataFrame, ignore: tuple[str, ...] = ()) -> Column:
    """Identity of a nested feed row.

    Message ids, then permalinks, then title and source together, else the whole
    row as JSON with sorted keys.  ``ignore`` names columns that are not part of
    the row (an arrival number).
    """
    ids = []
    for k in MESSAGE_KEYS:
        if k in df.columns:
            ids += [blank_to_null(f"{k}.{f}") for f in ID_FIELDS if f in df.schema[k].dataType.names]
    title, source = _any_of(df, TITLE_KEYS), _any_of(df, SOURCE_KEYS)
    whole = F.to_json(F.struct(*[c for c in df.columns if c not in ignore]))
    return F.coalesce(
        *ids,
        _any_of(df, LINK_KEYS),
        F.concat(title, F.lit("||"), source),
        F.to_json(F.parse_json(whole)),
    )


def dedup_feed(df: DataFrame, arrival: str, key: Column | None = None) -> DataFrame:
    """First arrival per key.

    ``row_number() = 1`` plans as a group limit on both sides of the exchange, so
    each task ships at most one row per key, however often a key occurs.
    """
    key = row_key(df, ignore=(arrival,)) if key is None else key
    w = Window.partitionBy("_key").orderBy(F.col(arrival))
    return (
        df.withColumn("_key", key)
        .withColumn("_n", F.row_number().over(w))
        .filter(F.col("_n") == 1)
        .drop("_key", "_n")
    )


def flatten_feed(df: DataFrame, *keep: str) -> DataFrame:
    """The 14 working columns of a nested feed row, after the columns in ``keep``."""
    es = "ES_MESSAGE_ID_0"
    return df.select(
        *keep,
        F.col(f"{es}.snType").alias("snType"),
        F.col(f"{es}.snMsgId").alias("snMsgId"),
        F.col(f"{es}.messageType").alias("messageType"),
        F.col(f"{es}.universalMessageId").alias("universalMessageId"),
        first_filled(f"{es}.permalink", "PERMALINK_4").alias("permalink"),
        F.col("WEB_TITLE_ES_MESSAGE_ID_3"),
        F.col(f"{es}.message").alias("message"),
        F.col(f"{es}.senderProfile.screenName").alias("screenName"),
        F.col(f"{es}.senderProfile.publisherName").alias("publisherName"),
        F.col("COUNTRY_5"),
        F.col(f"{es}.snCreatedTime").alias("snCreatedTime"),
        F.col(f"{es}.snModifiedTime").alias("snModifiedTime"),
        F.get(F.col(f"{es}.mediaList"), F.lit(0)).getField("type").alias("type"),
        F.col(f"{es}.workflowProperties.sentiment").alias("sentiment"),
    )


def prefilter_dump(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in DUMP_COLUMNS if c in df.columns])


def notes(source: Column | str, *parts: Column | str) -> Column:
    """``[page]`` or ``[feed]``, then the filled parts behind commas."""
    source = F.col(source) if isinstance(source, str) else source
    tag = F.when(F.lower(F.trim(source)) == "page", F.lit("[page]")).otherwise(F.lit("[feed]"))
    return F.concat_ws(",", tag, *[blank_to_null(p) for p in parts])


def article_source(feed_body: Column | str, page_body: Column | str, plain_body: Column | str) -> Column:
    """Where an article text came from: the feed, the page, or nowhere (``''``).

    Text classified straight from a page's plain text still counts as ``feed``.
    """
    return (
        F.when(is_filled(feed_body), F.lit("feed"))
        .when(is_filled(page_body), F.lit("page"))
        .when(is_filled(plain_body), F.lit("feed"))
        .otherwise(F.lit(""))
    )


def union_batches(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name, missing ones NULL."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first
