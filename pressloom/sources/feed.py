"""Feed rows as they arrive from a report: schemas, envelopes and page ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions.base import col

MESSAGE = T.StructType([
    T.StructField("universalMessageId", T.StringType()),
    T.StructField("snMsgId", T.StringType()),
    T.StructField("snType", T.StringType()),
    T.StructField("messageType", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("snCreatedTime", T.StringType()),
    T.StructField("snModifiedTime", T.StringType()),
    T.StructField("senderProfile", T.StructType([
        T.StructField("screenName", T.StringType()),
        T.StructField("publisherName", T.StringType()),
    ])),
    T.StructField("mediaList", T.ArrayType(T.StructType([T.StructField("type", T.StringType())]))),
    T.StructField("workflowProperties", T.StructType([T.StructField("sentiment", T.StringType())])),
])

FEED_ROW = T.StructType([
    T.StructField("ES_MESSAGE_ID_0", MESSAGE),
    T.StructField("WEB_TITLE_ES_MESSAGE_ID_2", T.StringType()),
    T.StructField("WEB_TITLE_ES_MESSAGE_ID_3", T.StringType()),
    T.StructField("MEDIA_SOURCE_NAME_3", T.StringType()),
    T.StructField("PERMALINK", T.StringType()),
    T.StructField("PERMALINK_1", T.StringType()),
    T.StructField("PERMALINK_4", T.StringType()),
    T.StructField("COUNTRY_5", T.StringType()),
])

# Top-level keys that may hold the rows of an answer, in order.
ROW_KEYS = ["rows", "tableData", "items", "result"]


def envelope_rows(body: Column | str) -> Column:
    """Rows of one JSON answer as ``array<variant>``.

    ``data.data`` when that is a list, else the first list under ``ROW_KEYS``,
    else the whole answer as one row.  NULL when the text is not JSON.
    """
    v = F.try_parse_json(col(body))
    lists = [F.try_variant_get(v, p, "array<variant>") for p in ["$.data.data", *[f"$.{k}" for k in ROW_KEYS]]]
    return F.when(v.isNotNull(), F.coalesce(*lists, F.array(v)))


def scan_envelopes(answers: DataFrame, body: str = "body") -> DataFrame:
    """One row per feed row: the other columns, its position in the answer, the row as VARIANT."""
    keep = [c for c in answers.columns if c != body]
    return answers.select(*keep, F.posexplode(envelope_rows(body)).alias("pos", "feed_row"))


def answer_pages(answers: DataFrame, body: str = "body") -> DataFrame:
    """Row count and ``hasMore`` of each answer, the input of :func:`truncate_feed`."""
    v = F.try_parse_json(F.col(body))
    listed = F.coalesce(
        *[F.try_variant_get(v, p, "array<variant>") for p in ["$.data.data", *[f"$.{k}" for k in ROW_KEYS]]]
    )
    return answers.withColumns({
        "n_rows": F.size(listed).cast("long"),
        "has_more": F.try_variant_get(v, "$.data.hasMore", "boolean"),
    })


def truncate_feed(
    pages: DataFrame, page_size: int, max_pages: int | None = None, batch: str = "batch_id", page: str = "page_no"
) -> DataFrame:
    """Keep each batch's pages up to and including its first stop page.

    A page stops the feed when ``has_more`` is false or, where that is unknown,
    when it holds no rows or fewer than ``page_size``.  The last page comes from
    an aggregate with map-side combine, so one huge batch is no bottleneck.
    """
    short = F.coalesce(F.col("n_rows") < page_size, F.lit(True))
    stop = F.coalesce(~F.col("has_more"), short)
    ends = pages.groupBy(F.col(batch).alias("_batch")).agg(
        F.min(F.when(stop, F.col(page))).alias("_stop"), F.min(page).alias("_first")
    )
    keep = F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))
    if max_pages is not None:
        keep &= F.col(page) - F.col("_first") < max_pages
    return pages.join(ends, F.col(batch).eqNullSafe(F.col("_batch"))).filter(keep).select(*pages.columns)


def part_scan(spark, path: str, skip_damaged: bool = False) -> DataFrame:
    """Rows of every part file of a folder.  A damaged file is an error, or skipped if asked for."""
    return spark.read.option("ignoreCorruptFiles", str(skip_damaged).lower()).option("mergeSchema", "true").parquet(path)
