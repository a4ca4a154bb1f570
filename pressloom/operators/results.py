"""Results of user extractors in any of their shapes, as one kind of record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.functions.lines import first_text


def extractor_records(results: DataFrame, value: str = "result", url: str = "url") -> DataFrame:
    """``url, title, published, content`` of results that are text, HTML, a JSON object or a JSON list.

    ``content`` is the first usable text; ``title`` and ``published`` come from an
    object (or a list's first object) that has them, else they are '' and NULL.
    """
    parsed = F.try_parse_json(F.col(value))

    def field(name: str):
        return F.coalesce(F.try_variant_get(parsed, f"$.{name}", "string"), F.try_variant_get(parsed, f"$[0].{name}", "string"))

    return results.select(
        F.col(url).alias("url"), F.coalesce(field("title"), F.lit("")).alias("title"), field("published").alias("published"),
        first_text(value).alias("content"),
    )
