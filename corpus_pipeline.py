"""The corpus pipeline: documents, stage by stage, to token ids.

Every stage takes the documents that its predecessor kept and returns documents with
the same columns; the last adds the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.bpe import decode_bpe, encode_bpe
from pressloom.llm.mixing import emit_copies, mix_sources
from pressloom.llm.ngram_join import drop_near_copies
from pressloom.llm.queries import RANKS
from pressloom.llm.substring_dedup import remove_repeats
from pressloom.llm.toxicity import REJECT_FROM, fit_toxicity, with_toxicity
from pressloom.session import drop_folders, made_folders, staged
from pressloom.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return with_toxicity(docs, model).filter(F.col("score") < REJECT_FROM).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that shares at least 0.8 of its five-word shingles, the smallest doc_id stays."""
    return drop_near_copies(docs, size=5, num=80, den=100).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 20 words that stand earlier are cut out of the texts."""
    cut = remove_repeats(docs, 20)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return emit_copies(mix_sources(docs)).select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids and the text that they decode to."""
    coded = decode_bpe(encode_bpe(docs.select(*COLUMNS), RANKS), RANKS)
    return coded.withColumn("text", F.col("decoded").cast("string")).select(*COLUMNS, "ids")


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing", mix),
    ("byte-level BPE", bpe),
]
# The toxicity stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other.  What a stage wrote for itself goes once its result is written, and so does its input."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with made_folders() as made:
            docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        drop_folders(spark, [*before, *made[:-1]])
        before = made[-1:]
    return docs
