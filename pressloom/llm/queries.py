"""The llm queries and the SQL that SQL can give for them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import chat, exact_dedup, hard_negatives, mixing
from pressloom.llm.bpe import bpe_digests
from pressloom.llm.chat import chat_digests
from pressloom.llm.embedding_dedup import embedding_components
from pressloom.llm.exact_dedup import mark_copies
from pressloom.llm.hard_negatives import mine_negatives
from pressloom.llm.mixing import mix_sources
from pressloom.llm.ngram_join import jaccard_components
from pressloom.llm.periodic_runs import run_digests, with_planted_cycles
from pressloom.llm.quality import with_quality
from pressloom.llm.sharding import shard_digests
from pressloom.llm.substring_dedup import repeat_digests
from pressloom.llm.toxicity import toxicity_scores
from pressloom.llm.token_files import token_file_digests
from pressloom.sources.tables import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digests(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), RANKS)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    scored = with_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), trusted)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_digests(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(with_planted_cycles(table(spark, sf_dir, "documents")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_toxicity,
        op3_ngram_join,
        op4_token_files,
        op5_bpe,
        op6_mixing,
        op7_substring_dedup,
        op8_quality,
        op9_embedding_dedup,
        op10_chat,
        op11_periodic_runs,
        op12_exact_dedup,
        op13_hard_negatives,
    )
}
SQL: dict[str, str] = {"op6_mixing": mixing.SQL, "op10_chat": chat.SQL, "op12_exact_dedup": exact_dedup.SQL, "op13_hard_negatives": hard_negatives.SQL}
