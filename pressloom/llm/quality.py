"""Quality rules: base rules, and a hashed n-gram log-likelihood ratio.

Words and pairs of words fall into ``buckets`` hash buckets.  One multinomial is
counted over trusted documents, one over the whole corpus; a document's score is
the mean, over its n-grams, of log p(bucket | trusted) - log p(bucket | corpus).
The trusted multinomial is smoothed with as much weight of the corpus', so an
n-gram never seen among the trusted counts log 1/2 and not minus infinity.  A
document is kept if it passes the base rules and its score reaches ``threshold``,
the same for every document; nothing is drawn at random.

DataFrame functions only.  The corpus is counted in one pass with partial sums per
task; the weights, one number per bucket, travel as a literal of the second pass.

Rows: a null or empty text has no words, fails the base rules and scores 0.
Repeated rows count as often as they stand; other columns are passed on, those
named like a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.stages import free_name

# The bound of the trusted sample: so many ids at most are broadcast.
TRUSTED_DOCS = 20_000
BUCKETS = 10_000
THRESHOLD = -0.025
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\x09-\\x0D]+"), lambda w: w != "")


def repeat_words(tokens: Column, n: Column) -> Column:
    """Words in 3-word windows that stand twice or more: sorted window hashes bring equal ones side by side."""
    windows = F.transform(F.slice(tokens, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w, i: F.struct(F.xxhash64(w, F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("h"), i.alias("p")))
    return F.array_sort(windows)


def with_measures(docs: DataFrame, tokens: str) -> DataFrame:
    """``docs`` with the base measures and the words in the column ``tokens``."""
    found, windows, at = (free_name(docs, n) for n in ("_lines", "_windows", "_places"))
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    out = docs.withColumn(tokens, words(text)).withColumns(
        {
            "n_words": F.size(tokens).cast("long"),
            "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            found: lines,
        }
    )
    out = out.withColumns(
        {
            "n_dup_lines": (F.size(found) - F.size(F.array_distinct(found))).cast("long"),
            windows: repeat_words(F.col(tokens), F.size(tokens)),
        }
    ).drop(found)
    sorted_windows = F.col(windows)
    again = F.filter(sorted_windows, lambda x, i: (F.get(sorted_windows, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(sorted_windows, i - 1)["h"] == x["h"])))
    out = out.withColumn(at, F.array_sort(F.transform(again, lambda x: x["p"]))).drop(windows)
    places = F.col(at)
    covered = F.aggregate(F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    out = out.withColumn("n_repeat_words", covered.cast("long")).drop(at)
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def ngram_buckets(tokens: Column, buckets: int) -> Column:
    """Buckets of a text's lower-cased words and pairs of words."""
    ones = F.transform(tokens, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    pairs = F.transform(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))), lambda w, i: F.pmod(F.xxhash64(w, F.get(tokens, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(ones, pairs)


def bucket_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, trusted_docs: int = TRUSTED_DOCS) -> list[float]:
    """log p(bucket | trusted) - log p(bucket | corpus) of every bucket.

    ``trusted``: rows with the doc_id of trusted documents; the ``trusted_docs``
    ids with the lowest hashes are used, all of them if there are fewer.
    """
    ids = trusted.select(F.col("doc_id").alias("_id")).filter("_id IS NOT NULL").distinct()
    ids = F.broadcast(ids.orderBy(F.xxhash64("_id"), "_id").limit(trusted_docs))
    marked = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id"), "left")
    lower = marked.select(F.col("_id").isNotNull().cast("long").alias("_trusted"), words(F.lower(F.coalesce(F.col("text"), F.lit("")))).alias("_words"))
    seen = lower.select("_trusted", F.explode(ngram_buckets(F.col("_words"), buckets)).alias("bucket"))
    counts = seen.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("_trusted").alias("t"))
    rows = {r["bucket"]: (r["n"], r["t"]) for r in counts.collect()}  # a row per bucket at most
    corpus, target = sum(n for n, _ in rows.values()), sum(t for _, t in rows.values())
    out = [0.0] * buckets
    for b, (n, t) in rows.items():
        if target:
            out[b] = math.log((t / target + n / corpus) / 2) - math.log(n / corpus)
    return out


def with_quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with the base measures, base_failed, score and kept."""
    rows = docs.drop(*[c for c in docs.columns if c.lower() in MEASURES])
    weights = F.split(F.lit(",".join(f"{w:.6f}" for w in bucket_weights(rows, trusted, buckets))), ",").cast("array<double>")
    tokens, grams = free_name(docs, "_words"), free_name(docs, "_grams")
    # a column of its own: an expression inside the lambda would be worked out for every element
    out = with_measures(rows, tokens).withColumn(tokens, F.transform(tokens, F.lower))
    out = out.withColumn(grams, ngram_buckets(F.col(tokens), buckets)).drop(tokens)
    mean = F.aggregate(F.col(grams), F.lit(0.0), lambda a, b: a + F.get(weights, b)) / F.size(grams)
    out = out.withColumn("score", F.when(F.size(grams) > 0, F.round(mean, 9)).otherwise(0.0)).drop(grams)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
