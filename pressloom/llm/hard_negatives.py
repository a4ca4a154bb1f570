"""Hard-negative mining by coordinate pruning over length buckets.

Vectors are quantised to integers; a row's score is its inner product with an anchor.
Rows are dealt into shards of bounded size, anchors into slices of bounded size, and a
task holds one shard and one slice.  It sorts its rows by length into buckets.  A score
of at least s asks for a cosine of at least ``s / (|anchor| * longest of the bucket)``,
so short buckets are passed over whole.  In the others every coordinate has a sorted
list of the unit vectors' values: from an anchor's largest (focus) coordinates follow
ranges that a row with such a cosine must lie in.  The ranges of the sorted lists are
intersected and what is left is scored exactly.  The bound rises as better rows are
found.  Bounds are computed in doubles and widened by SLACK; scores are integers.

First the positives of every anchor are found among the rows of its label, then, for
each positive, the best rows of other labels whose score lies between ``low`` and
``high`` hundredths of the positive's.  Each task returns its best rows only, and these
are ranked per anchor.

Rows: a null label, a null or empty vector and null or non-finite components take no
part.  Vectors of different lengths have no score together.  A null vec_id is no anchor
and comes last among equal scores.  Repeated rows are rows of their own, as anchors,
positives and negatives.  Scores beyond 64 bits are ranked exactly within a task and
returned as the nearest long.  Other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.stages import staged

LAST_ID = (1 << 63) - 1
SHARD_ROWS, SLICE_ROWS = 8192, 2048
# A bucket ends where lengths fall below this share of its longest, but holds some rows at least.
BUCKET_SHARE, BUCKET_ROWS = 0.9, 128
FOCUS, SLACK = 6, 1e-9


def integers(vectors: pd.Series, scale: int) -> np.ndarray:
    """floor(scale * x) of all components; Python integers where components are so large that a product may pass 64 bits."""
    plain = np.stack(vectors.to_numpy()).astype(np.float64)
    if np.abs(plain).max() * scale < 2.0**31 / np.sqrt(plain.shape[1]):
        return np.floor(plain * scale).astype(np.int64)
    # a double beyond 2**53 is an integer, so that its product needs no floor
    exact = [[int(x) * scale if abs(x) > 2.0**53 else math.floor(x * scale) for x in row] for row in plain.tolist()]
    return np.array(exact, dtype=object)


class Bucket:
    """Rows of about one length: unit vectors by coordinate, and each coordinate's values in order."""

    def __init__(self, rows: np.ndarray, whole: np.ndarray, length: np.ndarray):
        self.rows, self.longest = rows, float(length.max())
        self.unit = np.ascontiguousarray((whole.astype(np.float64) / np.maximum(length, 1e-300)[:, None]).T)
        self.places = self.unit.argsort(axis=1, kind="stable")
        self.values = np.take_along_axis(self.unit, self.places, 1)

    def candidates(self, unit: np.ndarray, length: float, focus: np.ndarray, least: float) -> np.ndarray:
        """Rows that may score ``least`` or more with the vector ``length * unit``."""
        if least <= 0:
            return self.rows
        most = length * self.longest
        if most * (1 + SLACK) < least:
            return self.rows[:0]
        # a row within the angle `turn` of the vector has each coordinate within `turn` of the vector's own angle to that axis
        turn = np.arccos(min(1.0, max(-1.0, least / most - SLACK)))
        own = np.arccos(np.clip(unit[focus], -1, 1))
        low, high = np.cos(np.minimum(np.pi, own + turn)) - SLACK, np.cos(np.maximum(0, own - turn)) + SLACK
        starts = [self.values[f].searchsorted(x, side="left") for f, x in zip(focus, low)]
        stops = [self.values[f].searchsorted(x, side="right") for f, x in zip(focus, high)]
        by_size = np.argsort(np.subtract(stops, starts), kind="stable")
        k = by_size[0]
        found = self.places[focus[k]][starts[k] : stops[k]]
        for k in by_size[1:]:
            value = self.unit[focus[k]][found]
            found = found[(value >= low[k]) & (value <= high[k])]
        return self.rows[found]


class Index:
    """A shard: its integer vectors, the rows' ids and labels, and buckets from long to short."""

    def __init__(self, whole: np.ndarray, ids: np.ndarray):
        self.whole, self.ids = whole, ids
        plain = whole.astype(np.float64)
        length = np.sqrt((plain * plain).sum(1))
        order = np.argsort(-length, kind="stable")
        self.buckets, first = [], 0
        while first < len(order):
            falling = -length[order[first:]]
            stop = first + max(BUCKET_ROWS, int(np.searchsorted(falling, -BUCKET_SHARE * length[order[first]], side="right")))
            rows = order[first:stop]
            self.buckets.append(Bucket(rows, whole[rows], length[rows]))
            first = stop

    def search(self, vector: np.ndarray, allowed: np.ndarray, ranges: list[tuple[int | None, int | None]], wanted: int) -> list[list[tuple[int, int]]]:
        """For each range (least, most; None: open), the first ``wanted`` of the allowed rows whose score lies in it, as (score, row).

        Python integers may pass what doubles bound, so with them every row is scored.
        """
        exact = object in (vector.dtype, self.whole.dtype)
        vector, whole = (vector.astype(object), self.whole.astype(object)) if exact else (vector, self.whole)
        plain = vector.astype(np.float64)
        length = float(np.sqrt((plain * plain).sum()))
        unit = plain / length if length else plain
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        best: list[list[tuple[int, int]]] = [[] for _ in ranges]
        bounds = [float("-inf") if least is None else least for least, _ in ranges]
        for bucket in self.buckets:
            rows = bucket.candidates(unit, length, focus, float("-inf") if exact else min(bounds))
            rows = rows[allowed[rows]]
            if not len(rows):
                continue
            scores = whole[rows] @ vector
            for k, (_, most) in enumerate(ranges):
                fits = scores >= bounds[k]
                if most is not None:
                    fits &= scores <= most
                if fits.any():
                    some, its = rows[fits], scores[fits]
                    order = np.lexsort((self.ids[some], -its))[:wanted]
                    best[k] = sorted(best[k] + list(zip(its[order].tolist(), some[order].tolist())), key=lambda x: (-x[0], self.ids[x[1]]))[:wanted]
                    if len(best[k]) == wanted:
                        bounds[k] = best[k][-1][0]
        return best


def as_long(score: int) -> int:
    return max(-LAST_ID - 1, min(LAST_ID, int(score)))


def cells(rows: DataFrame, anchors: DataFrame, by: list[str], shard_rows: int, slice_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors with the number of their cell (``by``, shard, slice): every anchor meets every row that agrees in ``by`` in one cell."""
    held = rows.groupBy(*by).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / shard_rows)).alias("shards"))
    asked = anchors.groupBy(*by).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / slice_rows)).alias("slices"))
    grid = held.join(asked, by)
    shard, slice_ = F.pmod(F.xxhash64("row"), F.col("shards")), F.pmod(F.xxhash64("row"), F.col("slices"))
    there = rows.join(grid, by).withColumns({"shard": shard, "slice": F.explode(F.sequence(F.lit(0), F.col("slices") - 1))})
    asking = anchors.join(grid, by).withColumns({"slice": slice_, "shard": F.explode(F.sequence(F.lit(0), F.col("shards") - 1))})
    asking = asking.drop("shards", "slices")
    return there.drop("shards", "slices"), asking.toDF(*asking.columns)  # columns of its own, both come from one table


def mine_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, shard_rows: int = SHARD_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of ``vectors`` (vec_id, embedding, label).

    ``anchor``: which rows are anchors.  A negative's score is at least ``low`` and at
    most ``high`` hundredths of its positive's; of these the first ``negatives`` are returned.
    """
    x = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label", F.coalesce(anchor, F.lit(False)).alias("asks"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = x.filter(F.col("label").isNotNull() & F.coalesce((F.size("v") > 0) & ~bad, F.lit(False)))
    rows = fine.select("label", F.size("v").alias("dim"), F.coalesce("id", F.lit(LAST_ID)).alias("id"), F.col("id").isNotNull().alias("named"), "asks", "v")
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    anchors = rows.filter("asks AND named")
    by_label, by_dim = ["label", "dim", "shard", "slice"], ["dim", "shard", "slice"]

    def found(asked: pd.DataFrame, held: pd.DataFrame, same_label: bool) -> Iterator[tuple]:
        index = Index(integers(held["v"], scale), held["id"].to_numpy())
        own, labels = held["row"].to_numpy(), held["label"].to_numpy()
        for number, vector in enumerate(integers(asked["v"], scale)):
            a = asked.iloc[number]
            if same_label:
                ranges = [(None, None)]
                allowed = own != a["row"]
            else:
                scores = [int(p["score"]) for p in a["positives"]]
                ranges = [(-(-low * s // 100), high * s // 100) for s in scores]
                allowed = labels != a["label"]
            for k, best in enumerate(index.search(vector, allowed, ranges, positives if same_label else negatives)):
                for score, row in best:
                    yield int(a["row"]), k, as_long(score), int(index.ids[row]), int(own[row])

    def frame(out: Iterator[tuple]) -> pd.DataFrame:
        return pd.DataFrame(list(out), columns=["anchor", "k", "score", "id", "row"])

    result = "anchor long, k int, score long, id long, row long"
    there, asking = cells(rows.select("label", "dim", "row", "id", "v"), anchors.select("label", "dim", "row", "v"), by_label[:2], shard_rows, slice_rows)
    near = asking.groupBy(*by_label).cogroup(there.groupBy(*by_label)).applyInPandas(lambda a, b: frame(found(a, b, True) if len(a) and len(b) else iter(())), result)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row"))
    near = near.withColumn("place", place).filter(F.col("place") <= positives)
    chosen = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "score", "id"))).alias("positives"))  # `positives` elements at most
    asked = staged(anchors.join(chosen, anchors["row"] == chosen["anchor"]).select("row", "id", "label", "dim", "v", "positives"), "anchors")

    there, asking = cells(rows.select("label", "dim", "row", "id", "v"), asked.select("label", "dim", "row", "v", "positives"), by_dim[:1], shard_rows, slice_rows)
    far = asking.groupBy(*by_dim).cogroup(there.groupBy(*by_dim)).applyInPandas(lambda a, b: frame(found(a, b, False) if len(a) and len(b) else iter(())), result)
    rank = F.row_number().over(Window.partitionBy("anchor", "k").orderBy(F.desc("score"), "id", "row"))
    far = far.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    out = far.join(asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "positives"), "anchor")
    positive = F.get("positives", F.col("k"))
    return out.select(
        "anchor_id",
        F.nullif(positive["id"], F.lit(LAST_ID)).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.nullif("id", F.lit(LAST_ID)).alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.id)::INTEGER AS rank,
             s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON p.place <= 5 AND p.anchor_id = s.anchor_id AND NOT s.same AND s.score * 100 BETWEEN 80 * p.score AND 100 * p.score)
SELECT * FROM n WHERE rank <= 5
"""
