"""Near-duplicates among embeddings with hierarchical navigable small-world graphs.

Vectors of one label (and dimension) are dealt into shards by a hash of their id; each
shard is one graph.  Every vector queries every shard of its label: a beam search finds
the way in, then the search goes on from every point it has met that reaches the
threshold, along all neighbours that do.  The audit of a pair of shards compares vectors
in random order with all points, until enough with links and enough groups of them
are known; while the beam misses too many of theirs it is doubled, and a beam as wide as
the shard compares with all.  What the audit has seen is added to what the searches
found, so links too sparse for a small audit are not lost either.  Cosines are computed
in double precision, so no pair below the threshold links; what the search may miss is
bounded by the audit.  Linked vectors are united.

Equal vectors of a label are one point of the graph, with a count.  A task holds one
graph and the points of another shard, whatever the label's size; of the links it
reports a count and one tie per vector, not all pairs.

Rows: vectors that are null, empty, zero or hold null or non-finite components, and those
without a label, link with nothing.  A null vec_id counts as 2**63-1.  Repeated rows are
vectors of their own.  Other columns are not used.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import cached_property
from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.arrays import lean
from pressloom.llm.components import components
from pressloom.llm.stages import staged

LAST_ID = (1 << 63) - 1
SHARD_ROWS = 8192
NEIGHBOURS, WIDEST_LEVEL = 12, 8
BUILD_BEAM, FIRST_BEAM = 40, 16
AUDITED, AUDIT_BLOCK, WANTED_RECALL = 48, 256, 0.98


class Graph:
    """A shard's graph.  ``links[level][i]``: neighbours of point i; level 0 holds all points, each with twice the neighbours."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.links: list[dict[int, list[int]]] = []
        self.entry = -1

    @classmethod
    def build(cls, points: np.ndarray, seed: int) -> Graph:
        out = cls(points)
        levels = np.minimum(np.random.default_rng(seed).geometric(1 - 1 / NEIGHBOURS, len(points)) - 1, WIDEST_LEVEL)
        for i, level in enumerate(levels.tolist()):
            out._insert(i, level)
        return out

    def _insert(self, i: int, level: int) -> None:
        q, at = self.points[i], self.entry
        if at < 0:
            at = i
        top = len(self.links) - 1
        for lev in range(top, level, -1):
            at = self._walk(q, at, lev)
        for lev in range(min(level, top), -1, -1):
            near = [(s, j) for s, j in self._beam(q, [at], BUILD_BEAM, lev)]
            chosen = self._spread(near, NEIGHBOURS)
            links = self.links[lev]
            links[i] = chosen
            room = 2 * NEIGHBOURS if lev == 0 else NEIGHBOURS
            for j in chosen:
                links[j].append(i)
                if len(links[j]) > 2 * room:
                    sims = (self.points[links[j]] @ self.points[j]).tolist()
                    links[j] = self._spread(sorted(zip(sims, links[j]), reverse=True), room)
            at = near[0][1]
        for _ in range(top, level):
            self.links.append({i: []})
            self.entry = i

    def _spread(self, near: list[tuple[float, int]], room: int) -> list[int]:
        """Neighbours in several directions: one that is nearer to a chosen one than to the point comes last."""
        if len(near) <= room:
            return [j for _, j in near]
        ids = [j for _, j in near]
        among = self.points[ids]
        among = among @ among.T
        closest = np.full(len(ids), -2.0)
        chosen, passed = [], []
        for k, (sim, _) in enumerate(near):
            if closest[k] < sim:
                chosen.append(k)
                if len(chosen) == room:
                    break
                np.maximum(closest, among[k], out=closest)
            else:
                passed.append(k)
        return [ids[k] for k in (chosen + passed)[:room]]

    def _walk(self, q: np.ndarray, at: int, level: int) -> int:
        """The point of a level that no neighbour beats, from ``at`` on."""
        links, best = self.links[level], float(self.points[at] @ q)
        while links[at]:
            sims = self.points[links[at]] @ q
            k = int(sims.argmax())
            if sims[k] <= best:
                break
            best, at = float(sims[k]), links[at][k]
        return at

    def _beam(self, q: np.ndarray, starts: list[int], width: int, level: int, seen: set[int] | None = None) -> list[tuple[float, int]]:
        """The ``width`` nearest points found, nearest first."""
        links = self.links[level]
        seen = set() if seen is None else seen
        seen.update(starts)
        found = [(float(self.points[j] @ q), j) for j in starts]
        todo = [(-s, j) for s, j in found]
        found.sort()
        while todo:
            far, j = heappop(todo)
            if len(found) >= width and -far < found[0][0]:
                break
            new = [k for k in links[j] if k not in seen]
            if not new:
                continue
            seen.update(new)
            for s, k in zip((self.points[new] @ q).tolist(), new):
                if len(found) < width:
                    heappush(found, (s, k))
                elif s > found[0][0]:
                    heapreplace(found, (s, k))
                else:
                    continue
                heappush(todo, (-s, k))
        return sorted(found, reverse=True)

    @cached_property
    def table(self) -> np.ndarray:
        """Neighbours on level 0, a row per point; free places hold one past the last point."""
        size = np.array([len(self.links[0][i]) for i in range(len(self.points))])
        out = np.full((len(self.points), max(1, size.max())), len(self.points))
        out[np.arange(out.shape[1]) < size[:, None]] = [k for i in range(len(self.points)) for k in self.links[0][i]]
        return out

    def within(self, q: np.ndarray, least: float, width: int) -> np.ndarray:
        """Points whose cosine with ``q`` reaches ``least``, as far as a beam of ``width`` leads to them."""
        if width >= len(self.points):
            return np.flatnonzero(self.points @ q >= least)
        at = self.entry
        for level in range(len(self.links) - 1, 0, -1):
            at = self._walk(q, at, level)
        seen: set[int] = set()
        self._beam(q, [at], width, 0, seen)
        met = np.array(sorted(seen), np.int64)
        visited = np.zeros(len(self.points), np.bool_)
        visited[met] = True
        # all that the beam has met, not only the nearest that it keeps
        front = met[self.points[met] @ q >= least]
        out = [front]
        while len(front):  # all neighbours of a whole front at once
            reached = np.zeros(len(self.points) + 1, np.bool_)
            reached[self.table[front]] = True
            new = np.flatnonzero(reached[:-1] & ~visited)
            visited[new] = True
            front = new[self.points[new] @ q >= least]
            out.append(front)
        return np.concatenate(out)

    def to_bytes(self, **more: np.ndarray) -> bytes:
        held = {"points": self.points, "entry": np.array([self.entry]), "levels": np.array([len(self.links)])} | more
        for lev, links in enumerate(self.links):
            held[f"own{lev}"] = np.array(list(links), np.int32)
            held[f"size{lev}"] = np.array([len(x) for x in links.values()], np.int32)
            held[f"to{lev}"] = np.array([k for x in links.values() for k in x], np.int32)
        np.savez(out := io.BytesIO(), **held)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
        held = dict(np.load(io.BytesIO(data)))
        out = cls(held["points"])
        out.entry = int(held["entry"][0])
        for lev in range(int(held["levels"][0])):
            stops = np.cumsum(held[f"size{lev}"]).tolist()
            to = held[f"to{lev}"].tolist()
            out.links.append({i: to[a:b] for i, a, b in zip(held[f"own{lev}"].tolist(), [0, *stops], stops)})
        return out, held


def recall(graph: Graph, queries: np.ndarray, truth: np.ndarray, least: float, width: int, *audits: list[int]) -> float:
    """The least of the audits' recalls: of all their links, and as the mean of their vectors."""
    found = {i: int(truth[i, graph.within(queries[i], least, width)].sum()) for i in sorted(set().union(*audits))}
    wanted = {i: int(truth[i].sum()) for i in found}
    of_links = [sum(found[i] for i in x) / sum(wanted[i] for i in x) for x in audits]
    of_vectors = [sum(found[i] / wanted[i] for i in x) / len(x) for x in audits]
    return min(of_links + of_vectors)


def linked(graph: Graph, queries: np.ndarray, least: float, same: bool) -> np.ndarray:
    """Which of the graph's points reach ``least``, a row per query; ``same``: the queries are the points themselves.

    Every query searches the graph.  The audit holds AUDITED vectors that have links, and
    one vector of each of at least AUDITED groups; where there are not so many, it ends
    when all vectors have been compared.
    A byte per pair of a shard's points bounds the memory, however many links there are.
    """
    n = len(queries)
    out = np.zeros((n, len(graph.points)), np.bool_)
    # vectors in random order are compared with all points until enough groups of links are known
    order = np.random.default_rng(n).permutation(n)
    met = np.zeros(len(graph.points), np.bool_)
    first_ones: list[int] = []
    one_a_group: list[int] = []
    for k in range(0, n, AUDIT_BLOCK):
        if len(one_a_group) >= AUDITED:
            break
        some = order[k : k + AUDIT_BLOCK]
        out[some] = queries[some] @ graph.points.T >= least
        if same:
            out[some, some] = False
        for i in some[out[some].any(1)].tolist():
            if len(first_ones) < AUDITED:
                first_ones.append(i)
            if not met[out[i]].any() and not (same and met[i]):
                one_a_group.append(i)
            met |= out[i]
            if same:
                met[i] = True
    width = FIRST_BEAM
    while first_ones and width < len(graph.points) and recall(graph, queries, out, least, width, first_ones, one_a_group) < WANTED_RECALL:
        width *= 2
    for i in range(n):
        out[i, graph.within(queries[i], least, width)] = True
    if same:  # a pair counts for both, whichever of the two has found it
        out |= out.T
        np.fill_diagonal(out, False)
    return out


def weighed(links: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Copies of the points that each row of ``links`` names."""
    blocks = [links[i : i + 512].astype(np.float64) @ copies for i in range(0, len(links), 512)]
    return np.concatenate(blocks).astype(np.int64)


def first_of_group(links: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row and each column, the first row that links lead to (itself, -1 for a column without any)."""
    rows, columns = np.arange(len(links)), np.full(links.shape[1], -1)
    seen, met = np.zeros(len(links), np.bool_), np.zeros(links.shape[1], np.bool_)
    for i in range(len(links)):
        front = np.array([i])
        while len(front) and not seen[front[0]]:
            seen[front] = True
            rows[front] = i
            reached = np.flatnonzero(links[front].any(0) & ~met)
            met[reached] = True
            columns[reached] = i
            front = reached[~seen[reached]] if same else np.flatnonzero(links[:, reached].any(1) & ~seen)
    return rows, columns


def embedding_components(vectors: DataFrame, least: float = 0.93, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label)."""
    x = vectors.select(F.coalesce(F.col("vec_id"), F.lit(LAST_ID)).cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = F.col("label").isNotNull() & F.coalesce(~bad & F.exists("v", lambda c: c != 0), F.lit(False))
    marked = x.withColumn("fine", fine)
    points = marked.filter("fine").groupBy("label", "v").agg(F.min("id").alias("point"), F.count("*").alias("copies"))
    points = points.withColumn("dim", F.size("v"))
    sizes = points.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = points.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("point"), F.col("shards")))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("point")
        at = np.stack(rows["v"].to_numpy()).astype(np.float64)
        at /= np.abs(at).max(1, keepdims=True)  # so that no square overflows
        at /= np.sqrt((at * at).sum(1, keepdims=True))
        # neighbours in id are often copies; a fixed shuffle spreads them over the build
        order = np.random.default_rng(len(rows)).permutation(len(rows))
        graph = Graph.build(at[order], seed=int(rows["shard"].iloc[0]))
        own = {"ids": rows["point"].to_numpy()[order], "copies": rows["copies"].to_numpy()[order]}
        np.savez(points := io.BytesIO(), points=at[order], **own)
        return pd.DataFrame({c: rows[c].iloc[:1] for c in ("label", "dim", "shard")} | {"graph": [graph.to_bytes(**own)], "points": [points.getvalue()]})

    label = dict(vectors.dtypes)["label"]
    shards = dealt.select("label", "dim", "shard", "point", "copies", "v").groupBy("label", "dim", "shard")
    shards = staged(shards.applyInPandas(build, f"label {label}, dim int, shard long, graph binary, points binary"), "graphs")
    # the shard that asks sends its points, not its graph
    other = shards.select("label", "dim", F.col("shard").alias("its"), F.col("points").alias("queries"))
    pairs = shards.drop("points").join(other, ["label", "dim"]).filter("shard <= its").repartition("label", "dim", "shard", "its")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                graph, of = Graph.from_bytes(batch.column("graph")[row].as_py())
                same = batch.column("shard")[row] == batch.column("its")[row]
                asking = of if same else dict(np.load(io.BytesIO(batch.column("queries")[row].as_py())))
                found = linked(graph, asking["points"], least, same)
                counts = [(asking["ids"], weighed(found, of["copies"]))]
                if not same:
                    counts.append((of["ids"], weighed(found.T, asking["copies"])))
                rows, columns = first_of_group(found, same)
                ties = [(asking["ids"], rows)] + [(of["ids"], columns)] * (not same)
                for ids, n in counts:
                    some = n > 0
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(n[some])], names=["a", "b", "n"])
                for ids, first in ties:  # one tie per point
                    some = first >= 0
                    left, right = ids[some], asking["ids"][first[some]]
                    yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right), pa.nulls(len(left), pa.int64())], names=["a", "b", "n"])

    found = staged(pairs.select("shard", "its", "graph", "queries").mapInArrow(lean(search), "a long, b long, n long"), "vector-links")
    counts = found.filter("n IS NOT NULL").groupBy(F.col("a").alias("point")).agg(F.sum("n").alias("n"))
    of = components(found.filter("n IS NULL").select("a", "b")).withColumnRenamed("node", "point")
    known = points.join(counts, "point", "left").join(of, "point", "left")
    known = known.select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "point").alias("component"))
    out = marked.filter("fine").join(known, ["label", "v"]).select("id", "n_links", "component")
    out = out.union(marked.filter("NOT fine").select("id", F.lit(0).cast("long"), "id"))
    own, least_id = F.nullif("id", F.lit(LAST_ID)), F.nullif("component", F.lit(LAST_ID))
    return out.select(own.alias("vec_id"), "n_links", least_id.alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))
