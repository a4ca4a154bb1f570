"""Exact Jaccard self-join of documents on word n-grams, by token-combination prefixes.

Tokens (hashed n-grams) stand in one order, rare ones first.  Two sets with a Jaccard
similarity of at least t share two tokens among the first ``n - ceil(t n) + 2`` of
each.  If the first they share is rare, the sets meet under that single token; if not, the
first two are both frequent and the sets meet under that pair, which far fewer sets hold
than any one frequent token.  Large sets have too many pairs: from ``pair_sets`` tokens on, frequent
tokens are indexed singly, and around that size a set is indexed both ways, so every
pair of linkable sizes has a way in common.

How frequent a token is comes from a histogram over all documents with a fixed number
of buckets.  It only steers the order: any order gives the same links.

Sets that are equal are one node from the start.  Under each key, members are first
verified against the key's most central member; only members that are still in
different components meet each other afterwards, under a size filter and a position
filter.  So a group of thousands of copies costs a star, not all its pairs, and no link
between components is lost.

Sets and tokens are told apart by 64-bit hashes: among N of them, one is mistaken with
probability below N / 2**64.  Verification compares whole hashed sets.

Rows: a text without words (or null) has an empty set and no link.  Rows are told apart by
doc_id and a hash of the text; rows that repeat a doc_id with another text are one
document as far as component_id goes, so their links unite.  A null doc_id is no id: such
rows are documents of their own and come after all others as smallest doc_id.  Other
columns are only passed on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.arrays import lean, mix, offsets, parts, slice_hashes, text_bytes, word_spans
from pressloom.llm.components import components
from pressloom.llm.stages import free_name, join_groups, staged

LAST_ID = (1 << 63) - 1
# The histogram has 2**BUCKET_BITS counts, sent in slices: its size never follows the data.
BUCKET_BITS, SLICE_BITS = 21, 15
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def token_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending, one text after the other, and the texts' offsets."""
    data, rows = text_bytes(column)
    data = LOWER[data]
    starts, ends, words = word_spans(data, rows)
    n = np.diff(words)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), count)
    first = words[row] + np.arange(len(row)) - np.repeat(offsets(count)[:-1], count)
    grams = slice_hashes(slice_hashes(data, starts, ends), first, first + np.minimum(n, size)[row])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.append(True, (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])) if len(row) else np.zeros(0, np.bool_)
    grams, row = grams[new], row[new]
    return grams, np.searchsorted(row, np.arange(len(n) + 1))


def set_nodes(grams: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One hash per set."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams ^ np.uint64(0xA24BAED4963EE407)), out=sums[1:])
    return mix((sums[edges[1:]] - sums[edges[:-1]]) + np.diff(edges).astype(np.uint64)).view(np.int64)


def survey(docs: DataFrame, size: int) -> DataFrame:
    """A row per document (doc, same, n, node), and slices of the token histogram (slice, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        kinds = {"doc": pa.int64(), "same": pa.int64(), "n": pa.int64(), "node": pa.int64(), "slice": pa.int32(), "counts": pa.binary()}

        def out(**columns: object) -> pa.RecordBatch:
            rows = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(rows, k) for c, k in kinds.items()], names=list(kinds))

        for batch in batches:
            for part in parts(batch, "text"):
                grams, edges = token_sets(part.column("text"), size)
                bucket, times = np.unique((grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), return_counts=True)
                counts[bucket] += times.astype(np.uint32)
                yield out(doc=part.column("doc"), same=part.column("same"), n=np.diff(edges), node=set_nodes(grams, edges))
        filled = [(i, x) for i, x in enumerate(np.split(counts, 1 << (BUCKET_BITS - SLICE_BITS))) if x.any()]
        if filled:
            yield out(slice=[i for i, _ in filled], counts=[zlib.compress(x.tobytes(), 1) for _, x in filled])

    return docs.mapInArrow(lean(run), "doc long, same long, n long, node long, slice int, counts binary")


def histogram(surveyed: DataFrame) -> np.ndarray:
    """The token histogram; slices are summed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.uint64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])

    slices = 1 << (BUCKET_BITS - SLICE_BITS)
    out = np.zeros((slices, 1 << SLICE_BITS), np.uint64)
    sent = surveyed.filter("slice IS NOT NULL").select("slice", "counts").repartitionById(slices, "slice")
    for row in sent.mapInArrow(lean(run), "slice int, counts binary").toLocalIterator():
        out[row["slice"]] = np.frombuffer(row["counts"], np.uint64)
    # float32 keeps the order well enough and halves what is broadcast
    return out.ravel().astype(np.float32)


def signatures(docs: DataFrame, size: int, num: int, den: int, counts: np.ndarray, pair_sets: int) -> DataFrame:
    """The index: key, node, n and place (of the key's first token in the set's order)."""
    held = docs.sparkSession.sparkContext.broadcast(counts)
    filled = counts[counts > 0]
    mean = float(filled.mean()) if len(filled) else 0.0
    frequent_from = mean + 6 * mean**0.5 + 8
    pairs_upto = pair_sets * den // num  # sets linkable with one of pair_sets tokens are no larger

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        often = held.value
        for batch in batches:
            for part in parts(batch, "text"):
                grams, edges = token_sets(part.column("text"), size)
                n = np.diff(edges)
                node = set_nodes(grams, edges)
                row = np.repeat(np.arange(len(n)), n)
                seen = often[(grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                order = np.lexsort((grams, seen, row))
                place = np.arange(len(row)) - edges[row]
                prefix = (n - (num * n + den - 1) // den + 2)[row]
                first = np.flatnonzero(place < prefix)
                order, row, place, prefix = order[first], row[first], place[first], prefix[first]
                grams, frequent = grams[order], seen[order] >= frequent_from
                leads = place < prefix - 1  # may be the first token that two sets share
                single = leads & (~frequent | (n[row] >= pair_sets))
                keys, rows, places = [grams[single]], [row[single]], [place[single]]
                paired = np.flatnonzero(frequent & (n[row] <= pairs_upto))
                # frequent tokens close a prefix, so those of a set lie side by side
                left = (np.searchsorted(row[paired], row[paired], side="right") - np.arange(len(paired)) - 1) * leads[paired]
                a = np.repeat(np.arange(len(paired)), left)
                b = a + 1 + np.arange(len(a)) - np.repeat(offsets(left)[:-1], left)
                a, b = paired[a], paired[b]
                keys.append(mix(grams[a] * np.uint64(0x9E3779B97F4A7C15) + grams[b]))
                rows.append(row[a])
                places.append(place[a])
                key, row, place = (np.concatenate(x) for x in (keys, rows, places))
                for i in range(0, len(key), 500_000):
                    some = slice(i, i + 500_000)
                    values = (key[some].view(np.int64), node[row[some]], n[row[some]], place[some])
                    yield pa.RecordBatch.from_arrays([pa.array(v, k, safe=False) for v, k in zip(values, kinds)], names=["key", "node", "n", "place"])

    return docs.select("text").mapInArrow(lean(run), "key long, node long, n int, place int")


def may_link(num: int, den: int) -> Column:
    """Size filter and position filter of the pair (n, place) and (m, at).

    Every pair of linked sets also meets under its first shared token (or under the
    pair of its first two), so a meeting counts as if it were that one: what stands
    before the place in either set is not shared.
    """
    most = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at"))
    return (den * F.least("n", "m") >= num * F.greatest("n", "m")) & ((num + den) * most >= num * (F.col("n") + F.col("m")))


def verified(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets have den * intersection >= num * union.  ``texts``: node, packed."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("of_a")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("packed").alias("of_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                sets = [token_sets(pa.array([zlib.decompress(x).decode() for x in some.column(c).to_pylist()], pa.string()), size) for c in ("of_a", "of_b")]
                n, m = (np.diff(edges) for _, edges in sets)
                row = np.concatenate([np.repeat(np.arange(len(n)), np.diff(edges)) for _, edges in sets])
                grams = np.concatenate([g for g, _ in sets])
                order = np.lexsort((grams, row))
                grams, row = grams[order], row[order]
                both_have = np.bincount(row[1:][(grams[1:] == grams[:-1]) & (row[1:] == row[:-1])], minlength=len(n))
                linked = pa.array(den * both_have >= num * (n + m - both_have))
                yield some.select(["a", "b"]).filter(linked)

    return both.select("a", "b", "of_a", "of_b").mapInArrow(lean(run), "a long, b long")


def packed_texts(docs: DataFrame, of: DataFrame) -> DataFrame:
    """``node, packed`` (deflated text) of the nodes in ``of`` (node, doc, same); a row per document that has the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pa.array([zlib.compress((x.as_py() or "").encode(), 1) for x in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), packed], names=["node", "packed"])

    return docs.join(of, ["doc", "same"]).select("node", "text").mapInArrow(lean(run), "node long, packed binary")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc, same (hash of the text) and text of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).cast("long").alias("doc"), F.xxhash64(text).alias("same"), text.alias("text"))


def linked_sets(docs: DataFrame, size: int, num: int, den: int, pair_sets: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as doc, same, n and node, and the links of their sets as components (node, component).

    Nodes without a link to another have no row in the second table.
    """
    keyed = keyed_texts(docs)
    surveyed = staged(survey(keyed, size), "ngram-survey")
    nodes = surveyed.filter("doc IS NOT NULL").select("doc", "same", "n", "node")
    counts = histogram(surveyed)

    index = signatures(keyed, size, num, den, counts, pair_sets)
    shared = index.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("key")
    index = staged(index.join(shared, "key"), "ngram-index")
    leader = index.groupBy("key").agg(F.min(F.struct("place", "node", "n")).alias("l"))
    leader = leader.select("key", F.col("l.node").alias("a"), F.col("l.n").alias("m"), F.col("l.place").alias("at"))
    stars = index.join(leader, "key").filter((F.col("a") != F.col("node")) & may_link(num, den))
    stars = staged(stars.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "ngram-stars")

    # a node stands for one set, whichever row has it
    one = nodes.filter("n > 0").groupBy("node").agg(F.min(F.struct("doc", "same")).alias("r")).select("node", "r.doc", "r.same")
    wanted = index.select("node").distinct().join(one, "node")
    texts = staged(packed_texts(keyed, wanted).dropDuplicates(["node"]), "ngram-texts")
    links = staged(verified(stars, texts, size, num, den), "ngram-links")
    of = components(links)

    known = index.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    known = staged(known.join(split, "key"), "ngram-split")
    other = known.select("key", F.col("node").alias("other"), F.col("n").alias("m"), F.col("place").alias("at"), F.col("component").alias("its"))
    met = known.join(other, "key").filter((F.col("node") < F.col("other")) & (F.col("component") != F.col("its")) & may_link(num, den))
    met = met.select(F.col("node").alias("a"), F.col("other").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    more = staged(verified(met, texts, size, num, den), "ngram-links")
    return nodes, links.union(more)


def grouped_sets(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with component, its first row (least: doc, same), and how many rows the node has (rows).

    Equal sets are merged before anything else, and the largest groups are broadcast, so
    a group with most of the rows is no single task.
    """
    sets = nodes.filter("n > 0").groupBy("node").agg(F.count("*").alias("rows"), F.min(F.struct("doc", "same")).alias("first"))
    sets = sets.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    sets = staged(sets, "ngram-sets")
    whole = sets.groupBy("component").agg(F.count("*").alias("sets"), F.min("first").alias("least"))
    sets = staged(join_groups(sets, staged(whole, "ngram-groups"), ["component"], "sets").select("node", "rows", "component", "least"), "ngram-sets")
    grouped = join_groups(nodes.filter("n > 0"), sets, ["node"], "rows")
    return grouped.unionByName(nodes.filter("n = 0"), allowMissingColumns=True)


def jaccard_components(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, pair_sets: int = 256) -> DataFrame:
    """doc_id, n_shingles (long) and component_id of every row of ``docs``.

    Documents link when den * intersection >= num * union of their n-gram sets;
    component_id is the smallest doc_id that links lead to, the document's own included.
    """
    nodes, links = linked_sets(docs, size, num, den, pair_sets)
    # a document whose rows differ ties its nodes together
    ids = nodes.filter((F.col("n") > 0) & (F.col("doc") != LAST_ID))
    same = ids.groupBy("doc").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    ties = ids.join(same.select("doc", "low"), "doc").select(F.col("low").alias("a"), F.col("node").alias("b"))
    placed = grouped_sets(nodes, links.union(ties))
    own = F.nullif(F.col("doc"), F.lit(LAST_ID))
    least = F.when(F.col("n") > 0, F.nullif(F.col("least.doc"), F.lit(LAST_ID))).otherwise(own)
    return placed.select(own.alias("doc_id"), F.col("n").alias("n_shingles"), least.alias("component_id"))


def drop_near_copies(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, pair_sets: int = 256) -> DataFrame:
    """``docs`` with one row of each group that links join: that of the smallest doc_id, then of the smallest text hash.

    Rows without words link with nothing and all stay.  Rows of one doc_id or of none are
    judged by their texts alone; of rows equal in doc_id and text one stays.
    """
    nodes, links = linked_sets(docs, size, num, den, pair_sets)
    placed = grouped_sets(nodes, links)
    gone = placed.filter((F.col("n") > 0) & ((F.col("doc") != F.col("least.doc")) | (F.col("same") != F.col("least.same"))))
    doc, same = free_name(docs, "_doc"), free_name(docs, "_same")
    gone = gone.select(F.col("doc").alias(doc), F.col("same").alias(same)).distinct()
    keys = {doc: F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).cast("long"), same: F.xxhash64(F.coalesce("text", F.lit("")))}
    marked = docs.withColumns(keys)
    worded = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    kept = marked.filter(worded).join(gone, [doc, same], "left_anti").dropDuplicates([doc, same])
    return kept.unionByName(marked.filter(~worded)).select(*docs.columns)
