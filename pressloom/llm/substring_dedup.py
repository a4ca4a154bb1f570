"""Removal of word passages that stand earlier in the corpus.

Every window of ``window`` consecutive words gets a Rabin-Karp hash.  A map task
keeps, of each hash, only the first place it has seen (a combiner: any later place
is a repeat for sure), and sends that place to the task that owns the hash's range.
There the windows of a hash are counted and all but the first place (smaller
doc_id, then the earlier start) are repeats.  The repeats go back to their
documents, where overlapping windows merge into maximal intervals and are cut.

Hash, document and place travel as packed blocks, about nine bytes a window.  The
hash has 64 bits: among N windows, a window is taken for a repeat by mistake with
probability below N / 2**64.

Rows: a null text has no words.  A null doc_id counts as 2**63-1.  Documents of the
same doc_id are ordered by their text's hash; rows equal in both are one document,
which gets one result on each of its rows.  Other columns pass through unchanged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.arrays import lean, offsets, parts, slice_hashes, text_bytes, word_spans
from pressloom.llm.stages import free_name

# Windows that a task holds before it sends them on.
HELD_WINDOWS = 1_000_000
# Text behind one task that counts windows: some three million windows, a hundred MB of arrays.
SLOT_BYTES = 16_000_000
LAST_ID = (1 << 63) - 1

BLOCKS = "slot int, payload binary, repeats binary"
REPEATS = "doc long, same long, starts binary"


def windows_of(column: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of some texts, each one's text and its start in words."""
    data, rows = text_bytes(column)
    starts, ends, words = word_spans(data, rows)
    n = np.diff(words)
    count = np.maximum(n - window + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(row)) - np.repeat(offsets(count)[:-1], count)
    first = words[row] + place
    return slice_hashes(slice_hashes(data, starts, ends), first, first + window), row.astype(np.int32), place.astype(np.int32)


def pack(hashes: np.ndarray, row: np.ndarray, place: np.ndarray, doc: np.ndarray, same: np.ndarray) -> bytes:
    """A block: windows ascending by row and place.  Rows' keys stand once, places as differences."""
    rows, first, count = np.unique(row, return_index=True, return_counts=True)
    step = np.diff(place, prepend=0).astype(np.int32)
    step[first] = place[first]
    steps = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 4).T)
    rest = b"".join(x.tobytes() for x in (doc[rows], same[rows], count.astype(np.int32), steps))
    return np.array([len(hashes), len(rows)], np.int64).tobytes() + hashes.tobytes() + zlib.compress(rest, 1)


def block_hashes(block: bytes) -> np.ndarray:
    """The hashes of a block's windows."""
    return np.frombuffer(block, np.uint64, int(np.frombuffer(block, np.int64, 1)[0]), 16)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, doc, same and place of each window of a block."""
    n, r = np.frombuffer(block, np.int64, 2)
    hashes = np.frombuffer(block, np.uint64, n, 16)
    rest = zlib.decompress(block[16 + 8 * n :])
    doc, same = np.frombuffer(rest, np.int64, r), np.frombuffer(rest, np.int64, r, 8 * r)
    count = np.frombuffer(rest, np.int32, r, 16 * r)
    step = np.ascontiguousarray(np.frombuffer(rest, np.uint8, 4 * n, 20 * r).reshape(4, -1).T).view(np.int32).ravel()
    place = np.cumsum(step, dtype=np.int64)
    first = offsets(count)[:-1]
    place -= np.repeat(place[first] - step[first], count)
    return hashes, np.repeat(doc, count), np.repeat(same, count), place


def packed_repeats(doc: np.ndarray, same: np.ndarray, place: np.ndarray, slots: int) -> Iterator[tuple[int, bytes]]:
    """Some windows, in one block for each slot that owns some of their documents."""
    slot = ((doc ^ same) % slots).astype(np.int32)
    order = np.lexsort((place, same, doc, slot))
    doc, same, place, slot = doc[order], same[order], place[order], slot[order]
    edges = np.searchsorted(slot, np.arange(slots + 1)).tolist()
    for s, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if a < b:
            new = np.flatnonzero(np.append(True, (doc[a + 1 : b] != doc[a : b - 1]) | (same[a + 1 : b] != same[a : b - 1])))
            count = np.diff(np.append(new, b - a)).astype(np.int32)
            parts_of = (np.array([len(new)], np.int64), doc[a:b][new], same[a:b][new], count, place[a:b].astype(np.int32))
            yield s, zlib.compress(b"".join(x.tobytes() for x in parts_of), 1)


def unpacked_repeats(block: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(doc, same, packed starts) of the documents of a block."""
    data = zlib.decompress(block)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    doc, same = np.frombuffer(data, np.int64, n, 8).tolist(), np.frombuffer(data, np.int64, n, 8 + 8 * n).tolist()
    first = 8 + 20 * n
    stops = (first + 4 * offsets(np.frombuffer(data, np.int32, n, 8 + 16 * n))).tolist()
    for d, s, a, b in zip(doc, same, stops[:-1], stops[1:]):
        yield d, s, data[a:b]


def repeated_windows(docs: DataFrame, window: int = 20, partitions: int | None = None) -> DataFrame:
    """``doc, same, starts`` (packed int32 places), a row per document with windows that start earlier elsewhere.

    ``docs`` has the columns doc, text and same (hash of the text).  A document may
    have several rows.  Windows are dealt to ``partitions`` tasks by their hash; by default
    so many that about SLOT_BYTES of text stand behind each, at least the session's
    shuffle partitions, so a task's memory does not follow the corpus.
    """
    slots = partitions
    if not slots:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        slots = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLOT_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def rows(values: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.binary(), pa.binary()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*values), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["slot", "payload", "repeats"])

        def flush() -> Iterator[pa.RecordBatch]:
            doc, same = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            before = offsets([len(x[0]) for x in held])
            hashes, place = (np.concatenate([x[i] for x in held]) for i in (2, 4))
            row = np.concatenate([x[3] + np.int32(b) for x, b in zip(held, before)])
            held.clear()
            # documents in their order, so that a smaller place in the arrays is an earlier start
            order = np.lexsort((same, doc))
            doc, same = doc[order], same[order]
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            again = np.append(False, (doc[1:] == doc[:-1]) & (same[1:] == same[:-1]))  # rows that repeat a document
            row = rank[row]
            whole = ~again[row]
            hashes, row, place = hashes[whole], row[whole], place[whole]
            order = np.argsort(row, kind="stable")
            hashes, row, place = hashes[order], row[order], place[order]

            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            late = np.zeros(len(hashes), np.bool_)
            late[order[1:][ranked[1:] == ranked[:-1]]] = True
            for s, block in packed_repeats(doc[row[late]], same[row[late]], place[late], slots):
                yield rows([(s, None, block)])
            hashes, row, place = hashes[~late], row[~late], place[~late]
            slot = ((hashes >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(slot, kind="stable")
            edges = np.searchsorted(slot[order], np.arange(slots + 1))
            for s in range(slots):
                own = order[edges[s] : edges[s + 1]]
                if len(own):
                    yield rows([(s, pack(hashes[own], row[own], place[own], doc, same), None)])

        many = 0
        for part in (p for batch in batches for p in parts(batch, "text")):
            hashes, row, place = windows_of(part.column("text"), window)
            # copies: a view would keep the whole batch with its texts
            held.append((part.column("doc").to_numpy().copy(), part.column("same").to_numpy().copy(), hashes, row, place))
            many += len(hashes)
            if many >= HELD_WINDOWS:
                yield from flush()
                many = 0
        if many:
            yield from flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            known = batch.filter(pc.is_valid(batch.column("repeats")))
            if known.num_rows:
                yield known.select(["slot", "repeats"])
            blocks += batch.column("payload").drop_null().to_pylist()
        if not blocks:
            return
        # blocks stay packed: only windows whose hash comes again are unpacked
        hashes = np.concatenate([block_hashes(x) for x in blocks])
        order = np.argsort(hashes)
        ranked = hashes[order]
        equal = ranked[1:] == ranked[:-1]
        shared = np.zeros(len(hashes), np.bool_)
        shared[order[np.append(False, equal) | np.append(equal, False)]] = True
        edges = offsets([len(block_hashes(x)) for x in blocks]).tolist()
        del hashes, order, ranked, equal
        found = [[c[part] for c in unpack(x)] for x, a, b in zip(blocks, edges[:-1], edges[1:]) if (part := shared[a:b]).any()]
        if not found:
            return
        del blocks, shared
        hashes, doc, same, place = (np.concatenate(x) for x in zip(*found))
        del found
        order = np.lexsort((place, same, doc, hashes))
        hashes, doc, same, place = hashes[order], doc[order], same[order], place[order]
        # the first place of each hash; a row that repeats a document repeats its places, which are no earlier
        head = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        head = np.repeat(head, np.diff(np.append(head, len(hashes))))
        late = (doc != doc[head]) | (same != same[head]) | (place != place[head])
        for slot, block in packed_repeats(doc[late], same[late], place[late], slots):
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([block], pa.binary())], names=["slot", "repeats"])

    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts: dict[tuple[int, int], list[bytes]] = {}
        for batch in batches:
            for block in batch.column("repeats").to_pylist():
                for doc, same, places in unpacked_repeats(block):
                    starts.setdefault((doc, same), []).append(places)
        found = list(starts.items())
        for a in range(0, len(found), 2000):
            keys, values = zip(*found[a : a + 2000])
            doc, same = zip(*keys)
            columns = [pa.array(doc, pa.int64()), pa.array(same, pa.int64()), pa.array([b"".join(v) for v in values], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "same", "starts"])

    sent = docs.select("doc", "same", "text").mapInArrow(lean(send), BLOCKS)
    counted = sent.repartitionById(slots, "slot").mapInArrow(lean(count), "slot int, repeats binary")
    return counted.repartitionById(slots, "slot").mapInArrow(lean(deliver), REPEATS)


def merged(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals of words, starts and ends, that the windows at ``starts`` cover."""
    place = np.unique(starts)
    if not len(place):
        return place, place
    new = np.append(True, place[1:] > place[:-1] + window)
    last = np.append(new[1:], True)
    return place[new], place[last] + window


def remove_repeats(docs: DataFrame, window: int = 20, partitions: int | None = None) -> DataFrame:
    """``docs`` with ``text`` cut and the columns n_words, n_removed (long) and removed (array of word intervals).

    A cut runs from a removed interval's first word to the next kept word, so what
    stays keeps its own white space.  Input columns of the new names are replaced.
    """
    keep = [f for f in docs.schema.fields if f.name.lower() not in ("n_words", "n_removed", "removed")]
    doc, same = free_name(docs, "_doc"), free_name(docs, "_same")
    keyed = docs.select(*[docs[f.name] for f in keep]).withColumn(doc, F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).cast("long")).withColumn(same, F.xxhash64(F.coalesce("text", F.lit(""))))
    found = repeated_windows(keyed.select(F.col(doc).alias("doc"), F.col(same).alias("same"), "text"), window, partitions)
    starts = free_name(docs, "_starts")
    joined = keyed.join(found.toDF(doc, same, starts), [doc, same], "left")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [*keep, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed", T.ArrayType(span))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, all_starts = batch.column("text"), batch.column(starts)
            kept_text, n_words, n_removed, removed = [], [], [], []
            for i in range(batch.num_rows):
                data, rows = text_bytes(texts.slice(i, 1))
                at, _, words = word_spans(data, rows)
                low, high = merged(np.frombuffer(all_starts[i].as_py() or b"", np.int32), window)
                whole, pieces, done = data.tobytes(), [], 0
                edge = np.append(at, len(whole))
                for a, b in zip(low.tolist(), high.tolist()):
                    pieces.append(whole[done : int(edge[a])])
                    done = int(edge[b])
                pieces.append(whole[done:])
                kept_text.append(b"".join(pieces).decode() if texts[i].is_valid else None)
                n_words.append(int(words[1]))
                n_removed.append(int((high - low).sum()))
                removed.append([{"start": int(a), "end": int(b)} for a, b in zip(low, high)])
            made = {"text": pa.array(kept_text, pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
            made["removed"] = pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([made.get(n, None) if n in made else batch.column(n) for n in schema.fieldNames()], names=schema.fieldNames())

    return joined.mapInArrow(lean(cut), schema)


def repeat_digests(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    cut = remove_repeats(docs.select("doc_id", "text"), window)
    words = F.array_join(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\x09-\\x0D]+"), lambda w: w != ""), " ")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))
