"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A piece's adjacent pairs wait in one bucket per merge rank.  Which buckets hold
anything is kept in a bitmap with a summary level above it, so "the lowest rank"
is a find-first-set from the top level down.  Buckets hold positions in a linked
list of parts; an entry whose parts have changed since is stale and skipped.  A
merge makes a longer token, so it never refills its own bucket.  A piece of n
bytes takes O(n log n), so texts without any boundary stay cheap.

The distinct new pieces of a chunk of texts share one queue: pieces don't touch,
so the lowest rank of all is also the lowest of its piece.  The ids of the texts
are then put together from the pieces' ids.

Rows: a null text counts as empty and gives no ids; repeated rows, ids and other
columns are passed on; every column of the input but the text's is kept.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.arrays import chunks, gather, lean, offsets, parts, worker_cache
from pressloom.llm.pretokens import pieces

# Distinct pieces that a Python worker remembers (some 40 bytes each), and characters, bytes to merge (some 150 each) and ids it handles at a time.
REMEMBERED_PIECES = 2_000_000
CHUNK_CHARS, MERGED_BYTES, CHUNK_IDS = 800_000, 200_000, 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file.

    A vocabulary is part of the installation, like a library: each machine
    has the file, and tasks open it at ``path``.
    """
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Ids of many pieces at once; the ranks are the vocabulary.

    All pieces lie in one row of parts; links never cross a piece's end.  The
    bitmap has two levels: words of WORD bits with a bit per rank, and a summary
    with a bit per word that isn't zero.  Both are Python integers, so
    find-first-set is ``x & -x``.
    """

    WORD = 9

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.base = max(ranks.values()) + 1
        #: left * base + right: the rank of the two parts joined
        self.pairs = {
            ranks[t[:i]] * self.base + ranks[t[i:]]: rank for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        }
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.byte_pairs = np.full(1 << 16, -1, np.int64)
        for t, rank in ranks.items():
            if len(t) == 2:
                self.byte_pairs[t[0] << 8 | t[1]] = rank

    def encode(self, piece: bytes) -> list[int]:
        return self.encode_many([piece])[0].tolist()

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and their offsets; about MERGED_BYTES share a queue."""
        ids, counts, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], offsets([len(p) for p in pieces])
        for a, b in ranges(np.diff(sizes), MERGED_BYTES):
            some, stops = self._merge(np.frombuffer(b"".join(pieces[a:b]), np.uint8), sizes[a : b + 1] - sizes[a])
            ids.append(some)
            counts.append(np.diff(stops))
        return np.concatenate(ids), offsets(np.concatenate(counts))

    def _merge(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``edges``: offsets of the pieces in ``data``."""
        n, pair, base, shift, low = len(data), self.pairs.get, self.base, self.WORD, (1 << self.WORD) - 1
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[edges[1:][edges[1:] > 0] - 1] = -1
        before[edges[:-1][edges[:-1] < n]] = -1
        rank = np.full(n, -1, np.int64)
        rank[:-1] = self.byte_pairs[data[:-1].astype(np.int64) << 8 | data[1:]]
        rank[after < 0] = -1
        # one bucket per rank; the positions in it rise
        at = np.flatnonzero(rank >= 0)
        at = at[np.argsort(rank[at], kind="stable")]
        filled, first = np.unique(rank[at], return_index=True)
        places, stops = at.tolist(), [*first[1:].tolist(), len(at)]
        buckets = {r: places[a:b] for r, a, b in zip(filled.tolist(), first.tolist(), stops)}
        words = [0] * ((base >> shift) + 1)
        summary = 0
        for r in buckets:
            words[r >> shift] |= 1 << (r & low)
            summary |= 1 << (r >> shift)
        part, after, before = self.bytes[data].tolist(), after.tolist(), before.tolist()  # a part that has gone: -1
        while summary:
            w = (summary & -summary).bit_length() - 1
            word = words[w]
            rank = w << shift | ((word & -word).bit_length() - 1)
            words[w] = word & (word - 1)
            if not words[w]:
                summary &= summary - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            for done, i in enumerate(bucket):
                j, left = after[i], part[i]
                # stale: the part has gone, ends its piece, or no longer makes this token with the next
                if left < 0 or j < 0 or pair(left * base + part[j]) != rank:
                    continue
                part[i], part[j] = rank, -1
                after[i] = k = after[j]
                lower = False
                if k >= 0:
                    before[k] = i
                    if (new := pair(rank * base + part[k])) is not None:
                        if (held := buckets.get(new)) is not None:
                            held.append(i)
                        else:
                            buckets[new] = [i]
                            words[new >> shift] |= 1 << (new & low)
                            summary |= 1 << (new >> shift)
                            lower = new < rank
                if (h := before[i]) >= 0:
                    if (new := pair(part[h] * base + rank)) is not None:
                        if (held := buckets.get(new)) is not None:
                            held.append(h)
                        else:
                            buckets[new] = [h]
                            words[new >> shift] |= 1 << (new & low)
                            summary |= 1 << (new >> shift)
                            lower = lower or new < rank
                if lower and done + 1 < len(bucket):  # a lower rank has come up: the rest waits behind it
                    buckets[rank] = bucket[done + 1 :]
                    words[rank >> shift] |= 1 << (rank & low)
                    summary |= 1 << (rank >> shift)
                    break
        left = np.array(part, np.int64)
        alive = np.flatnonzero(left >= 0)
        return left[alive].astype(np.uint32), np.searchsorted(alive, edges)


def encoder(path: str) -> Encoder:
    """The worker's encoder for the rank file at ``path``."""
    held = worker_cache("encoders", 8)
    if path not in held:
        held[path] = Encoder(read_ranks(path))
    return held[path]


def decoder(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The worker's tokens of the rank file at ``path``: all their bytes, and by rank where a token starts and its length (-1: no token)."""
    held = worker_cache("decoders", 8)
    if path not in held:
        tokens = {rank: token for token, rank in read_ranks(path).items()}
        lengths = np.array([len(tokens[r]) if r in tokens else -1 for r in range(max(tokens) + 1)], np.int64)
        data = np.frombuffer(b"".join(tokens.get(r, b"") for r in range(len(lengths))), np.uint8)
        held[path] = data, offsets(np.maximum(lengths, 0))[:-1], lengths
    return held[path]


def ranges(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about ``most`` in all; a larger row stands alone."""
    stops = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=0)).tolist()
    for a, b in zip([0, *stops], [*stops, len(sizes)]):
        if a < b:
            yield a, b


class PieceMemory:
    """Ids of pieces by the pieces' hashes: sorted keys, and where in one row of ids each one's stand."""

    def __init__(self):
        self.keys, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 for unknown ones."""
        at = np.searchsorted(self.keys, keys)
        known = np.append(self.keys, np.uint64(0))[at] == keys
        return np.where(known & (at < len(self.keys)), at, -1)

    def add(self, keys: np.ndarray, ids: np.ndarray, stops: np.ndarray) -> None:
        """New pieces: ``keys`` rise, piece i has the ids stops[i]..stops[i+1]."""
        at = np.searchsorted(self.keys, keys)
        self.first = np.insert(self.first, at, stops[:-1] + len(self.flat))
        self.size = np.insert(self.size, at, np.diff(stops))
        self.keys = np.insert(self.keys, at, keys)
        self.flat = np.concatenate((self.flat, ids.astype(np.uint32)))


def encode_texts(texts: list[str], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], key: str) -> Iterator[np.ndarray]:
    """Ids of each text, in order.  ``encode`` gives new pieces' ids and their offsets; ``key`` names the worker's memory of them."""
    for a, b in chunks(texts, CHUNK_CHARS):
        some = pieces(texts[a:b])
        held = worker_cache(key, 2)
        memory = held.setdefault("pieces", PieceMemory())
        if len(memory.keys) >= REMEMBERED_PIECES:
            memory = held["pieces"] = PieceMemory()
        new = np.flatnonzero(memory.find(some.keys) < 0)
        memory.add(some.keys[new], *encode(some.texts(new)))
        at = memory.find(some.keys)[some.number]
        lengths = memory.size[at]
        stop = offsets(lengths)
        ids = gather(memory.flat, memory.first[at], lengths)
        edges = stop[some.rows]
        for t in range(b - a):
            yield ids[edges[t] : edges[t + 1]]


def encode_bpe(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the array column ``ids`` (int) of each whole text; special tokens' strings are ordinary text.

    The column takes the place of one of the same name.  No shuffle; a null text stays null.
    """
    keep = [f for f in docs.schema.fields if f.name.lower() != ids.lower()]
    schema = T.StructType([*keep, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks_path)

        def merged(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
            return bpe.encode_many([p.encode() for p in new])

        for batch in batches:
            for part in parts(batch, text):
                found = list(encode_texts([t or "" for t in part.column(text).to_pylist()], merged, f"pieces:{ranks_path}"))
                flat = np.concatenate(found).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets([len(x) for x in found]), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), column], names=schema.fieldNames())

    return docs.mapInArrow(lean(run), schema)


def decode_bpe(encoded: DataFrame, ranks_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the binary column ``into``: the tokens' bytes, joined.  A null list gives no bytes.

    The column takes the place of one of the same name.  An id that the
    vocabulary lacks is an error.
    """
    keep = [f for f in encoded.schema.fields if f.name.lower() != into.lower()]
    schema = T.StructType([*keep, T.StructField(into, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts, lengths = decoder(ranks_path)
        for batch in batches:
            counts = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in ranges(counts, CHUNK_IDS):
                some = batch.slice(a, b - a)
                numbers = some.column(ids).flatten().to_numpy(zero_copy_only=False)
                if len(numbers) and (numbers.min() < 0 or numbers.max() >= len(lengths) or lengths[numbers].min() < 0):
                    raise ValueError("an id that the vocabulary lacks")
                size = lengths[numbers]
                ends = offsets(size)[offsets(counts[a:b])]
                column = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(gather(data, starts[numbers], size)))])
                yield pa.RecordBatch.from_arrays([*(some.column(f.name) for f in keep), column], names=schema.fieldNames())

    return encoded.mapInArrow(lean(run), schema)


def bpe_digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, through encoding and decoding."""
    coded = decode_bpe(encode_bpe(docs.select("doc_id", "text"), ranks_path), ranks_path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
