"""Token ids as wavelet matrices, one compressed file per shard.

A shard holds the ids of consecutive documents, ascending by doc_id.  Its wavelet
matrix stores one bit-plane per bit of the ids, highest first; each plane is the
id sequence stably sorted by the bits above.  A rank directory (ones before each
block of 4,096 bits) makes rank constant-time and select a binary search, so from
the one file come a token at a place, how often an id occurs before a place, and
where its k-th occurrence stands.

File format (little endian): magic ``PLWM``, version u16, bits u16, tokens u64, then
per plane: zeros u64, the rank directory (u32 per block and one for the total), the end
of each deflated chunk (u32, counted from the first chunk), and the chunks: CHUNK bytes
of the plane's bits (numpy packbits order), deflated one by one, so that a question
inflates one or two chunks per plane and not the file.  In the table, each shard's row
carries the file in ``payload`` next to its documents' ids, lengths and place, so Spark
alone reads and writes it in any store.

Rows: a null text is empty and holds the end id only.  Documents stand by doc_id,
null ids last; repeated ids by text.  Repeated rows are repeated documents.  Other
columns are not stored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit, Sequence

from pressloom.llm.arrays import lean, offsets, parts, worker_cache
from pressloom.llm.bpe import encode_texts
from pressloom.llm.stages import staged

MAGIC, VERSION, BLOCK = b"PLWM", 2, 4096
CHUNK, HELD_CHUNKS = 1 << 14, 64
# Pieces that the library gets as one text, and the signs that may part them.
JOINED, MARKS = 512, [chr(c) for c in (0, *range(0xE000, 0xE100))]
SHARD_SCHEMA = "part int, seq int, n_docs int, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


class Bits:
    """The bytes of a bit-plane: whole, or deflated in chunks that are inflated as they are asked for."""

    def __init__(self, whole: np.ndarray | None = None, packed: memoryview | None = None, ends: np.ndarray | None = None, size: int = 0):
        self.whole, self.packed, self.ends = whole, packed, ends
        self.size = size if whole is None else len(whole)
        self.held: dict[int, np.ndarray] = {}
        self.inflated = 0

    def _chunk(self, k: int) -> np.ndarray:
        if self.whole is not None:
            return self.whole[k * CHUNK : (k + 1) * CHUNK]
        if k not in self.held:
            if len(self.held) >= HELD_CHUNKS:
                self.held.clear()
            start = int(self.ends[k - 1]) if k else 0
            self.held[k] = np.frombuffer(zlib.decompress(self.packed[start : int(self.ends[k])]), np.uint8)
            self.inflated += 1
        return self.held[k]

    def read(self, start: int, stop: int) -> np.ndarray:
        """Bytes start .. stop - 1."""
        first, last = start // CHUNK, max(start, stop - 1) // CHUNK
        if start >= min(stop, self.size):
            return np.zeros(0, np.uint8)
        some = [self._chunk(k) for k in range(first, last + 1) if k * CHUNK < self.size]
        found = some[0] if len(some) == 1 else np.concatenate(some)
        return found[start - first * CHUNK : stop - first * CHUNK]

    def chunks(self) -> Iterator[np.ndarray]:
        return (self._chunk(k) for k in range(-(-self.size // CHUNK)))


class WaveletMatrix:
    """Succinct sequence of ids: ``access``, ``rank`` (count) and ``select`` (occurrence lookup)."""

    def __init__(self, n: int, bits: int, planes: list[Bits], zeros: list[int], ones: list[np.ndarray]):
        self.n, self.bits, self.planes, self.zeros, self.ones = n, bits, planes, zeros, ones

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length() if len(ids) else 1)
        rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, ones = [], [], []
        for b in range(bits - 1, -1, -1):
            bit = (rest & rest.dtype.type(1 << b)) != 0
            planes.append(Bits(np.packbits(bit)))
            ones.append(block_ones(planes[-1].whole))
            low = rest[~bit]
            zeros.append(len(low))
            rest = np.concatenate((low, rest[bit]))
        return cls(len(ids), bits, planes, zeros, ones)

    def to_bytes(self) -> bytes:
        out = [struct.pack("<4sHHQ", MAGIC, VERSION, self.bits, self.n)]
        for plane, zeros, ones in zip(self.planes, self.zeros, self.ones):
            packed = [zlib.compress(chunk, 1) for chunk in plane.chunks()]
            ends = np.cumsum([len(x) for x in packed]).astype("<u4")
            out += [struct.pack("<Q", zeros), ones.astype("<u4").tobytes(), ends.tobytes(), *packed]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, version, bits, n = struct.unpack_from("<4sHHQ", data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file")
        at, planes, zeros, ones = struct.calcsize("<4sHHQ"), [], [], []
        size = -(-n // 8)
        chunks, blocks = -(-size // CHUNK), -(-size // (BLOCK // 8)) + 1
        for _ in range(bits):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            ones.append(np.frombuffer(data, "<u4", blocks, at + 8).astype(np.int64))
            at += 8 + 4 * blocks
            ends = np.frombuffer(data, "<u4", chunks, at)
            at += 4 * chunks
            stop = at + (int(ends[-1]) if chunks else 0)
            planes.append(Bits(packed=memoryview(data)[at:stop], ends=ends, size=size))
            at = stop
        return cls(n, bits, planes, zeros, ones)

    def rank1(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // BLOCK
        piece = np.unpackbits(self.planes[plane].read(block * BLOCK // 8, (i + 7) // 8))
        return int(self.ones[plane][block]) + int(piece[: i - block * BLOCK].sum())

    def select(self, plane: int, one: bool, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        ones = self.ones[plane]
        before = ones if one else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        piece = np.unpackbits(self.planes[plane].read(block * BLOCK // 8, (block + 1) * BLOCK // 8))
        return block * BLOCK + int(np.flatnonzero(piece == one)[k - int(before[block])])

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane].read(i >> 3, (i >> 3) + 1)[0] >> (7 - (i & 7))) & 1

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for p in range(self.bits):
            bit = self._bit(p, i)
            ones = self.rank1(p, i)
            i = self.zeros[p] + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def _range(self, token: int, i: int) -> tuple[int, int]:
        low, high = 0, i
        for p in range(self.bits):
            a, b = self.rank1(p, low), self.rank1(p, high)
            low, high = (self.zeros[p] + a, self.zeros[p] + b) if token >> (self.bits - 1 - p) & 1 else (low - a, high - b)
        return low, high

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` stands in the first i places."""
        if token >> self.bits:
            return 0
        low, high = self._range(token, i)
        return high - low

    def locate(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``token``; -1 if there are fewer."""
        if token >> self.bits or k >= self.rank(token, self.n):
            return -1
        at = self._range(token, self.n)[0] + k
        for p in range(self.bits - 1, -1, -1):
            one = bool(token >> (self.bits - 1 - p) & 1)
            at = self.select(p, one, at - self.zeros[p] if one else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        rest = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for p in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[p].read(0, self.planes[p].size), count=self.n).view(np.bool_)
            out = np.empty_like(rest)
            out[~bit] = rest[: self.zeros[p]]
            out[bit] = rest[self.zeros[p] :] | rest.dtype.type(1 << (self.bits - 1 - p))
            rest = out
        return rest.astype(np.uint32)


def block_ones(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of BLOCK bits, and the total."""
    counts = np.bitwise_count(np.pad(plane, (0, -len(plane) % (BLOCK // 8)))).reshape(-1, BLOCK // 8).sum(1, dtype=np.int64)
    return np.concatenate(([0], np.cumsum(counts)))


def tokenizer(path: str) -> Tokenizer:
    """The worker's tokenizer of a ``tokenizers`` file.  It stays on the task's core: threads of its own cost a fifth more."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    held = worker_cache("tokenizers", 8)
    if path not in held:
        held[path] = Tokenizer.from_file(path)
    return held[path]


def joined_ids(new: list[str], encoder: Tokenizer, key: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids of pieces and their offsets; the library gets JOINED pieces as one text and splits it at a mark that none of them holds.

    The tokens' bytes tell where a piece ends.  None if they don't add up to the pieces,
    or if the tokenizer does more to a text than byte-level BPE: then each piece must go alone.
    """
    own, whole = encoder.pre_tokenizer, "".join([*new, *(t.content for t in encoder.get_added_tokens_decoder().values())])
    mark = next((m for m in MARKS if m not in whole), None)
    if not new or mark is None or encoder.normalizer is not None or not isinstance(own, ByteLevel) or own.add_prefix_space:
        return None
    held = worker_cache("id-sizes", 8)
    if key not in held:  # a character of a byte-level vocabulary is a byte
        vocabulary = encoder.get_vocab(with_added_tokens=False)
        held[key] = np.zeros(max(vocabulary.values()) + 1, np.int64)
        held[key][list(vocabulary.values())] = [len(t) for t in vocabulary]
    texts = [mark.join(new[a : a + JOINED]) for a in range(0, len(new), JOINED)]
    encoder.pre_tokenizer = Sequence([CharDelimiterSplit(mark), ByteLevel(add_prefix_space=False, use_regex=False)])
    try:
        found = [np.array(x.ids, np.uint32) for a in range(0, len(texts), 8) for x in encoder.encode_batch_fast(texts[a : a + 8], add_special_tokens=False)]
    finally:
        encoder.pre_tokenizer = own
    ids, sizes = np.concatenate(found), held[key]
    if len(ids) and ids.max() >= len(sizes):
        return None
    stops, ends = offsets(sizes[ids]), offsets([len(p.encode()) for p in new])
    first = np.searchsorted(stops, ends)
    return (ids, first) if stops[-1] == ends[-1] and (stops[first] == ends).all() else None


def library_ids(texts: list[str], encoder: Tokenizer, key: str) -> Iterator[np.ndarray]:
    """Ids of each text as the library gives them without special tokens of its own; ``key`` names the worker's memory of pieces.

    A text that holds the string of an added token goes to the library whole, which
    finds such tokens before it splits; of all others each piece is encoded once, many in one text.
    """
    added = [t.content for t in encoder.get_added_tokens_decoder().values()]

    def encode(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if joined := joined_ids(new, encoder, key):
            return joined
        found = [x.ids for a in range(0, len(new), 4096) for x in encoder.encode_batch_fast(new[a : a + 4096], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), offsets([len(x) for x in found])

    special = [any(a in t for a in added) for t in texts]
    plain = encode_texts(["" if s else t for t, s in zip(texts, special)], encode, key)
    for text, is_special, ids in zip(texts, special, plain):
        yield np.array(encoder.encode(text, add_special_tokens=False).ids, np.uint32) if is_special else ids


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, shard_ids: int = 4_000_000, partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the shards below ``spark.checkpoint.dir``; returns their table.

    A shard closes with the document that brings it to ``shard_ids`` ids; the
    range exchange gives every task consecutive documents, so memory is one shard
    plus one Arrow batch.  The tokenizer must be byte-level BPE whose pre-tokenizer
    is ``public_tokenizers.PATTERN``: its pieces are encoded once each.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    ranged = docs.select("doc_id", "text").repartitionByRange(n, order[0]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = tokenizer(tokenizer_path)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        docs_in: list[int | None] = []
        held = 0

        def shard() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            values = [part, seq, len(ids), len(flat), list(docs_in), [len(x) for x in ids], WaveletMatrix.build(flat).to_bytes()]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "seq", "n_docs", "n_ids", "doc_ids", "lengths", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        for part_of in (p for batch in batches for p in parts(batch, "text")):
            texts = [t or "" for t in part_of.column("text").to_pylist()]
            for doc_id, found in zip(part_of.column("doc_id").to_pylist(), library_ids(texts, encoder, f"pieces:{tokenizer_path}")):
                ids.append(np.append(found, np.uint32(end_id)))
                docs_in.append(doc_id)
                held += len(ids[-1])
                if held >= shard_ids:
                    yield shard()
                    seq, ids, docs_in, held = seq + 1, [], [], 0
        if ids:
            yield shard()

    return staged(ranged.mapInArrow(lean(run), SHARD_SCHEMA), "token-files")


def with_starts(files: DataFrame) -> DataFrame:
    """The shards' table with ``start``: ids of all shards before.  Works on sums per part, then per shard."""
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = sizes.select(F.col("part").alias("_part"), (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    own = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    starts = files.select("part", "seq", "n_ids").select(F.col("part").alias("_part"), F.col("seq").alias("_seq"), own.alias("_own"))
    starts = starts.join(before, "_part").select("_part", "_seq", (F.col("_own") + F.col("_before")).alias("start"))
    return files.join(starts, (files["part"] == starts["_part"]) & (files["seq"] == starts["_seq"])).drop("_part", "_seq")


def read_token_files(files: DataFrame) -> DataFrame:
    """Documents of the shards: doc_id, start (ids before it, over all shards), ids."""
    schema = "doc_id long, start long, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                of = {c: batch.column(c)[row].as_py() for c in ("doc_ids", "lengths", "payload", "start")}
                stops = np.concatenate(([0], np.cumsum(of["lengths"])))
                flat = WaveletMatrix.from_bytes(of["payload"]).decode().astype(np.int32)
                step = max(1, len(of["doc_ids"]) // (1 + len(flat) // 1_000_000))
                for a in range(0, len(of["doc_ids"]), step):
                    edges = stops[a : a + step + 1]
                    ids = pa.ListArray.from_arrays(pa.array(edges - edges[0], pa.int32()), pa.array(flat[edges[0] : edges[-1]]))
                    first = pa.array(of["start"] + edges[:-1], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(of["doc_ids"][a : a + step], pa.int64()), first, ids], names=["doc_id", "start", "ids"])

    return with_starts(files).select("doc_ids", "lengths", "payload", "start").mapInArrow(lean(run), schema)


def token_file_digests(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from its shard."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, stops = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            stops = stops - stops[0]
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(stops), pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return read_token_files(write_token_files(docs, tokenizer_path, end_id)).mapInArrow(lean(run), schema)
