"""Array helpers that the Python tasks share: ragged rows, rolling hashes, worker caches."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

PART_BYTES = 1_000_000
# Odd, so that it has an inverse modulo 2**64 and prefix sums give the hash of any slice.
BASE = 0x9E3779B97F4A7C15


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for a worker that lives on: what a task has freed goes back to the system when it ends.

    Allocators keep freed memory for themselves; in a long job each stage would leave its
    peak with every worker, next to that of the next one.
    """

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return task


def worker_cache(name: str, limit: int) -> dict:
    """A dictionary that the worker's tasks of one Spark stage share; emptied once it holds ``limit`` entries."""
    context = TaskContext.get()
    stage = context.stageId() if context else None
    caches = vars(sys).setdefault("_pressloom_caches", {})
    if caches.get("stage") != stage:
        caches.clear()
        caches["stage"] = stage
    held = caches.setdefault(name, {})
    if len(held) >= limit:
        held.clear()
    return held


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**0..n and the inverses of these, modulo 2**64; kept by the worker and grown by doubling."""
    held = worker_cache(f"powers-{base}", 10)
    if len(held.get("up", ())) < n + 1:
        size = 1 << max(16, int(n + 1).bit_length())
        for key, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
            out = np.ones(size, np.uint64)
            out[1:] = np.uint64(b)
            np.multiply.accumulate(out, out=out)
            held[key] = out
    return held["up"], held["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slice_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """Rabin-Karp hash of every slice values[start:end], equal for equal slices wherever they stand.

    ``starts`` and ``ends`` rise.  Works on about ``block`` values at a time, so memory doesn't follow the text's length.
    """
    if len(starts) and ends[-1] - starts[0] > block and len(starts) > 1:
        out, i = np.empty(len(starts), np.uint64), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, side="right")))
            out[i:j] = slice_hashes(values[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i], 1 << 62)
            i = j
        return out
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    # value 0 must differ from no value, so every value counts one more
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    out = (sums[ends] - sums[starts]) * down[starts]
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(BASE))


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices values[start:start+length], one after the other."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(total)]


def offsets(lengths: Iterable[int]) -> np.ndarray:
    """0 and the running sums of ``lengths``."""
    lengths = np.asarray(list(lengths) if not isinstance(lengths, np.ndarray) else lengths, np.int64)
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def chunks(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``chars`` characters; a longer text stands alone."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about PART_BYTES of text; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    stops = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // PART_BYTES, prepend=0)).tolist()
    for a, b in zip([0, *stops], [*stops, batch.num_rows]):
        if a < b:
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the offsets of its rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def word_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of all rows, and the offsets of the rows' words."""
    held = worker_cache("word-bytes", 4)
    if "table" not in held:
        table = np.ones(256, np.bool_)
        table[[0x20, *range(0x09, 0x0E)]] = False
        held["table"] = table
    inside = held["table"][data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = rows[(rows < len(data))]
    first[edge] = inside[edge]  # a row's first word never runs on from the row before
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = rows[1:][rows[1:] > 0] - 1
    last[edge] = inside[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, rows)
