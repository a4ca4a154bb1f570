"""Maximal periodic runs of words, found by block convolution.

A run is a stretch of words whose smallest period is q, at least ``least`` words and
``times`` periods long (four or more), that no neighbouring word extends.  At every
dyadic scale B the periods from B up to 2B - 1 are looked for: blocks of B words, one in
every 2B words, are compared with the 2B words that follow.  The number of each word
stands for it, and for all shifts at once ``sum (x - y)**2`` of block and window follows
from running sums of squares and one convolution by a number-theoretic transform, in
exact integers modulo PRIME.  A shift with sum zero is a distance at which the block
occurs again.  A run of four periods holds a block and its occurrence one period later,
so every run is met.  (A multiple of PRIME looks like zero: it can only add a distance.)

The distances seed extensions: how far words stay equal at that distance follows from
rolling hashes by doubling steps, then each run is compared word by word.  If a hash
has lied, the text is compared word by word at that distance.  Of several periods of one
stretch the smallest counts.

Work per word grows with the square of log n, whatever the text repeats; blocks of many
texts are transformed together, TABLE_CELLS numbers at a time.  Words are told apart by
64-bit hashes: among N of them one is mistaken with probability below N / 2**64.

Rows: a text without words (or null) has no runs and an empty collapsed text.  Repeated
rows are rows of their own; all columns are passed on, those named like a result column
are replaced.  No shuffle; a text is one row and is handled as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.arrays import gather, lean, mix, offsets, parts, powers, slice_hashes, text_bytes, word_spans, worker_cache

# 15 * 2**27 + 1: has transforms of up to 2**27 numbers; 31 generates its units.
PRIME, GENERATOR = 2013265921, 31
P = np.uint64(PRIME)
# Numbers that a transform works on at a time (kept small, so that they stay near the core), and seeds extended at a time.
TABLE_CELLS, SEEDS = 1 << 15, 1 << 17
LEAST_WORDS, LEAST_TIMES = 6, 4
ADDED = ("n_runs", "runs", "collapsed")


def reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo PRIME, in place."""
    times = x // P
    times *= P
    x -= times
    return x


def twiddles(half: int, back: bool) -> np.ndarray:
    """Powers 0 .. half - 1 of a root of unity of order 2 * half, or of its inverse."""
    held = worker_cache("roots", 64)
    key = (half, back)
    if key not in held:
        root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, -1, PRIME) if back else root
        out = np.ones(half, np.uint64)
        done = 1
        while done < half:
            step = min(done, half - done)
            out[done : done + step] = out[:step] * np.uint64(pow(root, done, PRIME)) % P
            done += step
        held[key] = out[:, None]
    return held[key]


def transform(table: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every column, in place; the result's order is bit-reversed."""
    n, columns = table.shape
    half = n // 2
    while half:
        pairs = table.reshape(n // (2 * half), 2, half, columns)
        a, b = pairs[:, 0], pairs[:, 1]
        turned = a + P
        turned -= b
        turned *= twiddles(half, False)
        a += b
        reduced(a)
        b[:] = reduced(turned)
        half //= 2
    return table


def transform_back(table: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``, in place and without the factor 1 / n."""
    n, columns = table.shape
    half = 1
    while half < n:
        pairs = table.reshape(n // (2 * half), 2, half, columns)
        a, b = pairs[:, 0], pairs[:, 1]
        turned = reduced(b * twiddles(half, True))
        b[:] = a
        b += P
        b -= turned
        reduced(b)
        a += turned
        reduced(a)
        half *= 2
    return table


def zero_shifts(values: np.ndarray, squares: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, shift) of all zeros of ``sum (x - y)**2`` between the blocks values[start:start+size] and the shifts size .. 2 * size - 1.

    ``squares``: running sums of the values' squares.  What stands behind the last value counts as 0.
    """
    span = np.arange(2 * size)[:, None]
    last = len(values) - 1
    at = starts + size + span
    window = values[np.minimum(at, last)]
    window[at > last] = 0
    block = np.zeros((2 * size, len(starts)), np.uint64)
    block[:size] = values[starts + span[:size][::-1]]
    both = transform(window)
    both *= transform(block)
    products = transform_back(reduced(both))[size - 1 : 2 * size - 1]  # the others wrap around
    products *= np.uint64(2 * pow(2 * size, -1, PRIME) % PRIME)
    own = squares[starts + size] - squares[starts]
    low = np.minimum(starts + size + span[:size], len(values))
    high = np.minimum(low + size, len(values))
    shift, block_number = np.nonzero(reduced(products) == reduced(squares[high] - squares[low] + own))
    return block_number, shift + size


def seeds(values: np.ndarray, squares: np.ndarray, rows: np.ndarray, size: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, first word, distance) of the blocks of ``size`` words that occur again at a distance that a run may have; ``rows``: offsets of the texts."""
    length = np.diff(rows)
    count = np.where(length >= times * size, length // (2 * size), 0)
    row = np.repeat(np.arange(len(length)), count)
    starts = rows[row] + 2 * size * (np.arange(len(row)) - np.repeat(offsets(count)[:-1], count))
    step = max(1, TABLE_CELLS // (2 * size))
    for k in range(0, len(row), step):
        block, shift = zero_shifts(values, squares, starts[k : k + step], size)
        its_row, start = row[k + block], starts[k + block]
        room = (times * shift <= length[its_row]) & (start + size + shift <= rows[its_row + 1])
        if room.any():
            yield its_row[room], start[room], shift[room]


def steps_equal(sums: np.ndarray, down: np.ndarray, left: np.ndarray, right: np.ndarray, room: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from ``left`` and ``right`` on (or before them) are equal, at most ``room``; ``sums``: running sums of the rolling hash."""
    done = np.zeros(len(left), np.int64)
    step = 1 << max(0, int(room.max(initial=0))).bit_length()
    while step:
        more = np.flatnonzero(done + step <= room)
        at = done[more] if forward else -done[more] - step
        a, b = left[more] + at, right[more] + at
        equal = (sums[a + step] - sums[a]) * down[a] == (sums[b + step] - sums[b]) * down[b]
        done[more[equal]] += step
        step //= 2
    return done


def stretches(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches in which values ``distance`` apart are equal, by comparing all of them."""
    equal = np.concatenate([[False], values[:-distance] == values[distance:], [False]])
    edges = np.flatnonzero(equal[1:] != equal[:-1])
    return edges[::2], edges[1::2] + distance


def find_runs(values: np.ndarray, rows: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start (in ``values``), end and period of all runs, by row, start and period.

    ``values``: the texts' words as numbers, one text after the other.
    """
    if times < 4:
        raise ValueError("blocks are sure to meet runs of four periods or more only")
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values + np.uint64(1)) * up[: len(values)], out=sums[1:])
    residues = values % P
    squares = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(reduced(residues * residues), out=squares[1:])
    # the run found last at each word: its end and its period
    until, of = np.zeros(len(values), np.int64), np.ones(len(values), np.int64)
    runs, size = [np.zeros((0, 4), np.int64)], 1
    while times * size <= np.diff(rows).max(initial=0):
        found = [np.zeros((0, 4), np.int64)]
        for all_rows, all_starts, all_distances in seeds(residues, squares, rows, size, times):
            # a multiple of the period of a run that holds block and occurrence tells nothing new
            new = (until[all_starts] < all_starts + size + all_distances) | (all_distances % of[all_starts] != 0)
            all_rows, all_starts, all_distances = all_rows[new], all_starts[new], all_distances[new]
            for k in range(0, len(all_rows), SEEDS):
                row, start, distance = all_rows[k : k + SEEDS], all_starts[k : k + SEEDS], all_distances[k : k + SEEDS]
                right = steps_equal(sums, down, start, start + distance, rows[row + 1] - start - distance, True)
                left = steps_equal(sums, down, start, start + distance, start - rows[row], False)
                low, high = start - left, start + distance + right
                long = high - low >= np.maximum(least, times * distance)
                found.append(np.unique(np.stack([row, low, high, distance], 1)[long], axis=0))
        sure = [run for one in np.unique(np.concatenate(found), axis=0).tolist() for run in _checked(values, rows, one, least, times)]
        for _, low, high, period in sorted(sure, key=lambda run: run[2] - run[1]):
            until[low:high], of[low:high] = high, period
        runs.append(np.array(sure, np.int64).reshape(-1, 4))
        size *= 2
    out = np.unique(np.concatenate(runs), axis=0)
    # a stretch stands once per multiple of its period, the smallest first
    new = np.append(True, (out[1:, :3] != out[:-1, :3]).any(1))[: len(out)]
    out = out[new]
    out = out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]
    return out[:, 0], out[:, 1], out[:, 2], out[:, 3]


def _checked(values: np.ndarray, rows: np.ndarray, run: list[int], least: int, times: int) -> list[list[int]]:
    """The run itself if its words say so, else all runs of its text at that distance."""
    row, low, high, distance = run
    first, last = int(rows[row]), int(rows[row + 1])
    ends = (low == first or values[low - 1] != values[low - 1 + distance]) and (high == last or values[high] != values[high - distance])
    if ends and np.array_equal(values[low : high - distance], values[low + distance : high]):
        return [run]
    starts, stops = stretches(values[first:last], distance)
    return [[row, first + a, first + b, distance] for a, b in zip(starts.tolist(), stops.tolist()) if b - a >= max(least, times * distance)]


def with_runs(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """``docs`` with n_runs (long), runs (array of start, length and period in words, by start, then period) and collapsed.

    ``collapsed``: the words, joined by one space, without those that a run holds after its first period.
    """
    keep = [f for f in docs.schema.fields if f.name.lower() not in ADDED]
    run = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
    schema = T.StructType([*keep, T.StructField("n_runs", T.LongType(), False), T.StructField("runs", T.ArrayType(run, False), False), T.StructField("collapsed", T.StringType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, text):
                data, edges = text_bytes(part.column(text))
                starts, ends, rows = word_spans(data, edges)
                _, values = np.unique(slice_hashes(data, starts, ends), return_inverse=True)
                row, low, high, period = find_runs(values.astype(np.uint64), rows, least, times)
                columns = [pa.array(x, pa.int64()) for x in (low - rows[row], high - low, period)]
                counts = np.bincount(row, minlength=part.num_rows).astype(np.int64)
                runs = pa.ListArray.from_arrays(pa.array(offsets(counts), pa.int32()), pa.StructArray.from_arrays(columns, fields=[pa.field(n, pa.int64(), False) for n in run.fieldNames()]))
                kept = ~covered(low + period, high, len(values))
                made = [pa.array(counts), runs, joined(data, starts[kept], ends[kept], np.append(0, np.cumsum(kept))[rows])]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), *made], names=schema.fieldNames())

    return docs.mapInArrow(lean(work), schema)


def covered(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in an interval low .. high - 1."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    return np.cumsum(change)[:n] > 0


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> pa.Array:
    """The words of each row, joined by one space."""
    lengths = ends - starts + 1
    out = gather(np.append(data, np.uint8(0x20)), starts, lengths).copy()
    stops = offsets(lengths)
    out[stops[1:] - 1] = 0x20
    edges = stops[rows]
    last = edges[1:][edges[1:] > edges[:-1]] - 1  # no space after a row's last word
    lengths_of_rows = np.diff(edges) - (edges[1:] > edges[:-1])
    whole = np.delete(out, last)
    return pa.StringArray.from_buffers(len(rows) - 1, pa.py_buffer(offsets(lengths_of_rows).astype(np.int32).tobytes()), pa.py_buffer(whole.tobytes()))


def by_exponent(a: Column, b: Column) -> Column:
    """Order of two runs: the greater length / period first, then start, then period."""
    more = b["length"] * a["period"] - a["length"] * b["period"]
    order = F.when(more != 0, F.signum(more)).when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"]))
    return order.cast("int")


def run_digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent (start, length, period, exponent_milli), runs_sha256 and collapsed_sha256."""
    out = with_runs(docs.select("doc_id", F.col(text).alias("text")))
    out = out.withColumn("first", F.get(F.array_sort("runs", by_exponent), F.lit(0)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select(
        "doc_id",
        "n_runs",
        F.col("first.start").alias("start"),
        F.col("first.length").alias("length"),
        F.col("first.period").alias("period"),
        F.floor(F.col("first.length") * 1000 / F.col("first.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_cycles(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document by hash repeats a cycle of its own words from some word on.

    With h = crc32(doc_id) a multiple of 10 and g = h // 10, words from a = g % n on
    become words a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).  A null doc_id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), "[ \\x09-\\x0D]+"), lambda w: w != "")
    out = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    out = out.withColumn("n", F.size("words"))
    out = out.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    out = out.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), rest))
    return out.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
