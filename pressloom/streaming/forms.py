"""Stream forms of the batch operators: deduplication, histogram, part merge.

All run to completion (``availableNow``) and keep their checkpoints in the shared
folder.  What arrives later than the stated lateness is not looked at again; that
bound also limits the state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from pressloom.session import shared_folder

END_OF_TIME = dt.datetime(9999, 1, 1)
# States that the keys of a deduplication share, and the kinds of keys that can; NEVER: no time yet.
GROUPS = 1024
PLAIN_KEYS = [T.StringType(), T.BinaryType(), T.BooleanType(), T.DateType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
NEVER = np.iinfo(np.int64).min


def stream_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of part files as a stream; each file is taken once."""
    return spark.readStream.schema(schema).parquet(path)


def stream_dedup(
    stream: DataFrame, key: str, time: str, lateness: dt.timedelta, within: dt.timedelta, *order: str, groups: int = GROUPS
) -> DataFrame:
    """First row per key by event time; a key's copies up to ``within`` after it are dropped, the next one is a first row again.

    Rows may arrive in any order as long as they are no later than ``lateness``: a
    key holds back what the watermark has not passed and decides in the order of ``time``,
    then ``order``, so the result does not depend on files or batches.  A timer wakes the
    key when its rows are due.  Once the last first row's time is over and
    nothing is held back, the key's state goes.

    Keys are dealt to ``groups`` states by their hash and decided together, so the calls
    to Python don't follow the number of keys; a state holds its share of the rows that
    the watermark has not passed.  Keys of other kinds than PLAIN_KEYS have a state each.

    What the watermark never passes is not emitted.  Rows without a time are left out.
    """
    own = "_at"
    while any(c.lower().startswith(own) for c in stream.columns):
        own = "_" + own
    schema, span, at = stream.schema, within // dt.timedelta(microseconds=1), own
    kind = stream.select(key).schema[0].dataType
    shared = kind in PLAIN_KEYS
    # pandas has no whole numbers with nulls: they travel as 0 with a flag
    flags = {f.name: f"{own}_{i}" for i, f in enumerate(schema) if isinstance(f.dataType, T.IntegralType)}
    names = [*schema.names, at, *flags.values()]
    ids = [key, flags[key]] if key in flags else [key]
    by = [at, *(c for o in order for c in (flags.get(o), o) if c)]

    def codes_of(frame: pd.DataFrame) -> np.ndarray:
        """Numbers of the rows' keys."""
        if not shared:
            return np.zeros(len(frame), np.int64)
        code = pd.factorize(frame[ids[0]], use_na_sentinel=False)[0]
        return pd.factorize(2 * code + frame[ids[1]].to_numpy(np.bool_))[0] if len(ids) > 1 else code

    def decide(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = [read_frame(x) if x else None for x in (state.get if state.exists else (None, None))]
        some = [f[names] for f in (before[1], *frames) if f is not None and len(f)]
        rows = pd.concat(some, ignore_index=True) if some else pd.DataFrame(columns=names)
        passed = state.getCurrentWatermarkMs()
        lasts = before[0] if before[0] is not None else pd.DataFrame({c: rows[c][:0] for c in ids} | {"last": np.zeros(0, np.int64)})
        heads = [f for f in (rows[ids], lasts[ids]) if len(f)]
        code = codes_of(pd.concat(heads, ignore_index=True)) if heads else np.zeros(0, np.int64)
        last = np.full(code.max() + 1 if len(code) else 0, NEVER)
        last[code[len(rows) :]] = lasts["last"].to_numpy(np.int64)

        rows = rows.assign(**{own + "_code": code[: len(rows)]}).sort_values([own + "_code", *by], kind="stable")
        code, times = rows[own + "_code"].to_numpy(np.int64), rows[at].to_numpy(np.int64)
        due = times // 1000 < passed
        first = np.flatnonzero(due)[firsts(code[due], times[due], last, span)]
        # no row that is still to come can change what ``last`` covers
        left = ~due & ((last[code] == NEVER) | (times > last[code] + span))
        rest, covered = rows.iloc[left][names], np.flatnonzero(last != NEVER)
        covered = covered[(last[covered] + span) // 1000 >= passed]
        if len(rest) or len(covered):
            heads = pd.concat(heads, ignore_index=True)
            example = pd.Series(np.arange(len(heads))).groupby(codes_of(heads)).first().to_numpy()
            kept = heads.iloc[example[covered]].assign(last=last[covered])
            state.update((frame_bytes(kept) if len(kept) else None, frame_bytes(rest) if len(rest) else None))
            alone = covered[~np.isin(covered, code[left])]
            wake = min([*times[left].tolist(), *(last[alone] + span).tolist()])
            state.setTimeoutTimestamp(max(wake // 1000, passed + 1))
        elif state.exists:
            state.remove()
        if len(first):
            yield rows.iloc[np.sort(first)][[*schema.names, *flags.values()]]

    timed = stream.filter(F.col(time).isNotNull()).withWatermark(time, f"{lateness // dt.timedelta(milliseconds=1)} milliseconds")
    dealt = F.pmod(F.xxhash64(key), F.lit(groups)) if shared else F.col(key)
    flagged = timed.select(
        *[F.coalesce(n, F.lit(0).cast(schema[n].dataType)).alias(n) if n in flags else n for n in schema.names],
        F.unix_micros(time).alias(at), *[F.col(n).isNull().alias(f) for n, f in flags.items()], dealt.alias(own + "_group"))
    out = T.StructType([*schema, *(T.StructField(f, T.BooleanType()) for f in flags.values())])
    decided = flagged.groupBy(own + "_group").applyInPandasWithState(decide, out, "lasts binary, held binary", "append", "EventTimeTimeout")
    return decided.select(*[F.when(~F.col(flags[n]), F.col(n)).alias(n) if n in flags else F.col(n) for n in schema.names])


def firsts(code: np.ndarray, times: np.ndarray, last: np.ndarray, span: int) -> np.ndarray:
    """Places of the first rows of all keys; the rows stand by key, then time.  ``last`` (time of each key's last first row) is brought up to date."""
    moments, rank = np.unique(times, return_inverse=True)
    wide = len(moments) + 1
    where = code * wide + rank

    def after(key: np.ndarray, time: np.ndarray) -> np.ndarray:
        """For keys, the place of the first row more than ``span`` after a time."""
        return np.searchsorted(where, key * wide + np.searchsorted(moments, time + span, side="right"))

    following, keys, found = after(code, times), np.arange(len(last)), []
    place = np.where(last == NEVER, np.searchsorted(where, keys * wide), after(keys, np.maximum(last, NEVER + 1)))
    while True:
        going = place < len(code)
        going[going] = code[place[going]] == keys[going]
        place, keys = place[going], keys[going]
        if not len(place):
            return np.concatenate([*found, np.zeros(0, np.int64)])
        found.append(place)
        last[keys] = times[place]
        place = following[place]


def frame_bytes(frame: pd.DataFrame) -> bytes:
    """A frame as an Arrow stream."""
    table, sink = pa.Table.from_pandas(frame, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def read_frame(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def stream_histogram(stream: DataFrame, time: str, interval: str, lateness: str, *groups: str) -> DataFrame:
    """``start, <groups>, n`` per interval, each emitted once it can no longer change."""
    counted = stream.withWatermark(time, lateness).groupBy(F.window(time, interval), *groups).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), *groups, "n")


def whole_histogram(stream: DataFrame, name: str, time: str, interval: str, lateness: str, *groups: str) -> DataFrame:
    """The histogram of all that is there, the intervals that are still open included.

    One row at the end of time follows the stream's, so the watermark passes every other
    row and all their intervals are emitted; its own never is.
    """
    spark, kinds = stream.sparkSession, dict(stream.dtypes)
    path = shared_folder(spark, f"{name}-end")
    spark.createDataFrame([(END_OF_TIME,)], "at timestamp").write.parquet(path)
    end = spark.readStream.schema("at timestamp").parquet(path)
    closing = end.select(F.col("at").cast(kinds[time]).alias(time), *[F.lit(None).cast(kinds[g]).alias(g) for g in groups])
    return run_to_table(stream_histogram(stream.select(time, *groups).unionByName(closing), time, interval, lateness, *groups), name)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run ``stream`` over all that is there and return what it wrote.

    All files are one batch, so their order doesn't decide what is late.
    """
    spark, path = stream.sparkSession, shared_folder(stream.sparkSession, name)
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", shared_folder(spark, f"{name}-state"))
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
