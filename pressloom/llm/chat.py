"""Chat formatting with prefix-target expansion.

A conversation's turns stand by turn number.  Every assistant turn becomes an example
of its own: all turns before it as context, then that reply, which alone is trainable.
If the last turn is not an assistant's, one more example holds the whole conversation
and has no trainable part, so no turn is lost.

Template, per turn: ``### role:``, a line end, the text, ``</turn>`` and a line end.
In texts and roles a backslash precedes every backslash, ``###`` and ``</turn>`` (in
roles also every colon and line end), so control strings in a text stay text, and
dropping the escapes gives it back.  Loss spans are code points of the formatted string.

Rows: a null text or role is empty.  A null turn number stands last; equal numbers are
ordered by role, then text.  Repeated rows are repeated turns.  A null conv_id is one
conversation.  Other columns are not used.  A conversation is put together in one task,
as each of its examples is one string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.arrays import lean

TRAINED_ROLE = "assistant"
BATCH_CHARS = 8_000_000
CONTROL = re.compile(r"\\|###|</turn>")
ROLE_CONTROL = re.compile(r"\\|###|</turn>|:|\n")
ESCAPED = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"### ((?:[^\\:\n]|\\.)*):\n((?:[^\\<]+|\\.|<(?!/turn>))*)</turn>\n", re.S)
EXAMPLES = "conv_id long, example int, formatted string, loss_start int, loss_end int"


def escape(text: str, control: re.Pattern = CONTROL) -> str:
    return control.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def examples_of(turns: list[tuple[str, str]]) -> Iterator[tuple[str, int | None, int | None]]:
    """(formatted, loss start, loss end) of each example of a conversation."""
    whole, stops = [], []
    at = 0
    for i, (role, text) in enumerate(turns):
        head, body = f"### {escape(role, ROLE_CONTROL)}:\n", escape(text)
        whole += [head, body, "</turn>\n"]
        start = at + len(head)
        at = start + len(body) + len("</turn>\n")
        if role == TRAINED_ROLE:
            stops.append((at, start, start + len(body)))
        elif i == len(turns) - 1:
            stops.append((at, None, None))
    joined = "".join(whole)
    for end, start, stop in stops:
        yield joined[:end], start, stop


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted example."""
    out, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


def format_chats(conversations: DataFrame) -> DataFrame:
    """Examples: conv_id, example (from 0), formatted, loss_start, loss_end (null: nothing trainable)."""
    turn = F.struct(
        F.col("turn").isNull().alias("late"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
        names = ["conv_id", "example", "formatted", "loss_start", "loss_end"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

        rows, held = [], 0
        for batch in batches:
            for conv_id, turns in zip(batch.column("conv_id"), batch.column("turns")):
                for k, found in enumerate(examples_of([(t["role"], t["text"]) for t in turns.as_py()])):
                    rows.append((conv_id.as_py(), k, *found))
                    held += len(found[0])
                    if held >= BATCH_CHARS:
                        yield out(rows)
                        rows, held = [], 0
        if rows:
            yield out(rows)

    return grouped.select(F.col("conv_id").cast("long").alias("conv_id"), "turns").mapInArrow(lean(run), EXAMPLES)


def chat_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from the examples."""
    schema = "conv_id long, example int, n_turns long, turns_sha256 string, loss string, formatted_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                conv_id, example, formatted, start, end = (batch.column(c)[row].as_py() for c in range(5))
                turns = parse(formatted)
                digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
                out.append((conv_id, example, len(turns), digest, unescape(formatted[start:end]) if start is not None else None, len(formatted)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["conv_id", "example", "n_turns", "turns_sha256", "loss", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds)], names=names)

    parts = format_chats(conversations).mapInArrow(lean(read), schema)
    loss = F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss"))))
    whole = parts.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max_by("turns_sha256", "example").alias("turns_sha256"),
        F.array_join(F.transform(loss, lambda x: x["loss"]), "").alias("_loss"),
        F.sum("formatted_chars").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS k,
        count(*) OVER (PARTITION BY conv_id) AS n FROM c),
s AS (SELECT *, sum(length(regexp_replace(role, '\\|###|</turn>|:|\n', '\\\0', 'g'))
                  + length(regexp_replace(text, '\\|###|</turn>', '\\\0', 'g')) + 14)
              OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""
