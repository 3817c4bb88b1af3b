"""Chat formatting: whole conversations assembled into one Arrow buffer per batch.

Each turn becomes ``<|im_start|>role\\ncontent<|im_end|>\\n`` and a conversation the
turns in order. The turns of a conversation meet in one shuffle; each batch then computes
the lengths of all segments (markers, roles, contents), their cumulative offsets in the
output, and from both the place every output byte comes from, and fills one preallocated
buffer by a single gather. No string is built in Python.

Spans tell which bytes of the output are content of an assistant, for a training loss.

Defined results: turns are ordered by turn, then role, then content, nulls first, so ties
don't depend on the input's order; repeated rows are repeated turns. A null or empty
role or content is written as nothing between its markers, and only the role
"assistant", exactly, counts as one. Rows without a conversation key form one
conversation with a null key. Markers that occur inside a content stay as they are.
Other columns are ignored. An empty table gives no conversations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import textkit as tk
from .tables import key_type, table

BEGIN, MIDDLE, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and each row's offset."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    bounds = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def assemble(role: pa.Array, content: pa.Array, first: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(conversations, span starts, span ends) of ordered turns; ``first`` has the index of each conversation's first turn.

    A span is counted from the beginning of its conversation; turns that aren't an assistant's have an empty one.
    """
    n = len(role)
    marks = np.frombuffer(BEGIN + MIDDLE + END, np.uint8)
    role_data, role_at = _bytes(role)
    text_data, text_at = _bytes(content)
    source = np.concatenate([marks, role_data, text_data])
    begin = np.empty((n, 5), np.int64)
    length = np.empty((n, 5), np.int64)
    for j, (b, k) in enumerate(((0, len(BEGIN)), (len(marks) + role_at[:-1], np.diff(role_at)), (len(BEGIN), len(MIDDLE)), (len(marks) + len(role_data) + text_at[:-1], np.diff(text_at)), (len(BEGIN) + len(MIDDLE), len(END)))):
        begin[:, j], length[:, j] = b, k
    begin, length = begin.ravel(), length.ravel()
    ends = np.cumsum(length)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    np.take(source, np.arange(len(out)) + np.repeat(begin - (ends - length), length), out=out)
    turn_start = np.append(ends[4::5] - length.reshape(n, 5).sum(1), len(out)) if n else np.zeros(1, np.int64)
    bounds = np.append(turn_start[first], len(out)).astype(np.int64)
    texts = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.tobytes()), pa.py_buffer(out))
    own = np.repeat(bounds[:-1], np.diff(np.append(first, n)))
    stop = ends[3::5] - own
    return texts, stop - np.diff(text_at) * (pc.fill_null(pc.equal(role, "assistant"), False).to_numpy(zero_copy_only=False)), stop


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """(conv, text, turns, spans) of each conversation; spans are (start, end) in bytes of the content of assistants."""
    plain = turns.select(F.col(f"`{conv_col}`").alias("key"), F.col(f"`{turn_col}`").alias("turn"), F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"))
    plain = plain.repartition(partitions, "key") if partitions else plain.repartition("key")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField(conv_col, key_type(turns, conv_col)), T.StructField("text", T.StringType()), T.StructField("turns", T.LongType()), T.StructField("spans", T.ArrayType(span))])

    def finish(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        key, role, text = (rows.column(c).chunk(0) if rows.num_rows else pa.array([], rows.schema.field(c).type) for c in ("key", "role", "text"))
        first = np.concatenate([[0], _changes(key) + 1]).astype(np.int64)
        texts, start, stop = assemble(role, text, first)
        used = stop > start
        conv = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(conv, used, len(first)))]).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(start[used]), pa.array(stop[used])], ["start", "end"])
        return pa.RecordBatch.from_arrays([key.take(pa.array(first)), texts.cast(pa.string()), pa.array(np.diff(np.append(first, len(key)))), pa.ListArray.from_arrays(pa.array(offsets), spans)], schema.names)

    def _changes(key: pa.Array) -> np.ndarray:
        """Indices after which another conversation begins."""
        a, b = key.slice(0, len(key) - 1), key.slice(1)
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        return np.flatnonzero(~same.to_numpy(zero_copy_only=False))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in tk.chunks(batch, "text"):
                key = pa.concat_arrays([held[-1].column("key").slice(held[-1].num_rows - 1), part.column("key")]) if held else part.column("key")
                changes = _changes(key) + 1 - bool(held)
                if len(changes):  # all but the last conversation of what has come so far is whole
                    cut = int(changes[-1])
                    yield finish(pa.Table.from_batches([*held, part.slice(0, cut)]))
                    held = [part.slice(cut)]
                else:
                    held.append(part)
        if held:
            yield finish(pa.Table.from_batches(held))

    return plain.sortWithinPartitions("key", "turn", "role", "text").mapInArrow(over, schema)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = format_chats(table(spark, sf_dir, "conversations"))
    return chats.withColumn("spans", F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ","))


ORACLE = """
with s as (
  select conv_id, turn, role, text, '<|im_start|>' || coalesce(role, '') || chr(10) as head, coalesce(text, '') as body, '<|im_end|>' || chr(10) as tail,
         row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n from conversations
), p as (
  select *, strlen(head) as h, strlen(body) as b, sum(strlen(head) + strlen(body) + strlen(tail)) over (partition by conv_id order by n) - strlen(head) - strlen(body) - strlen(tail) as before from s
)
select conv_id, string_agg(head || body || tail, '' order by n) as text, count(*) as turns,
       coalesce(string_agg(cast(before + h as bigint) || '-' || cast(before + h + b as bigint), ',' order by n) filter (role = 'assistant' and b > 0), '') as spans
from p group by conv_id
"""
