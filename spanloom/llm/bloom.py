"""A Bloom filter of keys, broadcast, that spares rows of other keys a shuffle.

It only ever leaves out rows whose key isn't among the keys; some other rows pass, and
the join that follows drops them. The filter grows with its keys, at ``BITS_A_KEY`` bits
each. Keys whose filter would be larger than ``max_mb`` get none: then all rows pass and
shuffle to the join, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import textkit as tk

SEGMENTS, BITS_A_KEY = 64, 16
#: Most MB of a filter that is gathered on the driver and broadcast.
MAX_MB = 32


def probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in a filter of 2**bits bits."""
    shift = np.uint64(64 - bits)
    x = tk.mix(h + np.uint64(1))
    return (x >> shift).astype(np.int64), (tk.mix(x) >> shift).astype(np.int64)


def bits_for(n: int, bits_a_key: int) -> int:
    """Logarithm of the size of a filter of n keys."""
    return int(max(10, np.ceil(np.log2(max(n, 1) * bits_a_key))))


def test(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bits at the places are set in a packed filter."""
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def segments_of(h: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the hashes by segment, where each segment begins in that order); ``segments`` is a power of two."""
    segment = (h >> np.uint64(65 - segments.bit_length())).astype(np.int64) if segments > 1 else np.zeros(len(h), np.int64)
    order = np.argsort(segment, kind="stable")
    return order, np.searchsorted(segment[order], np.arange(segments + 1))


def members(keys: DataFrame, bits_a_key: int = BITS_A_KEY, max_mb: float = MAX_MB):
    """Function from a column to a condition that holds for all values of the frame's only column, and for few others."""
    if keys.count() * bits_a_key > max_mb * 8e6:
        return lambda column: F.lit(True)
    sent = T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("hashes", T.BinaryType())])
    made = T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("bits", T.IntegerType()), T.StructField("filter", T.BinaryType())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.unique(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            order, cuts = segments_of(h, SEGMENTS)
            used = [s for s in range(SEGMENTS) if cuts[s] < cuts[s + 1]]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([h[order[cuts[s] : cuts[s + 1]]].tobytes() for s in used], pa.binary())], sent.names)

    def merge(group: pa.Table) -> pa.Table:
        h = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()]))
        bits = bits_for(len(h), bits_a_key)
        filled = np.zeros(1 << bits, bool)
        a, b = probes(h, bits)
        filled[a] = filled[b] = True
        return pa.table([[group.column("segment")[0].as_py()], [bits], [np.packbits(filled).tobytes()]], schema=pa.schema([("segment", pa.int32()), ("bits", pa.int32()), ("filter", pa.binary())]))

    hashes = keys.select(F.xxhash64(keys.columns[0]).alias("h")).mapInArrow(send, sent)
    found = {r.segment: (r.bits, bytes(r.filter)) for r in hashes.groupBy("segment").applyInArrow(merge, made).collect()}
    shared = keys.sparkSession.sparkContext.broadcast(found)

    @F.arrow_udf(T.BooleanType())
    def passes(col: pa.Array) -> pa.Array:
        h = col.to_numpy(zero_copy_only=False).view(np.uint64)
        out = np.zeros(len(h), bool)
        order, cuts = segments_of(h, SEGMENTS)
        for s, (bits, packed) in shared.value.items():
            at = order[cuts[s] : cuts[s + 1]]
            if len(at):
                filled = np.frombuffer(packed, np.uint8)
                a, b = probes(h[at], bits)
                out[at] = test(filled, a) & test(filled, b)
        return pa.array(out)

    def condition(column: Column) -> Column:
        return passes(F.xxhash64(column))

    return condition
