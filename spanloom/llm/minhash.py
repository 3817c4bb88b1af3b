"""MinHash near-dedup: ProbMinHash signatures of weighted shingles, banding, exact verification.

A text's shingles are its runs of ``shingle`` successive words without case, weighted by
how often they occur. Each shingle sends points of a Poisson process whose rate is its
weight to random registers of the signature; the first arrival at each register wins,
and a shingle stops as soon as its next point comes later than all registers' best. Two
signatures agree in a register with the probability Jaccard similarity of the texts.
Texts that agree in all registers of a band share a bucket. Signatures tell members of a
bucket that can't be near, and those that may be are verified by the exact probability
Jaccard of their whole texts.

Defined results: texts of fewer words than a shingle have one shingle, all their words;
texts without words, and null ones, are near nothing. Rows with a null key can't be
named in a pair: they take no part and are kept. Rows that share a key are one document,
near another if any of its rows is. Of each group, pairs joined by chains, the lowest
key is kept. Columns other than key and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import textkit as tk
from .groups import Near, byte_agreement, components, link, sketch_type
from .tables import fresh, key_type, map_arrow, table, two_columns

SHINGLE = 3
BANDS, BAND_ROWS = 24, 5
#: Least probability Jaccard of near copies. Two banded texts at this similarity meet with probability 0.95.
LEAST = 0.65
#: How far the share of equal registers may lie from the similarity: about four standard deviations of 120 registers.
DOUBT = 0.16


def shingles(w: tk.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count), ordered by row and hash."""
    values, at = tk.grams(w.hash, w.row, k)
    rows = w.row[at]
    counts, bounds = w.counts(), w.bounds()
    for size in range(1, k):
        few = np.flatnonzero(counts == size)
        if len(few):
            total = np.zeros(len(few), np.uint64)
            for j in range(size):
                total = total * tk.BASE + w.hash[bounds[few] + j]
            values, rows = np.concatenate([values, tk.mix(total)]), np.concatenate([rows, few])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(first)
    return rows[at], values[at], np.diff(np.append(at, len(values)))


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """ProbMinHash of each row: 32 bits of the element that came first at each register, 2**32 - 1 where none did."""
    best = np.full(rows * registers, np.uint64(0xFFFFFFFFFFFFFFFF))
    x, step = np.zeros(len(row)), 0
    name = element & np.uint64(0xFFFFFFFF)
    while len(row):
        step += 1
        r = tk.mix(element + np.uint64(step * 0xD1B54A32D192ED03 % 2**64))
        x = x - np.log1p(-((r >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / weight
        place = row * registers + ((r & np.uint64(0x7FF)) * np.uint64(registers) >> np.uint64(11)).astype(np.int64)
        packed = x.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | name
        better = packed < best[place]
        np.minimum.at(best, place[better], packed[better])
        left, inverse = np.unique(row, return_inverse=True) if step > 3 else (np.arange(rows), row)
        last = best.reshape(rows, registers)[left].max(axis=1)[inverse]
        going = packed < last
        row, element, weight, x, name = row[going], element[going], weight[going], x[going], name[going]
    return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(rows, registers)


def band_hashes(signature: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    total = np.zeros((len(signature), bands), np.uint64)
    part = signature.reshape(len(signature), bands, band_rows).astype(np.uint64)
    for j in range(band_rows):
        total = total * tk.BASE + part[:, :, j] + np.uint64(1)
    return tk.mix(total + np.arange(bands, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)).view(np.int64)


def sketches(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """Sketches of each text of (key, text) that has words: 128 bits of its shingles and weights, its registers, its bands."""
    schema = sketch_type(key_type(docs, "key"))
    salts = tuple(np.uint64(x) for x in (0x632BE59BD9B4E019, 0x9FB21C651E98DF25))

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            row, element, weight = shingles(tk.words(part.column("text")), shingle)
            have, row = np.unique(row, return_inverse=True)
            if not len(have):
                continue
            ends = np.searchsorted(row, np.arange(len(have) + 1))
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix(element ^ tk.mix(weight.astype(np.uint64) + salt)))])[ends] for salt in salts]
            same = np.stack([x[1:] - x[:-1] for x in sums], axis=1)
            registers = signatures(row, element, weight, len(have), bands * band_rows)
            found = band_hashes(registers, bands, band_rows)
            arrays = [
                part.column("key").take(pa.array(have)), pa.array(np.zeros(len(have), np.int32)),
                pa.array([x.tobytes() for x in same], pa.binary()), pa.array(np.ones(len(have), np.int64)), pa.array([x.tobytes() for x in (registers % np.uint32(255) + np.uint32(1)).astype(np.uint8)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(have) + 1, dtype=np.int32) * bands), pa.array(found.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return map_arrow(docs.where("key is not null and text is not null"), make, schema)


def probability_jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Of two weighted sets, each given by ascending distinct hashes and their weights."""
    if not len(ha) or not len(hb):
        return 0.0
    place = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    both = hb[place] == ha
    a, b = wa[both].astype(float), wb[place[both]].astype(float)
    order = np.argsort(-a / b, kind="stable")
    a, b = a[order], b[order]
    ratio = a / b
    upto = np.searchsorted(-ratio, -ratio, "right")
    above = np.concatenate([[0], np.cumsum(a)])[upto] + (wa.sum() - a.sum())
    below = (b.sum() - np.concatenate([[0], np.cumsum(b)])[upto]) + (wb.sum() - b.sum())
    return float((1 / (above / a + below / b)).sum())


def _sets(texts: pa.Array, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for part in tk.chunks(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
        w = tk.words(part.column("text"))
        row, element, weight = shingles(w, k)
        cuts = np.searchsorted(row, np.arange(w.rows + 1))
        out += [(element[a:b], weight[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bands: int = BANDS, band_rows: int = BAND_ROWS, least: float = LEAST, doubt: float = DOUBT) -> DataFrame:
    """Verified pairs (a, b, similarity); a group of copies is a star about its lowest key, not all its pairs."""
    plain = two_columns(docs, id_col, text_col)

    @F.arrow_udf(T.DoubleType())
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out: list[float] = []
        for pairs in tk.chunks(pa.RecordBatch.from_arrays([a, b], ["a", "b"]), "b"):
            x, y = (pc.dictionary_encode(pc.fill_null(pairs.column(c), "")) for c in ("a", "b"))
            sx, sy = _sets(x.dictionary, shingle), _sets(y.dictionary, shingle)
            out += [probability_jaccard(*sx[i], *sy[j]) for i, j in zip(x.indices.to_pylist(), y.indices.to_pylist())]
        return pa.array(out, pa.float64())

    found = link(plain, sketches(plain, shingle, bands, band_rows), similar.asNondeterministic()("text_a", "text_b"), F.col("value") >= least, 1.0, Near(byte_agreement, least - doubt))
    return found.groupBy("a", "b").agg(F.max("value").alias("similarity"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """(key, lead): each document that is near one with a lower key, and the lowest key of its group."""
    return components(near_pairs(docs, id_col, text_col, **parameters))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows without those of documents that ``duplicates`` lists."""
    (gone,) = fresh(docs, "gone")
    listed = duplicates(docs, id_col, text_col, **parameters).select(F.col("key").alias(gone))
    return docs.join(listed, F.col(f"`{id_col}`") == F.col(gone), "left_anti")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(table(spark, sf_dir, "documents")).select(F.col("key").alias("doc_id"), F.col("lead").alias("duplicate_of"))
