"""Benchmark decontamination: greedy string tiling of test items in documents.

Items and documents that share a run of ``least`` successive words are found by rolling
(Karp-Rabin) hashes; each such pair is tiled: the longest match of words that aren't
marked yet is marked again and again, until no match of ``least`` words is left. The
coverage is the share of the item's words that are marked. Tiles may lie in any order,
so an item whose passages were moved about is still found.

Items whose texts take ``broadcast_mb`` at most are broadcast, and documents never
shuffle. Beyond that, items and documents meet in a shuffled join of their run hashes;
both ways give the same pairs and the same coverages.

Words are compared by 64 bits of their hashes.

Defined results: words are runs of alphanumeric characters without case. An item of
fewer than ``least`` words must be matched whole, in one tile; one without words, or with
a null text, is matched by nothing. Null and empty documents match nothing. Rows with a
null key are scored, with that null key. Rows that repeat are scored each for itself.
Of matches equally long, the first in the document, then in the item, is marked first.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import textkit as tk
from .tables import fresh, key_type, map_arrow, table, two_columns

#: Words of the shortest tile.
LEAST = 4
#: Least share of an item's words in tiles for a document to be contaminated.
COVERAGE = 0.5
#: Most MB of item text that is broadcast.
BROADCAST_MB = 16


def tiles(doc: np.ndarray, item: np.ndarray, least: int, seeds: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (length, place in doc, place in item) of the tiles, longest first.

    ``seeds``: (places in doc, places in item) of all matching runs of ``least`` words.
    """
    if seeds is None:
        gd, gi = (tk.grams(x, np.zeros(len(x), np.int64), least)[0] for x in (doc, item))
        where = defaultdict(list)
        for q, h in enumerate(gi.tolist()):
            where[h].append(q)
        found = [(p, q) for p, h in enumerate(gd.tolist()) for q in where.get(h, ())]
        seeds = (np.array([p for p, _ in found], np.int64), np.array([q for _, q in found], np.int64))
    p, q = seeds
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(p) != 1) | (np.diff(q) != 1)
    at = np.flatnonzero(new)
    heap = [(-(int(n) + least - 1), int(p[i]), int(q[i])) for i, n in zip(at, np.diff(np.append(at, len(p))))]
    heapq.heapify(heap)
    used_doc, used_item, out = set(), bytearray(len(item)), []
    while heap:
        length, a, b = heapq.heappop(heap)
        free, begin, whole = [], None, True
        for k in range(-length + 1):
            if k < -length and a + k not in used_doc and not used_item[b + k]:
                begin = k if begin is None else begin
                continue
            whole = whole and k == -length
            if begin is not None and k - begin >= least:
                free.append((begin, k - begin))
            begin = None
        if whole:
            used_doc.update(range(a, a - length))
            used_item[b : b - length] = b"\1" * -length
            out.append((-length, a, b))
        else:
            for begin, n in free:
                heapq.heappush(heap, (-n, a + begin, b + begin))
    return out


@dataclass
class Items:
    """Benchmark items as words, and all their runs by length and hash."""

    keys: list
    words: list[np.ndarray]
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # run length: (sorted hashes, item, place, filter)


def index_items(keys: list, texts: pa.Array, least: int = LEAST) -> Items:
    w = tk.words(texts)
    bounds = w.bounds()
    lists = [w.hash[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    groups: dict[int, list[int]] = defaultdict(list)
    for i, x in enumerate(lists):
        if len(x):
            groups[min(len(x), least)].append(i)
    by_length = {}
    for k, members in groups.items():
        parts = [(tk.grams(lists[i], np.zeros(len(lists[i]), np.int64), k)[0], i) for i in members]
        hashes = np.concatenate([h for h, _ in parts])
        item = np.concatenate([np.full(len(h), i) for h, i in parts])
        place = np.concatenate([np.arange(len(h)) for h, _ in parts])
        order = np.argsort(hashes, kind="stable")
        near = np.zeros(1 << 22, bool)
        near[(hashes >> np.uint64(42)).astype(np.int64)] = True
        by_length[k] = (hashes[order], item[order], place[order], near)
    return Items(keys, lists, by_length)


def _matches(w: tk.Words, items: Items) -> Iterator[tuple[int, int, float]]:
    """(row, item, coverage) of every row and item that share a run."""
    bounds = w.bounds()
    for k, (hashes, item, place, near) in items.by_length.items():
        h, at = tk.grams(w.hash, w.row, k)
        maybe = np.flatnonzero(near[(h >> np.uint64(42)).astype(np.int64)])
        lo, hi = np.searchsorted(hashes, h[maybe], "left"), np.searchsorted(hashes, h[maybe], "right")
        owner, offset = tk.segments(hi - lo)
        if not len(owner):
            continue
        run = lo[owner] + offset
        first = at[maybe[owner]]
        row, which = w.row[first], item[run]
        p, q = first - bounds[row], place[run]
        order = np.lexsort((which, row))
        row, which, p, q = row[order], which[order], p[order], q[order]
        cuts = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(which) != 0), [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            text = items.words[which[a]]
            total = sum(n for n, _, _ in tiles(w.hash[bounds[row[a]] : bounds[row[a] + 1]], text, k, (p[a:b], q[a:b])))
            yield int(row[a]), int(which[a]), total / len(text)


def _result_schema(docs: DataFrame, items: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("key", key_type(docs, "key")), T.StructField("item", key_type(items, "key")), T.StructField("coverage", T.DoubleType())])


def _broadcast_scan(docs: DataFrame, items: DataFrame, least: int, coverage: float) -> DataFrame:
    rows = items.collect()
    index = index_items([r.key for r in rows], pa.array([r.text for r in rows], pa.string()), least)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = _result_schema(docs, items)

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            found = [x for x in _matches(tk.words(part.column("text")), shared.value) if x[2] >= coverage]
            if found:
                names = pa.array([shared.value.keys[i] for _, i, _ in found], arrow_type(schema["item"].dataType))
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array([r for r, _, _ in found])), names, pa.array([c for _, _, c in found])], schema.names)

    return map_arrow(docs.where("text is not null"), scan, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _item_sizes(items: DataFrame, least: int) -> list[int]:
    """The sizes of runs by which items are found: ``least``, or all their words where they have fewer."""
    schema = T.StructType([T.StructField("size", T.LongType())])

    def sizes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.minimum(tk.words(part.column("text")).counts(), least)).astype(np.int64))], schema.names)

    return sorted(r.size for r in map_arrow(items.where("text is not null"), sizes, schema).distinct().where("size > 0").collect())


def _run_rows(df: DataFrame, least: int, sizes: list[int], lengths: bool) -> DataFrame:
    """(key, run) of each distinct run hash of each text, for runs of ``sizes`` words; of items only the runs of the size that they are found by."""
    schema = T.StructType([T.StructField("key", key_type(df, "key")), T.StructField("run", T.LongType())])

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            w = tk.words(part.column("text"))
            counts = w.counts()
            rows, values = [], []
            for k in sizes:
                h, at = tk.grams(w.hash, w.row, k)
                row = w.row[at]
                used = (np.minimum(counts[row], least) == k) if lengths else np.ones(len(row), bool)
                rows.append(row[used])
                values.append(h[used] ^ np.uint64(k))
            row, value = np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.uint64), *values])
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            new = np.ones(len(row), bool)
            new[1:] = (np.diff(row) != 0) | (value[1:] != value[:-1])
            if not new.any():
                continue
            yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(row[new])), pa.array(value[new].view(np.int64))], schema.names)

    return map_arrow(df.where("text is not null"), make, schema)


def _shuffled_scan(docs: DataFrame, items: DataFrame, least: int, coverage: float) -> DataFrame:
    id_docs = docs.where("text is not null").groupBy("key", "text").count()
    named = id_docs.withColumn("name", F.struct("key", F.xxhash64("text").alias("h"), F.md5("text").alias("m")))
    item_rows = items.where("text is not null").withColumn("name", F.struct("key", F.md5("text").alias("m")))
    sizes = _item_sizes(item_rows, least)
    pairs = (
        _run_rows(named.select(F.to_json("name").alias("key"), "text"), least, sizes, False).alias("d")
        .join(_run_rows(item_rows.select(F.to_json("name").alias("key"), "text"), least, sizes, True).alias("i"), "run")
        .select(F.col("d.key").alias("d"), F.col("i.key").alias("i")).distinct()
    )
    schema = _result_schema(docs, items)

    def tile(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for part in tk.chunks(batch, "text"):
            w, v = tk.words(part.column("text")), tk.words(part.column("item_text"))
            wb, vb = w.bounds(), v.bounds()
            for r in range(part.num_rows):
                item = v.hash[vb[r] : vb[r + 1]]
                if len(item):
                    out.append((part.column("key")[r].as_py(), part.column("item")[r].as_py(), sum(n for n, _, _ in tiles(w.hash[wb[r] : wb[r + 1]], item, min(least, len(item)))) / len(item), part.column("count")[r].as_py()))
        found = [x[:3] for x in out if x[2] >= coverage for _ in range(x[3])]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), arrow_type(f.dataType)) for x, f in zip(zip(*found) if found else ((), (), ()), schema)], schema.names)

    wide = pairs.join(named.select(F.to_json("name").alias("d"), "key", "text", "count"), "d").join(item_rows.select(F.to_json("name").alias("i"), F.col("key").alias("item"), F.col("text").alias("item_text")), "i")
    return map_arrow(wide.select("key", "text", "item", "item_text", "count"), tile, schema)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = LEAST, coverage: float = COVERAGE, broadcast_mb: float = BROADCAST_MB) -> DataFrame:
    """(key, item, coverage) of each document and item whose coverage is ``coverage`` at least."""
    plain, tests = two_columns(docs, id_col, text_col), two_columns(items, item_id, item_text)
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return (_broadcast_scan if size <= broadcast_mb * 1e6 else _shuffled_scan)(plain, tests, least, coverage)


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of documents that no item covers; rows with a null key stay unless a row with a null key is covered."""
    (gone,) = fresh(docs, "gone")
    bad = contaminated(docs, items, id_col, text_col, **parameters).select(F.col("key").alias(gone)).distinct()
    return docs.join(bad, F.col(f"`{id_col}`").eqNullSafe(F.col(gone)), "left_anti")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "coverage")
