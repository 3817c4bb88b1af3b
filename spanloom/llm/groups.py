"""From sketches of texts to groups of near copies, without comparing all pairs of a bucket.

A sketch is a row (key, part, same, size, sig, buckets): texts with equal ``same`` are
copies of each other, ``sig`` holds the places of the text's signature, and texts near each
other share a bucket; sketches are compared within one ``part``. ``link`` turns them into
pairs:

1. of texts that are copies, the lowest key stands for all, so no copy needs a bucket;
2. each member of a bucket is held against the bucket's lowest key: first by sizes and
   signatures, and on their texts where these allow the two to be near;
3. pairs that passed are joined to groups. Members of a bucket that are in different groups
   are held against each other by signatures, all of them, in blocks of ``BLOCK``, so that
   the work on a hot bucket is spread over tasks. Buckets of one lowest key share many
   members, so a member's signature is sent once for all of these. Of the pairs that may be
   near, each member's best is verified and groups are joined anew, ``ROUNDS`` times; then
   all others are verified whose ends are still in different groups. Where a ``judge`` of
   texts is given, the pairs are verified in one turn instead, in cells of one lowest key:
   a text is sent once to each cell in which it has pairs, not once for each pair, and pairs
   whose ends the cell has joined already are left.

So no pair of a bucket is left out but those that sizes or signatures rule out and those
that are in one group already. A group of n near copies about its lowest key costs n
comparisons, and no bucket is cut short, whatever its size. Only texts that may be in a
pair move.

Nothing sorts or holds a bucket, a group of copies or a hub in one task: what is known of
one (lowest key, size, lowest group) is aggregated, map-side first, and joined back, and
the larger side of such a join may be split where it is skewed. ``components`` joins links
that touch, by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..plans.lineage import cut, forget
from . import textkit as tk
from .bloom import members

#: Members of a bucket that one task holds against each other.
BLOCK = 4000
#: Members of a block up to which its pairs are made together with those of other blocks, and pairs that are compared at once.
SMALL, AT_ONCE = 64, 400_000
#: How often members' best pairs are verified before all others; more rounds spare verifications, and change no group.
ROUNDS = 2
#: Characters and pairs of a lowest key's texts beyond which they are split over cells, and pairs that a cell's judge gets at once.
CELL, PAIRS, TURN = 4_000_000, 2000, 2000


def sketch_type(key: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("key", key), T.StructField("part", T.IntegerType()), T.StructField("same", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("sig", T.BinaryType()), T.StructField("buckets", T.ArrayType(T.LongType()))])


def sig_matrix(col: pa.Array) -> np.ndarray:
    """Signatures of equal length as rows of a matrix."""
    if not len(col):
        return np.zeros((0, 8), np.uint8)
    bounds = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].reshape(len(col), -1)


def byte_agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of bytes in which signatures are equal; a byte that is 0 in both says nothing."""
    used = (a > 0) | (b > 0)
    return ((a == b) & used).sum(axis=-1) / np.maximum(used.sum(axis=-1), 1)


def bit_agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from registers of one bit; the first half of a signature tells which registers are filled, the second holds the bits.

    Of registers that are filled in both, those of different elements agree half of the time.
    """
    a, b = (np.ascontiguousarray(x).view(np.uint64) for x in (a, b))
    half = a.shape[-1] // 2
    count = lambda x: np.bitwise_count(x).sum(axis=-1, dtype=np.int32)
    both = a[..., :half] & b[..., :half]
    n, differ = count(both), count((a[..., half:] ^ b[..., half:]) & both)
    return (n - 2 * differ) / np.maximum(count(a[..., :half] | b[..., :half]), 1)


@dataclass(frozen=True)
class Near:
    """What two sketches must have in common for their texts to be compared."""

    agreement: Callable[[np.ndarray, np.ndarray], np.ndarray]
    low: float  # least agreement of the signatures
    ratio: float = np.inf  # most ratio of the sizes


def _blocks_apart(bounds: np.ndarray, cut_at: np.ndarray, of: np.ndarray, sig: np.ndarray, size: np.ndarray, group: np.ndarray, near: Near) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, share) of places in one block, in different groups, that may be near; where ``cut_at`` isn't 0, i before and j from it on. ``of`` has the row of ``sig`` of each place."""

    def judged(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fit = (group[i] != group[j]) & (np.maximum(size[i], size[j]) <= near.ratio * np.minimum(size[i], size[j]))
        i, j = i[fit], j[fit]
        share = near.agreement(sig[of[i]], sig[of[j]])
        good = share >= near.low
        return i[good], j[good], share[good]

    n = np.diff(bounds)
    some = np.flatnonzero((n > 1) & (n <= SMALL))
    pairs = np.cumsum(n[some] ** 2)
    for part in np.split(some, np.searchsorted(pairs, np.arange(AT_ONCE, pairs[-1], AT_ONCE)) if len(pairs) else []):
        if not len(part):
            continue
        each = n[part] ** 2
        owner = np.repeat(np.arange(len(part)), each)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
        x, y, split = place // n[part][owner], place % n[part][owner], cut_at[part][owner]
        used = np.where(split > 0, (x < split) & (y >= split), x < y)
        yield judged((bounds[part][owner] + x)[used], (bounds[part][owner] + y)[used])
    for k in np.flatnonzero(n > SMALL).tolist():
        a, b, split = int(bounds[k]), int(bounds[k + 1]), int(cut_at[k])
        order = a + np.argsort(size[a:b], kind="stable")  # so that each is held against those of fitting size only
        sizes = size[order].astype(np.float64)
        late = (order - a) >= split
        upto = np.searchsorted(sizes, sizes * near.ratio, "right") if np.isfinite(near.ratio) else np.full(len(order), len(order))
        for x in range(len(order)):
            others = order[x + 1 : upto[x]]
            if split:
                others = others[late[x + 1 : upto[x]] != late[x]]
            if len(others):
                i, j, share = judged(np.full(len(others), order[x]), others)
                if len(i):
                    yield i, j, share


def _compare(rows: DataFrame, near: Near) -> DataFrame:
    """(a, b, share, lead) of (lead, part, lo, hi, side, group, key, size, sig, buckets): members of a block, or of two, that share a bucket, are in different groups and may be near."""
    kind = rows.schema["key"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("share", T.DoubleType()), T.StructField("lead", T.LongType())])

    names = ["lead", "part", "lo", "hi"]

    def ends_of(table) -> np.ndarray:
        """Places at which another block begins."""
        return np.flatnonzero(np.logical_or.reduce([np.diff(table.column(c).to_numpy()) != 0 for c in names])) + 1

    def whole(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        lead, lo, hi, side, group, size = (table.column(c).to_numpy() for c in ("lead", "lo", "hi", "side", "group", "size"))
        sig, key, lists = sig_matrix(table.column("sig").chunk(0)), table.column("key").chunk(0), table.column("buckets").chunk(0)
        block = np.zeros(len(lo), np.int64)
        block[ends_of(table)] = 1
        block = np.cumsum(block)
        of, bucket = np.repeat(np.arange(len(lo)), pc.list_value_length(lists).to_numpy()), lists.flatten().to_numpy()
        order = np.lexsort((of, bucket, block[of]))
        of, bucket = of[order], bucket[order]
        bounds = np.concatenate([[0], np.flatnonzero((np.diff(block[of]) != 0) | (np.diff(bucket) != 0)) + 1, [len(of)]])
        early = np.add.reduceat((side == lo)[of].astype(np.int64), bounds[:-1])
        two, n = (lo != hi)[of[bounds[:-1]]], np.diff(bounds)
        fit = ~two | (early > 0) & (early < n)  # a pair of blocks of which one is empty has no pairs
        cut_at = np.where(two, np.where(fit, early, n), 0)
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), *_blocks_apart(bounds, cut_at, of, sig, size[of], group[of], near)]
        first, second, shares = (np.concatenate(x) for x in zip(*parts))
        first, second = of[first], of[second]
        _, once = np.unique(np.minimum(first, second) * len(lo) + np.maximum(first, second), return_index=True)  # a pair may share many buckets
        first, second = first[once], second[once]
        return pa.RecordBatch.from_arrays([key.take(pa.array(first)), key.take(pa.array(second)), pa.array(shares[once]), pa.array(lead[first])], schema.names)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            before = [held[-1].slice(held[-1].num_rows - 1)] if held else []
            ends = ends_of(pa.Table.from_batches([*before, batch])) - len(before)
            if len(ends):  # all but the last block of what has come so far is whole
                if held or ends[-1]:
                    yield whole(pa.Table.from_batches([*held, batch.slice(0, int(ends[-1]))]))
                held = [batch.slice(int(ends[-1]))]
            else:
                held.append(batch)
        if held:
            yield whole(pa.Table.from_batches(held))

    return rows.select(*names, "side", "group", "key", "size", "sig", "buckets").repartition(*names).sortWithinPartitions(*names, "side", "key").mapInArrow(over, schema)


def texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, text_a, text_b) of pairs of keys; the texts are shuffled once by key, and those of ``b`` once more to their partners."""
    texts = docs.select("key", "text")
    leads = pairs.select("a").distinct().hint("shuffle_hash").join(texts.withColumnRenamed("key", "a"), "a").withColumnRenamed("text", "text_a")
    return pairs.hint("shuffle_hash").join(texts.withColumnRenamed("key", "b"), "b").withColumnRenamed("text", "text_b").join(leads, "a")


Judge = Callable[[list[str], list[str]], list[float | None]]


def verified_in_cells(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, judge: Judge, cell: int = CELL, many: int = PAIRS) -> DataFrame:
    """(a, b, value) of those pairs (a, b, share, lead) that ``judge`` gives a value, without pairs whose ends are joined by others of their cell.

    A cell has the pairs of one ``lead``, or where its texts have more than ``cell``
    characters by ``sizes`` (key, size) or more than ``many`` pairs, those between two parts
    of them: about twice ``many`` at most, where no text has most of the pairs.
    """
    kind = pairs.schema["a"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("value", T.DoubleType())])
    names = ["lead", "lo", "hi"]
    ends = F.explode(F.array("a", "b")).alias("key")
    loads = pairs.select("lead", ends).distinct().join(sizes, "key").groupBy("lead").agg((F.sum("size") / cell).alias("by_size"))
    loads = loads.join(pairs.groupBy("lead").agg(F.sqrt(F.count("*") / many).alias("by_pairs")), "lead").select("lead", F.ceil(F.greatest("by_size", "by_pairs")).alias("parts"))
    x, y = (F.pmod(F.xxhash64(c), F.col("parts")) for c in "ab")
    placed = cut(pairs.join(loads, "lead").select("lead", F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi"), "a", "b", "share"))
    own = members(placed.select(ends))
    texts = docs.where(own(F.col("key"))).join(placed.select(*names, ends).distinct(), "key")
    both = texts.select(*names, F.col("key").alias("a"), F.lit(None).cast(kind).alias("b"), F.lit(None).cast("double").alias("share"), "text").union(placed.select(*names, "a", "b", "share", F.lit(None).cast("string").alias("text")))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, texts, forest, waiting, held = None, {}, {}, [], 0

        def root(forest: dict, k):
            while (up := forest.get(k, k)) != k:
                forest[k] = k = forest.get(up, up)
            return k

        def judged() -> pa.RecordBatch:
            asked = [(k, s, t) for k, (a, b, own, forest) in enumerate(waiting) if root(forest, a) != root(forest, b) for s in own.get(a, ()) for t in own.get(b, ())]
            best: dict[int, float] = {}
            for (k, _, _), v in zip(asked, judge([s for _, s, _ in asked], [t for _, _, t in asked])):
                if v is not None:
                    best[k] = min(v, best.get(k, v))
            for k in best:
                a, b, _, forest = waiting[k]
                forest[root(forest, a)] = root(forest, b)
            made = pa.RecordBatch.from_arrays([pa.array([waiting[k][i] for k in best], sent.field(c).type) for i, c in enumerate("ab")] + [pa.array(best.values(), pa.float64())], schema.names)
            waiting.clear()
            return made

        for batch in batches:
            sent = pa.schema([batch.schema.field(c) for c in "ab"])
            columns = [batch.column(c).to_pylist() for c in (*names, "a", "b", "text")]
            for *place, a, b, text in zip(*columns):
                if place != at:
                    at, texts, forest = place, {}, {}
                    if held > 2 * cell:
                        yield judged()
                        held = 0
                if b is not None:
                    waiting.append((a, b, texts, forest))
                    if len(waiting) >= TURN:
                        yield judged()
                elif text:
                    texts.setdefault(a, []).append(text)
                    held += len(text)
            del columns
            tk.release()
        if waiting:
            yield judged()
        tk.release()

    first = F.col("b").isNotNull()
    return both.repartition(*names).sortWithinPartitions(*names, first, F.desc("share"), "a", "b").mapInArrow(over, schema)


def link(docs: DataFrame, sketches: DataFrame, value: Column, keep: Column, of_copies: float, near: Near, block: int = BLOCK, judge: Judge | None = None) -> DataFrame:
    """Verified pairs (a, b, value), a < b: those whose ``value`` of (text_a, text_b) passes ``keep``, and copies.

    ``judge`` gives many pairs of texts their values, None where they don't pass.
    """
    spark = docs.sparkSession

    @F.arrow_udf(T.BooleanType())
    def may(sig_a: pa.Array, sig_b: pa.Array, size_a: pa.Array, size_b: pa.Array) -> pa.Array:
        x, y = size_a.to_numpy(), size_b.to_numpy()
        return pa.array((near.agreement(sig_matrix(sig_a), sig_matrix(sig_b)) >= near.low) & (np.maximum(x, y) <= near.ratio * np.minimum(x, y)))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = cut(pairs)
        own = members(pairs.select(F.explode(F.array("a", "b")).alias("key")))
        return texts_of(pairs, docs.where(own(F.col("key")))).select("a", "b", value.alias("value")).where(keep)

    every = cut(sketches)
    multiple = cut(every.groupBy("part", "same").agg(F.min("key").alias("head"), F.max("key").alias("z")).where("head <> z").drop("z"))
    heads = cut(every.select("key", "part", "same").join(multiple, ["part", "same"]).where("key <> head").select("key", "part", "same", "head").distinct())
    copies = heads.select(F.col("head").alias("a"), F.col("key").alias("b"), F.lit(of_copies).alias("value")).distinct()
    copied = members(heads.select("key"))
    rows = every.where(~copied(F.col("key"))).union(every.where(copied(F.col("key"))).join(heads, ["key", "part", "same"], "left_anti").select(every.columns))
    placed = rows.select("key", "part", F.explode("buckets").alias("bucket"))
    firsts = cut(placed.groupBy("bucket").agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a <> z").drop("z"))
    several = members(firsts.select("bucket"))
    led = cut(placed.where(several(F.col("bucket"))).join(firsts, "bucket").where("a <> key").select("bucket", "part", "a", F.col("key").alias("b")).distinct())
    ends = cut(led.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    shared = members(ends)
    few = cut(rows.select("key", "part", "size", "sig").where(shared(F.col("key"))))
    del every, rows, placed
    forget(spark)
    side = lambda name: few.select(F.col("key").alias(name), "part", F.struct("size", "sig").alias(f"of_{name}"))
    held = led.select("a", "b", "part").distinct()
    if np.isfinite(near.ratio):  # signatures are sent for pairs of fitting sizes only
        for name in ("b", "a"):
            held = held.join(few.select(F.col("key").alias(name), "part", F.col("size").alias(f"size_{name}")), [name, "part"])
        held = held.where(F.greatest("size_a", "size_b") <= near.ratio * F.least("size_a", "size_b")).select("a", "b", "part").distinct()
    held = held.join(side("b"), ["b", "part"]).join(side("a"), ["a", "part"])
    held = cut(held.where(may("of_a.sig", "of_b.sig", "of_a.size", "of_b.size")).select("a", "b").distinct())
    found = cut(copies.union(verified(held)))
    forget(spark)

    def grouped(pairs: DataFrame, found: DataFrame, names: tuple[str, ...]) -> DataFrame:
        """``pairs`` with the group of each key column of ``names``."""
        group = cut(components(found))
        for name in names:
            pairs = pairs.join(group.select(F.col("key").alias(name), F.col("lead").alias(f"of_{name}")), name, "left").withColumn(f"of_{name}", F.coalesce(f"of_{name}", name))
        return pairs

    rest = cut(grouped(led.select("bucket", "part", F.col("a").alias("lead"), F.col("b").alias("key")), found, ("key",)))
    mixed = cut(rest.groupBy("bucket").agg(F.min("of_key").alias("x"), F.max("of_key").alias("y"), F.count("*").alias("n"), F.xxhash64(F.min("lead")).alias("lead")).where("x <> y").select("bucket", "lead", "n"))
    blocks = mixed.groupBy("lead").agg(F.ceil(F.max("n") / block).alias("blocks"))
    spread = rest.drop("lead").join(mixed.join(blocks, "lead").select("bucket", "lead", "blocks"), "bucket").repartition("key", "part")
    spread = spread.groupBy("key", "part", "lead").agg(F.min(F.xxhash64("of_key")).alias("group"), F.min("blocks").alias("blocks"), F.collect_list("bucket").alias("buckets"))
    spread = spread.withColumn("side", F.pmod(F.xxhash64("key", "lead"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = spread.select("lead", "part", "key", "group", "buckets", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    others = _compare(spread.join(few, ["key", "part"]), near).where("a <> b")
    others = others.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("share").alias("share"), F.min("lead").alias("lead"))
    others = cut(others.join(held, ["a", "b"], "left_anti"))
    del led, rest, mixed, blocks, spread
    forget(spark)
    if judge:
        return found.union(verified_in_cells(others, docs, few.groupBy("key").agg(F.max("size").alias("size")), judge))
    others = others.drop("lead")
    for _ in range(ROUNDS):
        if others.isEmpty():
            return found
        best = others.select(F.explode(F.array("a", "b")).alias("of"), F.struct((-F.col("share")).alias("s"), "a", "b").alias("pair")).groupBy("of").agg(F.min("pair").alias("pair"))
        best = cut(best.select("pair.a", "pair.b").distinct())
        found = cut(found.union(verified(best)))
        others = cut(grouped(others.join(best, ["a", "b"], "left_anti"), found, ("a", "b")).where("of_a <> of_b").select("a", "b", "share"))
    return found.union(verified(others.select("a", "b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "m"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(key, lead): every key of (a, b) but the lowest of its component, and that lowest key.

    In each round a node's larger neighbours, and then its smaller ones, are linked to the
    lowest node about it. The lowest nodes are aggregated and joined back, so a hub is
    never sorted in one task; rounds grow with the logarithm of the longest chain.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v <> m").distinct())
    state = _state(now)
    while state[0]:
        both = now.union(now.select("m", "v")).toDF("u", "v")
        lows = both.groupBy("u").agg(F.min("v").alias("low"))
        large = both.where("v > u").join(lows, "u").select("v", F.least("u", "low").alias("m")).distinct()
        lows = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(lows, "v").select(F.explode(F.array(F.struct("v", F.col("low").alias("m")), F.struct(F.col("m").alias("v"), F.col("low").alias("m")))).alias("e"))
        now = cut(small.select("e.*").where("v <> m").distinct())
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("v").alias("key"), F.col("m").alias("lead"))
