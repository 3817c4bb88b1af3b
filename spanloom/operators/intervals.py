"""Interval operators: overlap joins, depth, islands and merging.

Intervals are 0-based and half-open. All of them work on a partition key (a chromosome
or a query) and two coordinates; coordinates of one side are integers. Sweeps over a key
are cut at bins, with what a bin takes over from those before it summed up beside, so a
long key is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Width of the bins that overlap joins meet in; about 2 to 4 times a typical interval.
BIN = 1000
#: Intervals of more than so many bins are long, and meet others in bins that are so many times as wide.
LONG, WIDER = 64, 1000
#: Width of the bins that sweeps are cut at.
SWEEP = 1_000_000


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns])


def range_join(left: DataFrame, right: DataFrame, key: str | list[str], left_cols: tuple[str, str] = ("pos", "end_pos"), right_cols: tuple[str, str] = ("pos", "end_pos"), bin_width: int = BIN, suffixes: tuple[str, str] = ("l_", "r_"), flank: int = 0) -> DataFrame:
    """All pairs of rows with equal key whose intervals share a base, or lie within ``flank`` bases.

    Both sides are spread over the bins that they touch and joined on (key, bin), so
    neither a long partition nor a hot chromosome is compared as a whole; a pair is kept
    in the first bin that both touch, so none comes twice. Short intervals meet in narrow
    bins, and long ones meet all others in wide bins, so that an interval of any length
    is spread over few. An interval of no width counts as the base it begins at. Rows with
    null keys or coordinates join nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    a, b = suffixes
    (la, lb), (ra, rb) = left_cols, right_cols
    x, y = _prefixed(left, a), _prefixed(right, b)
    l0, l1 = F.col(f"{a}{la}") - flank, F.greatest(F.col(f"{a}{lb}"), F.col(f"{a}{la}") + 1) + flank
    r0, r1 = F.col(f"{b}{ra}"), F.greatest(F.col(f"{b}{rb}"), F.col(f"{b}{ra}") + 1)
    wide = bin_width * WIDER

    x = x.withColumn("__l", F.explode(_kinds(l0, l1, 2, bin_width)))
    y = y.withColumn("__r", F.explode(_kinds(r0, r1, 1, bin_width)))
    width = F.when(F.col("__l.kind") == 0, bin_width).otherwise(wide)
    on = (F.col("__l.kind") == F.col("__r.kind")) & (F.col("__l.bin") == F.col("__r.bin")) & (l0 < r1) & (r0 < l1) & (F.col("__l.bin") == F.floor(F.greatest(l0, r0) / width))
    for k in keys:
        on = on & (F.col(f"{a}{k}") == F.col(f"{b}{k}"))
    return x.join(y, on).drop("__l", "__r")


def _kinds(begin: Column, end: Column, own: int, bin_width: int) -> Column:
    """The (kind, bin) places of an interval: kind 0 holds short ones of both sides, 2 long ones of the left and short ones of the right, 1 the reverse, 3 long ones of both."""

    def spread(kind: int, width: int) -> Column:
        return F.transform(F.sequence(F.floor(begin / width), F.floor((end - 1) / width)), lambda i: F.struct(F.lit(kind).alias("kind"), i.alias("bin")))

    wide = bin_width * WIDER
    return F.when(end - begin > bin_width * LONG, F.concat(spread(own, wide), spread(3, wide))).otherwise(F.concat(spread(0, bin_width), spread(3 - own, wide)))


def overlap_bp(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.least(a1, b1) - F.greatest(a0, b0)


def flank_pairs(df: DataFrame, key: str, index: str, cols: tuple[str, str] = ("pos", "end_pos"), flank: int = 1000) -> DataFrame:
    """(key, index_a, index_b): pairs of intervals within ``flank`` of each other, index_a < index_b."""
    rows = df.select(key, index, *cols)
    pairs = range_join(rows, rows, key, cols, cols, flank=flank).where(f"l_{index} < r_{index}")
    return pairs.select(F.col(f"l_{key}").alias(key), F.col(f"l_{index}").alias("index_a"), F.col(f"r_{index}").alias("index_b"))


def pair_count(df: DataFrame, key: str, pos: str = "pos", end: str = "end_pos") -> DataFrame:
    """(n): how many pairs of rows with equal key share a base, by a sweep: what begins at a coordinate meets what is open there, and each other. As in ``range_join``, an interval of no width counts as the base it begins at."""
    rows = df.where(F.col(end).isNotNull()).select(F.col(key).alias("key"), F.col(pos).alias("pos"), F.greatest(F.col(end), F.col(pos) + 1).alias("end_pos")).where("key is not null and pos is not null")
    begun = rows.groupBy("key", "pos").agg(F.count("*").alias("n"))
    n = F.col("n")
    met = depth(rows, "key").join(begun, ["key", "pos"])  # a key is open from each place where a row begins
    return met.agg(F.coalesce(F.sum(n * (F.col("depth") - n) + (n * (n - 1) / 2).cast("long")), F.lit(0).cast("long")).alias("n"))


def overlap_count(df: DataFrame, key: str, index: str, cols: tuple[str, str] = ("pos", "end_pos")) -> DataFrame:
    """(n): how many pairs of rows with equal key and different ``index`` share a base; in proportion to the rows, however many the pairs."""
    rows = df.where(F.col(index).isNotNull()).withColumn("__h", F.xxhash64(index))
    twice = rows.groupBy(key, "__h").agg(F.count("*").alias("__n")).where("__n > 1").select(key, "__h")
    same = rows.join(twice, [key, "__h"], "left_semi").withColumn("__at", F.to_json(F.struct(key, index)))
    every, equal = pair_count(rows, key, *cols), pair_count(same, "__at", *cols).withColumnRenamed("n", "m")
    return every.crossJoin(equal).select((F.col("n") - F.col("m")).alias("n"))  # a row each


def coverage(left: DataFrame, right: DataFrame, key: str, index: str, cols: tuple[str, str] = ("pos", "end_pos"), right_cols: tuple[str, str] = ("pos", "end_pos")) -> DataFrame:
    """(index, len, bp, bp_prop) of every left interval: bases shared with intervals of the right, summed, 0 where there are none."""
    (a, b), (c, d) = cols, right_cols
    pairs = range_join(left.select(key, index, a, b), right.select(key, c, d), key, cols, right_cols)
    shared = pairs.groupBy(F.col(f"l_{index}").alias(index)).agg(F.sum(F.greatest(overlap_bp(F.col(f"l_{a}"), F.col(f"l_{b}"), F.col(f"r_{c}"), F.col(f"r_{d}")), F.lit(0))).alias("bp"))
    length = F.col(b) - F.col(a)
    return left.select(index, a, b).join(shared, index, "left").select(index, length.alias("len"), F.coalesce("bp", F.lit(0)).cast("long").alias("bp"), F.when(length > 0, F.coalesce("bp", F.lit(0)) / length).otherwise(0.0).alias("bp_prop"))


def depth(df: DataFrame, key: str = "chrom", pos: str = "pos", end: str = "end_pos", bin_width: int = SWEEP, zero: bool = False) -> DataFrame:
    """Sweep line: (key, pos, end, depth) of the elementary segments of positive depth, and of depth 0 between them where ``zero``.

    Events are summed by coordinate first, so a sweep sees each coordinate once; intervals of no width have none.
    """
    events = df.where(F.col(end) > F.col(pos)).select(key, F.explode(F.array(F.struct(F.col(pos).alias("c"), F.lit(1).alias("d")), F.struct(F.col(end).alias("c"), F.lit(-1).alias("d")))).alias("e"))
    steps = events.groupBy(key, F.col("e.c").alias("c")).agg(F.sum("e.d").alias("d")).withColumn("bin", F.floor(F.col("c") / bin_width))
    by_key = Window.partitionBy(key).orderBy("bin")  # one row a bin
    bins = steps.groupBy(key, "bin").agg(F.sum("d").alias("all"), F.min("c").alias("first"))
    bins = bins.select(key, "bin", F.coalesce(F.sum("all").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.lead("first").over(by_key).alias("next"))
    w = Window.partitionBy(key, "bin").orderBy("c")
    swept = steps.join(bins, [key, "bin"]).select(key, F.col("c").alias("pos"), F.coalesce(F.lead("c").over(w), "next").alias("end_pos"), (F.col("before") + F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))).alias("depth"))
    return swept.where("end_pos is not null" if zero else "depth > 0 and end_pos is not null")


def depth_with_rows(df: DataFrame, lengths: DataFrame | None = None, key: str = "chrom", pos: str = "pos", end: str = "end_pos", index: str = "align_index") -> DataFrame:
    """(key, pos, end_pos, depth, rows): segments of any depth, with the indices of the rows that cover each, in order of where they begin, then of index.

    With ``lengths`` (key, len), a segment of depth 0 comes before the first and after the last row of a key.
    """
    segments = depth(df, key, pos, end, zero=True)
    if lengths is not None:
        ends = segments.groupBy(key).agg(F.min("pos").alias("a"), F.max("end_pos").alias("b")).join(lengths.select(key, "len"), key)
        gaps = ends.select(key, F.explode(F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.col("a").alias("end_pos")), F.struct(F.col("b").alias("pos"), F.col("len").cast("long").alias("end_pos")))).alias("g"))
        segments = segments.unionByName(gaps.select(key, "g.pos", "g.end_pos", F.lit(0).cast("long").alias("depth")).where("end_pos > pos"))
    own = df.where(F.col(end) > F.col(pos)).select(key, F.col(pos).alias("pos"), F.col(end).alias("end_pos"), index)
    pairs = range_join(segments, own, key)
    lists = pairs.groupBy(F.col(f"l_{key}").alias(key), F.col("l_pos").alias("pos")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("r_pos"), F.col(f"r_{index}").alias("i")))), lambda s: s["i"]).alias("rows"))
    return segments.join(lists, [key, "pos"], "left").select(key, "pos", "end_pos", "depth", F.coalesce("rows", F.array().cast("array<bigint>")).alias("rows"))


def merge(df: DataFrame, key: str, pos: str = "pos", end: str = "end_pos", flank: int = 0, bin_width: int = SWEEP) -> DataFrame:
    """(key, pos, end_pos, n): intervals that overlap, touch or lie within ``flank`` of each other, joined."""
    return numbered(df.select(key, pos, end), key, pos, end, flank, bin_width).groupBy(key, "run").agg(F.min(pos).alias("pos"), F.max(end).alias("end_pos"), F.count("*").alias("n")).drop("run")


def numbered(df: DataFrame, key: str, pos: str = "pos", end: str = "end_pos", flank: int = 0, bin_width: int = SWEEP) -> DataFrame:
    """The rows with ``run``, the number within the key, from 1, of the stretch of intervals within ``flank`` of each other that a row is in."""
    by_key, inside = Window.partitionBy(key).orderBy("bin"), Window.partitionBy(key, "bin").orderBy(pos, end)
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("bin", F.floor(F.col(pos) / bin_width))
    reach = rows.groupBy(key, "bin").agg(F.max(end).alias("most")).select(key, "bin", F.max("most").over(earlier(by_key)).alias("reach"))
    before = F.greatest(F.max(end).over(earlier(inside)), F.col("reach"))
    marked = rows.join(reach, [key, "bin"]).withColumn("new", F.when(F.col(pos) <= before + flank, 0).otherwise(1)).drop("reach")
    runs = marked.groupBy(key, "bin").agg(F.sum("new").alias("n")).select(key, "bin", F.coalesce(F.sum("n").over(earlier(by_key)), F.lit(0)).alias("runs"))
    return marked.join(runs, [key, "bin"]).withColumn("run", F.col("runs") + F.sum("new").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))).drop("runs", "new", "bin")  # equal intervals are peers, so they are in one run whatever their order
