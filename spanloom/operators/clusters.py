"""Places that look like inversions: clusters of variants, matched insertions and deletions, and their union."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .intervals import depth, numbered


def signature(df: DataFrame, lengths: DataFrame, flank: int = 100, least: int = 1, most: int | None = 50, min_depth: int = 20, min_window: int = 500) -> DataFrame:
    """(chrom, pos, end_pos, align_index, depth_max): stretches of a record where at least ``min_depth`` variants, each widened by ``flank``, overlap.

    ``df`` has chrom, pos, end_pos, align_index and, where lengths count, varlen; bounds stay within the chromosome's length.
    """
    if "varlen" in df.columns:
        df = df.where(F.col("varlen") >= least)
        df = df if most is None else df.where(F.col("varlen") <= most)
    wide = df.select("chrom", "align_index", (F.col("pos") - flank).alias("pos"), (F.col("end_pos") + flank).alias("end_pos"), F.to_json(F.struct("chrom", "align_index")).alias("at"))
    names = wide.select("at", "chrom", "align_index").distinct()
    deep = depth(wide, "at").where(F.col("depth") >= min_depth)
    runs = numbered(deep, "at").groupBy("at", "run").agg(F.min("pos").alias("pos"), F.max("end_pos").alias("end_pos"), F.max("depth").alias("depth_max"))
    inside = lambda c: F.least(F.greatest(F.col(c), F.lit(0)), F.col("len"))
    placed = runs.join(names, "at").join(lengths.select("chrom", "len"), "chrom").select("chrom", inside("pos").alias("pos"), inside("end_pos").alias("end_pos"), "align_index", "depth_max")
    return placed.where(F.col("end_pos") - F.col("pos") >= min_window)


def matched_insdels(df: DataFrame, least: int = 50, offset_prop: float = 2.0, size_overlap: float = 0.8) -> DataFrame:
    """(chrom, align_index, pos, end_pos, vid_a, vid_b): insertions and deletions of one record, of like size and near each other.

    The offset is the larger distance of the two ends, as a share of the shorter variant.
    """
    side = lambda kind, p: df.where((F.col("vartype") == kind) & (F.col("varlen") >= least)).select("align_index", F.col("chrom").alias(f"{p}chrom"), F.col("pos").alias(f"{p}pos"), F.col("end_pos").alias(f"{p}end"), F.col("varlen").alias(f"{p}len"), F.col("vid").alias(f"vid_{p[0]}"))
    shorter, longer = F.least("a_len", "b_len"), F.greatest("a_len", "b_len")
    offset = F.greatest(F.abs(F.col("a_pos") - F.col("b_pos")), F.abs(F.col("a_end") - F.col("b_end")))
    pairs = side("INS", "a_").join(side("DEL", "b_"), "align_index").where((F.col("a_chrom") == F.col("b_chrom")) & (shorter >= size_overlap * longer) & (offset <= offset_prop * shorter))
    return pairs.select(F.col("a_chrom").alias("chrom"), "align_index", F.least("a_pos", "b_pos").alias("pos"), F.greatest("a_end", "b_end").alias("end_pos"), "vid_a", "vid_b")


def matched_clusters(pairs: DataFrame) -> DataFrame:
    """(chrom, pos, end_pos, align_index, depth_max): stretches of a record that matched pairs cover."""
    at = pairs.withColumn("at", F.to_json(F.struct("chrom", "align_index")))
    names = at.select("at", "chrom", "align_index").distinct()
    runs = numbered(depth(at, "at"), "at").groupBy("at", "run").agg(F.min("pos").alias("pos"), F.max("end_pos").alias("end_pos"), F.max("depth").alias("depth_max"))
    return runs.join(names, "at").select("chrom", "pos", "end_pos", "align_index", "depth_max")


def flags(parts: dict[str, DataFrame], flank: int = 1000) -> DataFrame:
    """(chrom, pos, end_pos, align_index, flag, clusters): clusters of all kinds within ``flank`` of each other, joined.

    A cluster that stands alone is left out; ``flag`` lists the kinds of a group, ``align_index`` the records.
    """
    rows = None
    for name, df in parts.items():
        one = df.select("chrom", "pos", "end_pos", "align_index", F.lit(name).alias("flag"))
        rows = one if rows is None else rows.unionByName(one)
    runs = numbered(rows, "chrom", flank=flank)
    grouped = runs.groupBy("chrom", "run").agg(F.min("pos").alias("pos"), F.max("end_pos").alias("end_pos"), F.array_sort(F.collect_set("align_index")).alias("align_index"), F.array_sort(F.collect_set("flag")).alias("flag"), F.count("*").alias("clusters"))
    return grouped.where("clusters > 1").drop("run")


def inversion_flags(table: DataFrame) -> DataFrame:
    """Groups that have more to show than clusters of single bases."""
    return table.where(F.col("flag") != F.array(F.lit("CLUSTER_SNV")))


def run_lengths(df: DataFrame, key: str | None = None) -> DataFrame:
    """(key, state, index_kde, len_kde, pos_qry, len_qry, max_gain) of the runs of equal states, in order of ``index``.

    ``df`` has index, state, kde_fwd, kde_fwdrev and kde_rev. The gain is how far the highest density exceeds the next one.
    """
    keys = [key] if key else []
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("index")
    kde = ("kde_fwd", "kde_fwdrev", "kde_rev")
    gain = F.greatest(*kde) * 2 - (sum((F.col(c) for c in kde[1:]), F.col(kde[0])) - F.least(*kde))
    rows = df.select(*keys, "index", "state", gain.alias("gain"), (F.row_number().over(w) - 1).alias("n"), F.when(F.col("state").eqNullSafe(F.lag("state").over(w)), 0).otherwise(1).alias("new"))
    rows = rows.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    made = rows.groupBy(*keys, "run").agg(F.first("state").alias("state"), F.min("n").cast("long").alias("index_kde"), F.count("*").alias("len_kde"), F.min("index").alias("pos_qry"), (F.max("index") + 1 - F.min("index")).alias("len_qry"), F.max("gain").alias("max_gain"))
    return made.drop("run")
