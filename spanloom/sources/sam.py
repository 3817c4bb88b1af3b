"""SAM text as alignment records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import aligned as al
from ..plans.lineage import cut

BAD_FLAGS = 0x700


def sam_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, value): the lines of a SAM file, plain or gzip, numbered in order of the file."""
    if path.endswith((".bam", ".cram")):
        raise ValueError(f"{path}: convert to SAM text first")
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("id"), "value")
    lines = cut(lines.withColumn("part", F.shiftright("id", 33)))
    counts = lines.groupBy("part").agg(F.count("*").alias("c"))
    before = counts.select("part", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row for each split
    return lines.join(F.broadcast(before), "part").select((F.col("before") + F.col("id").bitwiseAND((1 << 33) - 1)).alias("n"), "value")


def header(spark: SparkSession, path: str) -> DataFrame:
    return sam_lines(spark, path).where(F.col("value").startswith("@")).orderBy("n").select("value")


def read_sam(spark: SparkSession, path: str, lengths: DataFrame, min_mapq: int = 0, bad_flags: int = BAD_FLAGS, model: al.Affine = al.Affine()) -> DataFrame:
    """(align_index, chrom, pos, end_pos, qry_id, qry_pos, qry_end, qry_order, rg, mapq, is_rev, flags, filter, ops, score, match_prop, qry_prop).

    ``align_index`` counts all record lines, also those left out: unmapped ones, and those without a position. Clips are made hard, insertions and
    deletions at the ends with them. Records have to tell matches from mismatches. Query places are those of the query as it was sequenced.
    """
    c = F.split("value", "\t")
    rows = sam_lines(spark, path).where(~F.col("value").startswith("@") & (F.trim("value") != ""))
    first = rows.agg(F.min("n").alias("m"), F.count("*").alias("c")).first()
    heads = 0 if first.c == 0 else first.m
    rows = rows.withColumn("c", F.when(F.size(c) >= 11, c).otherwise(F.raise_error(F.concat(F.lit("fewer than 11 fields: "), F.substring("value", 1, 80))).cast("array<string>")))
    # lines without records after the first one would leave gaps, so records are ranked by their place among all lines of their split
    order = rows.select("n", "c").withColumn("align_index", F.col("n") - heads)
    tag = F.filter(F.slice("c", 12, F.greatest(F.size("c") - 11, F.lit(0))), lambda x: x.startswith("RG:Z:"))
    flags, pos = F.col("c")[1].cast("int"), F.col("c")[3].cast("long") - 1
    records = order.select("align_index", F.col("c")[0].alias("qry_id"), flags.alias("flags"), F.col("c")[2].alias("chrom"), pos.alias("pos"), F.col("c")[4].cast("int").alias("mapq"), F.col("c")[5].alias("cigar"), F.substring(F.get(tag, F.lit(0)), 6, 1 << 20).alias("rg"))
    records = cut(records.where((F.col("flags").bitwiseAND(4) == 0) & (F.col("pos") >= 0)))
    ops = al.parse_cigar(records, "align_index", "cigar")
    packed = al.normalise_clipping(al.pack(ops))
    long = cut(al.unpack(packed))
    lead = F.when(F.element_at("ops", 1)["op_code"] == 5, F.element_at("ops", 1)["op_len"]).otherwise(0)
    moved = packed.select("align_index", "ops", lead.cast("long").alias("lead"))
    # a deletion at the left end moves the record's place in the reference on
    edge = ops.join(ops.where("op_code not in (1, 2, 4, 5)").groupBy("align_index").agg(F.min("op_index").alias("first")), "align_index").where("op_index < first and op_code = 2").groupBy("align_index").agg(F.sum("op_len").alias("skip"))
    sums = long.groupBy("align_index").agg(al.total("op_code", al.REF_STEPS).alias("ref_bp"), al.total("op_code", (0, 1, 7, 8)).alias("qry_bp"))
    joined = records.join(moved, "align_index").join(sums, "align_index").join(edge, "align_index", "left").join(lengths.select(F.col("qry_id"), F.col("len").alias("qry_len")), "qry_id")
    is_rev = F.col("flags").bitwiseAND(16) != 0
    start = F.col("pos") + F.coalesce("skip", F.lit(0))
    qry_pos = F.when(is_rev, F.col("qry_len") - F.col("lead") - F.col("qry_bp")).otherwise(F.col("lead"))
    tags = F.array_compact(F.array(F.when(F.col("flags").bitwiseAND(bad_flags) != 0, "ALIGN"), F.when(F.col("mapq") < min_mapq, "MAPQ")))
    placed = joined.select("align_index", "chrom", start.alias("pos"), (start + F.col("ref_bp")).alias("end_pos"), "qry_id", qry_pos.cast("long").alias("qry_pos"), (qry_pos + F.col("qry_bp")).cast("long").alias("qry_end"), "rg", "mapq", is_rev.alias("is_rev"), "flags", tags.alias("filter"), "ops")
    w = Window.partitionBy("qry_id").orderBy("qry_pos", "qry_end", "align_index")
    placed = placed.withColumn("qry_order", (F.row_number().over(w) - 1).cast("long"))
    return al.with_features(placed, long, "align", lengths, model).orderBy("chrom", "pos", "end_pos", "align_index")
