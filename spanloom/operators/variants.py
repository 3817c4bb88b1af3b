"""Variants within alignments: single bases, insertions and deletions, with their names.

Works on the long form of operations with ``ref_off`` and ``qry_off`` (``aligned.with_offsets``)
joined to their records (key, chrom, pos, qry_id, is_rev, qry_len). Bases come from chunked
sequence tables by equi-join, each operation with the piece that it lies in; nothing leaves the JVM and no sequence is sent whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sequences import complement, reverse_complement, with_bases
from .aligned import Affine


def snv_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat(chrom, F.lit("-"), (pos + 1).cast("string"), F.lit("-SNV-"), F.upper(ref), F.upper(alt))


def any_id(chrom: Column, pos: Column, kind: Column, length: Column, ref: Column, alt: Column) -> Column:
    """The name of a variant of any type."""
    other = F.concat(chrom, F.lit("-"), (pos + 1).cast("string"), F.lit("-"), kind, F.lit("-"), length.cast("string"))
    return F.when(kind == "SNV", snv_id(chrom, pos, ref, alt)).otherwise(other)


def _placed(ops: DataFrame, is_rev: Column) -> tuple[Column, Column]:
    """(first query base, query bases before it is turned) of an operation in the query's own orientation."""
    n = F.when(F.col("op_code").isin(0, 1, 4, 5, 7, 8), F.col("op_len")).otherwise(0)
    return F.when(is_rev, F.col("qry_len") - F.col("qry_off") - n).otherwise(F.col("qry_off")).cast("long"), n


def snvs(ops: DataFrame, refs: DataFrame, queries: DataFrame, model: Affine = Affine()) -> DataFrame:
    """(chrom, pos, end_pos, id, ref, alt, qry_id, qry_pos, qry_end, is_rev, var_score, align_index) of each base of each X.

    ``ops`` has align_index, op_index, op_code, op_len, ref_off, qry_off, chrom, pos, qry_id, is_rev and qry_len;
    ``refs`` and ``queries`` have (name, bases).
    """
    begin, _ = _placed(ops, F.col("is_rev"))
    runs = ops.where("op_code = 8").select("align_index", "op_index", "op_len", "chrom", "qry_id", "is_rev", begin.alias("qb"), (F.col("pos") + F.col("ref_off")).alias("rb"))
    at, n = F.concat_ws(":", "align_index", "op_index"), F.col("op_len")
    both = with_bases(runs, [refs], F.lit(0), F.col("chrom"), F.col("rb"), F.col("rb") + n, at, "ref_bases")
    both = with_bases(both, [queries], F.lit(0), F.col("qry_id"), F.col("qb"), F.col("qb") + n, at, "qry_bases")
    both = both.withColumn("qry_bases", F.when(F.col("is_rev"), reverse_complement(F.col("qry_bases"))).otherwise(F.col("qry_bases")))
    letters = F.arrays_zip(F.split("ref_bases", "").alias("r"), F.split("qry_bases", "").alias("q"))
    each = both.select("align_index", "chrom", "rb", "qb", "qry_id", "is_rev", "op_len", F.posexplode(letters).alias("i", "s"))
    pos = F.col("rb") + F.col("i")
    qry_pos = F.col("qb") + F.col("i") + F.when(F.col("is_rev"), F.col("op_len") - 2 * F.col("i") - 1).otherwise(0)
    return each.select("chrom", pos.alias("pos"), (pos + 1).alias("end_pos"), snv_id(F.col("chrom"), pos, F.col("s.r"), F.col("s.q")).alias("id"), F.col("s.r").alias("ref"), F.col("s.q").alias("alt"), "qry_id", qry_pos.alias("qry_pos"), (qry_pos + 1).alias("qry_end"), "is_rev", F.lit(-model.mismatch).alias("var_score"), "align_index")


def insdels(ops: DataFrame, refs: DataFrame, queries: DataFrame, model: Affine = Affine()) -> DataFrame:
    """(chrom, pos, end_pos, id, vartype, varlen, qry_id, qry_pos, qry_end, is_rev, var_score, seq, align_index) of each I and D.

    An insertion ends one base after it begins and has the query's bases, turned where the record is; a deletion has the reference's.
    """
    begin, _ = _placed(ops, F.col("is_rev"))
    rows = ops.where("op_code in (1, 2)").select("align_index", "op_index", "op_code", "op_len", "chrom", "qry_id", "is_rev", begin.alias("qry_pos"), (F.col("pos") + F.col("ref_off")).alias("rb"))
    inserted = F.col("op_code") == 1
    name, first = F.when(inserted, F.col("qry_id")).otherwise(F.col("chrom")), F.when(inserted, F.col("qry_pos")).otherwise(F.col("rb"))
    joined = with_bases(rows, [refs, queries], F.when(inserted, 1).otherwise(0), name, first, first + F.col("op_len"), F.concat_ws(":", "align_index", "op_index"), "bases", "left")
    joined = joined.withColumn("bases", F.when(inserted & F.col("is_rev"), reverse_complement(F.col("bases"))).otherwise(F.col("bases")))
    kind = F.when(F.col("op_code") == 1, "INS").otherwise("DEL")
    end = F.when(F.col("op_code") == 1, F.col("rb") + 1).otherwise(F.col("rb") + F.col("op_len"))
    qry_end = F.col("qry_pos") + F.when(F.col("op_code") == 1, F.col("op_len")).otherwise(1)
    return joined.select("chrom", F.col("rb").alias("pos"), end.alias("end_pos"), any_id(F.col("chrom"), F.col("rb"), kind, F.col("op_len"), F.lit(""), F.lit("")).alias("id"), kind.alias("vartype"), F.col("op_len").alias("varlen"), "qry_id", "qry_pos", qry_end.cast("long").alias("qry_end"), "is_rev", model.gap(F.col("op_len")).alias("var_score"), F.col("bases").alias("seq"), "align_index")


def ordered_snvs(df: DataFrame) -> DataFrame:
    """By place, base, scores from high to low, and query."""
    return df.orderBy("chrom", "pos", "alt", F.desc("var_score"), F.desc("align_score"), "qry_id", "qry_pos")


def ordered_insdels(df: DataFrame) -> DataFrame:
    return df.orderBy("chrom", "pos", "end_pos", F.desc("align_score"), "qry_id", "qry_pos")


__all__ = ["any_id", "complement", "insdels", "ordered_insdels", "ordered_snvs", "snv_id", "snvs"]
