"""Liftover of points and regions between reference and query, in batches.

Points join the operations of all records by place. A point in an insertion or deletion
lifts to where the operation begins. On a reversed record the query runs backwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .intervals import range_join

#: What a choice among several lifts goes by, first to last.
POLICIES = {
    "best": ("score", "filter", "len", "single_align", "same_align"),
    "align": ("same_align", "score", "filter", "len", "single_align"),
    "len": ("len", "score", "filter", "single_align", "same_align"),
    "align_len": ("same_align", "len", "score", "filter", "single_align"),
}


def op_table(records: DataFrame, ops: DataFrame, key: str = "align_index") -> DataFrame:
    """Each operation in reference and query coordinates: (key, chrom, pos, end_pos, qry_id, qry_pos, qry_end, is_rev, op_code, score, n_filter).

    ``records`` has key, chrom, pos, qry_id, qry_pos, qry_end, is_rev, score and n_filter, and ``ops`` has ref_off and qry_off.
    """
    own = records.select(key, "chrom", F.col("pos").alias("__pos"), "qry_id", F.col("qry_pos").alias("__qp"), F.col("qry_end").alias("__qe"), "is_rev", "score", "n_filter")
    ref_n = F.when(F.col("op_code").isin(0, 2, 7, 8), F.col("op_len")).otherwise(0)
    qry_n = F.when(F.col("op_code").isin(0, 1, 7, 8), F.col("op_len")).otherwise(0)
    begin = F.when(F.col("is_rev"), F.col("__qe") - F.col("qry_off") - qry_n).otherwise(F.col("__qp") + F.col("qry_off"))
    joined = ops.where("op_code in (0, 1, 2, 7, 8)").join(own, key)
    return joined.select(key, "chrom", (F.col("__pos") + F.col("ref_off")).alias("pos"), (F.col("__pos") + F.col("ref_off") + ref_n).alias("end_pos"), "qry_id", begin.alias("qry_pos"), (begin + qry_n).alias("qry_end"), "is_rev", "op_code", "score", "n_filter")


def points(asked: DataFrame, table: DataFrame, to: str, only_passing: bool = False, index: str = "point_id", place: str = "at", name: str = "name", key: str = "align_index") -> DataFrame:
    """(index, name, at, lift_name, lift_at, is_rev, op_code, score, n_filter, key): all lifts of each point; ``to`` is "qry" or "ref".

    The point's side of an operation must hold it, so deletions lift only to the query and insertions only to the reference.
    """
    here, there = (("chrom", "pos", "end_pos"), ("qry_id", "qry_pos", "qry_end")) if to == "qry" else (("qry_id", "qry_pos", "qry_end"), ("chrom", "pos", "end_pos"))
    rows = table.where(F.col(here[2]) > F.col(here[1]))
    if only_passing:
        rows = rows.where("n_filter = 0")
    rows = rows.withColumnRenamed(here[0], "on")
    ends = asked.select(index, F.col(name).alias("on"), F.col(place).alias("at"), (F.col(place) + 1).alias("past"))
    hits = range_join(ends, rows, "on", ("at", "past"), (here[1], here[2]))
    off = F.when(F.col("r_is_rev"), F.col(f"r_{here[2]}") - 1 - F.col("l_at")).otherwise(F.col("l_at") - F.col(f"r_{here[1]}"))
    aligned = F.col("r_op_code").isin(0, 7, 8)
    if to == "ref":
        lifted = F.col("r_pos") + F.when(aligned, off).otherwise(0)
    else:  # offset from the start in the reference; on a reversed record it counts down from the end in the query
        step = F.col("l_at") - F.col("r_pos")
        lifted = F.when(~aligned, F.col("r_qry_pos")).when(F.col("r_is_rev"), F.col("r_qry_end") - 1 - step).otherwise(F.col("r_qry_pos") + step)
    return hits.select(F.col(f"l_{index}").alias(index), F.col("l_on").alias("name"), F.col("l_at").alias("at"), F.col(f"r_{there[0]}").alias("lift_name"), lifted.cast("long").alias("lift_at"), F.col("r_is_rev").alias("is_rev"), F.col("r_op_code").alias("op_code"), F.col("r_score").alias("score"), F.col("r_n_filter").alias("n_filter"), F.col(f"r_{key}").alias(key))


def _order(policy: str, key: str) -> list[Column]:
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    by = {
        "score": [-F.least(a("score"), b("score")), -F.greatest(a("score"), b("score"))],
        "filter": [F.greatest(a("n_filter"), b("n_filter")), F.least(a("n_filter"), b("n_filter"))],
        "len": [F.abs(F.abs(a("lift_at") - b("lift_at")) + 1 - F.col("length"))],
        "single_align": [(a(key) != b(key)).cast("int")],
        "same_align": [-((a(key).eqNullSafe(F.col("key_a"))).cast("int") + (b(key).eqNullSafe(F.col("key_b"))).cast("int"))],
    }
    return [x for name in POLICIES[policy] for x in by[name]] + [a(key), b(key), a("lift_at"), b("lift_at")]


def regions(asked: DataFrame, table: DataFrame, to: str, policy: str | None = "best", same_align: bool = False, single_align: bool = False, only_passing: bool = False, index: str = "region_id", key: str = "align_index") -> DataFrame:
    """(index, lift_name, lift_pos, lift_end, is_rev, key_a, key_b) of each region that lifts: its ends lifted, paired, and the best pair.

    ``asked`` has index, name, pos, end_pos and, where records are to be kept, key_a and key_b. Without a policy a region with several pairs isn't lifted.
    """
    keyed = asked
    for c in ("key_a", "key_b"):
        if c not in keyed.columns:
            keyed = keyed.withColumn(c, F.lit(None).cast("long"))
    first = points(keyed.select(index, "name", F.col("pos").alias("at")), table, to, only_passing, index)
    last = points(keyed.select(index, "name", (F.col("end_pos") - 1).alias("at")), table, to, only_passing, index)
    prefixed = lambda df, p: df.select(F.col(index), *[F.col(c).alias(f"{p}{c}") for c in df.columns if c != index])
    pairs = prefixed(first, "a_").join(prefixed(last, "b_"), index).where("a_lift_name = b_lift_name and a_is_rev = b_is_rev")
    pairs = pairs.join(keyed.select(index, (F.col("end_pos") - F.col("pos")).alias("length"), "key_a", "key_b"), index)
    if single_align:
        pairs = pairs.where(F.col(f"a_{key}") == F.col(f"b_{key}"))
    if same_align:
        pairs = pairs.where((F.col("key_a").isNull() | (F.col("key_a") == F.col(f"a_{key}"))) & (F.col("key_b").isNull() | (F.col("key_b") == F.col(f"b_{key}"))))
    own = Window.partitionBy(index)
    ranked = pairs.withColumn("r", F.row_number().over(own.orderBy(*_order(policy or "best", key)))).withColumn("n", F.count("*").over(own))
    best = ranked.where("r = 1" if policy else "n = 1")
    a, b = F.col("a_lift_at"), F.col("b_lift_at")
    return best.select(index, F.col("a_lift_name").alias("lift_name"), F.least(a, b).alias("lift_pos"), (F.greatest(a, b) + 1).alias("lift_end"), F.col("a_is_rev").alias("is_rev"), F.col(f"a_{key}").alias("key_a"), F.col(f"b_{key}").alias("key_b"))
