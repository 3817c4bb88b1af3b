"""Haplotype merge: variants of one callset matched to those of another, stage by stage, and genotypes.

Our specification of a stage: ``ro_min`` is the least reciprocal overlap (shared bases by
the longer variant; an insertion spans as many bases as it has), ``size_ro_min`` the least
ratio of lengths, ``offset_max`` the most distance of either end, ``offset_prop_max`` the
same as a share of the shorter variant. ``match`` names columns that must be equal. Each
stage sees only what no earlier one has matched; a variant of the later callset goes to
the nearest of the earlier, then to the first by index. The earlier one leads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..plans.lineage import cut
from .aligned import with_versions
from .frames import first_of
from .intervals import range_join


@dataclass(frozen=True)
class Stage:
    ro_min: float | None = None
    size_ro_min: float | None = None
    offset_max: int | None = None
    offset_prop_max: float | None = None
    match: tuple[str, ...] = ()


STAGES = {
    "insdel": (Stage(ro_min=0.5, match=("vartype",)), Stage(size_ro_min=0.8, offset_max=200, match=("vartype",)), Stage(size_ro_min=0.8, offset_prop_max=2.0, match=("vartype",))),
    "inv": (Stage(ro_min=0.2),), "snv": (Stage(offset_max=0, match=("ref", "alt")),), "cpx": (Stage(ro_min=0.5),), "dup": (Stage(ro_min=0.5),),
}


def matches(left: DataFrame, right: DataFrame, stage: Stage, index: str = "index") -> DataFrame:
    """(a, b, offset): pairs that a stage allows. Both sides have chrom, pos, end_pos, varlen, ``index`` and the columns to match."""
    span = lambda df: df.withColumn("__to", F.greatest(F.col("pos") + F.col("varlen"), F.col("end_pos")))
    far = F.lit(stage.offset_max or 0) if stage.offset_prop_max is None else F.greatest(F.lit(stage.offset_max or 0), F.ceil(F.col("varlen") * stage.offset_prop_max))
    wide = span(left).withColumn("__a", F.col("pos") - far).withColumn("__b", F.col("__to") + far + 1)
    pairs = range_join(wide, span(right), ["chrom", *stage.match], ("__a", "__b"), ("pos", "__to"))
    short, long = F.least("l_varlen", "r_varlen"), F.greatest("l_varlen", "r_varlen")
    offset = F.greatest(F.abs(F.col("l_pos") - F.col("r_pos")), F.abs(F.col("l_end_pos") - F.col("r_end_pos")))
    shared = F.least("l___to", "r___to") - F.greatest("l_pos", "r_pos")
    good = F.lit(True)
    for value, test in ((stage.ro_min, shared >= F.lit(stage.ro_min or 0) * F.greatest(F.col("l___to") - F.col("l_pos"), F.col("r___to") - F.col("r_pos"))), (stage.size_ro_min, short >= F.lit(stage.size_ro_min or 0) * long), (stage.offset_max, offset <= F.lit(stage.offset_max or 0)), (stage.offset_prop_max, offset <= F.lit(stage.offset_prop_max or 0) * short)):
        good = good & test if value is not None else good
    return pairs.where(good).select(F.col(f"l_{index}").alias("a"), F.col(f"r_{index}").alias("b"), offset.alias("offset"))


def staged(left: DataFrame, right: DataFrame, stages: tuple[Stage, ...], index: str = "index") -> DataFrame:
    """(a, b, stage): each variant of the right that matches, with its lead on the left."""
    found = None
    for i, stage in enumerate(stages):
        rest = right if found is None else right.join(found.select(F.col("b").alias(index)), index, "left_anti")
        w = Window.partitionBy("b").orderBy("offset", "a")
        own = matches(left, rest, stage, index).withColumn("r", F.row_number().over(w)).where("r = 1").select("a", "b", F.lit(i).alias("stage"))
        found = cut(own if found is None else found.union(own))
    return found


def merge_callsets(callsets: dict[str, DataFrame], stages: tuple[Stage, ...], keys: tuple[str, ...] = ("chrom", "pos", "end_pos", "varlen")) -> DataFrame:
    """Variants of all callsets, each with ``mg_src``, the sorted names of the callsets that have it, and an id that no other has.

    Callsets have chrom, pos, end_pos, varlen, vartype, id, n_filter and ``index``, unique over all. Of repeats within a callset the first by index counts.
    Passing and failing variants are merged apart.
    """
    merged = None
    for name, df in callsets.items():
        own = first_of(df.withColumn("__pass", F.col("n_filter") == 0), [*keys, "vartype", "__pass"], ["index"]).withColumn("mg_src", F.array(F.lit(name)))
        if merged is None:
            merged = cut(own)
            continue
        passing = tuple(Stage(s.ro_min, s.size_ro_min, s.offset_max, s.offset_prop_max, (*s.match, "__pass")) for s in stages)
        pairs = staged(merged, own, passing)
        more = pairs.select(F.col("a").alias("index")).distinct().withColumn("__more", F.lit(True))
        old = merged.join(more, "index", "left").withColumn("mg_src", F.when(F.col("__more"), F.array_append("mg_src", F.lit(name))).otherwise(F.col("mg_src"))).drop("__more")
        new = own.join(pairs.select(F.col("b").alias("index")), "index", "left_anti")
        merged = cut(old.unionByName(new))
    return with_versions(merged, "id", "n_filter", ["index"]).drop("__pass")


def genotypes(merged: DataFrame, haplotypes: list[str], callable_shares: dict[str, DataFrame] | None = None) -> DataFrame:
    """(id, gt): for each haplotype 1 where it has the variant, 0 where it hasn't and at least half of the place is callable, else a full stop.

    ``callable_shares`` has (index, bp_prop) of each haplotype (``intervals.coverage``); without it all places are callable.
    """
    out = merged
    parts = []
    for i, name in enumerate(haplotypes):
        here = F.lit(True)
        if callable_shares is not None:
            out = out.join(callable_shares[name].select("index", F.col("bp_prop").alias(f"__c{i}")), "index", "left")
            here = F.coalesce(F.col(f"__c{i}"), F.lit(0.0)) >= 0.5
        parts.append(F.when(F.array_contains("mg_src", name), "1").when(here, "0").otherwise("."))
    return out.select("id", F.concat_ws("|", *parts).alias("gt"))
