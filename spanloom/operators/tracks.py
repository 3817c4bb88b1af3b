"""Variants and alignments as rows of browser tracks."""

from __future__ import annotations

from itertools import cycle

from pyspark.sql import Column, DataFrame, functions as F

from .frames import fill

#: Red, green and blue of each variant type.
COLOURS = {"INS": (64, 64, 255), "DEL": (255, 64, 64), "INV": (96, 255, 96), "DUP": (255, 64, 255), "SNV": (0, 0, 0), "CPX": (0, 0, 0)}


def lighten(rgb: tuple[int, int, int], share: float = 0.5) -> tuple[int, int, int]:
    return tuple(int(c + (255 - c) * share) for c in rgb)


def colour_text(rgb: tuple[int, int, int]) -> str:
    return ",".join(map(str, rgb))


def colour(kind: Column, passing: Column) -> Column:
    """A variant's colour by type, lighter where it fails; black for types without one."""
    pick = lambda f: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, v in COLOURS.items() for x in (k, colour_text(f(v)))]), kind), F.lit("0,0,0"))
    return F.when(passing, pick(lambda x: x)).otherwise(pick(lighten))


def rotation():
    """Shares of a colour map, without end: quarters first, then what lies between those, so that colour n is the same however many there are."""
    width, at, step = 4, 0.0, 0.25
    widths = cycle([8, 16, 32, 64, 4])
    while True:
        if at >= 1.0:
            width = next(widths)
            step = 1 / width
            at = step / 2
        yield at
        at += step


def filled(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns as text by their track types; null is 0 in numbers and a full stop elsewhere, of arrays the element's type counts."""
    number = ("int", "uint", "short", "ushort", "byte", "ubyte", "float", "double", "bigint")
    shown = lambda name, kind: F.coalesce(F.col(name).cast("string"), F.lit("0" if kind.split("[")[0] in number else ".")).alias(name)
    return df.select(*[shown(n, k) for n, k in kinds.items()])


def lines(df: DataFrame, thick: bool = False, centred: bool = True, snv: bool = False, length: str = "chrom_len") -> DataFrame:
    """The variants with pos, end_pos, pos_thick and end_thick as drawn: insertions are widened to their length, about their place or from it."""
    p, e, n = F.col("pos"), F.col("end_pos"), F.col("varlen") if "varlen" in df.columns else F.lit(1)
    ins = F.col("vartype") == "INS"
    inside = lambda c: F.least(F.greatest(c, F.lit(0)), F.col(length))
    if snv:
        places = (p, e, p, e)
    elif thick:
        end = inside(F.when(ins, p + n).otherwise(e))
        places = (p, end, F.least(p, end), F.greatest(p, end))
    else:
        end = F.when(ins, inside(e + F.floor(n / (2 if centred else 1)))).otherwise(e)
        places = (F.when(ins, F.greatest(end - n, F.lit(0))).otherwise(p), end, p, F.when(ins, e).otherwise(p))
    names = ("pos", "end_pos", "pos_thick", "end_thick")
    return df.select(*[c for c in df.columns if c not in names], *[x.cast("long").alias(name) for name, x in zip(names, places)])


def short_sequence(seq: Column, ends: int = 25) -> Column:
    """The first and last bases of a long sequence, and how many lie between."""
    n = F.length(seq)
    return F.when(n > 2 * ends, F.concat(F.substring(seq, 1, ends), F.lit("...("), (n - 2 * ends).cast("string"), F.lit(")..."), F.substring(seq, -ends, ends))).otherwise(seq)


def variant_fields(df: DataFrame, assembly: str, haplotype: str) -> DataFrame:
    """Fields of variant tracks: lists joined, sequences shortened, strands, places and colours."""
    have = set(df.columns)
    made = {"asm_name": F.lit(assembly), "hap": F.lit(haplotype), "track_score": F.lit(1000), "strand": F.when(F.col("is_rev"), "-").when(~F.col("is_rev"), "+").otherwise(".") if "is_rev" in have else F.lit("."), "color": colour(F.col("vartype"), F.size("filter") == 0)}
    for name in ("filter", "align_source", "discord", "inner"):
        if name in have:
            made[name] = F.array_join(F.coalesce(F.col(name).cast("array<string>"), F.array().cast("array<string>")), ",")
    for name in ("call_source", "varsubtype"):
        if name in have:
            made[name] = F.coalesce(name, F.lit("."))
    if "seq" in have:
        made["seq"] = short_sequence(F.col("seq"))
    if {"qry_id", "qry_pos", "qry_end"} <= have:
        made["qry_region"] = F.concat("qry_id", F.lit(":"), (F.col("qry_pos") + 1).cast("string"), F.lit("-"), F.col("qry_end").cast("string"))
    return df.withColumns(made)


def variants(df: DataFrame, lengths: DataFrame, assembly: str, haplotype: str, least: int | None = None, most: int | None = None, **how) -> DataFrame:
    """A track of insertions, deletions or single bases, by place."""
    rows = df.where(F.lit(True) if least is None else F.col("varlen") >= least).where(F.lit(True) if most is None else F.col("varlen") < most)
    rows = rows.join(F.broadcast(lengths.select("chrom", F.col("len").alias("chrom_len"))), "chrom", "left")  # a row for each chromosome
    return variant_fields(lines(rows, **how), assembly, haplotype).drop("chrom_len").orderBy("chrom", "pos", "end_pos", "id")


def complex_segments(segments: DataFrame, variants_: DataFrame) -> DataFrame:
    """Segments of complex variants as rows of a track: gaps stand where their neighbour before ends, or the one after begins."""
    order = (["var_index"], ["seg_index"])
    rows = segments.withColumns({"chrom": F.coalesce(fill("chrom", *order), fill("chrom", *order, False)), "__e": fill("end_pos", *order), "__p": fill("pos", *order, False)})
    gap = ~F.col("is_aligned")
    rows = rows.withColumns({"pos": F.when(gap, F.coalesce("__e", "__p")).otherwise(F.col("pos"))}).withColumn("end_pos", F.when(gap, F.col("pos") + 1).otherwise(F.col("end_pos")))
    rows = rows.where("not is_anchor").join(variants_.select("var_index", "id", "qry_rev"), "var_index")
    label = F.when(gap, "CPX_INS").when(F.col("is_rev") != F.col("qry_rev"), "CPX_INVDUP").otherwise("CPX_DUP")
    return rows.select("chrom", "pos", "end_pos", "id", "seg_index", label.alias("vartype"))


def alignments(df: DataFrame, assembly: str, haplotype: str, trim: str) -> DataFrame:
    """A track of alignments, by place; the score is the share of matches in thousandths."""
    score = F.least(F.greatest((F.col("match_prop") * 1000).cast("int"), F.lit(0)), F.lit(1000))
    name = F.concat("qry_id", F.lit(" "), F.col("align_index").cast("string"))
    return df.select("chrom", "pos", "end_pos", name.alias("id"), F.coalesce(score, F.lit(0)).alias("track_score"), F.when(F.col("is_rev"), "-").otherwise("+").alias("strand"), F.col("pos").alias("pos_thick"), F.col("end_pos").alias("end_thick"), F.lit(assembly).alias("asm_name"), F.lit(haplotype).alias("hap"), F.lit(trim).alias("trim"), "align_index", "mapq").orderBy("chrom", "pos", "end_pos", "align_index")
