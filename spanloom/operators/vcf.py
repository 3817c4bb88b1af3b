"""Variant tables as VCF rows and headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sequences import with_bases

VERSION = "4.5"
INFO = (
    ("SVTYPE", "1", "String", "Variant type"), ("SVLEN", "1", "Integer", "Variant length, negative for deletions"), ("END", "1", "Integer", "Last base of the variant"), ("SUBTYPE", "1", "String", "Variant subtype"),
    ("CPX_REF_TRACE", "1", "String", "Reference structure of a complex variant"), ("CPX_QRY_TRACE", "1", "String", "Query structure of a complex variant"), ("QUERY", "1", "String", "Place in the query"), ("QUERYREV", "1", "String", "Strand of the query"),
    ("SEQ", "1", "String", "Sequence of a symbolic variant"), ("DUP", ".", "String", "Duplicated places"), ("HOMREF", "2", "Integer", "Homology in the reference, before and after"), ("HOMQRY", "2", "Integer", "Homology in the query, before and after"),
)
FILTERS = {"LCALIGN": "Low-confidence alignment", "ALIGN": "Alignment flags", "MAPQ": "Mapping quality", "DISCORD": "Overlaps a variant of another source", "INNER": "Inside a larger variant", "DERIVED": "Implied by a complex variant", "VARLEN": "Length out of bounds", "TRIMREF": "In bases trimmed in the reference", "TRIMQRY": "In bases trimmed in the query", "DEPTH": "Too many alignments"}
FORMATS = (("GT", "1", "String", "Genotype"),)
ALTS = {"INS": "Insertion", "DEL": "Deletion", "INV": "Inversion", "DUP": "Duplication", "CPX": "Complex variant"}


def headers(date: str, source: str, reference: str | None = None, contigs: list[tuple[str, int, str]] = ()) -> list[str]:
    """Header lines up to the column names; of the reference only its file's name is told."""
    lines = [f"##fileformat=VCFv{VERSION}", f"##filedate={date}", f"##source={source}"]
    if reference is not None:
        lines.append(f"##reference=file://{reference.rsplit('/', 1)[-1]}")
    lines += [f"##contig=<ID={c},length={n},md5={m}>" for c, n, m in contigs]
    lines += [f'##ALT=<ID={k},Description="{v}">' for k, v in ALTS.items()]
    lines += [f'##INFO=<ID={k},Number={n},Type={t},Description="{d}">' for k, n, t, d in INFO]
    lines += [f'##FILTER=<ID={k},Description="{v}">' for k, v in FILTERS.items()]
    return lines + [f'##FORMAT=<ID={k},Number={n},Type={t},Description="{d}">' for k, n, t, d in FORMATS]


def fields(df: DataFrame, refs: DataFrame, symbolic: tuple[str, ...] = ("INV", "DUP", "CPX"), index: str = "index") -> DataFrame:
    """The variants with vcf_pos, vcf_ref, vcf_alt and is_symbolic.

    Insertions and deletions that aren't symbolic have the reference's base before them, or after them at a chromosome's start. Symbolic ones
    have the base before them, or N at the start.
    """
    kind = F.col("vartype")
    sym = kind.isin(*symbolic) if symbolic else F.lit(False)
    left = F.col("pos") > 0
    at = F.when(left, F.col("pos") - 1).otherwise(F.col("end_pos"))
    asked = F.when(kind != "SNV", at)
    rows = with_bases(df, [refs.select("name", "bases")], F.lit(0), F.col("chrom"), asked, asked + 1, F.col(index), "__base", "left", most=1)
    base = F.coalesce("__base", F.lit("N"))
    have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    own_ref, own_alt = F.when(kind == "DEL", have("seq")).otherwise(""), F.when(kind == "INS", have("seq")).otherwise("")
    near = lambda own: F.when(left, F.concat(base, own)).otherwise(F.concat(own, base))
    pos = F.when(kind == "SNV", F.col("pos") + 1).when(sym & ~left, F.lit(1)).when(left, F.col("pos")).otherwise(F.col("pos") + 1)
    ref = F.when(kind == "SNV", have("ref")).when(sym, F.when(left, base).otherwise("N")).otherwise(near(own_ref))
    alt = F.when(kind == "SNV", have("alt")).when(sym, F.concat(F.lit("<"), kind, F.lit(">"))).otherwise(near(own_alt))
    return rows.select(*[c for c in df.columns], pos.cast("long").alias("vcf_pos"), F.upper(ref).alias("vcf_ref"), F.when(sym, alt).otherwise(F.upper(alt)).alias("vcf_alt"), sym.alias("is_symbolic"))


def info(df: DataFrame) -> Column:
    """The INFO text of a table that has ``fields``; parts whose columns are absent or null are left out, and semicolons in values become colons."""
    have = set(df.columns)
    parts: list[Column] = []

    def add(name: str, value: Column, *needs: str, when: Column | None = None) -> None:
        if have.issuperset(needs):
            shown = F.concat(F.lit(f"{name}="), F.replace(value.cast("string"), F.lit(";"), F.lit(":")))
            parts.append(shown if when is None else F.when(when, shown))

    kind = F.col("vartype")
    add("SVTYPE", kind, "vartype", when=kind != "SNV")
    add("SVLEN", F.when(kind == "DEL", -F.col("varlen")).otherwise(F.col("varlen")), "varlen", when=kind != "SNV")
    add("END", F.col("vcf_pos") + F.col("varlen"), "varlen", when=kind.isin("DEL", "INV"))
    for name, column in (("SUBTYPE", "varsubtype"), ("CPX_REF_TRACE", "trace_ref"), ("CPX_QRY_TRACE", "trace_qry")):
        if column in have:
            add(name, F.col(column), column)
    add("QUERY", F.concat("qry_id", F.lit(":"), (F.col("qry_pos") + 1).cast("string"), F.lit("-"), F.col("qry_end").cast("string")), "qry_id", "qry_pos", "qry_end")
    if "qry_rev" in have:
        add("QUERYREV", F.when(F.col("qry_rev"), "-").when(~F.col("qry_rev"), "+").otherwise("*"), "qry_rev")
    if "seq" in have:
        add("SEQ", F.col("seq"), "seq", when=F.col("is_symbolic"))
    if "dup" in have:
        place = lambda d: F.concat(d["chrom"], F.lit(":"), (d["pos"] + 1).cast("string"), F.lit("-"), d["end_pos"].cast("string"))
        add("DUP", F.array_join(F.transform("dup", place), ","), "dup", when=F.size("dup") > 0)
    for name, column in (("HOMREF", "hom_ref"), ("HOMQRY", "hom_qry")):
        if column in have:
            add(name, F.concat(F.col(f"{column}.up").cast("string"), F.lit(","), F.col(f"{column}.dn").cast("string")), column)
    return F.array_join(F.array_compact(F.array(*parts)), ";")


def rows(df: DataFrame, refs: DataFrame, samples: dict[str, str] | None = None, symbolic: tuple[str, ...] = ("INV", "DUP", "CPX"), index: str = "index") -> DataFrame:
    """VCF columns of variants; ``samples`` maps names of samples to columns of genotypes, and ``filter`` is a list."""
    made = fields(df, refs, symbolic, index)
    tags = F.when(F.size("filter") > 0, F.array_join("filter", ";")).otherwise("PASS") if "filter" in df.columns else F.lit("PASS")
    gts = [F.col(c).alias(name) for name, c in (samples or {}).items()]
    return made.select(F.col("chrom").alias("#CHROM"), F.col("vcf_pos").alias("POS"), F.coalesce("id", F.lit(".")).alias("ID"), F.col("vcf_ref").alias("REF"), F.col("vcf_alt").alias("ALT"), F.lit(".").alias("QUAL"), tags.alias("FILTER"), info(made).alias("INFO"), *([F.lit("GT").alias("FORMAT"), *gts] if gts else []))


def haplotype_order(wanted: str | None, known: list[str]) -> list[str]:
    """Haplotypes in the order asked for, or as they are known; one that is unknown or there twice raises."""
    if not wanted:
        return list(known)
    names = [x.strip() for x in wanted.split(",") if x.strip()]
    if len(set(names)) < len(names) or (missing := [n for n in names if n not in known]):
        raise ValueError(f"haplotypes {names}: unknown or repeated")
    return names
