"""FASTA, FASTQ and GFA files as tables of (name, bases); plain or gzip, by the reader's own codecs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _chosen(rows: DataFrame, names: list[str] | dict[str, str] | None, keep_others: bool, every: bool) -> DataFrame:
    """Records by a list of names, or renamed by a map; repeated names raise, and missing ones where ``every``."""
    checked = rows.groupBy("name").agg(F.min("bases").alias("bases"), F.count("*").alias("__n"))
    name = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("repeated record: "), "name")).cast("string")).otherwise(F.col("name"))
    checked = checked.select(name.alias("name"), "bases")
    if names is None:
        return checked
    wanted = dict.fromkeys(names) if not isinstance(names, dict) else names
    if every:
        have = {r.name for r in checked.where(F.col("name").isin(*wanted)).select("name").collect()}  # of the names asked for only
        if missing := [n for n in wanted if n not in have]:
            raise ValueError(f"missing records: {', '.join(missing[:5])}")
    if not keep_others:
        checked = checked.where(F.col("name").isin(*wanted))
    if not isinstance(names, dict):
        return checked
    new = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("name")), F.col("name"))
    return checked.withColumn("name", new)


def read_fasta(spark: SparkSession, path: str, names: list[str] | dict[str, str] | None = None, every: bool = True) -> DataFrame:
    """A record's name ends at its first white space; its lines are joined."""
    parts = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    head = F.split("value", r"\r?\n", 2)
    return _chosen(parts.select(F.split(F.trim(head[0]), r"\s+")[0].alias("name"), F.regexp_replace(F.coalesce(F.get(head, F.lit(1)), F.lit("")), r"\s", "").alias("bases")), names, False, every)


def read_fastq(spark: SparkSession, path: str, names: list[str] | dict[str, str] | None = None, every: bool = True) -> DataFrame:
    """Records of four lines; a file is read as one text, since only its beginning tells which lines are names."""
    lines = spark.read.text(path, wholetext=True).select(F.split(F.regexp_replace("value", r"\s+$", ""), r"\r?\n").alias("l"))
    records = lines.select("l", F.explode(F.sequence(F.lit(0), F.size("l") - 1, F.lit(4))).alias("i"))
    name, mark = F.get("l", F.col("i")), F.get("l", F.col("i") + 2)
    good = name.startswith("@") & F.coalesce(mark.startswith("+"), F.lit(False))
    shown = F.when(good, F.split(F.substring(name, 2, 1 << 30), r"\s+")[0]).otherwise(F.raise_error(F.concat(F.lit("not FASTQ: "), name)).cast("string"))
    return _chosen(records.select(shown.alias("name"), F.get("l", F.col("i") + 1).alias("bases")), names, False, every)


def read_gfa(spark: SparkSession, path: str, names: list[str] | dict[str, str] | None = None, every: bool = True) -> DataFrame:
    """The S lines of a graph; a map of names renames, but leaves no record out."""
    c = F.split("value", "\t")
    rows = spark.read.text(path).where(F.col("value").startswith("S\t")).select(F.get(c, F.lit(1)).alias("name"), F.get(c, F.lit(2)).alias("bases"))
    return _chosen(rows, names, isinstance(names, dict), every)


def read_fai(spark: SparkSession, path: str, name: str = "chrom") -> DataFrame:
    """(name, len) of a FASTA index."""
    return spark.read.csv(path, sep="\t").select(F.col("_c0").alias(name), F.col("_c1").cast("long").alias("len"))


def sequence_info(seqs: DataFrame) -> DataFrame:
    """(chrom, len, md5) of sequences, in capitals."""
    return seqs.select(F.col("name").alias("chrom"), F.length("bases").cast("long").alias("len"), F.md5(F.upper("bases")).alias("md5"))
