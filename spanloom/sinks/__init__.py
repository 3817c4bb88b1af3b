"""Writers of variant, alignment and sequence files. All write folders of parts from the executors; ``joined`` makes one file of one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_lines(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.mode("overwrite").option("compression", compression).text(path)


def vcf_lines(rows: DataFrame, headers: list[str]) -> DataFrame:
    """(value): header lines, column names and rows by place and id, in order; a sort by ranges keeps parts in order of their names."""
    names = rows.columns
    ordered = rows.orderBy("#CHROM", "POS", "ID").select(F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(".")) for c in names]).alias("value"))
    spark = rows.sparkSession
    top = spark.createDataFrame([(x,) for x in [*headers, "\t".join(names)]], "value string").coalesce(1)
    return top.union(ordered)


def write_vcf(rows: DataFrame, headers: list[str], path: str) -> None:
    write_lines(vcf_lines(rows, headers), path)


def write_bed(rows: DataFrame, fields: list[str], path: str) -> None:
    """Tab-separated rows of the fields, with the names in a comment line."""
    write_lines(rows.select(F.concat_ws("\t", *[F.col(f"`{c}`").cast("string") for c in fields]).alias("value")), path)


def auto_sql(name: str, kinds: dict[str, tuple[str, str]]) -> str:
    """The description of a BED table: (type, text) by field."""
    body = "\n".join(f'    {kind} {field}; "{text}"' for field, (kind, text) in kinds.items())
    return f'table {name}\n"{name}"\n(\n{body}\n)\n'


def fasta_lines(seqs: DataFrame) -> DataFrame:
    """(value) of each record; a name that occurs twice raises."""
    once = seqs.groupBy("name").agg(F.min("bases").alias("bases"), F.count("*").alias("n"))
    name = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("repeated record: "), "name")).cast("string")).otherwise(F.col("name"))
    return once.select(F.concat(F.lit(">"), name, F.lit("\n"), "bases").alias("value"))


def dot_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(qry_id, value): a graph for each query; nodes have (qry_id, qry_order, label), edges (qry_id, first, last, label, best)."""
    own = nodes.select("qry_id", F.struct(F.lit(1).alias("k"), F.col("qry_order").alias("a"), F.lit(0).cast("long").alias("b"), F.concat(F.lit("    n"), F.col("qry_order").cast("string"), F.lit(' [label="'), "label", F.lit('"]')).alias("t")).alias("x"))
    way = F.concat(F.lit("    n"), F.col("first").cast("string"), F.lit(" -> n"), F.col("last").cast("string"), F.lit(' [label="'), "label", F.when(F.col("best"), '" color=red]').otherwise('"]'))
    both = own.union(edges.select("qry_id", F.struct(F.lit(2).alias("k"), F.col("first").alias("a"), F.col("last").alias("b"), way.alias("t"))))
    body = both.groupBy("qry_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda s: s["t"]), "\n").alias("b"))
    return body.select("qry_id", F.concat(F.lit('digraph "'), "qry_id", F.lit('" {\n'), "b", F.lit("\n}")).alias("value"))


def write_dot(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """One folder of text for each query."""
    dot_lines(nodes, edges).write.mode("overwrite").partitionBy("qry_id").option("compression", "gzip").text(path)
