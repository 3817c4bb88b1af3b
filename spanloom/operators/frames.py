"""Operators on tables of any kind: schemas, tags, audits, fills, orders and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def conform(df: DataFrame, schema: dict[str, str], ordered: bool = True) -> DataFrame:
    """Known columns cast to their types and, where ``ordered``, first in the schema's order; unknown ones are kept after them."""
    known = [c for c in schema if c in df.columns] if ordered else [c for c in df.columns if c in schema]
    cast = {c: F.col(f"`{c}`").cast(schema[c]).alias(c) for c in known}
    if ordered:
        return df.select(*cast.values(), *[F.col(f"`{c}`") for c in df.columns if c not in schema])
    return df.select(*[cast.get(c, F.col(f"`{c}`")) for c in df.columns])


def with_source(df: DataFrame, source: str, column: str = "call_source") -> DataFrame:
    given = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, F.coalesce(given, F.lit(source.upper())))


def passing(tags: str = "filter") -> Column:
    """Whether a list of filters is empty, or absent."""
    return F.coalesce(F.size(tags), F.lit(0)) <= 0


def tag(condition: Column, name: str, tags: str = "filter", once: bool = False) -> Column:
    """The list of filters, with one more where the condition holds; ``once`` leaves lists alone that have it."""
    if once:
        condition = condition & ~F.array_contains(tags, name)
    return F.when(F.coalesce(condition, F.lit(False)), F.array_append(tags, F.lit(name))).otherwise(F.col(tags))


def require(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns named, in order; one that is missing raises."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{n}`") for n in names])


def repeated(df: DataFrame, key: str = "align_index") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), key)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n) of the columns that have nulls: one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n")) for c in df.columns])).alias("x")).select("x.*").where("n > 0")


def violations(df: DataFrame, key: str = "align_index") -> DataFrame:
    """(what, name, n): keys that occur more than once, and columns with nulls."""
    twice = repeated(df, key).select(F.lit("repeated key").alias("what"), F.col(key).cast("string").alias("name"), "n")
    return twice.unionByName(null_counts(df).select(F.lit("null").alias("what"), F.col("column").alias("name"), "n"))


def check(df: DataFrame, key: str = "align_index") -> DataFrame:
    """The table; raises where ``violations`` has any."""
    if found := violations(df, key).limit(5).collect():
        raise ValueError(f"invalid table: {[tuple(r) for r in found]}")
    return df


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each combination of the keys."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def row_index(df: DataFrame, order: list[str | Column], name: str = "index", parts: int | None = None) -> DataFrame:
    """Rows numbered from 0 in a total order, without gathering them in one task: sorted by ranges, counted, and numbered within each.

    ``order`` must tell all rows apart, or rows that tie are numbered in any order among them.
    """
    from ..plans.lineage import cut

    ranged = df.repartitionByRange(*([parts] if parts else []), *order).withColumn("__part", F.spark_partition_id())
    ranged = cut(ranged)  # so that both passes see the same ranges
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # a row for each range
    numbered = ranged.join(F.broadcast(before), "__part")  # a row for each range
    return numbered.withColumn(name, (F.col("__before") + F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1).cast("long")).drop("__part", "__before")


def fill(column: str, keys: list[str], order: list[str], forward: bool = True) -> Column:
    """The last value before, or the next one after, where there is none."""
    w = Window.partitionBy(*keys).orderBy(*order)
    if forward:
        return F.last(column, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.first(column, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))


def inner_rows(df: DataFrame, flag: str, keys: list[str], order: list[str]) -> DataFrame:
    """The rows without the runs at either end of which the flag holds."""
    w = Window.partitionBy(*keys)
    upto, onward = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0), w.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    outside = lambda x: F.coalesce(F.max(F.when(~F.col(flag), 1)).over(x), F.lit(0))
    return df.withColumn("__a", outside(upto)).withColumn("__b", outside(onward)).where(f"not {flag} or (__a = 1 and __b = 1)").drop("__a", "__b")


def stack(*parts: DataFrame) -> DataFrame:
    """Tables under each other by name; what one doesn't have is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def total_share(column: str, alias: str) -> Column:
    """A value's share of the sum over all rows; for tables of a row a group, since all rows meet in one task."""
    return (F.col(column) / F.sum(column).over(Window.partitionBy())).alias(alias)
