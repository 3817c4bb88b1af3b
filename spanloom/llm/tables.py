"""Reading the input tables and building Arrow-backed transformations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .textkit import release


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the key and the text, under fixed names: other columns can't clash with an operator's own."""
    return df.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))


def key_type(df: DataFrame, id_col: str) -> T.DataType:
    return df.schema[id_col].dataType


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for temporary columns that the frame doesn't have, compared without case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | list[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def over(batches):
        for batch in batches:
            yield from function(batch)
            release()

    return df.mapInArrow(over, schema)


def one_text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))
