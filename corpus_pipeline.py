"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
All but the last return the columns of ``documents``; the last one returns tokens.

Defined results: a null, empty or blank text has the lowest grade and goes in the first
stage. Rows with a null key are graded, kept in near-dedup, and keep their first lines
like any others. Repeated rows share their fate. An empty table gives an empty one.
Columns beside the key, the text and ``n_chars`` pass as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import bpe, decontaminate, lines, minhash, quality
from spanloom.llm.tables import table
from spanloom.plans.lineage import shared_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives the highest grade; it is fitted on the labelled ones among ``docs``."""
    return quality.keep_good(docs, quality.train(docs, quality.graded(table(spark, sf_dir, "labels"))))


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line but where it occurs first taken out; documents of which nothing is left go."""
    return lines.dedup_lines(docs, emptied="drop")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the lowest key, of each group of near copies."""
    return minhash.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item covers."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, token_ids, decoded) of each document."""
    return bpe.with_tokens(docs)


STAGES = [("quality", good_quality), ("line_dedup", new_lines), ("near_dedup", one_of_each), ("decontamination", no_benchmark), ("bpe", tokens)]

#: Fitted weights, probabilistic signatures and tilings can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    jvm, before = spark.sparkContext._jvm, None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:  # only the last stage's rows are read again
            path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{before}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
