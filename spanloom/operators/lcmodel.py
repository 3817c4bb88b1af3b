"""Low-confidence alignments: labels by rule, logistic models, their training and evaluation. No pretrained weights are shipped."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .intervals import merge, range_join


@dataclass(frozen=True)
class Logistic:
    """Weights by feature, a bias and a threshold; features count as 32-bit floats."""

    weights: dict[str, float]
    bias: float
    threshold: float = 0.5

    def probability(self) -> Column:
        total = sum((F.col(c).cast("float").cast("double") * w for c, w in self.weights.items()), F.lit(self.bias))
        return 1 / (1 + F.exp(-total))

    def low(self) -> Column:
        return self.probability() >= self.threshold


class Null:
    """Finds nothing."""

    def low(self) -> Column:
        return F.lit(False)


def labels(df: DataFrame, trimmed: DataFrame, regions: DataFrame, score_prop: float = 0.9, match_prop: float = 0.9, rescue: float = 0.97) -> DataFrame:
    """(align_index, lc_score, lc_trim, lc_region, low): records with low shares, lost in trimming, or inside merged regions unless their matches rescue them."""
    low = (F.col("score_prop") < score_prop) | (F.col("match_prop") < match_prop)
    lost = df.select("align_index").join(trimmed.select("align_index"), "align_index", "left_anti").withColumn("lc_trim", F.lit(True))
    pairs = range_join(df.select("chrom", "pos", "end_pos", "align_index"), merge(regions, "chrom"), "chrom").where("r_pos <= l_pos and l_end_pos <= r_end_pos")
    inside = pairs.select(F.col("l_align_index").alias("align_index")).distinct().withColumn("__in", F.lit(True))
    joined = df.join(lost, "align_index", "left").join(inside, "align_index", "left")
    held = lambda c: F.coalesce(c, F.lit(False))
    made = joined.select("align_index", held(low).alias("lc_score"), held(F.col("lc_trim")).alias("lc_trim"), (held(F.col("__in")) & held(F.col("match_prop") < rescue)).alias("lc_region"))
    return made.withColumn("low", F.col("lc_score") | F.col("lc_trim") | F.col("lc_region"))


def splits(df: DataFrame, strata: list[str], key: str, test: float = 0.2, folds: int = 5) -> DataFrame:
    """The rows with ``is_test`` and ``fold``: within each stratum by a hash of the key, so a row's part doesn't depend on the other rows of its task."""
    h = F.pmod(F.xxhash64(*strata, key), F.lit(1_000_000)) / 1_000_000
    return df.withColumn("is_test", h < test).withColumn("fold", F.when(h >= test, F.least(F.floor((h - test) / (1 - test) * folds), F.lit(folds - 1)).cast("int")))


def train(df: DataFrame, names: Sequence[str], label: str = "low", steps: int = 100, ridge: float = 1e-3) -> Logistic:
    """A logistic model fitted by the library's distributed solver."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = df.select(*[F.col(n).cast("float").cast("double").alias(n) for n in names], F.col(label).cast("double").alias("label")).dropna()
    made = LogisticRegression(maxIter=steps, regParam=ridge).fit(VectorAssembler(inputCols=list(names), outputCol="features").transform(rows))
    return Logistic(dict(zip(names, map(float, made.coefficients))), float(made.intercept))


def auc(df: DataFrame, score: str, label: str) -> float:
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label).evaluate(df.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label)))


def evaluation(df: DataFrame, by: list[str], low: str = "low") -> DataFrame:
    """(by, low, n, bp, bp_mean, bp_median, bp_min, bp_max): records of each group that pass and fail."""
    n = F.col("qry_end") - F.col("qry_pos")
    return df.groupBy(*by, F.col(low).alias("low")).agg(F.count("*").alias("n"), F.sum(n).alias("bp"), F.avg(n).alias("bp_mean"), F.median(n).alias("bp_median"), F.min(n).alias("bp_min"), F.max(n).alias("bp_max"))


def order_within(strata: list[str], key: str) -> Column:
    """A row's place within its stratum, by a hash of its key."""
    return F.row_number().over(Window.partitionBy(*strata).orderBy(F.xxhash64(key), key))
