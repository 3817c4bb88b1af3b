"""Quality classifier: ordinal cumulative-link regression of graded ratings on hashed text.

``P(grade <= k) = sigmoid(threshold_k - s)`` with one score ``s``, the mean-free sum of
the weights that the text's hashed features share over all grades, and ordered
thresholds. The expected grade and the probability of the highest grade follow.

Features of a text, each counted once: its words (runs of alphanumeric characters
without case), its runs of symbols, words in capitals, and bands of six whole-text
ratios. They are hashed to 64 bits; weights under an L1 penalty are kept only where
they aren't zero, so the model stays small however large the vocabulary is.

Defined results: a null, empty or blank text has no features to judge, and gets grade
0 with tail probability 0. Repeated rows are scored each for itself. Labels that are
null count as absent; of several labels of one document the lowest grade counts. With
no labelled rows, or one grade only, every text that isn't blank gets the single grade.
An empty table gives an empty result. Columns other than the key and the text are
ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import textkit as tk
from .tables import fresh, key_type, map_arrow, table, two_columns

#: Most labelled documents that the classifier is fitted on; those with the lowest hash of their key.
FIT_ROWS = 8_000
#: Documents that must have a feature for it to get a weight.
LEAST_DOCUMENTS = 4
#: L1 penalty, to be divided by the root of the number of fitted documents, and the share of it in the second fit.
PENALTY, AGAIN = 0.05, 0.15
#: Least probability of the highest grade for a document to be kept.
LEAST_TAIL = 0.8

_SALT = {name: np.uint64(0x5851F42D4C957F2D * (i + 1) % 2**64) for i, name in enumerate(("word", "symbol", "capital", "ratio", "pair"))}


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature hashes, where each row's begin, whether the row has any visible character); a row's hashes are distinct."""
    w = tk.words(col)
    n = w.rows
    counts = w.counts()
    capital = (w.points != w.lower).astype(np.int64)
    capitals = np.concatenate([[0], np.cumsum(capital)])
    letters = np.concatenate([[0], np.cumsum(w.kind == 1)])
    length = w.end - w.start
    shouted = (capitals[w.end] - capitals[w.start] == length) & (length >= 2)
    visible = (w.kind == 0) & (w.points != 0)
    symbol_start, symbol_end = tk.runs(visible, w.offsets)
    symbol_row = np.searchsorted(w.offsets, symbol_start, "right") - 1
    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    order = np.lexsort((w.hash, w.row))
    again = np.zeros(len(order), bool)
    again[1:] = (w.hash[order][1:] == w.hash[order][:-1]) & (w.row[order][1:] == w.row[order][:-1])
    distinct = np.bincount(w.row[order][~again], minlength=n)
    chars = np.maximum(np.diff(w.offsets), 1)
    total = np.maximum(counts, 1)
    ratios = [
        (np.bincount(symbol_row, symbol_end - symbol_start, n) / chars, 32),
        ((capitals[w.offsets[1:]] - capitals[w.offsets[:-1]]) / np.maximum(letters[w.offsets[1:]] - letters[w.offsets[:-1]], 1), 16),
        (distinct / total, 16),
        (np.bincount(w.row, same, n) / total, 32),
        (np.bincount(w.row, length, n) / total / 16, 16),
        (np.bincount(symbol_row, minlength=n) / total / 2, 16),
    ]
    hashes = [w.hash[order][~again] ^ _SALT["word"], tk.span_hash(w.prefix, symbol_start, symbol_end) ^ _SALT["symbol"], np.full(int(shouted.sum()), _SALT["capital"])]
    owners = [w.row[order][~again], symbol_row, w.row[shouted]]
    for i, (value, bands) in enumerate(ratios):
        hashes.append(tk.mix((np.minimum(value, 1) * bands).astype(np.uint64) + np.uint64(1000 * i)) ^ _SALT["ratio"])
        owners.append(np.arange(n))
    values, owner = np.concatenate(hashes), np.concatenate(owners)
    seen = counts + np.bincount(symbol_row, minlength=n) > 0
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    first &= seen[owner]
    values, owner = values[first], owner[first]
    return values, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]), seen


def _sum_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


@dataclass
class Ordinal:
    """A fitted model: sorted feature hashes, their weights, and the ordered thresholds."""

    keys: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(bounds) - 1)
        if not hasattr(self, "near"):
            self.near = np.zeros(1 << 20, bool)
            self.near[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        values = np.zeros(len(hashes))
        at = np.flatnonzero(self.near[(hashes >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        hit = self.keys[place] == hashes[at]
        values[at[hit]] = self.weights[place[hit]]
        return _sum_by_row(values, bounds)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def fit(hashes: np.ndarray, bounds: np.ndarray, grade: np.ndarray, steps: int = 300, rate: float = 0.1, penalty: float = PENALTY, again: float = AGAIN) -> Ordinal:
    """Least mean negative log likelihood plus an L1 penalty; ``grade`` counts from 0.

    Weights: accelerated proximal gradient, with each weight's step from the diagonal bound of the curvature. Thresholds: Adam.
    The weights that aren't zero are fitted once more under ``again`` of the penalty, which else would hold them too low.
    """
    levels = int(grade.max()) + 1 if len(grade) else 1
    keys, column, df = np.unique(hashes, return_inverse=True, return_counts=True)
    often = df >= min(LEAST_DOCUMENTS, max(1, len(grade) // 10))
    place = np.cumsum(often) - 1
    used = often[column]
    owner = np.repeat(np.arange(len(grade)), np.diff(bounds))[used]
    column = place[column[used]]
    keys = keys[often]
    if levels < 2 or not len(keys):
        return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.full(max(levels - 1, 0), -50.0))
    rows = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(grade)))])
    w = y = np.zeros(len(keys))
    pace = 1 / (0.5 * np.bincount(column, np.diff(rows)[owner], len(keys)) / len(grade))
    shrink, momentum = penalty / np.sqrt(len(grade)), 1.0
    share = np.clip(np.cumsum(np.bincount(grade, minlength=levels)[:-1]) / len(grade), 1e-3, 1 - 1e-3)
    cut = np.log(share / (1 - share))
    raw = np.concatenate([cut[:1], np.log(np.maximum(np.diff(cut), 1e-2))])
    rm, rv = np.zeros(levels - 1), np.zeros(levels - 1)
    n = len(grade)
    for step in range(1, steps + 1):
        cut = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        s = _sum_by_row(y[column], rows)
        bounds_ = np.concatenate([[-np.inf], cut, [np.inf]])
        upper = 1 / (1 + np.exp(-np.clip(bounds_[grade + 1] - s, -40, 40)))
        lower = 1 / (1 + np.exp(-np.clip(bounds_[grade] - s, -40, 40)))
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        ds = (du - dl) / n
        g = np.bincount(column, ds[owner], len(keys))
        dcut = np.bincount(grade, -du / n, levels)[:-1] + np.bincount(grade, dl / n, levels)[1:]
        back = np.cumsum(dcut[::-1])[::-1]
        graw = np.concatenate([back[:1], back[1:] * np.exp(raw[1:])])
        stepped = y - pace * g
        new = np.sign(stepped) * np.maximum(np.abs(stepped) - pace * shrink, 0)
        if ((y - new) * (new - w)).sum() > 0:  # restart where the momentum leads uphill
            momentum = 1.0
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y, w, momentum = new + (momentum - 1) / after * (new - w), new, after
        rm = 0.9 * rm + 0.1 * graw
        rv = 0.99 * rv + 0.01 * graw * graw
        raw = raw - rate / np.sqrt(step / 25 + 1) * (rm / (1 - 0.9**step)) / (np.sqrt(rv / (1 - 0.99**step)) + 1e-8)
    kept = w != 0
    if again and kept.any():
        chosen = np.isin(hashes, keys[kept])
        counts = np.add.reduceat(np.append(chosen, False).astype(np.int64), bounds[:-1]) * (np.diff(bounds) > 0)
        return fit(hashes[chosen], np.concatenate([[0], np.cumsum(counts)]), grade, steps, rate, penalty * again, 0.0)
    return Ordinal(keys[kept], w[kept], np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxicity: 0 poor, 1 good but toxic, 2 good; the lowest of a document's grades."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def _feature_rows(df: DataFrame) -> DataFrame:
    """(grade, features) of (grade, text); the features as the bytes of 64-bit hashes."""
    schema = T.StructType([T.StructField("grade", T.IntegerType()), T.StructField("features", T.BinaryType())])

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            hashes, bounds, _ = features(part.column("text"))
            lists = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([part.column("grade").cast(pa.int32()), pa.array(lists, pa.binary())], ["grade", "features"])

    return map_arrow(df, make, schema)


def train(docs: DataFrame, grades: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Ordinal:
    """Fit on at most ``fit_rows`` labelled documents, chosen by a hash of the key; ``grades`` has (doc_id, grade)."""
    chosen = grades.select(F.col("doc_id").alias("key"), "grade").orderBy(F.xxhash64("key"), "key").limit(fit_rows)
    sample = two_columns(docs, id_col, text_col).join(F.broadcast(chosen), "key").select("grade", "text")  # the broadcast side has fit_rows rows at most
    rows = sorted(((r.grade, bytes(r.features)) for r in _feature_rows(sample).collect()), key=lambda r: (r[0], r[1]))
    rows = [r for r in rows if r[1]]
    parts = [np.frombuffer(f, np.uint64) for _, f in rows]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return fit(np.concatenate(parts) if parts else np.zeros(0, np.uint64), bounds, np.array([g for g, _ in rows], np.int64))


def _judge(model: Ordinal, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(expected grade, probability of the highest grade)."""
    hashes, bounds, seen = features(col)
    tails = model.tails(model.scores(hashes, bounds))
    expected = tails.sum(axis=1) * seen
    tail = (tails[:, -1] if tails.shape[1] else np.ones(len(seen))) * seen
    return expected, tail


def score(docs: DataFrame, model: Ordinal, least_tail: float = LEAST_TAIL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, expected_grade, tail_prob, keep) of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, key_type(docs, id_col)), T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_prob", T.DoubleType()), T.StructField("keep", T.BooleanType())])

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            expected, tail = _judge(shared.value, part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(expected), pa.array(tail), pa.array(tail >= least_tail)], schema.names)

    return map_arrow(two_columns(docs, id_col, text_col), judge, schema)


def keep_good(docs: DataFrame, model: Ordinal, least_tail: float = LEAST_TAIL, text_col: str = "text") -> DataFrame:
    """The rows whose text gets the highest grade with probability ``least_tail`` at least, unchanged and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.BooleanType())
    def good(col: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([col], ["text"])
        found = [_judge(shared.value, part.column("text"))[1] >= least_tail for part in tk.chunks(batch, "text")]
        return pa.array(np.concatenate(found) if found else np.zeros(0, bool))

    (flag,) = fresh(docs, "good")
    return docs.withColumn(flag, good.asNondeterministic()(F.col(f"`{text_col}`").cast("string"))).where(F.col(flag)).drop(flag)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, graded(table(spark, sf_dir, "labels"))))
