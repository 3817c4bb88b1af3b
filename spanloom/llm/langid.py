"""Language ID: a linear-chain conditional random field labels the words of code-switched text.

A word's features are its first and last one to three characters, all its character
triples, and itself (the lexicon), hashed into one table of weights by language. Learned
transitions tie neighbouring words. Forward-backward gives each word's probability of
each language given the whole text; the most probable language labels it.

It is fitted on texts of one known language each: sequences of spans from such texts in
random languages stand for code-switched text, with the language of every word known.

Defined results: a null or blank text, or one without words (runs of alphanumeric
characters), has a null language and no spans. Texts whose language is null aren't used
to fit; with one language only, every word gets it, and with none, ``und``. The language
of a text is the one with most expected words, of equal ones the first by name. Rows are
labelled each for itself, and null or repeated keys and other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import textkit as tk
from .tables import key_type, map_arrow, table, two_columns

#: Most labelled texts that the field is fitted on; those with the lowest hash of their key.
FIT_TEXTS = 800
TABLE_BITS = 18
SEQUENCES, SEQUENCE_WORDS, EPOCHS = 3000, 48, 3
CHUNK = 6_000_000
_KINDS = [np.uint64(0x2545F4914F6CDD1D * (i + 1) % 2**64) for i in range(8)]


def _slot(h: np.ndarray, kind: int) -> np.ndarray:
    return (tk.mix(h ^ _KINDS[kind]) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def features(w: tk.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slots, owners): table slots of features and the words that have them, in ascending order of the word; one pair for each kind."""
    length = w.end - w.start
    inverse = tk.powers(len(w.prefix))[1]
    span = lambda a, b: (w.prefix[b] - w.prefix[a]) * inverse[a]
    every = np.arange(len(length))
    out = [(_slot(w.hash, 0), every)]
    for n in (1, 2, 3):
        has = every[length >= n]
        out.append((_slot(span(w.start[has], w.start[has] + n), n), has))
        out.append((_slot(span(w.end[has] - n, w.end[has]), 3 + n), has))
    count = np.maximum(length - 2, 0)
    owner, place = tk.segments(count)
    at = w.start[owner] + place
    out.append((_slot(span(at, at + 3), 7), owner))
    return out


@dataclass
class Field:
    """Labels, feature weights by slot and label, transitions from label to label, and weights of the first label."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    begin: np.ndarray

    def emissions(self, w: tk.Words) -> np.ndarray:
        total = np.zeros((len(w.hash), len(self.labels)), np.float32)
        for slots, owner in features(w):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else owner
            if len(first) < len(owner):
                total[owner[first]] += np.add.reduceat(self.weights[slots], first, axis=0)
            else:  # one feature a word
                total[owner] += self.weights[slots]
        return total


def forward_backward(emissions: np.ndarray, bounds: np.ndarray, moves: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Probability of each label at each place of sequences laid end to end; all sequences advance together, longest first."""
    n = len(emissions)
    if not n:
        return emissions
    e = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + np.float32(1e-12)
    a, start = np.exp(moves - moves.max()).astype(np.float32), np.exp(begin - begin.max()).astype(np.float32)
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    first, falling = bounds[:-1][order], -lengths[order]
    live = np.searchsorted(falling, -np.arange(1, lengths.max() + 1), "right")
    alpha, now = np.empty_like(e), None
    for t, k in enumerate(live.tolist()):
        at = first[:k] + t
        now = e[at] * (start if t == 0 else now[:k] @ a)
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    back = np.ones((len(order), e.shape[1]), np.float32)
    for t in range(len(live) - 2, -1, -1):
        k = live[t + 1]
        at = first[:k] + t
        step = (e[at + 1] * back[:k]) @ a.T
        step /= step.sum(axis=1, keepdims=True)
        back[:k] = step
        alpha[at] *= step
    return alpha / alpha.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = 11) -> Field:
    """Stochastic gradient ascent (AdaGrad) on the conditional likelihood of made-up code-switched sequences."""
    labels = sorted(set(langs)) or ["und"]
    k = len(labels)
    field = Field(labels, np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros((k, k), np.float32), np.zeros(k, np.float32))
    if k < 2:
        return field
    w = tk.words(pa.array(texts, pa.string()))
    slots = np.concatenate([s for s, _ in features(w)])
    owner = np.concatenate([o for _, o in features(w)])
    order = np.argsort(owner, kind="stable")
    slots, starts = slots[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(w.hash)))])
    bounds = w.bounds()
    by = [[d for d, x in enumerate(langs) if x == name and bounds[d + 1] > bounds[d]] for name in labels]
    usable = [i for i in range(k) if by[i]]
    r = np.random.default_rng(seed)
    gw, gm, gb = np.full_like(field.weights, 1e-3), np.full((k, k), 1e-2, np.float32), np.full(k, 1e-2, np.float32)
    sequences = []
    for _ in range(SEQUENCES):
        words, tags = [], []
        while len(words) < SEQUENCE_WORDS:
            label = usable[r.integers(len(usable))]
            d = by[label][r.integers(len(by[label]))]
            n = int(min(r.geometric(0.06), SEQUENCE_WORDS - len(words), bounds[d + 1] - bounds[d]))
            a = int(r.integers(bounds[d], bounds[d + 1] - n + 1))
            words += range(a, a + n)
            tags += [label] * n
        sequences.append((words, tags))
    size = 50
    for _ in range(EPOCHS):
        turn = r.permutation(len(sequences))
        for i in range(0, len(turn), size):
            batch = [sequences[j] for j in turn[i : i + size]]
            words, tags = np.array([x for x, _ in batch]).ravel(), np.array([x for _, x in batch])
            own, place = tk.segments(starts[words + 1] - starts[words])
            used = slots[starts[words][own] + place]
            heads = np.concatenate([[0], np.cumsum(starts[words + 1] - starts[words])])[:-1]
            em = np.add.reduceat(field.weights[used], heads, axis=0)
            at = np.arange(0, len(words) + 1, SEQUENCE_WORDS)
            gamma = forward_backward(em, at, field.moves, field.begin)
            diff = -gamma
            diff[np.arange(len(words)), tags.ravel()] += 1
            unique, where = np.unique(used, return_inverse=True)
            g = np.stack([np.bincount(where, diff[own, c], len(unique)) for c in range(k)], axis=1).astype(np.float32) / size
            g -= 1e-5 * field.weights[unique]
            gw[unique] += g * g
            field.weights[unique] += 0.3 * g / np.sqrt(gw[unique])
            p = gamma.reshape(len(batch), -1, k)
            seen = np.zeros((k, k))
            np.add.at(seen, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
            e = np.exp(field.moves)
            pair = p[:, :-1, :, None] * e * (p[:, 1:] / np.maximum(p[:, :-1] @ e, 1e-9))[:, :, None, :]
            gt = ((seen - pair.sum(axis=(0, 1)) * seen.sum() / pair.sum()) / size).astype(np.float32)
            gm += gt * gt
            field.moves += 0.2 * gt / np.sqrt(gm)
            gs = ((np.bincount(tags[:, 0], minlength=k) - p[:, 0].sum(axis=0)) / size).astype(np.float32)
            gb += gs * gs
            field.begin += 0.2 * gs / np.sqrt(gb)
    return field


def train(docs: DataFrame, fit_texts: int = FIT_TEXTS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Field:
    """Fit on at most ``fit_texts`` labelled texts, chosen by a hash of the key."""
    plain = docs.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    chosen = plain.where("key is not null and lang is not null").select("key").orderBy(F.xxhash64("key"), "key").limit(fit_texts).distinct()
    rows = plain.join(F.broadcast(chosen), "key").where("text is not null and lang is not null").select("key", "text", "lang").collect()  # the broadcast side has fit_texts keys at most
    rows = sorted(rows, key=lambda r: (str(r.key), r.text, r.lang))[:fit_texts]
    return fit([r.text for r in rows], [r.lang for r in rows])


def label(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, lang, share, spans): the text's language, its share of the words, and (start, end, lang) of runs of words of one language, in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
    schema = T.StructType([T.StructField(id_col, key_type(docs, id_col)), T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])

    def tag(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array(model.labels, pa.string())
        for part in tk.chunks(batch, "text", CHUNK):
            w = tk.words(part.column("text"))
            bounds, counts = w.bounds(), w.counts()
            p = forward_backward(model.emissions(w), bounds, model.moves, model.begin)
            mass = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0, dtype=np.float64)])
            mass = mass[bounds[1:]] - mass[bounds[:-1]]
            best, tags, none = mass.argmax(axis=1), p.argmax(axis=1), counts == 0
            n = len(tags)
            new = np.ones(n, bool)
            new[1:] = (tags[1:] != tags[:-1]) | (w.row[1:] != w.row[:-1])
            head = np.flatnonzero(new)
            last = np.append(head[1:], n)[: len(head)] - 1
            begin = w.offsets[w.row[head]]
            spans = pa.StructArray.from_arrays([pa.array((w.start[head] - begin).astype(np.int32)), pa.array((w.end[last] - begin).astype(np.int32)), names.take(pa.array(tags[head]))], ["start", "end", "lang"])
            offsets = np.concatenate([[0], np.cumsum(np.bincount(w.row[head], minlength=w.rows))]).astype(np.int32)
            share = mass[np.arange(len(best)), best] / np.maximum(counts, 1)
            yield pa.RecordBatch.from_arrays([part.column("key"), names.take(pa.array(best, mask=none)), pa.array(share, mask=none), pa.ListArray.from_arrays(pa.array(offsets), spans)], schema.names)

    return map_arrow(two_columns(docs, id_col, text_col), tag, schema)


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return label(docs, train(docs))
