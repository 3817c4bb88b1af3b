"""K-mer states of a query region against a reference region, their densities, and the inversions they show."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.sequences import FITS, base_numbers, gathered, good_runs, reverse_complement, run_numbers, spread_kmers, turned_numbers

FWD, FWDREV, REV = 0, 1, 2
#: Bases of a name, of both sides, up to which its k-mers are held against each other in one task.
WHOLE = 8_000_000
#: Hidden states: left reference, left repeat, inversion, right repeat, right reference, inversion without repeats.
MOVES = ((0.95, 0.04, 0, 0, 0, 0.01), (0, 0.95, 0.05, 0, 0, 0), (0, 0, 0.95, 0.05, 0, 0), (0, 0, 0, 0.95, 0.05, 0), (0, 0, 0, 0, 1, 0), (0, 0, 0, 0, 0.05, 0.95))
SEEN = {0: FWD, 1: FWDREV, 2: REV, 3: FWDREV, 4: FWD, 5: REV}
LABELS = {0: "fwd", 1: "fwdrev", 2: "rev", 3: "fwdrev", 4: "fwd", 5: "rev"}
#: Progressions of hidden states that make an inversion: with inverted repeats about it, and without.
WITH_REPEATS, WITHOUT = (0, 1, 2, 3, 4), (0, 5, 4)


def spread_states(reference: DataFrame, query: DataFrame, k: int, most: int, key: str, bases: str, reverse: str | None) -> DataFrame:
    """``states`` of sequences of any length, by joins of k-mers."""
    counts = spread_kmers(reference, k, key, bases).groupBy(key, "kmer").agg(F.count("*").alias("n"))
    turned = counts.select(key, reverse_complement(F.col("kmer")).alias("kmer"), F.col("n").alias("m"))
    both = counts.join(turned, [key, "kmer"], "full").select(key, "kmer", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("m", F.lit(0)).alias("m")).where(F.col("n") + F.col("m") <= most)
    fwd, rev = F.col("n") > 0, F.col("m") > 0
    found = spread_kmers(query.where(f"not coalesce({reverse}, false)") if reverse else query, k, key, bases).join(both, [key, "kmer"])
    name = lambda f, r: F.when(f & r, FWDREV).when(f, FWD).otherwise(REV).alias("state_mer")
    out = found.select(key, "index", name(fwd, rev))
    if reverse:
        out = out.union(spread_kmers(query.where(reverse), k, key, bases).join(both, [key, "kmer"]).select(key, "index", name(rev, fwd)))
    return out


def states_of(refs: list[str | None], queries: list[tuple[str | None, bool]], k: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, state_mer) of a name's k-mers that count, in order."""
    runs = lambda numbers: run_numbers(numbers, k)[good_runs(numbers, k)]
    parts = [runs(base_numbers(x)) for x in refs if x and len(x) >= k]
    known, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    index, mer = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]

    def often(wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return np.where(known[at] == wanted, counts[at], 0)

    for text, backwards in queries if len(known) else ():
        if not text or len(text) < k:
            continue
        numbers = base_numbers(text)
        good = good_runs(numbers, k)
        n, m = often(run_numbers(numbers, k)[good]), often(run_numbers(turned_numbers(numbers), k)[len(numbers) - k - good])
        counted = (n + m > 0) & (n + m <= most)
        fwd, rev = (m > 0, n > 0) if backwards else (n > 0, m > 0)
        index.append(good[counted])
        mer.append(np.where(fwd & rev, FWDREV, np.where(fwd, FWD, REV)).astype(np.int32)[counted])
    index, mer = np.concatenate(index), np.concatenate(mer)
    order = np.argsort(index, kind="stable")
    return index[order], mer[order]


def with_states(reference: DataFrame, query: DataFrame, work: Callable[[np.ndarray, np.ndarray], list[np.ndarray]], schema: T.StructType, far: Callable[[DataFrame], DataFrame], k: int, most: int, key: str, bases: str, reverse: str | None) -> DataFrame:
    """What ``work`` makes of the places and states of each name's k-mers, a row at a time; ``far`` makes the same of the rows of ``states``.

    The sequences of a name meet in one task, and no k-mer is sent; names of more than ``WHOLE`` bases have theirs sent, joined and given to ``far``.
    """
    backwards = F.coalesce(F.col(reverse), F.lit(False)) if reverse else F.lit(False)
    refs = reference.groupBy(key).agg(F.collect_list(bases).alias("r"))
    queries = query.groupBy(key).agg(F.collect_list(F.struct(F.col(bases).alias("q"), backwards.alias("rev"))).alias("q"))
    long = lambda c, get: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + F.coalesce(F.length(get(x)), F.lit(0)))
    met = refs.join(queries, key).select(key, "r", "q")
    bp = long("r", lambda x: x) + long("q", lambda x: x["q"])

    def found(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
        for row, (r, q) in enumerate(zip(batch.column(1), batch.column(2))):
            index, mer = states_of(r.as_py(), [(x["q"], x["rev"]) for x in q.as_py()], k, most)
            if len(index):
                yield row, work(index, mer)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from gathered(batch, found(batch), schema.names)

    near = met.where(bp <= WHOLE if k <= FITS else F.lit(False)).mapInArrow(over, schema)
    rest = met.where(bp > WHOLE if k <= FITS else F.lit(True))
    own = rest.select(key, F.explode("q").alias("x")).select(key, F.col("x.q").alias("bases"), F.col("x.rev").alias("rev"))
    return near.union(far(spread_states(rest.select(key, F.explode("r").alias("bases")), own, k, most, key, "bases", "rev")).select(schema.names))


def states(reference: DataFrame, query: DataFrame, k: int = 31, most: int = 10, key: str = "name", bases: str = "bases", reverse: str | None = None) -> DataFrame:
    """(key, index, state_mer) of the query's k-mers that are in the reference as they are (0), turned (2) or both (1).

    Reference and query rows meet by ``key``; k-mers that, with their reverse, occur more than ``most`` times in the reference
    don't count. ``reverse`` names a column of the query that says whether it runs backwards.
    """
    schema = query.select(key).schema.add("index", "long").add("state_mer", "integer")
    return with_states(reference, query, lambda index, mer: [index, mer], schema, lambda x: x, k, most, key, bases, reverse)


def kernel(bandwidth: float = 100.0, cut: float = 3.0) -> np.ndarray:
    """A normal density cut at ``cut`` deviations, at whole positions, that sums to 1."""
    half = int(np.ceil(cut * bandwidth))
    w = np.exp(-0.5 * (np.arange(-half, half + 1) / bandwidth) ** 2)
    return w / w.sum()


@lru_cache(16)
def spectrum(weights: bytes, size: int) -> np.ndarray:
    return np.fft.rfft(np.frombuffer(weights), size)


def density(ones: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Convolution of a 0/1 vector with a kernel, by FFT, of the vector's length."""
    n, half = len(ones), len(weights) // 2
    size = 1 << (n + len(weights) - 1).bit_length()
    full = np.fft.irfft(np.fft.rfft(ones, size) * spectrum(weights.tobytes(), size), size)
    return np.maximum(full[half : half + n], 0)


def densities_of(mer: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """kde_fwd, kde_fwdrev, kde_rev and the state of the highest, the first of equals, of states in order."""
    made = [density((mer == s).astype(float), weights) for s in (FWD, FWDREV, REV)]
    return [*made, np.argmax(np.round(made, 12), axis=0).astype(np.int32)]


DENSITIES = (("kde_fwd", "double"), ("kde_fwdrev", "double"), ("kde_rev", "double"), ("state", "integer"))


def added(schema: T.StructType, columns: tuple[tuple[str, str], ...]) -> T.StructType:
    for name, kind in columns:
        schema = schema.add(name, kind)
    return schema


def with_densities(table: DataFrame, key: str = "name", bandwidth: float = 100.0, cut: float = 3.0) -> DataFrame:
    """The states with kde_fwd, kde_fwdrev, kde_rev over the k-mers that count, in order, and the state of the highest; the first of equals."""
    weights = kernel(bandwidth, cut)
    schema = added(table.select(key, "index", "state_mer").schema, DENSITIES)

    def work(group):
        group = group.sort_values("index", kind="stable").reset_index(drop=True)
        for (name, _), y in zip(DENSITIES, densities_of(group["state_mer"].to_numpy(), weights)):
            group[name] = y
        return group[schema.names]

    return table.select(key, "index", "state_mer").groupBy(key).applyInPandas(work, schema)


def state_densities(reference: DataFrame, query: DataFrame, k: int = 31, most: int = 10, key: str = "name", bases: str = "bases", reverse: str | None = None, bandwidth: float = 100.0, cut: float = 3.0) -> DataFrame:
    """``with_densities`` of ``states``, without their rows being sent."""
    weights = kernel(bandwidth, cut)
    schema = added(query.select(key).schema.add("index", "long").add("state_mer", "integer"), DENSITIES)
    return with_states(reference, query, lambda index, mer: [index, mer, *densities_of(mer, weights)], schema, lambda x: with_densities(x, key, bandwidth, cut), k, most, key, bases, reverse)


def binomial_p(rev: int, fwd: int, p: float = 0.5, two_sided: bool = True) -> float:
    """Probability of more than ``rev`` of ``rev + fwd`` draws, times 2 where two-sided."""
    n = rev + fwd
    log = lambda k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    return (2 if two_sided else 1) * math.fsum(math.exp(log(k)) for k in range(rev + 1, n + 1))


def run_test(runs: list[tuple[int, int]], trim: bool = True, **how) -> float:
    """``binomial_p`` of (state, length) runs, without forward runs at either end."""
    runs = list(runs)
    if trim and runs and runs[0][0] == FWD:
        runs = runs[1:]
    if trim and runs and runs[-1][0] == FWD:
        runs = runs[:-1]
    return binomial_p(sum(n for s, n in runs if s == REV), sum(n for s, n in runs if s == FWD), **how)


def viterbi(seen: np.ndarray) -> np.ndarray:
    """The likeliest hidden states of a run of observed ones; the lowest of equally likely ones."""
    with np.errstate(divide="ignore"):
        moves = np.log(np.array(MOVES)).tolist()
        sends = np.log(np.array([[0.9 if SEEN[h] == s else 0.05 for h in range(6)] for s in (FWD, FWDREV, REV)])).tolist()
    m00, m01, m05, m11, m12, m22, m23, m33, m34, m44, m54, m55 = (moves[i][j] for i, j in ((0, 0), (0, 1), (0, 5), (1, 1), (1, 2), (2, 2), (2, 3), (3, 3), (3, 4), (4, 4), (5, 4), (5, 5)))
    never = -math.inf
    b0, b1, b2, b3, b4, b5 = sends[seen[0]][0], never, never, never, never, never
    back = np.zeros((len(seen) - 1, 6), np.int8)
    rows, last = [], 0
    for i, s in enumerate(seen[1:].tolist()):  # of the moves only those that can be made, in order of the state that they come from
        t = sends[s]
        x1, y1, x2, y2, x3, y3, x4, y4, z4, x5, y5 = b0 + m01, b1 + m11, b1 + m12, b2 + m22, b2 + m23, b3 + m33, b3 + m34, b4 + m44, b5 + m54, b0 + m05, b5 + m55
        w4, f4 = (y4, 4) if y4 > x4 else (x4, 3)
        if z4 > w4:
            w4, f4 = z4, 5
        rows.append((0, 1 if y1 > x1 else 0, 2 if y2 > x2 else 1, 3 if y3 > x3 else 2, f4, 5 if y5 > x5 else 0))
        b0, b1, b2, b3, b4, b5 = b0 + m00 + t[0], (y1 if y1 > x1 else x1) + t[1], (y2 if y2 > x2 else x2) + t[2], (y3 if y3 > x3 else x3) + t[3], w4 + t[4], (y5 if y5 > x5 else x5) + t[5]
        if len(rows) == 100_000:
            back[last : i + 1], rows, last = rows, [], i + 1
    if rows:
        back[last:] = rows
    best = (b0, b1, b2, b3, b4, b5)
    at = best.index(max(best))
    path = [at]
    for i in range(len(back) - 1, -1, -1):
        at = int(back[i, at])
        path.append(at)
    return np.array(path[::-1], np.int32)


RUNS = (("run", "integer"), ("inv_state", "integer"), ("label", "string"), ("index_start", "long"), ("index_end", "long"), ("len", "long"), ("n_fwd", "long"), ("n_fwdrev", "long"), ("n_rev", "long"))


def runs_of(index: np.ndarray, mer: np.ndarray, state: np.ndarray) -> list[tuple]:
    path = viterbi(state)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
    rows = [(i, int(path[a]), LABELS[int(path[a])], int(index[a]), int(index[b - 1]), int(index[b - 1] - index[a]), *(int((mer[a:b] == s).sum()) for s in (FWD, FWDREV, REV))) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    return [r for r in rows if r[5] > 0]


def hidden_runs(table: DataFrame, key: str = "name") -> DataFrame:
    """(key, run, inv_state, label, index_start, index_end, len, n_fwd, n_fwdrev, n_rev): runs of hidden states, in order, but those of one k-mer."""
    schema = added(table.select(key).schema, RUNS)

    def work(group):
        import pandas as pd

        group = group.sort_values("index", kind="stable")
        return pd.DataFrame([(group[key].iloc[0], *r) for r in runs_of(*(group[c].to_numpy() for c in ("index", "state_mer", "state")))], columns=schema.names)

    return table.groupBy(key).applyInPandas(work, schema)


def state_runs(reference: DataFrame, query: DataFrame, k: int = 31, most: int = 10, key: str = "name", bases: str = "bases", reverse: str | None = None, bandwidth: float = 100.0, cut: float = 3.0) -> DataFrame:
    """``hidden_runs`` of ``with_densities`` of ``states``, without their rows being sent."""
    weights = kernel(bandwidth, cut)
    schema = added(query.select(key).schema, RUNS)

    def work(index, mer):
        rows = runs_of(index, mer, densities_of(mer, weights)[3])
        kinds = (np.int32, np.int32, object, *[np.int64] * 6)
        return [np.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

    return with_states(reference, query, work, schema, lambda x: hidden_runs(with_densities(x, key, bandwidth, cut), key), k, most, key, bases, reverse)


def inversion_regions(runs: DataFrame, key: str = "name") -> DataFrame:
    """(key, inner_pos, inner_end, outer_pos, outer_end) of those whose runs make an inversion; ends are one past the first base of the last k-mer."""
    listed = runs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("run", "inv_state", "index_start", "index_end"))).alias("r"))
    path = F.transform("r", lambda x: x["inv_state"])
    is_path = lambda states: path == F.array(*[F.lit(s) for s in states])
    a, b = (lambda i: F.get("r", i)["index_start"]), (lambda i: F.get("r", i)["index_end"] + 1)
    full: Column = is_path(WITH_REPEATS)
    pick = lambda with_repeats, without: F.when(full, with_repeats).otherwise(without)
    made = listed.where(full | is_path(WITHOUT))
    return made.select(key, pick(a(2), a(1)).alias("inner_pos"), pick(b(2), b(1)).alias("inner_end"), a(1).alias("outer_pos"), pick(b(3), b(1)).alias("outer_end"))
