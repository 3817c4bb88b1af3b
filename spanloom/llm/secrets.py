"""Secret scans: probabilistic automata inferred from labelled credentials score all candidates.

For each labelled format the credentials form a prefix tree. Level by level, states of
the tree are merged where their next characters (and, after each, the ones that follow)
are compatible by Hoeffding's bound; then states of different levels are merged where
the automaton from them on is compatible, folding what they lead to. The first pass
keeps what a format fixes: literal prefixes, lengths, alphabets by place. The second
finds its loops. Characters that a state wasn't seen to send share a little probability
with those of their kind, if the state sends several of the kind.

Candidates lie in maximal runs of ``ALPHABET`` in whole texts: all parts that begin at the
run's start or after one of ``SEPARATORS``, and stop at its end or before one. Each is
scored by every automaton; a format is reported where its log likelihood beats that of
ordinary runs (an automaton inferred in the same way from runs labelled as such) by
``margin``. Parts shorter than any that an automaton can send have no likelihood under it,
so they are passed over.

Defined results: a null or empty text has no candidates. A candidate that two formats
accept is given to the likelier one, and of equally likely ones to the first by name.
Of candidates that overlap, the one with the highest ratio is reported, of equally high
ones the longest, then the first. Repeated rows, and repeated credentials in a text, are
reported each for itself. Rows with a null key are scanned, and reported with it. Other
columns are ignored.
"""

from __future__ import annotations

import math
import random
import string
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from . import textkit as tk
from .tables import key_type, map_arrow, table, two_columns

ALPHABET = string.ascii_letters + string.digits + "_-+/=."
#: Characters of the shortest ordinary runs that are made up.
ORDINARY_LENGTH = 16
SEPARATORS = "=/.-_+"
#: Labelled credentials of each format that the automata are inferred from, and Hoeffding's confidence.
PER_FORMAT, CONFIDENCE = 300, 0.01
#: Characters of a kind that a state must have been seen to send before it may send the others of that kind.
SPREAD = 4
#: Natural logarithm by which a format must be likelier than ordinary text.
MARGIN = 12.0
ORDINARY = "ordinary"
END = len(ALPHABET)
_KINDS = [string.ascii_lowercase, string.ascii_uppercase, string.digits, "_-", "+/", "=", "."]
_CODE = {c: i for i, c in enumerate(ALPHABET)}
_KIND = np.array([next(k for k, cs in enumerate(_KINDS) if c in cs) for c in ALPHABET] + [len(_KINDS)])


def labelled_credentials(per_format: int = PER_FORMAT, seed: int = 7) -> list[tuple[str, str]]:
    """(format, run) pairs: made-up credentials of published formats, and ordinary runs that aren't secrets."""
    r = random.Random(seed)
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    pick = lambda chars, n: "".join(r.choices(chars, k=n))
    b62, hexa, b64u = lower + upper + digits, digits + "abcdef", lower + upper + digits + "_-"
    formats = {
        "aws_access_key": lambda: r.choice(["AKIA", "ASIA"]) + pick(upper + "234567", 16),
        "github_token": lambda: r.choice(["ghp", "gho", "ghs", "ghu"]) + "_" + pick(b62, 36),
        "google_api_key": lambda: "AIza" + pick(b64u, 35),
        "gitlab_token": lambda: "glpat-" + pick(b64u, 20),
        "hex_32": lambda: pick(hexa, 32),
        "hex_40": lambda: pick(hexa, 40),
        "hex_64": lambda: pick(hexa, 64),
        "json_web_token": lambda: "eyJhbGciOi" + pick(b62, r.randint(20, 30)) + ".eyJ" + pick(b62, r.randint(30, 90)) + "." + pick(b64u, 43),
        "npm_token": lambda: "npm_" + pick(b62, 36),
        "slack_token": lambda: "xox" + r.choice("bpar") + "-" + pick(digits, r.randint(11, 13)) + "-" + pick(digits, r.randint(11, 13)) + "-" + pick(b62, 24),
        "stripe_key": lambda: r.choice(["sk", "rk"]) + "_" + r.choice(["live", "test"]) + "_" + pick(b62, 24),
        "base64_40": lambda: pick(b62 + "+/", 40),
    }
    syllables = "the an er on in re at es st en or ti ha ing tion ed th nd ou ly le la de que ment eau ir ch sch ung keit lich heit ver be ge zu au ie ci ado ue as os ar con mente ra ca lo mi su pe".split()
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 5)))

    def ordinary() -> str:
        shape = r.randrange(7)
        if shape < 3:
            out = "".join(r.choices(syllables, k=r.randint(6, 16)))
            out = out.capitalize() if shape == 1 else out.upper() if shape == 2 else out
        elif shape == 3:
            out = r.choice("-_./").join(word() for _ in range(r.randint(3, 7)))
        elif shape == 4:
            out = "www." + word() + word() + "." + r.choice(["com", "org", "net"]) + "/" + word() + "/" + pick(digits, r.randint(1, 4))
        elif shape == 5:
            out = f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}" + r.choice(["", "." + pick(digits, 6)]) + "-" + word() + word()
        else:
            out = r.choice(["-", "=", "_", ".", "0"]) * r.randint(16, 60) if r.random() < 0.5 else pick(digits, r.randint(16, 20))
        return out if len(out) >= ORDINARY_LENGTH else out + "-" + word() * 6

    out = [(name, make()) for name, make in formats.items() for _ in range(per_format)]
    return out + [(ORDINARY, ordinary()) for _ in range(4 * per_format)]


def _compatible(a: Counter, b: Counter) -> bool:
    n, m = sum(a.values()), sum(b.values())
    if not n or not m:
        return True
    bound = math.sqrt(0.5 * math.log(2 / CONFIDENCE)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    return all(abs(a[c] / n - b[c] / m) <= bound for c in a.keys() | b.keys())


def _layers(codes: list[list[int]]) -> tuple[list[Counter], list[dict[int, int]], list[int]]:
    """The prefix tree with compatible states of one depth merged: (counts, transitions, depth) of each state."""
    counts: list[Counter] = [Counter(x[0] if x else END for x in codes)]
    moves: list[dict[int, int]] = [{}]
    depths = [0]
    level = {0: list(range(len(codes)))}

    def alike(xs: list[int], ys: list[int], d: int, deep: int = 0) -> bool:
        a, b = Counter(codes[i][d] if d < len(codes[i]) else END for i in xs), Counter(codes[i][d] if d < len(codes[i]) else END for i in ys)
        if not _compatible(a, b):
            return False
        if deep == 3 or len(xs) < 8 or len(ys) < 8:
            return True
        return all(alike([i for i in xs if d < len(codes[i]) and codes[i][d] == c], [i for i in ys if d < len(codes[i]) and codes[i][d] == c], d + 1, deep + 1) for c in a.keys() & b.keys() if c != END)

    depth = 0
    while level:
        blue: dict[tuple[int, int], list[int]] = defaultdict(list)
        for state, members in level.items():
            for i in members:
                if depth < len(codes[i]):
                    blue[state, codes[i][depth]].append(i)
        depth += 1
        red: list[tuple[int, list[int]]] = []
        for (state, c), members in sorted(blue.items(), key=lambda x: (-len(x[1]), x[0])):
            for number, own in red:
                if alike(members, own, depth):
                    own.extend(members)
                    moves[state][c] = number
                    break
            else:
                moves[state][c] = len(counts)
                red.append((len(counts), list(members)))
                counts.append(Counter())
                moves.append({})
                depths.append(depth)
        for number, own in red:
            counts[number] = Counter(codes[i][depth] if depth < len(codes[i]) else END for i in own)
        level = dict(red)
    return counts, moves, depths


def infer(runs: list[str]) -> tuple[list[Counter], list[dict[int, int]]]:
    """(counts of each state's next characters, its transitions) of the automaton inferred from labelled runs; state 0 begins."""
    counts, moves, depths = _layers([[_CODE[c] for c in x] for x in sorted(runs)])

    def agree(a: int, b: int, seen: set[tuple[int, int]]) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if x == y or (x, y) in seen:
                continue
            seen.add((x, y))
            if not _compatible(counts[x], counts[y]):
                return False
            todo += [(moves[x][c], moves[y][c]) for c in moves[x].keys() & moves[y].keys()]
        return True

    def fold(a: int, b: int) -> None:
        """Merge b into a, and what both lead to by the same character."""
        alias: dict[int, int] = {}

        def real(s: int) -> int:
            while s in alias:
                s = alias[s]
            return s

        todo = [(a, b)]
        while todo:
            x, y = (real(s) for s in todo.pop())
            if x == y:
                continue
            x, y = min(x, y), max(x, y)
            alias[y] = x
            counts[x] = counts[x] + counts[y]
            for c, t in moves[y].items():
                if c in moves[x]:
                    todo.append((moves[x][c], t))
                else:
                    moves[x][c] = t
        for m in moves:
            for c, t in m.items():
                m[c] = real(t)

    kept = [0]
    pending = True
    while pending:
        reached = sorted({t for s in kept for t in moves[s].values()} - set(kept), key=lambda s: (depths[s], s))
        pending = bool(reached)
        if not reached:
            break
        blue = reached[0]
        for red in sorted(kept, key=lambda s: (-depths[s], s)):
            if sum(counts[red].values()) >= 8 and sum(counts[blue].values()) >= 8 and agree(red, blue, set()):
                fold(red, blue)
                kept = [s for s in kept if s == 0 or any(s in m.values() for m in moves)] or [0]
                break
        else:
            kept.append(blue)
    names = {}
    order = [0]
    for s in order:
        names.setdefault(s, len(names))
        for t in moves[s].values():
            if t not in names and t not in order:
                order.append(t)
    return [counts[s] for s in order], [{c: order.index(t) for c, t in moves[s].items()} for s in order]


@dataclass
class Automaton:
    """Tables of one format: log probability and next state, by state and character (the last is the end)."""

    name: str
    logp: np.ndarray
    follow: np.ndarray

    @classmethod
    def of(cls, name: str, runs: list[str], smooth: float = 0.5) -> Automaton:
        counts, moves = infer(runs)
        logp, follow = np.full((len(counts) + 1, END + 1), -np.inf), np.full((len(counts) + 1, END + 1), len(counts), np.int32)
        kind_size = np.bincount(_KIND)
        for s, (count, move) in enumerate(zip(counts, moves)):
            n = sum(count.values())
            kinds, distinct = Counter(), Counter(_KIND[c] for c in count)
            for c, k in count.items():
                kinds[_KIND[c]] += k
            for c in range(END + 1):
                k = _KIND[c]
                share = kinds[k] if count.get(c) or distinct[k] >= SPREAD else 0  # fewer characters are literals of the format
                if name == ORDINARY:
                    share = kinds[k] + 0.5
                if share:
                    p = (count.get(c, 0) + smooth * share / (n + 1e-9) / kind_size[k]) / (n + smooth)
                    logp[s, c] = math.log(max(p, 1e-12))
                    if c != END:
                        alike = [(count[x], -x) for x in move if _KIND[x] == k] or [(count[x], -x) for x in move]
                        follow[s, c] = move.get(c, move[-max(alike)[1]] if alike else s)
        return cls(name, logp, follow)

    @cached_property
    def shortest(self) -> int:
        """Characters of the shortest run that the automaton can send."""
        level, seen, n = {0}, set(), 0
        while level and not any(self.logp[s, END] > -np.inf for s in level):
            seen |= level
            level = {int(self.follow[s, c]) for s in level for c in np.flatnonzero(self.logp[s, :END] > -np.inf)} - seen
            n += 1
        return max(n, 1) if level else 1 << 40

    def score(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Log likelihood of the run codes[start : start + length] for each run."""
        total, state = np.zeros(len(start)), np.zeros(len(start), np.int32)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        out, live = total, len(start)
        for k in range(int(length.max()) if len(length) else 0):
            live = int(np.searchsorted(-length, -k, "left"))
            c = codes[start[:live] + k]
            out[:live] += self.logp[state[:live], c]
            state[:live] = self.follow[state[:live], c]
        out += self.logp[state, END]
        back = np.empty(len(out))
        back[order] = out
        return back


def learn(labelled: list[tuple[str, str]]) -> list[Automaton]:
    """An automaton of each format, ordinary runs last; labels beside runs with characters outside ``ALPHABET`` are refused."""
    by: dict[str, list[str]] = defaultdict(list)
    for name, run in labelled:
        if not run or set(run) - set(ALPHABET):
            raise ValueError(f"{name}: {run!r} isn't a run of {ALPHABET}")
        by[name].append(run)
    if ORDINARY not in by:
        raise ValueError("there must be ordinary runs among the labelled ones")
    return [Automaton.of(name, by[name]) for name in sorted(by, key=lambda x: (x == ORDINARY, x))]


_TABLE = np.full(256, 255, np.uint8)
for _c, _i in _CODE.items():
    _TABLE[ord(_c)] = _i


def candidates(points: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of all characters, starts, lengths) of the maximal runs of ``least`` characters and more."""
    codes = _TABLE[np.minimum(points, 255)]
    start, end = tk.runs(codes != 255, offsets)
    long = end - start >= least
    return codes, start[long], (end - start)[long]


_SEPARATES = np.zeros(256, bool)
_SEPARATES[[_CODE[c] for c in SEPARATORS]] = True


def accepted(automaton: Automaton, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, log likelihoods) of the parts that the automaton can send, from the starts given to a separator or to ``end``."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    total, state, k = np.zeros(len(start)), np.zeros(len(start), np.int32), 0
    while len(start):
        c = codes[start + k]
        total = total + automaton.logp[state, c]
        state = automaton.follow[state, c]
        k += 1
        live = total > -np.inf
        start, end, total, state = start[live], end[live], total[live], state[live]
        more = start + k < end
        if k >= automaton.shortest:
            score = total + automaton.logp[state, END]
            stops = ~more
            stops[more] = _SEPARATES[codes[start[more] + k]]
            ok = stops & (score > -np.inf)
            found.append((start[ok], np.full(int(ok.sum()), k), score[ok]))
        start, end, total, state = start[more], end[more], total[more], state[more]
    return tuple(np.concatenate(x) for x in zip(*found))


def judge(automata: list[Automaton], codes: np.ndarray, start: np.ndarray, length: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, index of the format, log likelihood ratio to ordinary runs) of the parts of the runs that reach ``margin``, in order; none overlap."""
    at = np.arange(int(length.sum())) + np.repeat(start - np.cumsum(length) + length, length)
    end = np.repeat(start + length, length)
    begins = (at == np.repeat(start, length)) | _SEPARATES[codes[at - 1]]
    parts = [accepted(a, codes, at[own], end[own]) for a in automata[:-1] for own in [begins & (end - at >= a.shortest)]]
    s, n, score = (np.concatenate(x) for x in zip(*parts))
    form = np.repeat(np.arange(len(parts)), [len(x[0]) for x in parts])
    score = score - np.maximum(automata[-1].score(codes, s, n), -1e6)
    hit = np.flatnonzero(score >= margin)
    kept: list[int] = []
    taken: set[int] = set()
    for i in hit[np.lexsort((form[hit], s[hit], -n[hit], -score[hit]))].tolist():
        own = range(int(s[i]), int(s[i] + n[i]))
        if taken.isdisjoint(own):
            taken.update(own)
            kept.append(i)
    kept = np.array(sorted(kept, key=lambda i: s[i]), np.int64)
    return s[kept], n[kept], form[kept], score[kept]


def scan(docs: DataFrame, automata: list[Automaton], margin: float = MARGIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, start, end, format, score): each secret's place in its text, in characters, and its log likelihood ratio."""
    shared = docs.sparkSession.sparkContext.broadcast(automata)
    least = min((a.shortest for a in automata[:-1]), default=1 << 40)
    schema = T.StructType([T.StructField(id_col, key_type(docs, id_col)), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("format", T.StringType()), T.StructField("score", T.DoubleType())])

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text"):
            points, offsets = tk.decode(part.column("text"))
            codes, start, length = candidates(points, offsets, least)
            if not len(start):
                continue
            start, length, best, score = judge(shared.value, codes, start, length, margin)
            row = np.searchsorted(offsets, start, "right") - 1
            begin = start - offsets[row]
            names = pa.array([shared.value[i].name for i in best], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(row)), pa.array(begin), pa.array(begin + length), names, pa.array(score)], schema.names)

    return map_arrow(two_columns(docs, id_col, text_col), find, schema)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), learn(labelled_credentials()))
