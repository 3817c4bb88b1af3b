"""Operators on alignment operations and alignment tables.

An operation has a code (0 M, 1 I, 2 D, 3 N, 4 S, 5 H, 6 P, 7 =, 8 X) and a length. Long
form is one row an operation; packed form is one row a record, with an array ``ops`` of
structs (op_index, op_code, op_len) in order. Only ``expand_matches`` and k-mers leave the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.sequences import gathered, kmer_counts, kmers, reverse_complement  # noqa: F401
from .intervals import merge  # noqa: F401

LETTERS = "MIDNSHP=X"
REF_STEPS, QRY_STEPS = (0, 2, 3, 7, 8), (0, 1, 4, 7, 8)
#: Operations that coordinates move on by; hard clipped bases are part of the query.
REF_ADVANCE, QRY_ADVANCE = (0, 2, 7, 8), (0, 1, 4, 5, 7, 8)


@dataclass(frozen=True)
class Affine:
    """Scores of matches and mismatches a base, and (open, extend) pairs of which the cheapest prices a gap."""

    match: float = 2.0
    mismatch: float = 4.0
    gaps: tuple[tuple[float, float], ...] = ((4.0, 2.0), (24.0, 1.0))
    switch: float | None = None  # score of a template switch; by default that of a gap of 50 bases
    off_variant: float = 2.0  # factor of penalties beside the variant that is called

    def __post_init__(self):
        if self.off_variant <= 1:
            raise ValueError("off_variant must be over 1")

    def gap_of(self, n: float) -> float:
        """Score of a gap of a length that is known."""
        return max(-(o + e * n) for o, e in self.gaps) if n else 0.0

    def template_switch(self, n: int = 1) -> float:
        return (self.gap_of(50) if self.switch is None else self.switch) * n

    def mismatch_model(self) -> Affine:
        """The model in which gaps are free."""
        return Affine(self.match, self.mismatch, ((0.0, 0.0),), self.template_switch(), self.off_variant)

    @classmethod
    def parse(cls, spec: str) -> Affine:
        """From affine::match=2.0,mismatch=4.0,gap=4:2;24:1,ts=..,off_var=..; values in that order need no name, and none may follow a named one."""
        kind, _, rest = spec.partition("::")
        if kind.strip().lower() != "affine":
            raise ValueError(f"unknown score model: {spec}")
        names, values, named = ["match", "mismatch", "gap", "ts", "off_var"], {}, False
        for i, part in enumerate(x.strip() for x in rest.split(",") if x.strip()):
            name, mark, value = part.partition("=")
            if not mark:
                if named or i >= len(names):
                    raise ValueError(f"{part!r} has no name")
                name, value = names[i], part
            named = named or bool(mark)
            name = name.strip().lower()
            if name not in names or name in values:
                raise ValueError(f"{name!r} is unknown or there twice")
            values[name] = value.strip()
        out = {k: abs(float(values[k])) for k in ("match", "mismatch") if k in values}
        if "gap" in values:
            out["gaps"] = tuple(tuple(abs(float(x)) for x in pair.split(":")) for pair in values["gap"].split(";"))
            if any(len(pair) != 2 for pair in out["gaps"]):
                raise ValueError(f"gaps are open:extend pairs: {values['gap']}")
        if "ts" in values:
            out["switch"] = cls(**out).gap_of(float(values["ts"][:-2])) if values["ts"].endswith("bp") else -abs(float(values["ts"]))
        if "off_var" in values:
            out["off_variant"] = float(values["off_var"])
        return cls(**out)

    def spec(self) -> str:
        gaps = ";".join(f"{o}:{e}" for o, e in self.gaps)
        return f"affine::match={self.match},mismatch={self.mismatch},gap={gaps},ts={self.template_switch()},off_var={self.off_variant}"

    def gap(self, n: Column) -> Column:
        costs = [-(F.lit(o) + F.lit(e) * n) for o, e in self.gaps]
        best = F.greatest(*costs) if len(costs) > 1 else costs[0]
        return F.when(n == 0, F.lit(0.0)).otherwise(best)

    def op(self, code: Column, n: Column) -> Column:
        """Score of an operation; M, which hides matches and mismatches, raises."""
        return (
            F.when(code == 7, F.lit(self.match) * n).when(code == 8, -F.lit(self.mismatch) * n).when(code.isin(1, 2), self.gap(n))
            .when(code == 0, F.raise_error(F.lit("M can't be scored; expand it to = and X first")).cast("double")).otherwise(F.lit(0.0))
        )


def pack(ops: DataFrame, key: str = "align_index") -> DataFrame:
    return ops.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("op_index", "op_code", "op_len"))).alias("ops"))


def cigar(ops: Column) -> Column:
    letter = lambda code: F.substring(F.lit(LETTERS), code + 1, F.lit(1))
    return F.array_join(F.transform(ops, lambda o: F.concat(o["op_len"].cast("string"), letter(o["op_code"]))), "")


def parse_cigar(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, op_index from 1, op_code, op_len); a string with anything but operations in it raises."""
    pattern = "([0-9]+)([MIDNSHP=X])"
    left = F.regexp_replace(text, pattern, "")
    checked = F.when(left == "", F.col(text)).otherwise(F.raise_error(F.concat(F.lit("not a CIGAR string: "), text)))
    parts = df.select(key, checked.alias("c")).select(key, F.posexplode(F.arrays_zip(F.regexp_extract_all("c", F.lit(pattern), F.lit(1)).alias("n"), F.regexp_extract_all("c", F.lit(pattern), F.lit(2)).alias("x"))).alias("i", "o"))
    return parts.select(key, (F.col("i") + 1).cast("long").alias("op_index"), (F.instr(F.lit(LETTERS), F.col("o.x")) - 1).alias("op_code"), F.col("o.n").cast("int").alias("op_len"))


def collapse(ops: DataFrame, key: str = "align_index") -> DataFrame:
    """Runs of M, = and X become one M each; other operations stay by themselves."""
    w = Window.partitionBy(key).orderBy("op_index")
    aligned = F.col("op_code").isin(0, 7, 8)
    marked = ops.withColumn("aligned", aligned).withColumn("new", F.when(F.col("aligned") & F.coalesce(F.lag("aligned").over(w), F.lit(False)), 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(key, "run").agg(F.min(F.when(F.col("aligned"), 0).otherwise(F.col("op_code"))).alias("op_code"), F.sum("op_len").alias("op_len"))


def total(code: str | Column, codes: tuple[int, ...], n: str | Column = "op_len") -> Column:
    """Sum of the lengths of operations of the given codes; 0 where there are none."""
    code, n = (F.col(x) if isinstance(x, str) else x for x in (code, n))
    return F.coalesce(F.sum(F.when(code.isin(*codes), n)), F.lit(0)).cast("long")


def unpack(packed: DataFrame, key: str = "align_index") -> DataFrame:
    """Long form of a packed table."""
    return packed.select(key, F.explode("ops").alias("o")).select(key, "o.*")


def with_offsets(ops: DataFrame, key: str = "align_index", pos: str | None = None, index: bool = False) -> DataFrame:
    """The operations with what comes before each in the reference and the query; an operation that moves neither on raises.

    ``pos`` names the column of the record's position, which ``pos_ref`` is counted from; ``index`` numbers the operations from 0.
    """
    order = Window.partitionBy(key).orderBy("op_index")
    w = order.rowsBetween(Window.unboundedPreceding, 0)
    moves = F.col("op_code").isin(*REF_ADVANCE, *QRY_ADVANCE)
    n = F.when(moves, F.col("op_len")).otherwise(F.raise_error(F.concat(F.lit("an operation moves neither sequence on: "), F.col("op_code").cast("string"))).cast("int"))
    step = lambda codes: F.when(F.col("op_code").isin(*codes), n).otherwise(n * 0)
    off = lambda codes: (F.sum(step(codes)).over(w) - step(codes)).cast("long")
    out = ops.withColumn("ref_off", off(REF_ADVANCE)).withColumn("qry_off", off(QRY_ADVANCE))
    if pos:
        out = out.withColumn("pos_ref", F.col(pos) + F.col("ref_off"))
    return out.withColumn("op_number", (F.row_number().over(order) - 1).cast("long")) if index else out


def normalise_clipping(packed: DataFrame, ops: str = "ops") -> DataFrame:
    """Clips, insertions and deletions at either end become one hard clip of the query bases they hold; a record of nothing else raises."""
    edge = (1, 2, 4, 5)
    inner = F.filter(F.sequence(F.lit(1), F.size(ops)), lambda i: ~F.element_at(ops, i)["op_code"].isin(*edge))
    some = F.when(F.size(ops) == 0, F.array().cast("array<int>")).otherwise(inner)
    first = F.coalesce(F.array_min(some), F.raise_error(F.lit("a record has no aligned operations")).cast("int"))
    last = F.array_max(some)
    clipped = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda acc, o: acc + F.when(o["op_code"] == 2, 0).otherwise(o["op_len"]))
    left, right = clipped(F.slice(ops, 1, first - 1)), clipped(F.slice(ops, last + 1, F.size(ops) - last))
    hard = lambda n: F.when(n > 0, F.array(F.struct(F.lit(5).alias("op_code"), n.cast("int").alias("op_len")))).otherwise(F.array().cast("array<struct<op_code:int,op_len:int>>"))
    middle = F.transform(F.slice(ops, first, last - first + 1), lambda o: F.struct(o["op_code"].cast("int").alias("op_code"), o["op_len"].cast("int").alias("op_len")))
    joined = F.concat(hard(left), middle, hard(right))
    return packed.withColumn(ops, F.transform(joined, lambda o, i: F.struct((i + 1).cast("long").alias("op_index"), o["op_code"].alias("op_code"), o["op_len"].alias("op_len"))))


def compared(pieces: DataFrame, key: str = "align_index") -> DataFrame:
    """(key, op_index, op_code, i, same): each base of operations with the pieces ``ref_piece`` and ``qry_piece`` that they align."""
    letters = lambda c: F.split(F.upper(c), "")
    zipped = F.arrays_zip(letters("ref_piece").alias("r"), letters("qry_piece").alias("q"))
    return pieces.where(F.length("ref_piece") > 0).select(key, "op_index", "op_code", F.posexplode(zipped).alias("i", "b")).select(key, "op_index", "op_code", "i", F.coalesce(F.col("b.r") == F.col("b.q"), F.lit(False)).alias("same"))


def expand_matches(pieces: DataFrame, key: str = "align_index") -> DataFrame:
    """(key, op_index, run, op_code, op_len): operations of code M as runs of = and X, by comparing their pieces without case; others as they are.

    Pieces are compared where they are read, and no base is a row. A base that the query's piece hasn't differs, as do those that the reference's hasn't.
    """
    given = pieces.where("op_code = 0 and length(ref_piece) > 0 and qry_piece is not null").select(F.struct(key, "op_index").alias("at"), F.upper("ref_piece").alias("r"), F.upper("qry_piece").alias("q"))
    schema = given.select("at").schema.add("run", "long").add("op_code", "integer").add("op_len", "integer")

    def found(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
        for row, (r, q) in enumerate(zip(batch.column(1), batch.column(2))):
            r, q = (np.frombuffer((x.as_py() or "").encode("utf-32-le"), np.uint32) for x in (r, q))
            same = np.zeros(max(len(r), len(q)), bool)
            n = min(len(r), len(q))
            same[:n] = r[:n] == q[:n]
            cuts = np.concatenate([[0], np.flatnonzero(same[1:] != same[:-1]) + 1, [len(same)]])
            yield row, [np.arange(1, len(cuts)), np.where(same[cuts[:-1]], 7, 8).astype(np.int32), np.diff(cuts).astype(np.int32)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from gathered(batch, found(batch), schema.names)

    made = given.mapInArrow(work, schema).select("at.*", "run", "op_code", "op_len")
    return made.unionByName(pieces.where("op_code <> 0").select(key, "op_index", F.lit(1).cast("long").alias("run"), F.col("op_code").cast("int").alias("op_code"), F.col("op_len").cast("int").alias("op_len")))


def base_violations(pieces: DataFrame, key: str = "align_index") -> DataFrame:
    """(key, op_index, op_code, bad): operations = with bases that differ, and X with bases that are equal."""
    wrong = (F.col("op_code") == 7) & ~F.col("same") | (F.col("op_code") == 8) & F.col("same")
    return compared(pieces.where("op_code in (7, 8)"), key).where(wrong).groupBy(key, "op_index", "op_code").agg(F.count("*").alias("bad"))


def op_totals(ops: DataFrame, key: str = "align_index") -> DataFrame:
    """Bases of each record by operation, in reference and query, and clipped at its ends; clips in wrong places raise.

    From either end, hard clips come before soft ones, and both before any other operation.
    """
    clip = F.col("op_code").isin(4, 5)
    inner = Window.partitionBy(key)
    first, last = F.min(F.when(~clip, F.col("op_index"))).over(inner), F.max(F.when(~clip, F.col("op_index"))).over(inner)
    marked = ops.withColumn("first", first).withColumn("last", last)
    at = F.col("op_index")
    soft_first, soft_last = F.min(F.when(F.col("op_code") == 4, at)).over(inner), F.max(F.when(F.col("op_code") == 4, at)).over(inner)
    marked = marked.withColumn("soft_first", soft_first).withColumn("soft_last", soft_last)
    wrong = clip & (at > F.col("first")) & (at < F.col("last")) | (F.col("op_code") == 5) & (at < F.col("first")) & (at > F.col("soft_first")) & (F.col("soft_first") < F.col("first")) | (F.col("op_code") == 5) & (at > F.col("last")) & (at < F.col("soft_last"))
    n = F.when(F.coalesce(wrong, F.lit(False)), F.raise_error(F.concat(F.lit("clips in wrong places of record "), F.col(key).cast("string"))).cast("int")).otherwise(F.col("op_len"))
    marked = marked.withColumn("op_len", n)
    one = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("op_len"))), F.lit(0)).cast("long")
    by_code = [total("op_code", (code,)).alias(f"n_{name}") for code, name in enumerate(("m", "i", "d", "n", "s", "h", "p", "eq", "x"))]
    ends = [one((F.col("op_code") == code) & side).alias(f"clip_{where}_{name}") for where, side in (("left", at < F.col("first")), ("right", at > F.col("last"))) for code, name in ((5, "hard"), (4, "soft"))]
    return marked.groupBy(key).agg(*by_code, total("op_code", REF_STEPS).alias("ref_bp"), total("op_code", QRY_STEPS).alias("qry_bp"), *ends)


def features(ops: DataFrame, model: Affine = Affine(), key: str = "align_index") -> DataFrame:
    """Score, score without gaps, and the shares of them that are reached, of each record; summed as doubles, given as 32-bit floats."""
    gapless = model.mismatch_model()
    code, n = F.col("op_code"), F.col("op_len")
    sums = ops.groupBy(key).agg(F.sum(model.op(code, n)).alias("score"), F.sum(gapless.op(code, n)).alias("score_mm"), total("op_code", (7,)).alias("match_bp"), total("op_code", (7, 8)).alias("aligned_bp"), total("op_code", QRY_STEPS).alias("qry_bp"))
    share = lambda a, b: F.when(b > 0, a / b)
    made = {"score": F.col("score"), "score_mm": F.col("score_mm"), "score_prop": share(F.col("score"), F.col("qry_bp") * model.match), "score_mm_prop": share(F.col("score_mm"), F.col("aligned_bp") * model.match), "match_prop": share(F.col("match_bp"), F.col("aligned_bp"))}
    return sums.select(key, *[c.cast("float").alias(name) for name, c in made.items()])


def islands(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The frame with ``run``: numbers, from 1, of maximal runs of rows with the same value; nulls equal each other."""
    w = Window.partitionBy(key).orderBy(*order)
    first = F.row_number().over(w) == 1
    change = F.when(first | ~F.col(value).eqNullSafe(F.lag(value).over(w)), 1).otherwise(0)
    return df.withColumn("change", change).withColumn("run", F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("change")


def variant_id(chrom: Column, pos: Column, kind: Column, length: Column) -> Column:
    return F.concat_ws("-", chrom, (pos + 1).cast("string"), kind, length.cast("string"))


def versioned(df: DataFrame, name: str, badness: str, tie: list[str]) -> DataFrame:
    """Equal names told apart: the row with the fewest filters keeps its name, later ones get .1, .2 and so on."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(badness, *tie)) - 1
    return df.withColumn(name, F.when(n > 0, F.concat(name, F.lit("."), n.cast("string"))).otherwise(F.col(name)))


def with_versions(df: DataFrame, name: str, badness: str, tie: list[str], existing: DataFrame | None = None) -> DataFrame:
    """Names told apart by versions: bases are names without their version, and a base's versions go on after the highest that exists.

    ``existing`` has one column of names. Version 0 isn't written.
    """
    base = F.regexp_extract(F.col(name), r"^([^.]*)(\.([0-9]+))?$", 1)
    rows = df.withColumn("__base", F.when(base != "", base).otherwise(F.col(name)))
    first = F.lit(0)
    if existing is not None:
        old = existing.toDF("__id")
        part = lambda i: F.regexp_extract("__id", r"^([^.]*)(\.([0-9]+))?$", i)
        taken = old.select(part(1).alias("__base"), F.when(part(3) == "", 0).otherwise(part(3).try_cast("long")).alias("v")).groupBy("__base").agg((F.max("v") + 1).alias("__first"))
        rows = rows.join(taken, "__base", "left")
        first = F.coalesce("__first", F.lit(0))
    n = first + F.row_number().over(Window.partitionBy("__base").orderBy(badness, *tie)) - 1
    return rows.withColumn(name, F.when(n > 0, F.concat("__base", F.lit("."), n.cast("string"))).otherwise(F.col("__base"))).drop("__base", "__first")


def anchor_share(df: DataFrame, least: float = 0.85, query: str = "qry_id", order: str = "qry_order", share: str = "score_prop") -> Column:
    """Half for each side on which a confident record of the query lies beyond this one; 0 where there is no confident record."""
    w = Window.partitionBy(query)
    sure = F.when(F.col(share) >= least, F.col(order))
    side = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return ((side(F.col(order) > F.min(sure).over(w)) + side(F.col(order) < F.max(sure).over(w))) / 2).cast("float")


def align_stats(df: DataFrame, means: tuple[str, ...] = (), head: dict[str, object] | None = None) -> DataFrame:
    """Records by their list of filters: counts, bases in query and reference, their shares and means, and means of other columns."""
    rows = df.select("filter", (F.col("qry_end") - F.col("qry_pos")).alias("__q"), (F.col("end_pos") - F.col("pos")).alias("__r"), "mapq", *means)
    sums = rows.groupBy("filter").agg(F.count("*").alias("n"), F.sum("__q").alias("bp"), F.sum("__r").alias("bp_ref"), F.avg("mapq").alias("mapq_mean"), *[F.avg(c).alias(f"{c}_mean") for c in means])
    every = Window.partitionBy()  # over a row for each list
    share = lambda c: (F.col(c) / F.sum(c).over(every)).alias(f"{c}_prop")
    mean = lambda c: (F.col(c) / F.col("n")).alias(f"{c}_mean")
    return sums.select(*[F.lit(v).alias(k) for k, v in (head or {}).items()], "filter", "n", share("n"), "bp", share("bp"), mean("bp"), "bp_ref", share("bp_ref"), mean("bp_ref"), "mapq_mean", *[f"{c}_mean" for c in means])


#: Features by name: (type, function of the model to a column of a record's sums).
FEATURES: dict[str, tuple[str, object]] = {}
SETS = {"align": ("score", "score_prop", "match_prop", "qry_prop"), "all": None}


def feature(name: str, kind: str = "float"):
    """Register a feature: a function of (model, settings) to a column of records with the sums of ``op_totals`` and ``score``."""

    def register(function):
        FEATURES[name] = (kind, function)
        return function

    return register


share_of = lambda a, b: F.when(b > 0, a / b)
feature("score")(lambda model: F.col("__score"))
feature("score_mm")(lambda model: F.col("__score_mm"))
feature("score_prop")(lambda model: share_of(F.col("__score"), (F.col("qry_end") - F.col("qry_pos")) * model.match))
feature("score_mm_prop")(lambda model: share_of(F.col("__score_mm"), F.col("__aligned") * model.match))
feature("match_prop")(lambda model: share_of(F.col("__match"), F.col("__aligned")))
feature("qry_prop")(lambda model: share_of((F.col("qry_end") - F.col("qry_pos")).cast("double"), F.col("__qry_len")))


def with_features(df: DataFrame, ops: DataFrame, names: str | tuple[str, ...] = "align", lengths: DataFrame | None = None, model: Affine = Affine(), force: bool = False, only: bool = False, key: str = "align_index") -> DataFrame:
    """Records with features: a set's name, names apart by commas, or a tuple. What a record has already is kept unless ``force``."""
    if isinstance(names, str):
        parts = [x.strip() for x in names.split(",")]
        names = tuple(dict.fromkeys(n for x in parts for n in (FEATURES if x == "all" else SETS.get(x) or (x,))))
    if unknown := [n for n in names if n not in FEATURES]:
        raise ValueError(f"unknown features: {unknown}")
    wanted = [n for n in names if force or n not in df.columns]
    if not wanted:
        return df.select(key, *names) if only else df
    code, n = F.col("op_code"), F.col("op_len")
    sums = ops.groupBy(key).agg(F.sum(model.op(code, n)).alias("__score"), F.sum(model.mismatch_model().op(code, n)).alias("__score_mm"), total("op_code", (7,)).alias("__match"), total("op_code", (7, 8)).alias("__aligned"))
    rows = df.join(sums, key, "left")
    if "qry_prop" in wanted:
        if lengths is None:
            raise ValueError("qry_prop needs the lengths of queries")
        rows = rows.join(lengths.select("qry_id", F.col("len").alias("__qry_len")), "qry_id", "left")
    made = rows.select(*[c for c in df.columns if c not in wanted], *[FEATURES[n][1](model).cast(FEATURES[n][0]).alias(n) for n in wanted])
    return made.select(key, *names) if only else made
