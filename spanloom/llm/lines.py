"""Line dedup: two Bloom filters find suspected repeats, and only those shuffle.

One pass hashes every line of every text (64 bits) and sends 32 bits of each, once for
every batch it occurs in, to the filter segment that its top bits name. Each segment fills
a filter of hashes seen once and, where a hash falls on bits that were set, a second
filter of hashes seen twice; the second one is all that is kept. A second pass holds every
line against it: a line that isn't in it occurs once in the corpus and never moves. The
suspected lines shuffle with their whole text, so a false alarm is found out, and the
first occurrence of each is chosen exactly.

Filters grow with the lines, at ``BITS_A_LINE`` bits each, and their segments with the
session's shuffle partitions, so a segment stays of a size that a task can hold. Filters
of ``max_filter_mb`` in all at most are broadcast. Beyond that they stay where they are:
the hashes of all lines go to their segments, with the key and the place of each, and the
suspects that are found there come back to the texts by key. Both ways give the same rows.

Defined results: lines are the parts of a text between newlines, compared exactly. Of
equal lines the first by (key, place in its text) stays, a null key counting as lowest
and, under one key, the text with the lower hash as first; rows that repeat key and
text verbatim share their decisions. Lines that are empty or white space stay. A null
text stays null, an empty one empty. Any column may be null, and all columns come back:
only the text changes, and ``n_chars`` with it where there is such a column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..plans.lineage import cut
from . import textkit as tk
from .bloom import bits_for, probes, segments_of, test
from .tables import fresh, map_arrow, table

SEGMENTS = 64
#: Bits of filter for each line.
BITS_A_LINE = 16
#: Most MB of the filter that is gathered on the driver and broadcast.
MAX_FILTER_MB = 64
CHUNK = 1_000_000


@dataclass
class Lines:
    """The lines of a batch of texts, in order; null texts have none."""

    raw: np.ndarray  # bytes of all texts
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray  # lines of each text
    hash: np.ndarray
    blank: np.ndarray  # whether a line has nothing but spaces, tabs and carriage returns

    def text(self, i: int) -> str:
        return self.raw[self.start[i] : self.end[i]].tobytes().decode("utf-8")


def lines_of(col: pa.Array) -> Lines:
    null = col.is_null().to_numpy(zero_copy_only=False)
    col = pc.fill_null(col.cast(pa.large_string()), "")
    bounds = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(col.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if len(col) and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    breaks = np.flatnonzero(raw == 10)
    start = np.sort(np.concatenate([bounds[:-1][~null], breaks + 1]))
    end = np.sort(np.concatenate([bounds[1:][~null], breaks]))
    counts = np.where(null, 0, 1 + np.diff(np.searchsorted(breaks, bounds)))
    ink = np.concatenate([[0], np.cumsum((raw != 32) & (raw != 9) & (raw != 13))])
    return Lines(raw, start, end, counts, tk.span_hash(tk.rolling(raw), start, end), ink[end] == ink[start])


def _chunked(col: pa.Array) -> Iterator[Lines]:
    for part in tk.chunks(pa.RecordBatch.from_arrays([col], ["text"]), "text", CHUNK):
        yield lines_of(part.column("text"))


class TwoFilters:
    """Filters of one segment: hashes seen once, and hashes seen twice or more."""

    def __init__(self, bits: int):
        self.bits, self.once, self.twice = bits, np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)

    def add(self, low: np.ndarray) -> None:
        """Distinct hashes; those that are in the first filter, or share its bits, go to the second."""
        a, b = probes(low.astype(np.uint64), self.bits)
        seen = self.once[a] & self.once[b]
        self.twice[a[seen]] = self.twice[b[seen]] = True
        self.once[a] = self.once[b] = True

    def add_twice(self, low: np.ndarray) -> None:
        a, b = probes(low.astype(np.uint64), self.bits)
        self.once[a] = self.once[b] = self.twice[a] = self.twice[b] = True


def _low(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _suspected(h: np.ndarray, bits: int, packed: bytes) -> np.ndarray:
    filled = np.frombuffer(packed, np.uint8)
    a, b = probes(_low(h).astype(np.uint64), bits)
    return test(filled, a) & test(filled, b)


def twice_filters(docs: DataFrame, text_col: str, bits_a_line: int, segments: int) -> DataFrame:
    """(segment, bits, filter) of the hashes that were seen twice or more."""
    sent = T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("again", T.BooleanType()), T.StructField("low", T.BinaryType())])
    made = T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("bits", T.IntegerType()), T.StructField("filter", T.BinaryType())])

    def send(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h = np.concatenate([np.zeros(0, np.uint64), *(x.hash[~x.blank] for x in _chunked(batch.column(0)))])
        values, counts = np.unique(h, return_counts=True)
        rows = []
        for again in (False, True):
            own = values[(counts > 1) == again]
            order, cuts = segments_of(own, segments)
            lows = _low(own[order])
            rows += [(s, again, lows[cuts[s] : cuts[s + 1]].tobytes()) for s in np.flatnonzero(np.diff(cuts)).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows) if rows else ((), (), ()), (pa.int32(), pa.bool_(), pa.binary()))], sent.names)

    def merge(group: pa.Table) -> pa.Table:
        lows = [np.frombuffer(x, np.uint32) for x in group.column("low").to_pylist()]
        both = TwoFilters(bits_for(sum(map(len, lows)), bits_a_line))
        for low, twice in zip(lows, group.column("again").to_pylist()):
            (both.add_twice if twice else both.add)(low)
        return pa.table([[group.column("segment")[0].as_py()], [both.bits], [np.packbits(both.twice).tobytes()]], schema=pa.schema([("segment", pa.int32()), ("bits", pa.int32()), ("filter", pa.binary())]))

    return map_arrow(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null"), send, sent).groupBy("segment").applyInArrow(merge, made)


def _places(lines: Lines, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in it, index among all lines) of the lines that are hit."""
    owner, place = tk.segments(lines.counts)
    return owner[hit], place[hit].astype(np.int32), np.flatnonzero(hit)


class Marks:
    """Finds suspects by filters that every worker has."""

    def __init__(self, spark: SparkSession, filters: DataFrame, segments: int):
        self.segments = segments
        self.shared = spark.sparkContext.broadcast({r.segment: (r.bits, bytes(r.filter)) for r in filters.collect()})

    def hits(self, lines: Lines) -> np.ndarray:
        order, cuts = segments_of(lines.hash, self.segments)
        hit = np.zeros(len(lines.hash), bool)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if s in self.shared.value:
                at = order[cuts[s] : cuts[s + 1]]
                hit[at] = _suspected(lines.hash[at], *self.shared.value[s])
        return hit & ~lines.blank

    def places(self) -> Column:
        """Function of a text column: the places of its suspected lines; null for a null text."""

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def find(col: pa.Array) -> pa.Array:
            counts, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for lines in _chunked(col):
                owner, place, _ = _places(lines, self.hits(lines))
                counts.append(np.bincount(owner, minlength=len(lines.counts)))
                places.append(place)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(places)))

        return find.asNondeterministic()  # so that it is evaluated once, not in the filter and again in the projection

    def lines(self, named: DataFrame) -> DataFrame:
        """(key, th, i, line) of the suspected lines of (key, th, text)."""
        schema = T.StructType([*named.select("key", "th").schema.fields, T.StructField("i", T.IntegerType()), T.StructField("line", T.StringType())])

        def take(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in tk.chunks(batch, "text", CHUNK):
                lines = lines_of(part.column("text"))
                owner, place, index = _places(lines, self.hits(lines))
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(owner)) for c in ("key", "th")), pa.array(place), pa.array([lines.text(i) for i in index.tolist()], pa.string())], schema.names)

        return map_arrow(named, take, schema)


def distributed_places(named: DataFrame, filters: DataFrame, segments: int) -> DataFrame:
    """(key, th, places) of (key, th, text): the suspected lines, found where the filters are."""
    fields = named.select("key", "th").schema.fields
    place = T.StructField("i", T.IntegerType())
    schema = T.StructType([T.StructField("segment", T.IntegerType()), *fields, place, T.StructField("h", T.LongType())])

    def spread(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in tk.chunks(batch, "text", CHUNK):
            lines = lines_of(part.column("text"))
            owner, at, index = _places(lines, ~lines.blank)
            h = lines.hash[index]
            segment = (h >> np.uint64(65 - segments.bit_length())).astype(np.int32) if segments > 1 else np.zeros(len(h), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(segment), *(part.column(c).take(pa.array(owner)) for c in ("key", "th")), pa.array(at), pa.array(h.view(np.int64))], schema.names)

    def probe(lines: pa.Table, own: pa.Table) -> pa.Table:
        h = lines.column("h").to_numpy().view(np.uint64)
        hit = _suspected(h, own.column("bits")[0].as_py(), own.column("filter")[0].as_py()) if len(h) and own.num_rows else np.zeros(len(h), bool)
        return lines.select(["key", "th", "i"]).filter(pa.array(hit))

    found = map_arrow(named, spread, schema).groupBy("segment").cogroup(filters.groupBy("segment")).applyInArrow(probe, T.StructType([*fields, place]))
    return found.groupBy("key", "th").agg(F.array_sort(F.collect_set("i")).alias("places"))


@F.arrow_udf(T.StringType())
def rebuild(text: pa.Array, suspected: pa.Array, kept: pa.Array) -> pa.Array:
    """The texts without their suspected lines that aren't kept; null where no line is left."""
    out = []
    for t, s, k in zip(text.to_pylist(), suspected.to_pylist(), kept.to_pylist()):
        drop = set(s).difference(k or ())
        lines = [x for i, x in enumerate(t.split("\n")) if i not in drop] if drop else [t]
        out.append("\n".join(lines) if lines else None)
    return pa.array(out, pa.string())


def segments_for(spark: SparkSession) -> int:
    return max(SEGMENTS, 1 << (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_a_line: int = BITS_A_LINE, max_filter_mb: float = MAX_FILTER_MB, emptied: str = "keep") -> DataFrame:
    """The rows with every line that occurred before taken out.

    ``emptied``: "keep" leaves a row of which no line is left with the text '', "drop" takes it out.
    """
    spark, segments = docs.sparkSession, segments_for(docs.sparkSession)
    sus, key, th, keep, new = fresh(docs, "suspected", "key", "text_hash", "kept", "rebuilt")
    text = F.col(f"`{text_col}`")
    filters = cut(twice_filters(docs, text_col, bits_a_line, segments))
    named = docs.select(F.col(f"`{id_col}`").alias("key"), F.xxhash64(text).alias("th"), text.cast("string").alias("text")).where("text is not null")
    if (filters.agg(F.sum(F.octet_length("filter"))).first()[0] or 0) <= max_filter_mb * 1e6:
        marks = Marks(spark, filters, segments)
        marked = docs.withColumn(sus, marks.places()(text.cast("string")))
        suspected = marks.lines(named)
    else:
        places = cut(distributed_places(named, filters, segments))
        marked = docs.withColumn(th, F.xxhash64(text)).alias("d").join(places.alias("p"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("p.key")) & (F.col(f"d.{th}") == F.col("p.th")) & F.col(f"d.`{text_col}`").isNotNull(), "left")
        marked = marked.select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns], F.col("p.places").alias(sus))
        suspected = marked.where(F.col(sus).isNotNull()).select(F.col(f"`{id_col}`").alias("key"), F.xxhash64(text).alias("th"), F.explode(F.transform(sus, lambda i: F.struct(i.alias("i"), F.get(F.split(text, "\n"), i).alias("line")))).alias("x")).select("key", "th", "x.i", "x.line")
    none = F.coalesce(F.size(sus), F.lit(0)) == 0
    exact = suspected.groupBy("line").agg(F.min(F.struct("key", "i", "th")).alias("first")).groupBy(F.col("first.key").alias(key), F.col("first.th").alias(th)).agg(F.collect_list("first.i").alias(keep))
    touched = marked.where(~none).withColumn(th, F.xxhash64(text)).alias("d").join(exact.alias("k"), F.col(f"d.`{id_col}`").eqNullSafe(F.col(f"k.{key}")) & (F.col(f"d.{th}") == F.col(f"k.{th}")), "left")
    touched = touched.select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns], rebuild.asNondeterministic()(F.col(f"d.`{text_col}`"), F.col(f"d.{sus}"), F.col(f"k.{keep}")).alias(new))
    if emptied == "drop":
        touched = touched.where(F.col(new).isNotNull())
    changes = {text_col: F.coalesce(F.col(new), F.lit(""))}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.length(changes[text_col]).cast(docs.schema["n_chars"].dataType)
    return marked.where(none).drop(sus).unionByName(touched.withColumns(changes).drop(new))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = """
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents
), r as (
  select *, trim(translate(line, chr(9) || chr(13), '  ')) = '' as blank, row_number() over (partition by line order by doc_id nulls first, i) as n from l
)
select d.doc_id, case when d.text is null then null else coalesce(t.text, '') end as text
from documents d left join (
  select doc_id, string_agg(line, chr(10) order by i) as text from r where n = 1 or blank group by doc_id
) t on d.doc_id is not distinct from t.doc_id
"""
