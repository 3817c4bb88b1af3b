"""Region algebra as column functions: intervals with names, 0-based and half-open in tables, 1-based in text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def region_text(chrom: Column, pos: Column, end: Column) -> Column:
    """chrom:first-last, both 1-based."""
    return F.concat(chrom, F.lit(":"), (pos + 1).cast("string"), F.lit("-"), end.cast("string"))


def region_id(chrom: Column, pos: Column, end: Column, kind: Column) -> Column:
    """chrom-first-kind-length."""
    return F.concat(chrom, F.lit("-"), (pos + 1).cast("string"), F.lit("-"), kind, F.lit("-"), (end - pos).cast("string"))


def parse_text(text: Column) -> Column:
    """struct(chrom, pos, end_pos) of chrom:first-last, with or without thousands separators; null where it is neither."""
    pattern = r"^(.+):([0-9,]+)-([0-9,]+)$"
    number = lambda i: F.regexp_replace(F.regexp_extract(text, pattern, i), ",", "").try_cast("long")
    return F.when(text.rlike(pattern), F.struct(F.regexp_extract(text, pattern, 1).alias("chrom"), (number(2) - 1).alias("pos"), number(3).alias("end_pos")))


def parse_id(text: Column) -> Column:
    """struct(chrom, pos, end_pos) of chrom-first-kind-length, a version at its end left out; null where it isn't one."""
    pattern = r"^(.+)-([0-9]+)-([A-Za-z]+)-([0-9]+)(\.[0-9]+)?$"
    number = lambda i: F.regexp_extract(text, pattern, i).try_cast("long")
    return F.when(text.rlike(pattern), F.struct(F.regexp_extract(text, pattern, 1).alias("chrom"), (number(2) - 1).alias("pos"), (number(2) - 1 + number(4)).alias("end_pos")))


def expand(pos: Column, end: Column, bp: Column | int, least: Column | int = 0, most: Column | None = None, shift: bool = True, balance: float = 0.5) -> Column:
    """struct(pos, end_pos) of a region grown by ``bp``, ``balance`` of them at its start.

    What would pass ``least`` or ``most`` is cut off, or, with ``shift``, added at the other end as far as there is room.
    """
    bp, least = (x if isinstance(x, Column) else F.lit(x) for x in (bp, least))
    before = F.floor(bp * balance)
    a, b = pos - before, end + (bp - before)
    short = F.greatest(least - a, F.lit(0))
    over = F.greatest(b - most, F.lit(0)) if most is not None else F.lit(0)
    a2, b2 = F.greatest(a, least), F.least(b, most) if most is not None else b
    if shift:
        a2, b2 = F.greatest(a2 - over, least), b2 + short
        b2 = F.least(b2, most) if most is not None else b2
    return F.struct(a2.cast("long").alias("pos"), b2.cast("long").alias("end_pos"))


def contains(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Whether the first region has all of the second."""
    return (a0 <= b0) & (a1 >= b1)
