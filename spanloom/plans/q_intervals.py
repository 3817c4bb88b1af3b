"""Queries of the interval operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import intervals as iv
from .fixtures import fixture, oracle
from .registry import operator

DEPTH_SQL = """
with ev as (select chrom, pos as c, 1 as d from fx_interval where end_pos > pos union all select chrom, end_pos, -1 from fx_interval where end_pos > pos),
st as (select chrom, c, sum(d) as d from ev group by chrom, c),
sw as (select chrom, c as pos, lead(c) over (partition by chrom order by c) as end_pos, cast(sum(d) over (partition by chrom order by c rows between unbounded preceding and current row) as bigint) as depth from st)
"""


@operator("d01_depth_histogram", oracle(DEPTH_SQL + "select depth, count(*) as n, cast(sum(end_pos - pos) as bigint) as bp from sw where depth > 0 and end_pos is not null group by depth"))
def depth_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.depth(fixture(spark, sf_dir, "fx_interval")).groupBy("depth").agg(F.count("*").alias("n"), F.sum(F.col("end_pos") - F.col("pos")).alias("bp"))
