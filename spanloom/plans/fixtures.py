"""Inputs for the interval and sequence operators, derived from the star-schema and document tables.

``FIXTURES`` holds one SQL text for each; the few places where the dialects differ are
written in braces and filled for Spark or DuckDB. Fixtures may use earlier ones.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

FIXTURES = {
    "fx_interval": """
select concat('chr', cast(l_suppkey % 24 + 1 as <string>)) as chrom,
       cast((l_partkey*977 + l_orderkey*13) % 2000000 as bigint) as pos,
       cast((l_partkey*977 + l_orderkey*13) % 2000000 + l_quantity*10 as bigint) as end_pos,
       l_orderkey as order_id, l_linenumber as line_no, l_partkey as part_id, l_suppkey as supp_id,
       concat_ws('-', cast(l_orderkey as <string>), cast(l_linenumber as <string>), cast(l_partkey as <string>), cast(l_suppkey as <string>)) as iv_id,
       l_linestatus as hap, l_returnflag as flag
from lineitem""",
    "fx_op": """
select l_orderkey as align_index,
       cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as bigint) as op_index,
       cast(case when l_returnflag = 'N' then 7 when l_returnflag = 'A' then 8 when l_linestatus = 'F' then 1 else 2 end as int) as op_code,
       cast(l_quantity as int) as op_len
from lineitem""",
    "fx_op_coord": """
select o.*, cast(sum(case when op_code in (2,7,8) then op_len else 0 end) over (partition by align_index order by op_index rows between unbounded preceding and current row)
                 - case when op_code in (2,7,8) then op_len else 0 end as bigint) as ref_off,
       cast(sum(case when op_code in (1,7,8) then op_len else 0 end) over (partition by align_index order by op_index rows between unbounded preceding and current row)
                 - case when op_code in (1,7,8) then op_len else 0 end as bigint) as qry_off
from fx_op o""",
    "fx_align": """
select g.align_index, concat('chr', cast(o.o_custkey % 24 + 1 as <string>)) as chrom,
       cast((g.align_index*7919) % 2000000 as bigint) as pos,
       cast((g.align_index*7919) % 2000000 + g.ref_bp as bigint) as end_pos,
       concat('q', cast(o.o_custkey as <string>)) as qry_id,
       cast(sum(g.qry_bp) over (partition by o.o_custkey order by g.align_index rows between unbounded preceding and current row) - g.qry_bp as bigint) as qry_pos,
       cast(sum(g.qry_bp) over (partition by o.o_custkey order by g.align_index rows between unbounded preceding and current row) as bigint) as qry_end,
       o.o_orderstatus = 'F' as is_rev, cast(substring(o.o_orderpriority,1,1) as int) * 10 as mapq
from (select align_index, cast(sum(case when op_code in (2,7,8) then op_len else 0 end) as bigint) as ref_bp,
             cast(sum(case when op_code in (1,7,8) then op_len else 0 end) as bigint) as qry_bp
      from fx_op group by align_index) g
join orders o on o.o_orderkey = g.align_index where g.ref_bp > 0 and g.qry_bp > 0""",
    "fx_shift": """
select align_index, chrom, pos, end_pos, qry_id, is_rev, mapq,
       greatest(qry_pos - 10 * (rn - 1), 0) as qry_pos, greatest(qry_end - 10 * (rn - 1), 1) as qry_end
from (select *, row_number() over (partition by qry_id order by qry_pos, align_index) as rn from fx_align) s""",
    "fx_qlen": "select qry_id, cast(max(qry_end) as bigint) as len from fx_align group by qry_id",
    "fx_seq": """
select doc_id, concat('d', cast(doc_id as <string>)) as name,
       translate(regexp_replace(lower(text), '[^a-z]', ''<g>), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as bases
from documents""",
    "fx_variant": """
select a.chrom, cast(a.pos + c.ref_off as bigint) as pos,
       cast(case when c.op_code = 1 then a.pos + c.ref_off + 1 else a.pos + c.ref_off + c.op_len end as bigint) as end_pos,
       case when c.op_code = 1 then 'INS' when c.op_code = 2 then 'DEL' else 'SUB' end as vartype,
       c.op_len as varlen, a.qry_id, a.align_index, c.op_index,
       concat(cast(a.align_index as <string>), '-', cast(c.op_index as <string>)) as vid,
       case when a.mapq < 20 then 'MAPQ' else '' end as filter_str, case when a.align_index % 2 = 0 then 'h1' else 'h2' end as hap
from fx_op_coord c join fx_align a on a.align_index = c.align_index where c.op_code in (1,2,8)""",
    "fx_clip": """
select align_index, op_index, cast(case when op_index = 1 and op_len % 2 = 0 then 5 when op_index = last and op_index > 1 and op_len % 3 = 0 then 4 else op_code end as int) as op_code, op_len
from (select *, max(op_index) over (partition by align_index) as last from fx_op) c""",
    "fx_rec": """
select a.*, s.score, case when s.aligned_bp > 0 then s.match_bp / cast(s.aligned_bp as double) end as match_prop, s.score / cast(2 * (a.qry_end - a.qry_pos) as double) as score_prop,
       cast(row_number() over (partition by a.qry_id order by a.qry_pos, a.qry_end, a.align_index) - 1 as bigint) as qry_order,
       case when a.mapq < 20 and a.align_index % 3 = 0 then 'ALIGN,MAPQ' when a.mapq < 20 then 'MAPQ' when a.align_index % 3 = 0 then 'ALIGN' else '' end as filters
from fx_align a join (
  select align_index, cast(sum(case when op_code = 7 then 2 * op_len when op_code = 8 then -4 * op_len else greatest(-(4 + 2 * op_len), -(24 + op_len)) end) as double) as score,
         cast(sum(case when op_code = 7 then op_len else 0 end) as bigint) as match_bp, cast(sum(case when op_code in (7, 8) then op_len else 0 end) as bigint) as aligned_bp
  from fx_op group by align_index) s on s.align_index = a.align_index""",
    "fx_dop": """
select s.name, s.doc_id, s.doc_id % 2 = 1 as is_rev, cast(4 * b.b + o.k as bigint) as op_index, cast(o.op_code as int) as op_code, cast(o.op_len as int) as op_len,
       cast(18 * b.b + o.ref_at as bigint) as ref_off, cast(17 * b.b + o.qry_at as bigint) as qry_off, cast(17 * floor(length(s.bases) / 20) as bigint) as qry_len
from fx_seq s, lateral (select <unnest>(<upto>(cast(floor(length(s.bases) / 20) as bigint))) as b) b
cross join (select 1 as k, 7 as op_code, 12 as op_len, 0 as ref_at, 0 as qry_at union all select 2, 8, 3, 12, 12 union all select 3, 1, 2, 15, 15 union all select 4, 2, 3, 15, 17) o
where length(s.bases) >= 20""",
}

_DIALECTS = {"spark": {"<unnest>": "explode", "<string>": "string", "<g>": ""}, "duckdb": {"<unnest>": "unnest", "<upto>": "range", "<string>": "varchar", "<g>": ", 'g'"}}


def _text(name: str, dialect: str) -> str:
    text = FIXTURES[name]
    if dialect == "spark":
        text = re.sub(r"<upto>\((cast\(.*? as bigint\))\)", r"sequence(0, \1 - 1)", text)
    for mark, word in _DIALECTS[dialect].items():
        text = text.replace(mark, word)
    return text


def _needs(name: str) -> list[str]:
    """The fixture and those it uses, in the order of definition."""
    found = {name}
    for other in reversed(FIXTURES):
        if any(re.search(rf"\b{other}\b", FIXTURES[x]) for x in found):
            found.add(other)
    return [x for x in FIXTURES if x in found]


def oracle(query: str) -> str:
    """DuckDB SQL: the query with all fixtures that it names as common table expressions before it."""
    used = [x for x in FIXTURES if re.search(rf"\b{x}\b", query)]
    needed = [x for x in FIXTURES if any(x in _needs(u) for u in used)]
    heads = ", ".join(f"{x} as ({_text(x, 'duckdb')})" for x in needed)
    query = query.strip()
    if not heads:
        return query
    if query.lower().startswith("with recursive"):
        return f"with recursive {heads}, {query[len('with recursive'):]}"
    return f"with {heads}, {query[4:]}" if query.lower().startswith("with ") else f"with {heads} {query}"


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    frames: dict[str, DataFrame] = {}
    for x in _needs(name):
        text = _text(x, "spark")
        for other in [*TABLES, *FIXTURES]:
            if other != x and re.search(rf"\b{other}\b(?!\.)", text) and re.search(rf"(from|join) {other}\b", text):
                text = re.sub(rf"(from|join) {other}\b", rf"\1 {{{other}}}", text)
                if other not in frames:
                    frames[other] = table(spark, sf_dir, other)
        used = {k: v for k, v in frames.items() if f"{{{k}}}" in text}
        frames[x] = spark.sql(text, **used)
    return frames[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
