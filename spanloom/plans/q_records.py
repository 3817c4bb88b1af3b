"""Queries of record-level operators: clips, totals, checks, statistics, joins, windows, unions and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import regions as rg, sequences as sq
from ..operators import aligned as al, frames as fr, intervals as iv
from .fixtures import fixture, oracle
from .registry import operator

LETTER = "substring('MIDNSHP=X', op_code + 1, 1)"


def tags():
    """The filters of ``fx_rec`` as a list."""
    return F.filter(F.split("filters", ","), lambda x: x != "")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_rec").withColumn("filter", tags())


@operator("c03_pack_unpack", oracle("select align_index, op_index, op_code, op_len from fx_op"))
def pack_unpack(spark, sf_dir):
    return al.unpack(al.pack(fixture(spark, sf_dir, "fx_op")))


@operator("c04_normalise_clipping", oracle("""
with m as (select *, min(case when op_code not in (1,2,4,5) then op_index end) over (partition by align_index) as a, max(case when op_code not in (1,2,4,5) then op_index end) over (partition by align_index) as b from fx_clip),
x as (select align_index, op_index, op_code, op_len from m where op_index between a and b
 union all select align_index, 0, 5, cast(sum(case when op_code = 2 then 0 else op_len end) as int) from m where op_index < a group by align_index having sum(case when op_code = 2 then 0 else op_len end) > 0
 union all select align_index, 1000, 5, cast(sum(case when op_code = 2 then 0 else op_len end) as int) from m where op_index > b group by align_index having sum(case when op_code = 2 then 0 else op_len end) > 0)
select align_index, row_number() over (partition by align_index order by op_index) as op_index, op_code, op_len from x"""))
def normalise_clipping(spark, sf_dir):
    ops = fixture(spark, sf_dir, "fx_clip")
    some = ops.where("op_code not in (1, 2, 4, 5)").select("align_index").distinct()
    return al.unpack(al.normalise_clipping(al.pack(ops.join(some, "align_index", "left_semi"))))


@operator("c06_expand_matches", oracle("""
with p as (select name, upper(bases) as r, upper(reverse(bases)) as q from fx_seq), b as (select name, unnest(range(1, length(r) + 1)) as i, r, q from p where length(r) > 0),
s as (select name, i, substring(r, i, 1) = substring(q, i, 1) as same from b), n as (select *, case when same is not distinct from lag(same) over (partition by name order by i) then 0 else 1 end as new from s),
u as (select *, sum(new) over (partition by name order by i rows between unbounded preceding and current row) as run from n)
select name, 1 as op_index, cast(run as bigint) as run, case when bool_and(same) then 7 else 8 end as op_code, cast(count(*) as int) as op_len from u group by name, run"""))
def expand_matches(spark, sf_dir):
    seqs = fixture(spark, sf_dir, "fx_seq")
    pieces = seqs.select("name", F.lit(1).alias("op_index"), F.lit(0).alias("op_code"), F.length("bases").alias("op_len"), F.col("bases").alias("ref_piece"), F.reverse("bases").alias("qry_piece"))
    return al.expand_matches(pieces, "name")


@operator("c09_base_violations", oracle("""
with b as (select name, case when doc_id % 2 = 0 then 7 else 8 end as op_code, bases, unnest(range(1, length(bases) + 1)) as i from fx_seq where length(bases) > 0),
s as (select name, op_code, substring(bases, i, 1) = substring(reverse(bases), i, 1) as same from b)
select name, 1 as op_index, op_code, count(*) as bad from s where same = (op_code = 8) group by name, op_code"""))
def base_violations(spark, sf_dir):
    seqs = fixture(spark, sf_dir, "fx_seq")
    pieces = seqs.select("name", F.lit(1).alias("op_index"), F.when(F.col("doc_id") % 2 == 0, 7).otherwise(8).alias("op_code"), F.col("bases").alias("ref_piece"), F.reverse("bases").alias("qry_piece"))
    return al.base_violations(pieces, "name")


@operator("c10_table_violations", oracle("""
with t as (select order_id, line_no, case when flag = 'N' then null else flag end as flag from fx_interval)
select 'repeated key' as what, cast(order_id as varchar) as name, count(*) as n from t group by order_id having count(*) > 1 union all select 'null', 'flag', count(*) from t where flag is null having count(*) > 0"""))
def table_violations(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_interval").select("order_id", "line_no", F.when(F.col("flag") != "N", F.col("flag")).alias("flag"))
    return fr.violations(rows, "order_id")


@operator("a04_null_counts", oracle("""
with t as (select nullif(mapq, 10) as mapq, nullif(is_rev, true) as is_rev, chrom from fx_align)
select 'mapq' as "column", count(*) as n from t where mapq is null having count(*) > 0 union all select 'is_rev', count(*) from t where is_rev is null having count(*) > 0"""))
def null_counts(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_align").select(F.expr("nullif(mapq, 10)").alias("mapq"), F.expr("nullif(is_rev, true)").alias("is_rev"), "chrom")
    return fr.null_counts(rows)


@operator("a16_op_totals", oracle(f"""
with m as (select *, min(case when op_code not in (4,5) then op_index end) over (partition by align_index) as a, max(case when op_code not in (4,5) then op_index end) over (partition by align_index) as b from fx_clip)
select align_index, {', '.join(f"cast(sum(case when op_code = {i} then op_len else 0 end) as bigint) as n_{n}" for i, n in enumerate(('m', 'i', 'd', 'n', 's', 'h', 'p', 'eq', 'x')))},
 cast(sum(case when op_code in (0,2,3,7,8) then op_len else 0 end) as bigint) as ref_bp, cast(sum(case when op_code in (0,1,4,7,8) then op_len else 0 end) as bigint) as qry_bp,
 {', '.join(f"cast(coalesce(sum(case when op_code = {c} and op_index {o} then op_len else 0 end), 0) as bigint) as clip_{w}_{n}" for w, o in (('left', '< a'), ('right', '> b')) for c, n in ((5, 'hard'), (4, 'soft')))}
from m group by align_index"""))
def op_totals(spark, sf_dir):
    return al.op_totals(fixture(spark, sf_dir, "fx_clip"))


@operator("a01_align_stats_by_filter", oracle("""
select filters, count(*) as n, count(*)::double / sum(count(*)) over () as n_prop, cast(sum(qry_end - qry_pos) as bigint) as bp, sum(qry_end - qry_pos)::double / sum(sum(qry_end - qry_pos)) over () as bp_prop, sum(qry_end - qry_pos)::double / count(*) as bp_mean,
 cast(sum(end_pos - pos) as bigint) as bp_ref, sum(end_pos - pos)::double / sum(sum(end_pos - pos)) over () as bp_ref_prop, sum(end_pos - pos)::double / count(*) as bp_ref_mean, avg(mapq) as mapq_mean, round(avg(score), 6) as score_mean, round(avg(match_prop), 9) as match_prop_mean, 'none' as trim
from fx_rec group by filters"""))
def align_stats(spark, sf_dir):
    stats = al.align_stats(records(spark, sf_dir), ("score", "match_prop"), {"trim": "none"})
    return stats.select(F.array_join("filter", ",").alias("filters"), *[c for c in stats.columns if c not in ("filter", "score_mean", "match_prop_mean")], F.round("score_mean", 6).alias("score_mean"), F.round("match_prop_mean", 9).alias("match_prop_mean"))


@operator("f11_anchor_share", oracle("""
with m as (select *, min(case when match_prop >= 0.6 then qry_order end) over (partition by qry_id) as a, max(case when match_prop >= 0.6 then qry_order end) over (partition by qry_id) as b from fx_rec)
select align_index, cast((coalesce(cast(qry_order > a as int), 0) + coalesce(cast(qry_order < b as int), 0)) / 2.0 as double) as anchor_prop from m"""))
def anchor_share(spark, sf_dir):
    return records(spark, sf_dir).select("align_index", al.anchor_share(None, 0.6, share="match_prop").cast("double").alias("anchor_prop"))


@operator("f13_feature_sets", oracle("""
select r.align_index, cast(cast(r.score as float) as double) as score, cast(cast(r.score / (2.0 * (r.qry_end - r.qry_pos))::double as float) as double) as score_prop, cast(cast(r.match_prop as float) as double) as match_prop,
 cast(cast((r.qry_end - r.qry_pos)::double / l.len as float) as double) as qry_prop from fx_rec r join fx_qlen l using (qry_id)"""))
def feature_sets(spark, sf_dir):
    rows = al.with_features(fixture(spark, sf_dir, "fx_align"), fixture(spark, sf_dir, "fx_op"), "align", fixture(spark, sf_dir, "fx_qlen"), only=True)
    return rows.select("align_index", *[F.col(c).cast("double").alias(c) for c in al.SETS["align"]])


@operator("f03_template_switches", oracle("select align_index, cast(-74.0 * count(*) as double) as switches, cast(2.0 * sum(case when op_code in (1,2) then greatest(-(4.0 + 2.0 * op_len), -(24.0 + op_len)) else 0 end) as double) as off_variant from fx_op group by align_index"))
def template_switches(spark, sf_dir):
    model = al.Affine()
    gaps = F.sum(F.when(F.col("op_code").isin(1, 2), model.gap(F.col("op_len"))).otherwise(0.0))
    return fixture(spark, sf_dir, "fx_op").groupBy("align_index").agg((F.lit(model.template_switch()) * F.count("*")).alias("switches"), (gaps * model.off_variant).alias("off_variant"))


@operator("p01_conform", oracle("select cast(pos as int) as pos, cast(mapq as double) as mapq, align_index, chrom from fx_align"))
def conform(spark, sf_dir):
    return fr.conform(fixture(spark, sf_dir, "fx_align").select("align_index", "mapq", "chrom", "pos"), {"pos": "int", "missing": "string", "mapq": "double"})


@operator("p02_call_source", oracle("select align_index, coalesce(case when is_rev then 'given' end, 'INTRA') as call_source from fx_align"))
def call_source(spark, sf_dir):
    return fr.with_source(fixture(spark, sf_dir, "fx_align").select("align_index", F.when(F.col("is_rev"), "given").alias("call_source")), "intra")


@operator("p03_passing", oracle("select filters = '' as passing, count(*) as n from fx_rec group by 1"))
def passing(spark, sf_dir):
    return records(spark, sf_dir).groupBy(fr.passing().alias("passing")).agg(F.count("*").alias("n"))


@operator("p04_tag", oracle("select align_index, case when score >= 0 then filters when filters = '' then 'LCALIGN' else filters || ',LCALIGN' end as tagged, case when mapq < 20 then filters when filters = '' then 'MAPQ' else filters || ',MAPQ' end as once from fx_rec"))
def tagged(spark, sf_dir):
    rows = records(spark, sf_dir)
    return rows.select("align_index", F.array_join(fr.tag(F.col("score") < 0, "LCALIGN"), ",").alias("tagged"), F.array_join(fr.tag(F.lit(True), "MAPQ", once=True), ",").alias("once"))


@operator("p05_length_filters", oracle("select case when varlen >= 50 then 'sv' else 'indel' end as kind, count(*) as n from fx_variant where vartype in ('INS', 'DEL') and varlen >= 1 group by 1"))
def length_filters(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_variant").where("vartype in ('INS', 'DEL') and varlen >= 1")
    return rows.groupBy(F.when(F.col("varlen") >= 50, "sv").otherwise("indel").alias("kind")).agg(F.count("*").alias("n"))


@operator("p06_proper_intervals", oracle("select align_index from fx_align where end_pos > pos and qry_end - qry_pos >= 30"))
def proper_intervals(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_align").where("end_pos > pos and qry_end - qry_pos >= 30").select("align_index")


@operator("p07_membership", oracle("select vartype, count(*) as n from fx_variant where vartype in ('INS', 'DEL') group by vartype"))
def membership(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_variant").where(F.col("vartype").isin("INS", "DEL")).groupBy("vartype").agg(F.count("*").alias("n"))


@operator("p08_list_inequality", oracle("select align_index from fx_rec where filters <> 'MAPQ'"))
def list_inequality(spark, sf_dir):
    return records(spark, sf_dir).where(F.col("filter") != F.array(F.lit("MAPQ"))).select("align_index")


@operator("p09_required_columns", oracle("select chrom, align_index from fx_align"))
def required_columns(spark, sf_dir):
    return fr.require(fixture(spark, sf_dir, "fx_align"), ["chrom", "align_index"])


@operator("j02_reference_overlaps", oracle("""
select a.align_index as a, b.align_index as b, least(a.score, b.score) as score_min, greatest(a.score, b.score) as score_max from fx_rec a join fx_rec b on a.chrom = b.chrom and a.align_index <> b.align_index and a.pos < b.end_pos and b.pos < a.end_pos"""))
def reference_overlaps(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_rec").select("chrom", "pos", "end_pos", "align_index", "score")
    pairs = iv.range_join(rows, rows, "chrom").where("l_align_index <> r_align_index")
    return pairs.select(F.col("l_align_index").alias("a"), F.col("r_align_index").alias("b"), F.least("l_score", "r_score").alias("score_min"), F.greatest("l_score", "r_score").alias("score_max"))


@operator("j01_scored_overlaps", oracle("""
with s as (select f.align_index, f.qry_id, f.qry_pos, f.qry_end, r.score from fx_shift f join fx_rec r on r.align_index = f.align_index)
select a.align_index as a, b.align_index as b, least(a.score, b.score) as score_min, greatest(a.score, b.score) as score_max from s a join s b on a.qry_id = b.qry_id and a.align_index <> b.align_index and a.qry_pos < b.qry_end and b.qry_pos < a.qry_end"""))
def scored_overlaps(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_shift").select("qry_id", "qry_pos", "qry_end", "align_index").join(fixture(spark, sf_dir, "fx_rec").select("align_index", "score"), "align_index")
    pairs = iv.range_join(rows, rows, "qry_id", ("qry_pos", "qry_end"), ("qry_pos", "qry_end")).where("l_align_index <> r_align_index")
    out = pairs.select(F.col("l_align_index").alias("a"), F.col("r_align_index").alias("b"), F.least("l_score", "r_score").alias("score_min"), F.greatest("l_score", "r_score").alias("score_max"), F.col("l_qry_pos").alias("p"), F.col("r_qry_pos").alias("q"))
    return out.orderBy("score_max", "score_min", "p", "q", "a", "b").drop("p", "q")


@operator("j03_overlap_audit", oracle("select a.qry_id, count(*) as n from fx_shift a join fx_shift b on a.qry_id = b.qry_id and a.align_index < b.align_index and a.qry_pos < b.qry_end and b.qry_pos < a.qry_end group by a.qry_id"))
def overlap_audit(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_shift").select("qry_id", "qry_pos", "qry_end", "align_index")
    return iv.range_join(rows, rows, "qry_id", ("qry_pos", "qry_end"), ("qry_pos", "qry_end")).where("l_align_index < r_align_index").groupBy(F.col("l_qry_id").alias("qry_id")).agg(F.count("*").alias("n"))


@operator("j04_coverage", oracle("""
with a as (select * from fx_align where not is_rev), b as (select * from fx_align where is_rev), s as (select a.align_index, a.end_pos - a.pos as len, coalesce(sum(case when b.pos is not null then least(a.end_pos, b.end_pos) - greatest(a.pos, b.pos) end), 0) as bp from a left join b on a.chrom = b.chrom and a.pos < b.end_pos and b.pos < a.end_pos group by a.align_index, a.end_pos, a.pos)
select align_index, cast(len as bigint) as len, cast(bp as bigint) as bp, case when len > 0 then bp::double / len else 0.0::double end as bp_prop, bp::double / len >= 0.5 as half from s"""))
def coverage(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_align").select("chrom", "pos", "end_pos", "align_index", "is_rev")
    return iv.coverage(rows.where("not is_rev"), rows.where("is_rev"), "chrom", "align_index").withColumn("half", F.col("bp_prop") >= 0.5)


SWEPT = """with ev as (select chrom, pos as c, 1 as d from fx_align union all select chrom, end_pos, -1 from fx_align), st as (select chrom, c, sum(d) as d from ev group by chrom, c),
sw as (select chrom, c as pos, lead(c) over (partition by chrom order by c) as end_pos, sum(d) over (partition by chrom order by c rows between unbounded preceding and current row) as depth from st)"""


@operator("j05_deep_filter", oracle(SWEPT + """, deep as (select * from sw where depth > 2 and end_pos is not null),
b as (select a.align_index, sum(least(a.end_pos, d.end_pos) - greatest(a.pos, d.pos)) as bp from fx_align a join deep d on a.chrom = d.chrom and a.pos < d.end_pos and d.pos < a.end_pos group by a.align_index)
select r.align_index, case when coalesce(b.bp, 0)::double / (r.end_pos - r.pos) <= 0.5 then r.filters when r.filters = '' then 'DEPTH' else r.filters || ',DEPTH' end as filters from fx_rec r left join b using (align_index)"""))
def deep_filter(spark, sf_dir):
    rows = records(spark, sf_dir)
    deep = iv.depth(rows).where("depth > 2")
    share = iv.coverage(rows, deep, "chrom", "align_index").select("align_index", "bp_prop")
    return rows.join(share, "align_index").select("align_index", F.array_join(fr.tag(F.col("bp_prop") > 0.5, "DEPTH", once=True), ",").alias("filters"))


@operator("j10_anti_join", oracle("select align_index from fx_align a where not exists (select 1 from fx_shift s where s.align_index = a.align_index and s.qry_pos <> a.qry_pos)"))
def anti_join(spark, sf_dir):
    moved = fixture(spark, sf_dir, "fx_shift").select("align_index", F.col("qry_pos").alias("p"))
    rows = fixture(spark, sf_dir, "fx_align").select("align_index", "qry_pos")
    return rows.join(moved, (moved.align_index == rows.align_index) & (moved.p != rows.qry_pos), "left_anti").select("align_index")


@operator("j12_lookup", oracle("select r.align_index, l.len from fx_align r left join (select * from fx_qlen where len > 100) l using (qry_id)"))
def lookup(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_align").join(fixture(spark, sf_dir, "fx_qlen").where("len > 100"), "qry_id", "left").select("align_index", "len")


@operator("j13_semi_join", oracle("select align_index, op_index from fx_op where align_index in (select align_index from fx_rec where filters = '')"))
def semi_join(spark, sf_dir):
    good = records(spark, sf_dir).where(fr.passing()).select("align_index")
    return fixture(spark, sf_dir, "fx_op").join(good, "align_index", "left_semi").select("align_index", "op_index")


@operator("j14_ordered_inner_join", oracle("select a.align_index, a.pos, a.end_pos, s.qry_pos from fx_align a join fx_shift s using (align_index)"))
def ordered_inner_join(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_align").select("align_index", "pos", "end_pos").join(fixture(spark, sf_dir, "fx_shift").select("align_index", "qry_pos"), "align_index")
    return rows.orderBy("pos", "end_pos", "align_index")


@operator("j19_flank_pairs", oracle("select a.chrom, a.align_index as index_a, b.align_index as index_b from fx_align a join fx_align b on a.chrom = b.chrom and a.align_index < b.align_index and a.pos - 1000 < b.end_pos and b.pos < a.end_pos + 1000"))
def flank_pairs(spark, sf_dir):
    return iv.flank_pairs(fixture(spark, sf_dir, "fx_align"), "chrom", "align_index", flank=1000)


@operator("j23_pivot_columns", oracle("select align_index, cast(sum(case when op_code = 7 then op_len end) as bigint) as eq, cast(sum(case when op_code = 8 then op_len end) as bigint) as x from fx_op group by align_index"))
def pivot_columns(spark, sf_dir):
    made = fixture(spark, sf_dir, "fx_op").groupBy("align_index").pivot("op_code", [7, 8]).agg(F.sum("op_len"))
    return made.select("align_index", F.col("7").alias("eq"), F.col("8").alias("x"))


@operator("a05_confident_order", oracle("select qry_id, min(qry_order) as first, max(qry_order) as last from fx_rec where match_prop >= 0.6 group by qry_id"))
def confident_order(spark, sf_dir):
    return records(spark, sf_dir).where("match_prop >= 0.6").groupBy("qry_id").agg(F.min("qry_order").alias("first"), F.max("qry_order").alias("last"))


@operator("a06_next_version", oracle(r"select regexp_extract(id, '^([^.]*)(\.([0-9]+))?$', 1) as base, max(coalesce(try_cast(nullif(regexp_extract(id, '^([^.]*)(\.([0-9]+))?$', 3), '') as bigint), 0)) + 1 as next from (select vartype || '-' || cast(varlen as varchar) || case when op_index > 1 then '.' || cast(op_index as varchar) else '' end as id from fx_variant) v group by 1"))
def next_version(spark, sf_dir):
    names = fixture(spark, sf_dir, "fx_variant").select(F.concat("vartype", F.lit("-"), F.col("varlen").cast("string"), F.when(F.col("op_index") > 1, F.concat(F.lit("."), F.col("op_index").cast("string"))).otherwise("")).alias("id"))
    part = lambda i: F.regexp_extract("id", r"^([^.]*)(\.([0-9]+))?$", i)
    return names.groupBy(part(1).alias("base")).agg((F.max(F.coalesce(part(3).try_cast("long"), F.lit(0))) + 1).alias("next"))


@operator("a07_first_and_last", oracle("select align_index, arg_min(op_len, op_index) as first_len, arg_max(op_len, op_index) as last_len from fx_op group by align_index"))
def first_and_last(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_op").groupBy("align_index").agg(F.min_by("op_len", "op_index").alias("first_len"), F.max_by("op_len", "op_index").alias("last_len"))


@operator("a08_collected_lists", oracle("select qry_id, string_agg(cast(align_index as varchar), ',' order by align_index) as records from fx_align group by qry_id"))
def collected_lists(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_align").groupBy("qry_id").agg(F.array_join(F.array_sort(F.collect_list("align_index")), ",").alias("records"))


@operator("a09_flat_distinct_lists", oracle("select qry_id, coalesce((select string_agg(x, ',' order by x) from (select distinct unnest(string_split(string_agg(r.filters, ','), ',')) as x) u where x <> ''), '') as tags from fx_rec r group by qry_id"))
def flat_distinct_lists(spark, sf_dir):
    return records(spark, sf_dir).groupBy("qry_id").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("filter")))), ",").alias("tags"))


@operator("a11_filtered_totals", oracle("select cast(sum(op_len) filter (op_code = 7) as double) / sum(op_len) as eq_prop, count(*) filter (op_code = 8) as n_x from fx_op"))
def filtered_totals(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_op").agg((F.sum(F.when(F.col("op_code") == 7, F.col("op_len"))) / F.sum("op_len")).alias("eq_prop"), F.count_if(F.col("op_code") == 8).alias("n_x"))


@operator("a12_any_all_distinct", oracle("select qry_id, bool_or(is_rev) as any_rev, bool_and(is_rev) as all_rev, count(distinct chrom) as chroms from fx_align group by qry_id"))
def any_all_distinct(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_align").groupBy("qry_id").agg(F.bool_or("is_rev").alias("any_rev"), F.bool_and("is_rev").alias("all_rev"), F.count_distinct("chrom").alias("chroms"))


@operator("a13_state_range", oracle("select op_code as state, min(op_index) as first, max(op_index) as last from fx_op group by op_code"))
def state_range(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_op").groupBy(F.col("op_code").alias("state")).agg(F.min("op_index").alias("first"), F.max("op_index").alias("last"))


@operator("a15_segment_count", oracle("select align_index, max(op_index) as segments from fx_op group by align_index"))
def segment_count(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_op").groupBy("align_index").agg(F.max("op_index").alias("segments"))


@operator("a10_run_structs", oracle("""
with a as (select *, case when lag(op_code) over (partition by align_index order by op_index) is not distinct from op_code then 0 else 1 end as new from fx_op), b as (select *, sum(new) over (partition by align_index order by op_index rows between unbounded preceding and current row) as run from a)
select align_index, cast(run as bigint) as run, arg_min(op_len, op_index) as first_len, arg_max(op_len, op_index) as last_len, count(*) as n, count(*) filter (op_len > 25) as long from b group by align_index, run"""))
def run_structs(spark, sf_dir):
    runs = al.islands(fixture(spark, sf_dir, "fx_op"), "align_index", ["op_index"], "op_code")
    return runs.groupBy("align_index", "run").agg(F.struct(F.min_by("op_len", "op_index").alias("first_len"), F.max_by("op_len", "op_index").alias("last_len"), F.count("*").alias("n"), F.count_if(F.col("op_len") > 25).alias("long")).alias("s")).select("align_index", "run", "s.*")


@operator("a17_joined_text", oracle(f"select align_index, string_agg({LETTER} || '[' || format('{{:,}}', op_len * 1000) || ']', ':' order by op_index) as trace from fx_op group by align_index"))
def joined_text(spark, sf_dir):
    part = F.concat(F.substring(F.lit(al.LETTERS), F.col("op_code") + 1, F.lit(1)), F.lit("["), F.format_number(F.col("op_len") * 1000, 0), F.lit("]"))
    parts = fixture(spark, sf_dir, "fx_op").groupBy("align_index").agg(F.array_sort(F.collect_list(F.struct("op_index", part.alias("p")))).alias("l"))
    return parts.select("align_index", F.array_join(F.transform("l", lambda s: s["p"]), ":").alias("trace"))


@operator("w02_versions", oracle("select align_index, op_index, row_number() over (partition by chrom, pos, vartype, varlen order by length(filter_str), align_index, op_index) - 1 as version from fx_variant"))
def versions(spark, sf_dir):
    w = Window.partitionBy("chrom", "pos", "vartype", "varlen").orderBy(F.length("filter_str"), "align_index", "op_index")
    return fixture(spark, sf_dir, "fx_variant").select("align_index", "op_index", (F.row_number().over(w) - 1).cast("long").alias("version"))


@operator("w05_lead_lag_fill", oracle("select align_index, op_index, lead(op_len, 1, 0) over (partition by align_index order by op_index) as next, lag(op_len, 1, -1) over (partition by align_index order by op_index) as before, cast(sum(op_len) over (partition by align_index order by op_index rows between unbounded preceding and current row) as bigint) as upto from fx_op"))
def lead_lag_fill(spark, sf_dir):
    w = Window.partitionBy("align_index").orderBy("op_index")
    return fixture(spark, sf_dir, "fx_op").select("align_index", "op_index", F.lead("op_len", 1, 0).over(w).alias("next"), F.lag("op_len", 1, -1).over(w).alias("before"), F.sum("op_len").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))


@operator("w08_inner_rows", oracle("""
with m as (select *, min(case when op_code <> 7 then op_index end) over (partition by align_index) as a, max(case when op_code <> 7 then op_index end) over (partition by align_index) as b from fx_op) select align_index, op_index from m where op_code <> 7 or (op_index > a and op_index < b)"""))
def inner_rows(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_op").withColumn("eq", F.col("op_code") == 7)
    return fr.inner_rows(rows, "eq", ["align_index"], ["op_index"]).select("align_index", "op_index")


@operator("w09_fills", oracle("""
select align_index, op_index, last_value(case when op_code = 7 then op_len end ignore nulls) over (partition by align_index order by op_index rows between unbounded preceding and current row) as forward,
 first_value(case when op_code = 7 then op_len end ignore nulls) over (partition by align_index order by op_index rows between current row and unbounded following) as backward from fx_op"""))
def fills(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_op").withColumn("v", F.when(F.col("op_code") == 7, F.col("op_len")))
    return rows.select("align_index", "op_index", fr.fill("v", ["align_index"], ["op_index"]).alias("forward"), fr.fill("v", ["align_index"], ["op_index"], False).alias("backward"))


@operator("w10_running_count", oracle("select align_index, op_index, case when op_code in (7, 8) then cast(sum(case when op_code in (7, 8) then 1 else 0 end) over (partition by align_index order by op_index rows between unbounded preceding and current row) - 1 as bigint) end as n from fx_op"))
def running_count(spark, sf_dir):
    w = Window.partitionBy("align_index").orderBy("op_index").rowsBetween(Window.unboundedPreceding, 0)
    aligned = F.col("op_code").isin(7, 8)
    return fixture(spark, sf_dir, "fx_op").select("align_index", "op_index", F.when(aligned, F.count_if(aligned).over(w) - 1).alias("n"))


@operator("w11_first_of", oracle("select align_index, op_index from (select *, row_number() over (partition by chrom, pos, end_pos, varlen order by align_index, op_index) as r from fx_variant) v where r = 1"))
def first_of(spark, sf_dir):
    return fr.first_of(fixture(spark, sf_dir, "fx_variant"), ["chrom", "pos", "end_pos", "varlen"], ["align_index", "op_index"]).select("align_index", "op_index")


@operator("w12_row_index", oracle("select align_index, op_index, row_number() over (order by chrom, pos, align_index, op_index) - 1 as \"index\" from fx_variant"))
def row_index(spark, sf_dir):
    return fr.row_index(fixture(spark, sf_dir, "fx_variant").select("chrom", "pos", "align_index", "op_index"), ["chrom", "pos", "align_index", "op_index"]).select("align_index", "op_index", "index")


@operator("w13_total_share", oracle("select op_code, count(*)::double / sum(count(*)) over () as share from fx_op group by op_code"))
def total_share(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_op").groupBy("op_code").agg(F.count("*").alias("n")).select("op_code", fr.total_share("n", "share"))


@operator("o01_record_order", oracle("select align_index, row_number() over (order by chrom nulls first, pos nulls first, end_pos nulls first, align_index) - 1 as place from fx_align"))
def record_order(spark, sf_dir):
    return fr.row_index(fixture(spark, sf_dir, "fx_align").select("chrom", "pos", "end_pos", "align_index"), ["chrom", "pos", "end_pos", "align_index"], "place").select("align_index", "place")


@operator("o02_variant_order", oracle("select align_index, op_index, row_number() over (order by chrom, pos, end_pos, length(filter_str), align_index, op_index) - 1 as place from fx_variant"))
def variant_order(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_variant").select("chrom", "pos", "end_pos", F.length("filter_str").alias("bad"), "align_index", "op_index")
    return fr.row_index(rows, ["chrom", "pos", "end_pos", "bad", "align_index", "op_index"], "place").select("align_index", "op_index", "place")


@operator("o05_mixed_order", oracle("select align_index, op_index, row_number() over (order by length(filter_str) desc, varlen desc, align_index, op_index) - 1 as place from fx_variant"))
def mixed_order(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_variant").select((-F.length("filter_str")).alias("bad"), (-F.col("varlen")).alias("short"), "align_index", "op_index")
    return fr.row_index(rows, ["bad", "short", "align_index", "op_index"], "place").select("align_index", "op_index", "place")


@operator("o08_null_order", oracle("select qry_id, align_index, row_number() over (partition by qry_id order by nullif(mapq, 10) nulls first, align_index) as place from fx_align"))
def null_order(spark, sf_dir):
    w = Window.partitionBy("qry_id").orderBy(F.expr("nullif(mapq, 10)").asc_nulls_first(), "align_index")
    return fixture(spark, sf_dir, "fx_align").select("qry_id", "align_index", F.row_number().over(w).cast("long").alias("place"))


@operator("o09_top_one", oracle("select qry_id, arg_max(align_index, score * 1000000 - align_index) as best from fx_rec group by qry_id"))
def top_one(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_rec").groupBy("qry_id").agg(F.max_by("align_index", F.col("score") * 1000000 - F.col("align_index")).alias("best"))


@operator("u01_union", oracle("select align_index from fx_align where is_rev union all select align_index from fx_align where not is_rev"))
def union(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_align")
    return rows.where("is_rev").select("align_index").union(rows.where("not is_rev").select("align_index"))


@operator("u02_stack", oracle("select align_index, chrom, cast(null as bigint) as varlen from fx_align union all select align_index, chrom, cast(varlen as bigint) from fx_variant"))
def stack(spark, sf_dir):
    return fr.stack(fixture(spark, sf_dir, "fx_align").select("align_index", "chrom"), fixture(spark, sf_dir, "fx_variant").select("align_index", "chrom", F.col("varlen").cast("long").alias("varlen")))


@operator("u03_distinct", oracle("select distinct qry_id from fx_align"))
def distinct(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_align").select("qry_id").distinct()


@operator("u04_list_sets", oracle("select align_index, array_to_string(list_sort(list_distinct(list_concat(list_filter(string_split(filters, ','), lambda x: x <> ''), ['MAPQ', 'TRIM']))), ',') as tags, contains(filters, 'ALIGN') as has from fx_rec"))
def list_sets(spark, sf_dir):
    both = F.array_sort(F.array_distinct(F.concat("filter", F.array(F.lit("MAPQ"), F.lit("TRIM")))))
    return records(spark, sf_dir).select("align_index", F.array_join(both, ",").alias("tags"), F.array_contains("filter", "ALIGN").alias("has"))


@operator("d01_depth_with_rows", oracle(SWEPT + """ select s.chrom, s.pos, s.end_pos, cast(s.depth as bigint) as depth, coalesce(string_agg(cast(a.align_index as varchar), ',' order by a.pos, a.align_index), '') as rows
from sw s left join fx_align a on a.chrom = s.chrom and a.pos < s.end_pos and s.pos < a.end_pos where s.end_pos is not null group by s.chrom, s.pos, s.end_pos, s.depth
union all select chrom, 0, min(pos), 0, '' from fx_align group by chrom having min(pos) > 0 union all select chrom, max(end_pos), 3000000, 0, '' from fx_align group by chrom"""))
def depth_with_rows(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_align")
    lengths = rows.select("chrom").distinct().withColumn("len", F.lit(3_000_000))
    return iv.depth_with_rows(rows, lengths).withColumn("rows", F.array_join("rows", ","))


@operator("r01_region_algebra", oracle("""
with e as (select align_index, chrom, pos, end_pos, pos - 2500 as a, end_pos + 2500 as b from fx_align)
select align_index, chrom || ':' || cast(pos + 1 as varchar) || '-' || cast(end_pos as varchar) as text, chrom || '-' || cast(pos + 1 as varchar) || '-INV-' || cast(end_pos - pos as varchar) as id,
 cast(greatest(greatest(a, 0) - greatest(b - 2000000, 0), 0) as bigint) as grown_pos, cast(least(least(b, 2000000) + greatest(-a, 0), 2000000) as bigint) as grown_end from e"""))
def region_algebra(spark, sf_dir):
    rows = fixture(spark, sf_dir, "fx_align")
    c, p, e = F.col("chrom"), F.col("pos"), F.col("end_pos")
    made = rows.select("align_index", rg.region_text(c, p, e).alias("text"), rg.region_id(c, p, e, F.lit("INV")).alias("id"), rg.expand(p, e, 5000, 0, F.lit(2_000_000)).alias("g"))
    return made.select("align_index", "text", "id", F.col("g.pos").alias("grown_pos"), F.col("g.end_pos").alias("grown_end"))


@operator("r01_parsed_regions", oracle("select align_index, chrom, pos, end_pos, true as same from fx_align"))
def parsed_regions(spark, sf_dir):
    c, p, e = F.col("chrom"), F.col("pos"), F.col("end_pos")
    rows = fixture(spark, sf_dir, "fx_align").select("align_index", rg.parse_text(rg.region_text(c, p, e)).alias("t"), rg.parse_id(rg.region_id(c, p, e, F.lit("INV"))).alias("i"))
    return rows.select("align_index", "t.*", (F.col("t") == F.col("i")).alias("same"))


@operator("s06_region_fetch", oracle("""
select name, case when doc_id % 2 = 1 then reverse(translate(x, 'ACGT', 'TGCA')) else x end as bases from (select doc_id, name, substring(bases, cast(floor(length(bases) / 3) as bigint) + 1, cast(floor(length(bases) / 2) as bigint)) as x from fx_seq where length(bases) >= 6) t"""))
def region_fetch(spark, sf_dir):
    seqs = fixture(spark, sf_dir, "fx_seq")
    n = F.length("bases")
    asked = seqs.where(n >= 6).select("name", F.floor(n / 3).alias("pos"), (F.floor(n / 3) + F.floor(n / 2)).alias("end_pos"), (F.col("doc_id") % 2 == 1).alias("rev"))
    return sq.fetch(asked.withColumn("at", F.col("name")), seqs, "at", reverse="rev").withColumnRenamed("at", "name")


@operator("x10_sequence_lengths", oracle("select name, cast(length(bases) as bigint) as len, md5(upper(bases)) as md5 from fx_seq"))
def sequence_lengths(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_seq").select("name", F.length("bases").cast("long").alias("len"), F.md5(F.upper("bases")).alias("md5"))


@operator("x01_kmer_stream", oracle("""
with k as (select name, cast(i as bigint) as "index", substring(bases, cast(i + 1 as bigint), 31) as kmer from (select name, bases, unnest(range(0, length(bases) - 30)) as i from fx_seq where length(bases) >= 31) s)
select name, "index", least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) as canonical from k where translate(kmer, 'ACGT', '') = ''"""))
def kmer_stream(spark, sf_dir):
    return sq.kmers(fixture(spark, sf_dir, "fx_seq"), 31, canonical=True).withColumnRenamed("kmer", "canonical")


@operator("x09_homology", oracle("""
with t as (select name, upper(substring(bases, 1, 40)) as v, upper(substring(bases, 41, 40)) as dn, upper(substring(bases, 81, 40)) as up from fx_seq where length(bases) >= 120)
select name, cast((select coalesce(min(i) - 1, 40) from (select unnest(range(1, 41)) as i) r where substring(reverse(v), i, 1) <> substring(reverse(up), i, 1)) as int) as up,
 cast((select coalesce(min(i) - 1, 40) from (select unnest(range(1, 41)) as i) r where substring(v, i, 1) <> substring(dn, i, 1)) as int) as dn from t"""))
def homology(spark, sf_dir):
    part = lambda a: F.substring("bases", a, 40)
    return fixture(spark, sf_dir, "fx_seq").where(F.length("bases") >= 120).select("name", sq.homology(part(1), part(81), part(41)).alias("h")).select("name", "h.*")


@operator("v03_complements", oracle("select name, translate(lower(bases), 'acgt', 'tgca') as low, translate(replace(bases, 'T', 'U'), 'ACGU', 'TGCA') as rna from fx_seq"))
def complements(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_seq").select("name", sq.complement(F.lower("bases")).alias("low"), sq.complement(F.translate("bases", "T", "U")).alias("rna"))
