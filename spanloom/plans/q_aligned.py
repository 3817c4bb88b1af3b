"""Queries of the alignment operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import aligned as al, intervals as iv
from .fixtures import fixture, oracle
from .registry import operator

LETTER = "substring('MIDNSHP=X', op_code + 1, 1)"
GAP = "greatest(-(4.0 + 2.0 * op_len), -(24.0 + op_len))"
SCORE = f"cast(case when op_code = 7 then 2.0 * op_len when op_code = 8 then -4.0 * op_len else {GAP} end as double)"
SCORE_MM = "cast(case when op_code = 7 then 2.0 * op_len when op_code = 8 then -4.0 * op_len else 0 end as double)"


@operator("c01_parse_cigar", oracle("select align_index, op_index, op_code, op_len from fx_op"))
def parse_cigar(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = al.pack(fixture(spark, sf_dir, "fx_op")).select("align_index", al.cigar(F.col("ops")).alias("cigar"))
    return al.parse_cigar(packed, "align_index", "cigar")


@operator("c02_render_cigar", oracle(f"select align_index, string_agg(cast(op_len as varchar) || {LETTER}, '' order by op_index) as cigar from fx_op group by align_index"))
def render_cigar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.pack(fixture(spark, sf_dir, "fx_op")).select("align_index", al.cigar(F.col("ops")).alias("cigar"))


@operator("c05_op_coordinates", oracle("select align_index, op_index, op_code, op_len, ref_off, qry_off from fx_op_coord"))
def op_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.with_offsets(fixture(spark, sf_dir, "fx_op"))


@operator("c07_collapse_ops", oracle("""
with a as (select *, op_code in (0,7,8) as al from fx_op), b as (select *, case when al and coalesce(lag(al) over (partition by align_index order by op_index), false) then 0 else 1 end as new from a),
c as (select *, sum(new) over (partition by align_index order by op_index rows between unbounded preceding and current row) as run from b)
select align_index, cast(run as bigint) as run, min(case when al then 0 else op_code end) as op_code, cast(sum(op_len) as bigint) as op_len from c group by align_index, run"""))
def collapse_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.collapse(fixture(spark, sf_dir, "fx_op"))


@operator("c08_bad_records", oracle("""
select a.align_index, cast(o.ref_bp as bigint) as ref_bp, cast(o.qry_bp as bigint) as qry_bp from fx_shift a
join (select align_index, sum(case when op_code in (0,2,3,7,8) then op_len else 0 end) as ref_bp, sum(case when op_code in (0,1,4,7,8) then op_len else 0 end) as qry_bp from fx_op group by align_index) o using (align_index)
join fx_qlen l using (qry_id) where a.qry_end > l.len or a.pos < 0 or a.qry_pos < 0 or a.end_pos <= a.pos or a.qry_end <= a.qry_pos or a.pos + o.ref_bp <> a.end_pos or a.qry_pos + o.qry_bp <> a.qry_end"""))
def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = fixture(spark, sf_dir, "fx_op").groupBy("align_index").agg(al.total("op_code", al.REF_STEPS).alias("ref_bp"), al.total("op_code", al.QRY_STEPS).alias("qry_bp"))
    bad = "qry_end > len or pos < 0 or qry_pos < 0 or end_pos <= pos or qry_end <= qry_pos or pos + ref_bp <> end_pos or qry_pos + qry_bp <> qry_end"
    return fixture(spark, sf_dir, "fx_shift").join(sums, "align_index").join(fixture(spark, sf_dir, "fx_qlen"), "qry_id").where(bad).select("align_index", "ref_bp", "qry_bp")


@operator("f01_op_scores", oracle(f"select align_index, op_index, {SCORE} as score from fx_op"))
def op_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_op").select("align_index", "op_index", al.Affine().op(F.col("op_code"), F.col("op_len")).alias("score"))


@operator("f04_record_features", oracle(f"""
with s as (select align_index, sum({SCORE}) as score, sum({SCORE_MM}) as score_mm, sum(case when op_code = 7 then op_len else 0 end) as m, sum(case when op_code in (7,8) then op_len else 0 end) as a, sum(case when op_code in (0,1,4,7,8) then op_len else 0 end) as q from fx_op group by align_index)
select align_index, cast(score as float) as score, cast(score_mm as float) as score_mm, cast(case when q > 0 then score / (q * 2.0::double) end as float) as score_prop, cast(case when a > 0 then score_mm / (a * 2.0::double) end as float) as score_mm_prop, cast(case when a > 0 then m::double / a end as float) as match_prop from s"""))
def record_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.features(fixture(spark, sf_dir, "fx_op"))


@operator("f12_query_share", oracle("select a.align_index, cast(a.qry_end - a.qry_pos as double) / l.len as qry_prop from fx_align a join fx_qlen l using (qry_id)"))
def query_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = fixture(spark, sf_dir, "fx_qlen")
    return fixture(spark, sf_dir, "fx_align").join(lengths, "qry_id").select("align_index", ((F.col("qry_end") - F.col("qry_pos")).cast("double") / F.col("len")).alias("qry_prop"))


@operator("a01_align_stats", oracle("""
select case when mapq < 20 then 'MAPQ' else '' end as filter, count(*) as n, count(*)::double / sum(count(*)) over () as n_prop, cast(sum(qry_end - qry_pos) as bigint) as bp,
       sum(qry_end - qry_pos)::double / sum(sum(qry_end - qry_pos)) over () as bp_prop, sum(qry_end - qry_pos)::double / count(*) as bp_mean, cast(sum(end_pos - pos) as bigint) as bp_ref, avg(mapq) as mapq_mean
from fx_align group by 1"""))
def align_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_align").select(F.when(F.col("mapq") < 20, "MAPQ").otherwise("").alias("filter"), (F.col("qry_end") - F.col("qry_pos")).alias("q"), (F.col("end_pos") - F.col("pos")).alias("r"), "mapq")
    sums = rows.groupBy("filter").agg(F.count("*").alias("n"), F.sum("q").alias("bp"), F.sum("r").alias("bp_ref"), F.avg("mapq").alias("mapq_mean"))
    every = Window.partitionBy()  # over a row for each filter
    return sums.select("filter", "n", (F.col("n") / F.sum("n").over(every)).alias("n_prop"), "bp", (F.col("bp") / F.sum("bp").over(every)).alias("bp_prop"), (F.col("bp") / F.col("n")).alias("bp_mean"), "bp_ref", "mapq_mean")


@operator("a03_repeated_keys", oracle("select l_orderkey as order_id, l_linenumber as line_no, count(*) as n from lineitem group by 1, 2 having count(*) > 1"))
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_interval").groupBy("order_id", "line_no").agg(F.count("*").alias("n")).where("n > 1")


@operator("a14_kmer_counts", oracle("""
with k as (select substring(bases, cast(i + 1 as bigint), 8) as kmer from (select bases, unnest(range(0, length(bases) - 7)) as i from fx_seq where length(bases) >= 8) s)
select kmer, count(*) as n from k where regexp_full_match(kmer, '[ACGT]+') group by kmer"""))
def kmer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.kmer_counts(fixture(spark, sf_dir, "fx_seq"), 8)


@operator("s06_reverse_complement", oracle("select name, reverse(translate(bases, 'ACGT', 'TGCA')) as bases from fx_seq"))
def reversed_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_seq").select("name", al.reverse_complement(F.col("bases")).alias("bases"))


@operator("w01_query_order", oracle("select align_index, row_number() over (partition by qry_id order by qry_pos, qry_end, align_index) - 1 as qry_order from fx_shift"))
def query_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("qry_id").orderBy("qry_pos", "qry_end", "align_index")
    return fixture(spark, sf_dir, "fx_shift").select("align_index", (F.row_number().over(w) - 1).cast("long").alias("qry_order"))


@operator("w07_islands", oracle("""
with a as (select *, case when lag(op_code) over w is not distinct from op_code and row_number() over w > 1 then 0 else 1 end as change from fx_op window w as (partition by align_index order by op_index)),
b as (select *, sum(change) over (partition by align_index order by op_index rows between unbounded preceding and current row) as run from a)
select align_index, cast(run as bigint) as run, min(op_code) as op_code, min(op_index) as first_op, max(op_index) as last_op, cast(sum(op_len) as bigint) as bp from b group by align_index, run"""))
def code_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = al.islands(fixture(spark, sf_dir, "fx_op"), "align_index", ["op_index"], "op_code")
    return runs.groupBy("align_index", "run").agg(F.min("op_code").alias("op_code"), F.min("op_index").alias("first_op"), F.max("op_index").alias("last_op"), F.sum("op_len").alias("bp"))


@operator("j01_query_overlaps", oracle("""
select a.align_index as a, b.align_index as b, cast(least(a.qry_end, b.qry_end) - greatest(a.qry_pos, b.qry_pos) as bigint) as bp
from fx_shift a join fx_shift b on a.qry_id = b.qry_id and a.align_index < b.align_index and a.qry_pos < b.qry_end and b.qry_pos < a.qry_end"""))
def query_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_shift").select("qry_id", "align_index", "qry_pos", "qry_end")
    pairs = iv.range_join(rows, rows, "qry_id", ("qry_pos", "qry_end"), ("qry_pos", "qry_end")).where("l_align_index < r_align_index")
    return pairs.select(F.col("l_align_index").alias("a"), F.col("r_align_index").alias("b"), iv.overlap_bp(F.col("l_qry_pos"), F.col("l_qry_end"), F.col("r_qry_pos"), F.col("r_qry_end")).alias("bp"))


@operator("j04_overlap_with_other", oracle("""
with a as (select * from fx_align where not is_rev), b as (select * from fx_align where is_rev)
select a.align_index, cast(a.end_pos - a.pos as bigint) as len, cast(coalesce(sum(case when b.pos is not null then least(a.end_pos, b.end_pos) - greatest(a.pos, b.pos) end), 0) as bigint) as bp
from a left join b on a.chrom = b.chrom and a.pos < b.end_pos and b.pos < a.end_pos group by a.align_index, a.end_pos, a.pos"""))
def overlap_with_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_align").select("chrom", "pos", "end_pos", "align_index", "is_rev")
    left = rows.where("not is_rev")
    sums = iv.range_join(left, rows.where("is_rev"), "chrom").groupBy(F.col("l_align_index").alias("align_index")).agg(F.sum(iv.overlap_bp(F.col("l_pos"), F.col("l_end_pos"), F.col("r_pos"), F.col("r_end_pos"))).alias("bp"))
    return left.join(sums, "align_index", "left").select("align_index", (F.col("end_pos") - F.col("pos")).alias("len"), F.coalesce("bp", F.lit(0)).alias("bp"))


@operator("w07_merged_intervals", oracle("""
with o as (select chrom, pos, end_pos, max(end_pos) over (partition by chrom order by pos, end_pos rows between unbounded preceding and 1 preceding) as b from fx_align),
r as (select *, sum(case when pos <= b + 1000 then 0 else 1 end) over (partition by chrom order by pos, end_pos range between unbounded preceding and current row) as run from o)
select chrom, min(pos) as pos, max(end_pos) as end_pos, count(*) as n from r group by chrom, run"""))
def merge_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.merge(fixture(spark, sf_dir, "fx_align"), "chrom", flank=1000)


@operator("l02_lift_points", oracle("""
with p as (select chrom, event_pos, event_id from (select 'chr' || cast(user_id % 24 + 1 as varchar) as chrom, (event_id * 7907) % 2000000 as event_pos, event_id from events) e)
select p.event_id, a.align_index, cast(case when c.op_code = 2 then a.qry_pos + c.qry_off else a.qry_pos + c.qry_off + p.event_pos - a.pos - c.ref_off end as bigint) as qry_point
from p join fx_align a on a.chrom = p.chrom and a.pos <= p.event_pos and p.event_pos < a.end_pos
join fx_op_coord c on c.align_index = a.align_index and c.op_code in (2,7,8) and a.pos + c.ref_off <= p.event_pos and p.event_pos < a.pos + c.ref_off + c.op_len"""))
def lift_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fixtures import table

    points = table(spark, sf_dir, "events").select(F.concat(F.lit("chr"), (F.col("user_id") % 24 + 1).cast("string")).alias("chrom"), ((F.col("event_id") * 7907) % 2000000).alias("at"), "event_id").withColumn("past", F.col("at") + 1)
    steps = fixture(spark, sf_dir, "fx_align").select("align_index", "chrom", F.col("pos").alias("a_pos"), "qry_pos").join(fixture(spark, sf_dir, "fx_op_coord").where("op_code in (2, 7, 8)"), "align_index")
    steps = steps.select("chrom", "align_index", "op_code", (F.col("a_pos") + F.col("ref_off")).alias("pos"), (F.col("a_pos") + F.col("ref_off") + F.col("op_len")).alias("end_pos"), (F.col("qry_pos") + F.col("qry_off")).alias("qry"))
    hits = iv.range_join(points, steps, "chrom", ("at", "past"))
    return hits.select(F.col("l_event_id").alias("event_id"), F.col("r_align_index").alias("align_index"), F.when(F.col("r_op_code") == 2, F.col("r_qry")).otherwise(F.col("r_qry") + F.col("l_at") - F.col("r_pos")).alias("qry_point"))


@operator("v05_variant_ids", oracle("""
with b as (select *, concat_ws('-', chrom, cast(pos + 1 as varchar), vartype, cast(varlen as varchar)) as base from fx_variant),
n as (select *, row_number() over (partition by base order by length(filter_str), align_index, op_index) - 1 as v from b)
select align_index, op_index, case when v > 0 then base || '.' || cast(v as varchar) else base end as id from n"""))
def variant_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_variant")
    rows = rows.select("align_index", "op_index", F.length("filter_str").alias("bad"), al.variant_id(F.col("chrom"), F.col("pos"), F.col("vartype"), F.col("varlen")).alias("id"))
    return al.versioned(rows, "id", "bad", ["align_index", "op_index"]).drop("bad")


@operator("d02_callable_regions", oracle("""
with ev as (select chrom, pos as c, 1 as d from fx_align where mapq >= 20 union all select chrom, end_pos, -1 from fx_align where mapq >= 20), st as (select chrom, c, sum(d) as d from ev group by chrom, c),
sw as (select chrom, c as pos, lead(c) over (partition by chrom order by c) as end_pos, sum(d) over (partition by chrom order by c rows between unbounded preceding and current row) as depth from st)
select chrom, pos, end_pos from sw where depth > 0 and end_pos is not null"""))
def callable_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.depth(fixture(spark, sf_dir, "fx_align").where("mapq >= 20")).select("chrom", "pos", "end_pos")


@operator("t01_id_genotypes", oracle("""
select vid, case when bool_or(hap = 'h1') then '1' else '0' end || '|' || case when bool_or(hap = 'h2') then '1' else '0' end as gt
from (select concat_ws('-', chrom, cast(pos + 1 as varchar), vartype, cast(varlen as varchar)) as vid, hap from fx_variant) v group by vid"""))
def genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_variant").select(al.variant_id(F.col("chrom"), F.col("pos"), F.col("vartype"), F.col("varlen")).alias("vid"), "hap")
    has = lambda h: F.when(F.bool_or(F.col("hap") == h), "1").otherwise("0")
    return rows.groupBy("vid").agg(F.concat(has("h1"), F.lit("|"), has("h2")).alias("gt"))
