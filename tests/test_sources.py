"""Readers, writers, parameters and small operators that SQL can't check, on files made here."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from spanloom import sinks
from spanloom.operators import aligned as al, frames as fr, graph as gr, intervals as iv, inversions as inv, trim as tm, vcf
from spanloom.sources import parameters as pr, sam, sequences as sq, tables as tb


def test_sequence_readers(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one\nACGT\nAC\n>y\nGG\n")
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write("@r1 d\nACGT\n+\n!!!!\n@r2\nTT\n+\n!!\n")
    (tmp_path / "c.gfa").write_text("H\tVN:Z:1.0\nS\ts1\tACG\nL\ts1\t+\ts2\t+\t0M\nS\ts2\tTT\n")
    (tmp_path / "a.fa.fai").write_text("x\t6\t7\t4\t5\n")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(sq.read_fasta(spark, str(tmp_path / "a.fa"))) == [("x", "ACGTAC"), ("y", "GG")]
    assert rows(sq.read_fasta(spark, str(tmp_path / "a.fa"), {"y": "new"})) == [("new", "GG")]
    assert rows(sq.read_fastq(spark, str(tmp_path / "b.fq.gz"))) == [("r1", "ACGT"), ("r2", "TT")]
    assert rows(sq.read_gfa(spark, str(tmp_path / "c.gfa"), {"s2": "z"})) == [("s1", "ACG"), ("z", "TT")]
    assert rows(sq.read_fai(spark, str(tmp_path / "a.fa.fai"))) == [("x", 6)]
    with pytest.raises(ValueError, match="missing"):
        sq.read_fasta(spark, str(tmp_path / "a.fa"), ["q"])
    (tmp_path / "d.fa").write_text(">x\nA\n>x\nC\n")
    with pytest.raises(Exception, match="repeated record"):
        sq.read_fasta(spark, str(tmp_path / "d.fa")).collect()


def test_sam(spark, tmp_path):
    line = lambda name, flag, pos, mapq, cigar: f"{name}\t{flag}\tchr1\t{pos}\t{mapq}\t{cigar}\t*\t0\t0\t*\t*\tRG:Z:g1"
    (tmp_path / "a.sam").write_text("\n".join(["@HD\tVN:1.6", "@SQ\tSN:chr1\tLN:1000", line("q1", 0, 101, 60, "5S10=2X3I10="), line("q1", 4, 0, 0, "*"), line("q1", 16, 11, 5, "10=4D10=10H")]) + "\n")
    lengths = spark.createDataFrame([("q1", 40)], "qry_id string, len long")
    got = {r.align_index: r for r in sam.read_sam(spark, str(tmp_path / "a.sam"), lengths, min_mapq=20).collect()}
    assert set(got) == {0, 2}
    assert (got[0].pos, got[0].end_pos, got[0].qry_pos, got[0].qry_end, got[0].rg, got[0].filter, got[0].is_rev) == (100, 122, 5, 30, "g1", [], False)
    assert (got[2].pos, got[2].end_pos, got[2].qry_pos, got[2].qry_end, got[2].filter, got[2].is_rev) == (10, 34, 20, 40, ["MAPQ"], True)
    assert got[0].score == pytest.approx(20 * 2 - 2 * 4 - 10) and got[0].match_prop == pytest.approx(20 / 22)
    assert [r.value for r in sam.header(spark, str(tmp_path / "a.sam")).collect()] == ["@HD\tVN:1.6", "@SQ\tSN:chr1\tLN:1000"]


def test_assemblies_and_configurations(spark, tmp_path):
    (tmp_path / "assemblies.tsv").write_text("NAME\tHAP_x\tHAP2\tFILTER_a\n a1 \tx.fa\t\tz\na2\t\ty.fa\t\n")
    table = tb.read_assemblies(spark, str(tmp_path / "assemblies.tsv"))
    assert sorted(map(tuple, tb.haplotypes(table).collect())) == [("a1", "x", "x.fa"), ("a2", "h2", "y.fa")]
    (tmp_path / "x.fa").write_text(">x\nA\n")
    (tmp_path / "l.fofn").write_text("# c\nx.fa\n")
    assert tb.expand([str(tmp_path / "l.fofn")]) == [(str(tmp_path / "x.fa"), "fasta")]
    (tmp_path / "l.fofn").write_text("l.fofn\n")
    with pytest.raises(ValueError, match="lists itself"):
        tb.expand([str(tmp_path / "l.fofn")])
    for name, config in (("one", {"alias": "two"}), ("two", {"type": "null"}), ("loop", {"alias": "loop"})):
        (tmp_path / name).mkdir()
        (tmp_path / name / "model.json").write_text(json.dumps(config))
    assert tb.model_config("one", [str(tmp_path)])["type"] == "null"
    with pytest.raises(ValueError, match="aliases"):
        tb.model_config("loop", [str(tmp_path)])
    assert tb.find_assemblies(str(tmp_path)).endswith("assemblies.tsv") and tb.find_config(str(tmp_path)) is None


def test_parameters_and_models():
    got = pr.settings({"inv_min": "5"}, "inv_k_size=21; redundant_callset=yes")
    assert (got["inv_min"], got["inv_k_size"], got["redundant_callset"], got["lg_gap_scale"]) == (5, 21, True, 0.2)
    for bad in ({"lg_gap_scale": 0}, {"aligner": "x"}, {"inv_min": "a"}, {"unknown": 1}):
        with pytest.raises(ValueError):
            pr.settings(bad)
    assert pr.wildcards("{assembly}-{hap}-{k}", [("a", "h1")], k=["1", "2"]) == ["a-h1-1", "a-h1-2"] and "inv_min" in pr.help_text()
    model = al.Affine.parse("affine::1,mismatch=3,gap=5:2;20:1,ts=100bp,off_var=3")
    assert (model.match, model.mismatch, model.gaps, model.template_switch(2), model.off_variant) == (1.0, 3.0, ((5.0, 2.0), (20.0, 1.0)), -240.0, 3.0)
    assert al.Affine.parse(model.spec()) == al.Affine(1.0, 3.0, ((5.0, 2.0), (20.0, 1.0)), -120.0, 3.0)
    assert gr.anchor_score("50bp") == 100.0 and al.Affine().template_switch() == -74.0
    for bad in ("x::1", "affine::match=1,2", "affine::gap=1"):
        with pytest.raises(ValueError):
            al.Affine.parse(bad)


def test_float_score(spark):
    ops = spark.createDataFrame([(1, 1, 7, 12_707_018)], "align_index long, op_index long, op_code int, op_len int")
    assert dict(al.features(ops).dtypes)["score"] == "float" and al.features(ops).first().score == 25_414_036.0


def test_range_join_of_one_very_long_interval(spark):
    r = random.Random(1)
    rows = [(i, "c", p, p + r.randint(0, 300)) for i, p in enumerate(r.randrange(3_000_000) for _ in range(300))] + [(999, "c", 0, 50_000_000), (1000, "c", 100_000, 900_000)]
    df = spark.createDataFrame(rows, "i long, chrom string, pos long, end_pos long")
    got = sorted((x.l_i, x.r_i) for x in iv.range_join(df, df, "chrom").collect())
    end = lambda a: max(a[3], a[2] + 1)
    assert got == sorted((a[0], b[0]) for a in rows for b in rows if a[2] < end(b) and b[2] < end(a))


def test_trimming_of_two_records():
    left = {"align_index": 0, "chrom": "c", "pos": 0, "end_pos": 100, "qry_id": "q", "qry_pos": 0, "qry_end": 100, "is_rev": False, "score": 200.0, "failing": False, "ops": [(7, 100)]}
    right = {"align_index": 1, "chrom": "c", "pos": 500, "end_pos": 580, "qry_id": "q", "qry_pos": 90, "qry_end": 170, "is_rev": False, "score": 100.0, "failing": False, "ops": [(7, 5), (8, 5), (7, 70)]}
    inner = dict(right, align_index=2, qry_pos=20, qry_end=30, ops=[(7, 10)], pos=700, end_pos=710, score=20.0)
    kept = sorted(tm.trim_rows([left, right, inner], True), key=lambda x: x["align_index"])
    assert [x["align_index"] for x in kept] == [0, 1] and kept[0]["qry_end"] <= kept[1]["qry_pos"]
    for x in kept:
        assert sum(n for c, n in x["ops"] if c in (7, 8, 1)) == x["qry_end"] - x["qry_pos"] and sum(n for c, n in x["ops"] if c in (7, 8, 2)) == x["end_pos"] - x["pos"]


def test_trimming_leaves_no_overlap():
    def row(i, pos, qry, ops, score=0.0, is_rev=False, failing=False, chrom="c"):
        size = lambda codes: sum(n for c, n in ops if c in codes)
        return {"align_index": i, "chrom": chrom, "pos": pos, "end_pos": pos + size((7, 8, 2)), "qry_id": "q", "qry_pos": qry, "qry_end": qry + size((7, 8, 1)), "is_rev": is_rev, "score": score, "failing": failing, "ops": ops}

    cases = {
        "a pair of operations that can't part them scores highest": ([row(0, 0, 183, [(1, 43), (8, 2)], -75.0), row(1, 900, 218, [(8, 2), (8, 29), (2, 4), (7, 19)], -227.0, chrom="d")], [0, 1]),
        "the failing one has too few aligned bases": ([row(0, 0, 395, [(2, 24), (8, 10), (8, 9)], -124.0), row(1, 900, 404, [(1, 28), (8, 1)], -56.0, True, True)], [0, 1]),
        "nothing parts them": ([row(0, 0, 0, [(1, 50), (7, 3), (1, 20)], 9.0), row(1, 900, 20, [(1, 25), (7, 2), (1, 50)], 5.0, chrom="d")], [0]),
        "nothing parts them, and the better one fails": ([row(0, 0, 0, [(1, 50), (7, 3), (1, 20)], 9.0, failing=True), row(1, 900, 20, [(1, 25), (7, 2), (1, 50)], 5.0)], [1]),
    }
    r = random.Random(5)
    for k in range(300):
        ops = lambda: [(r.choice((7, 7, 8, 1, 2)), r.randint(1, 12)) for _ in range(r.randint(1, 5))]
        cases[k] = ([row(i, r.randint(0, 60), r.randint(0, 60), ops(), float(r.randint(-9, 9)), r.random() < 0.5, r.random() < 0.3, r.choice("cd")) for i in range(6)], None)
    for name, (rows, stay) in cases.items():
        for by_query, a, b, key in ((True, "qry_pos", "qry_end", "qry_id"), (False, "pos", "end_pos", "chrom")):
            kept = tm.trim_rows(rows, by_query)
            assert stay is None or not by_query or sorted(x["align_index"] for x in kept) == stay, name
            assert not [1 for x in kept for y in kept if x["align_index"] < y["align_index"] and x[key] == y[key] and x[a] < y[b] and y[a] < x[b]], name
            for x in kept:
                assert sum(n for c, n in x["ops"] if c in (7, 8, 1)) == x["qry_end"] - x["qry_pos"] and sum(n for c, n in x["ops"] if c in (7, 8, 2)) == x["end_pos"] - x["pos"], name


def test_densities_and_hidden_states():
    import numpy as np

    ones = (np.arange(400) % 7 == 0).astype(float)
    w = inv.kernel(10, 3)
    assert np.allclose(inv.density(ones, w), np.convolve(ones, w)[30:-30]) and abs(w.sum() - 1) < 1e-12
    assert list(dict.fromkeys(inv.viterbi(np.array([0] * 60 + [2] * 60 + [0] * 60)).tolist())) == [0, 5, 4]
    assert list(dict.fromkeys(inv.viterbi(np.array([0] * 60 + [1] * 60 + [2] * 60 + [1] * 60 + [0] * 60)).tolist())) == [0, 1, 2, 3, 4]
    assert inv.binomial_p(3, 1) == pytest.approx(2 / 16) and inv.run_test([(0, 50), (2, 30), (0, 9)]) == 0.0


def test_smooth_trace():
    seg = lambda p, e, f, r, i: {"pos": p, "end_pos": e, "fwd_count": f, "rev_count": r, "seg_index": [i]}
    got = gr.smooth([seg(0, 3, 1, 0, 0), seg(3, 103, 2, 0, 1), seg(103, 105, 0, 0, 2), seg(105, 205, 1, 1, 3), seg(205, 206, 1, 0, 4)], 100)
    assert [(x["pos"], x["end_pos"], x["seg_index"]) for x in got] == [(3, 104, [1, 2]), (104, 205, [3, 2])]
    assert gr.smooth([seg(0, 1, 1, 0, 0)], 100) == []


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("c", 5, "v1", "A", "C", ".", "PASS", "X=1"), ("b", 9, None, "A", "C", ".", "PASS", "")], "`#CHROM` string, POS long, ID string, REF string, ALT string, QUAL string, FILTER string, INFO string")
    lines = [r.value for r in sinks.vcf_lines(rows, vcf.headers("20260101", "s", "/x/ref.fa", [("c", 10, "m")])).collect()]
    assert lines[0].startswith("##fileformat=VCFv4.5") and "##reference=file://ref.fa" in lines and lines[-2].startswith("b\t9\t.") and lines[-1].startswith("c\t5\tv1")
    sinks.write_vcf(rows, ["##x"], str(tmp_path / "v"))
    sinks.write_bed(rows.withColumnRenamed("#CHROM", "chrom"), ["chrom", "POS"], str(tmp_path / "b"))
    sinks.write_parquet(rows.withColumnRenamed("#CHROM", "chrom"), str(tmp_path / "p"), ["chrom"])
    assert spark.read.text(str(tmp_path / "v")).count() == 4 and spark.read.parquet(str(tmp_path / "p")).count() == 2
    twice = spark.createDataFrame([("x", "A"), ("x", "C")], "name string, bases string")
    with pytest.raises(Exception, match="repeated record"):
        sinks.fasta_lines(twice).collect()
    assert "uint pos" in sinks.auto_sql("t", {"pos": ("uint", "Place")}) and vcf.haplotype_order("b,a", ["a", "b"]) == ["b", "a"]


def test_table_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "align_index long, x string")
    assert {(r.what, r.name, r.n) for r in fr.violations(df).collect()} == {("repeated key", "1", 2), ("null", "x", 1)}
    with pytest.raises(ValueError, match="invalid table"):
        fr.check(df)
    with pytest.raises(ValueError, match="missing columns"):
        fr.require(df, ["y"])
    ops = spark.createDataFrame([(1, 1, 3, 5)], "align_index long, op_index long, op_code int, op_len int")
    with pytest.raises(Exception, match="moves neither"):
        al.with_offsets(ops).collect()
    only = al.pack(spark.createDataFrame([(1, 1, 4, 5), (1, 2, 1, 3)], "align_index long, op_index long, op_code int, op_len int"))
    with pytest.raises(Exception, match="no aligned operations"):
        al.normalise_clipping(only).select(F.explode("ops")).collect()
