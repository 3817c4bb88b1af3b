"""Small cases of what showed on larger tables only."""

from pyspark.sql import functions as F

from spanloom.functions import sequences as sq
from spanloom.operators import aligned as al, graph as gr, intervals as iv, inversions as inv, trim as tm, variants as va


def test_segments_of_one_position_are_in_order_of_their_ends(spark):
    rows = spark.createDataFrame([("q", 5, 128, "NML"), ("q", 5, 54, "NML"), ("q", 1, 9, "DEL")], "qry_id string, pos long, end_pos long, type string")
    assert gr.ref_trace_text(rows, ["qry_id"]).first().trace_ref == "DEL[8]:NML[49]:NML[123]"


def odd_sequences(spark):
    rows = [("a", "ACGTTGCAAC" * 9), ("b", "ACGTNACGTTACGNNNACGTTTTTACGACGTAGCATCAGT" * 4), ("c", None), ("d", ""), ("e", "ACG"), ("f", "ACGé" + "ACGTACGATTTACG" * 3), (None, "ACGTACGTAC"), ("g", "acgtACGTACGA"), ("h", "ACGTAGGCTATTCGAGGACTTTACG"), ("h", "GGCTATTCGAGGA")]
    return spark.createDataFrame(rows, "name string, bases string")


def test_kmers_and_their_counts_are_those_of_pieces(spark):
    seqs = odd_sequences(spark)
    for k in (1, 4, 5, 31, 33):
        want = sq.spread_kmers(seqs, k)
        assert sorted(map(tuple, sq.kmers(seqs, k).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        low = want.select("name", "index", F.least("kmer", sq.reverse_complement(F.col("kmer"))))
        assert sorted(map(tuple, sq.kmers(seqs, k, canonical=True).collect()), key=str) == sorted(map(tuple, low.collect()), key=str)
        assert sorted(map(tuple, sq.kmer_counts(seqs, k).collect())) == sorted(map(tuple, want.groupBy("kmer").count().collect()))
    assert "Exchange" not in sq.kmers(seqs, 5)._jdf.queryExecution().executedPlan().toString()


def test_states_in_one_task_are_those_of_joined_kmers(spark, monkeypatch):
    seqs = odd_sequences(spark)
    query = seqs.select("name", F.concat(F.substring("bases", 1, 20), sq.reverse_complement(F.substring("bases", 21, 20))).alias("bases"), (F.col("name") > "d").alias("rev"))
    for reverse in (None, "rev"):
        got = [inv.states(seqs, query, 5, 6, reverse=reverse), inv.state_densities(seqs, query, 5, 6, reverse=reverse, bandwidth=2.0), inv.state_runs(seqs, query, 5, 6, reverse=reverse, bandwidth=2.0)]
        got = [sorted(map(tuple, x.collect()), key=str) for x in got]
        far = inv.spread_states(seqs, query, 5, 6, "name", "bases", reverse)
        assert got[0] and got[0] == sorted(map(tuple, far.collect()), key=str)
        with monkeypatch.context() as m:
            m.setattr(inv, "WHOLE", 0)
            far = [inv.states(seqs, query, 5, 6, reverse=reverse), inv.state_densities(seqs, query, 5, 6, reverse=reverse, bandwidth=2.0), inv.state_runs(seqs, query, 5, 6, reverse=reverse, bandwidth=2.0)]
            names = [x for x, _ in got[1:] and [(r[0], 0) for r in got[0]]]
            single = {n for n in names if n != "h"}  # a name with two sequences has k-mers at one place, in any order
            for a, b in zip(got, [sorted(map(tuple, x.collect()), key=str) for x in far]):
                assert [r for r in a if r[0] in single] == [r for r in b if r[0] in single]


def test_bases_beside_rows_are_those_that_are_fetched(spark):
    bases = "".join("ACGT"[i * i % 7 % 4] for i in range(100))
    seqs = spark.createDataFrame([("a", bases), ("b", bases[::-1]), ("é", "ACGé" * 12)], "name string, bases string")
    rows = spark.createDataFrame([(i, n, a, a + m) for i, (n, a, m) in enumerate((n, a, m) for n in ("a", "b", "é", "z", None) for a in (-3, 0, 7, 8, 15, 40, 95, 200) for m in (0, 1, 8, 9, 30))], "i int, name string, pos long, end_pos long")
    want = dict(map(tuple, sq.fetch(rows, seqs, "i").collect()))
    for size in (8, 512):
        for how in ("inner", "left"):
            made = sq.with_bases(rows, [seqs.where("name = 'b'"), seqs.where("name <> 'b'")], F.when(F.col("name") == "b", 0).otherwise(1), F.col("name"), F.col("pos"), F.col("end_pos"), F.col("i"), "out", how, size, min(size, 64))
            got = {r.i: r.out for r in made.collect()}
            assert len(got) == (rows.count() if how == "left" else made.count()) and {i: x for i, x in got.items() if x} == {i: x for i, x in want.items() if x}


def test_variants_send_each_operation_once(spark):
    ops = spark.createDataFrame([(1, 1, 1, 2, 0, 0, "a", 0, "a", False, 9)], "align_index long, op_index long, op_code int, op_len int, ref_off long, qry_off long, chrom string, pos long, qry_id string, is_rev boolean, qry_len long")
    seqs = spark.createDataFrame([("a", "ACGTACGTA")], "name string, bases string")
    plan = va.insdels(ops, seqs, seqs)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("Join") == 1 and [r.seq for r in va.insdels(ops, seqs, seqs).collect()] == ["AC"]


def test_matches_are_expanded_without_a_row_for_each_base(spark):
    rows = [(1, 1, 0, 5, "ACGTA", "acctt"), (1, 2, 7, 3, "AAA", "CCC"), (1, 3, 0, 4, "ACGT", "AC"), (2, 1, 0, 2, "AC", "ACGT"), (2, 2, 0, 1, "", ""), (3, 1, 0, 3, "AéC", None)]
    pieces = spark.createDataFrame(rows, "align_index long, op_index long, op_code int, op_len int, ref_piece string, qry_piece string")
    made = al.expand_matches(pieces)
    assert "Window" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, made.collect())) == [(1, 1, 1, 7, 2), (1, 1, 2, 8, 1), (1, 1, 3, 7, 1), (1, 1, 4, 8, 1), (1, 2, 1, 7, 3), (1, 3, 1, 7, 2), (1, 3, 2, 8, 2), (2, 1, 1, 7, 2), (2, 1, 2, 8, 2)]


def test_overlaps_are_counted_as_they_are_joined(spark):
    rows = [("ab"[i % 2], i * i % 61, i * i % 61 + i % 9, f"x{i % 37}") for i in range(150)] + [(None, 1, 5, "x"), ("a", None, 5, "y"), ("a", 1, 50, None), ("a", 1, None, "z")]
    df = spark.createDataFrame(rows, "chrom string, pos long, end_pos long, iv_id string")
    whole = df.where("end_pos is not null")
    want = iv.range_join(whole, whole, "chrom").where("l_iv_id < r_iv_id").count()
    made = iv.overlap_count(df, "chrom", "iv_id")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert want > 500 and made.first().n == want and "sequence(" not in plan
    assert iv.overlap_count(df.where("false"), "chrom", "iv_id").first().n == 0


def test_groups_of_overlaps_are_trimmed_in_batches(spark):
    rows = [{"align_index": i, "chrom": f"c{i % 3}", "pos": 10 * i, "end_pos": 10 * i + 20, "qry_id": f"q{i % 5}", "qry_pos": 7 * (i // 5), "qry_end": 7 * (i // 5) + 20, "is_rev": i % 2 == 0, "score": float(i % 11), "failing": i % 4 == 0, "ops": [(7, 12), (8, 3), (7, 5)]} for i in range(40)]
    schema = "align_index long, chrom string, pos long, end_pos long, qry_id string, qry_pos long, qry_end long, is_rev boolean, score double, failing boolean, ops array<struct<op_code:int,op_len:int>>"
    df = spark.createDataFrame([tuple(x.values()) for x in rows], schema)
    made = tm.trim(df, True)
    assert "FlatMapGroups" not in made._jdf.queryExecution().optimizedPlan().toString()
    want = [tuple(x[c] for c in df.columns) for q in range(5) for x in tm.trim_rows([r for r in rows if r["qry_id"] == f"q{q}"], True)]
    assert sorted((*tuple(r)[:-1], [tuple(o) for o in r.ops]) for r in made.collect()) == sorted((*x[:-1], x[-1]) for x in want)
