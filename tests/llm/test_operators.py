"""The ten operators: against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from spanloom.llm import bpe, chat, decontaminate, edits, html, langid, lines, minhash, quality, secrets
from spanloom.llm.groups import bit_agreement
from spanloom.llm.tables import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, key string, bucket string, lang string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and blank texts, a long one, repeated rows, a repeated key, columns named as an operator's own."""
    words = random.Random(1).choices("river stone cloud amber north quiet lamp field paper glass".split(), k=30_000)
    long = " ".join(words)
    rows = [(1, None, "a"), (None, "null key here with words", "b"), (2, "", None), (3, " \n\t ", "c"), (4, long, "d"), (5, long, "d"), (6, "one two three four", "e"), (6, "one two three four", "e"), (6, "another text of that key", "f"), (None, None, None), (7, "x", "g"), (8, "日本語のテキスト ñandú 😀 \u0000 end", "h")]
    return spark.createDataFrame([(k, t, x, x, "en" if k else None, len(t) if t else None) for k, t, x in rows], DOCS)


def none(spark):
    return spark.createDataFrame([], DOCS)


def group_of(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent) if find(x) != x}


@pytest.fixture(scope="module")
def copies(spark):
    """Texts with exact and near copies, and the texts by key."""
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 9))) for _ in range(400)]
    texts = {}
    for i in range(60):
        own = r.choices(vocabulary, k=r.randint(40, 200))
        texts[10 * i] = " ".join(own)
        for j in range(1, 1 + i % 4):
            other = list(own)
            for _ in range(j - 1):
                other[r.randrange(len(other))] = r.choice(vocabulary)
            texts[10 * i + j] = " ".join(other)
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), texts


def test_minhash_finds_the_groups_of_brute_force(copies):
    docs, texts = copies
    keys = list(texts)
    sets = minhash._sets(pa.array(texts.values()), minhash.SHINGLE)
    near = [(keys[i], keys[j]) for i in range(len(keys)) for j in range(i + 1, len(keys)) if minhash.probability_jaccard(*sets[i], *sets[j]) >= minhash.LEAST]
    truth, got = group_of(near), {r.key: r.lead for r in minhash.duplicates(docs).collect()}
    assert sum(got.get(k) == v for k, v in truth.items()) >= 0.9 * len(truth) and set(got) <= set(truth)
    assert minhash.keep_one(docs).count() == len(texts) - len(got)


def test_probability_jaccard_is_that_of_its_definition():
    a, b = {1: 2, 2: 1, 5: 4}, {1: 1, 5: 3, 9: 2}
    want = sum(1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in a.keys() | b.keys()) for x in a.keys() & b.keys())
    sets = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
    assert minhash.probability_jaccard(*sets[0], *sets[1]) == pytest.approx(want)


def test_edits_finds_the_groups_of_brute_force(copies):
    docs, texts = copies
    keys = sorted(texts)
    near = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if abs(len(texts[a]) - len(texts[b])) <= 0.1 * max(len(texts[a]), len(texts[b])) and edits.edit_distance(texts[a], texts[b]) <= 0.1 * max(len(texts[a]), len(texts[b]))]
    found = edits.components(edits.near_pairs(docs))
    truth, got = group_of(near), {r.key: r.lead for r in found.collect()}
    assert sum(got.get(k) == v for k, v in truth.items()) >= 0.9 * len(truth) and set(got) <= set(truth)


@pytest.mark.parametrize("length", [60, 300, 3_000, 20_000, 120_000])
@pytest.mark.parametrize("share, of", [(0.08, "words"), (0.04, "characters"), (0.08, "characters")])
def test_near_copies_of_any_length_share_a_bucket(length, share, of):
    if length == 60 and of == "words":
        pytest.skip("too few words")
    r = random.Random(length)
    letters, met, pairs = "abcdefghijklmnopqrstuvwxyz", 0, 20
    for _ in range(pairs):
        words = ["".join(r.choices(letters, k=r.randint(2, 9))) for _ in range(length // 6)]
        a = " ".join(words)[:length]
        if of == "words":
            b = " ".join("".join(r.choices(letters, k=len(w))) if r.random() < share else w for w in words)[:length]
        else:
            b = "".join(r.choice(["", r.choice(letters), x + r.choice(letters)]) if r.random() < share else x for x in a)
        first, second = ({part: (sig, values) for part, _, sig, values, _ in edits.embeddings(pa.array([text]))} for text in (a, b))
        met += any((first[k][1] == second[k][1]).any() and bit_agreement(first[k][0], second[k][0])[0] >= edits.LOW for k in first.keys() & second.keys())
    print(length, share, of, met / pairs)
    assert met >= 0.9 * pairs


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    r = random.Random(3)
    for _ in range(200):
        a, b = ("".join(r.choices("abc", k=r.randint(0, 30))) for _ in range(2))
        want, most = plain(a, b), r.randint(0, 20)
        assert edits.edit_distance(a, b) == want and edits.spoiled(a, b, (8, 6, 4)) <= want
        assert edits.edit_distance(a, b, most) == want if want <= most else edits.edit_distance(a, b, most) > most
    for share in (0.02, 0.1, 0.3):
        a = "".join(r.choices("abcd", k=1000))
        b = "".join(r.choice(["", r.choice("abcd"), x + r.choice("abcd")]) if r.random() < share else x for x in a)
        want = plain(a, b)
        for most in (20, 50, 100, 200, want - 1, want, want + 1):
            got = edits.edit_distance(a, b, most)
            assert got == want if want <= most else got > most


@pytest.mark.parametrize("operator", [minhash.duplicates, lambda d: edits.components(edits.near_pairs(d))])
def test_near_copies_on_odd_rows(spark, odd, operator):
    assert {(r.key, r.lead) for r in operator(odd).collect()} == {(5, 4)}
    assert operator(none(spark)).count() == 0


def test_copies_about_a_source_that_is_not_the_lowest_key_join_one_group(spark):
    """60 copies of a text of 300 words with 14 words replaced in each; they are near the text, but not each other."""
    r = random.Random(11)
    vocabulary = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 9))) for _ in range(3000)]
    own = r.choices(vocabulary, k=300)
    texts = {30: " ".join(own)}
    for k in [*range(30), *range(31, 61)]:
        other = list(own)
        for at in r.sample(range(300), 14):
            other[at] = r.choice(vocabulary)
        texts[k] = " ".join(other)
    sets = minhash._sets(pa.array(texts.values()), minhash.SHINGLE)
    near = [(30, k) for k, s in list(zip(texts, sets))[1:] if minhash.probability_jaccard(*sets[0], *s) >= minhash.LEAST]
    got = {x.key: x.lead for x in minhash.duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert len(near) >= 58 and sum(k in got or k == 0 for _, k in near) >= 0.95 * len(near) and set(got.values()) == {0}


def test_lines_as_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert sorted(map(tuple, lines.op8_lines(spark, SF).collect())) == sorted(con.execute(lines.ORACLE).fetchall())


def test_lines_by_filters_that_are_not_broadcast(spark):
    docs = table(spark, SF, "documents")
    rows = lambda **k: sorted(map(tuple, lines.dedup_lines(docs, **k).collect()))
    assert rows() == rows(max_filter_mb=0) == rows(bits_a_line=1)


@pytest.mark.parametrize("mb", [64, 0])
def test_lines_on_odd_rows(spark, odd, mb):
    out = lines.dedup_lines(odd, max_filter_mb=mb)
    assert out.columns == odd.columns and out.count() == odd.count()
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert {(1, None), (None, None), (2, ""), (3, " \n\t "), (5, ""), (None, "null key here with words"), (6, "one two three four")} <= got
    assert lines.dedup_lines(odd, emptied="drop").count() == odd.count() - 1
    assert lines.dedup_lines(none(spark)).count() == 0


def test_tiles_catch_moved_passages():
    doc, item = np.array([9, 9, 4, 5, 6, 7, 9, 1, 2, 3, 9, 9], np.uint64), np.array([1, 2, 3, 8, 4, 5, 6, 7], np.uint64)
    assert sorted(decontaminate.tiles(doc, item, 3)) == [(3, 7, 0), (4, 2, 4)]


def test_decontamination_both_ways_and_odd_rows(spark, odd):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    rows = lambda **k: sorted(map(tuple, decontaminate.contaminated(docs, items, **k).collect()))
    assert rows() == rows(broadcast_mb=0)
    tests = spark.createDataFrame([(1, "one two three four"), (2, None), (3, ""), (None, "null key here with words")], "item_id bigint, text string")
    got = [(r.key, r.item, r.coverage) for r in decontaminate.contaminated(odd, tests).collect()]
    assert sorted(got, key=str) == sorted([(6, 1, 1.0), (6, 1, 1.0), (None, None, 1.0)], key=str)
    assert decontaminate.contaminated(none(spark), tests).count() == 0
    assert decontaminate.contaminated(odd, tests.limit(0)).count() == 0
    clean = decontaminate.keep_clean(odd, tests)
    assert clean.columns == odd.columns and 6 not in {r.doc_id for r in clean.collect()}


def test_bpe_is_that_of_the_vocabulary(spark, odd):
    import base64

    import tiktoken

    with open(bpe.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
    own = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for docs in (odd, table(spark, SF, "documents").select("doc_id", "text")):
        texts = sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
        got = bpe.with_tokens(docs).collect()
        assert sorted((r.doc_id or 0, r.decoded or "") for r in got) == texts
        assert all(r.token_ids is None if r.decoded is None else r.token_ids == own.encode_ordinary(r.decoded) for r in got)
    assert bpe.with_tokens(none(spark)).count() == 0


def test_secrets_held_out(spark, odd):
    automata = secrets.learn(secrets.labelled_credentials())
    held = secrets.labelled_credentials(40, seed=99)
    docs = spark.createDataFrame([(i, f"some words ({run}) and more") for i, (_, run) in enumerate(held)], "doc_id bigint, text string")
    found = {r.doc_id: r.format for r in secrets.scan(docs, automata).collect()}
    real = [i for i, (name, _) in enumerate(held) if name != secrets.ORDINARY]
    plain = [i for i, (name, _) in enumerate(held) if name == secrets.ORDINARY]
    assert sum(i in found for i in real) >= 0.95 * len(real)
    assert sum(i in found for i in plain) <= 0.02 * len(plain)
    assert secrets.scan(odd, automata).count() == 0 and secrets.scan(none(spark), automata).count() == 0


def test_secrets_beside_separators(spark):
    automata = secrets.learn(secrets.labelled_credentials())
    held = [(name, run) for name, run in secrets.labelled_credentials(10, seed=123) if name != secrets.ORDINARY]
    shapes = ["API_KEY={}", "see https://host.example/v1?key={}&x=1", "https://host.example/path/{}", "it was {}.", "a:{}, b", "export TOKEN={}\n"]
    made = [(name, run, shape) for name, run in held for shape in shapes]
    docs = spark.createDataFrame([(i, shape.format(run)) for i, (_, run, shape) in enumerate(made)], "doc_id bigint, text string")
    found = {(r.doc_id, r.start, r.end) for r in secrets.scan(docs, automata).collect()}
    for shape in shapes:
        own = [(i, made[i][2].index("{}"), made[i][2].index("{}") + len(made[i][1])) for i in range(len(made)) if made[i][2] == shape]
        assert sum(x in found for x in own) >= 0.9 * len(own), shape


def test_chats_as_sql_and_odd_rows(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    cols = ["conv_id", "text", "turns", "spans"]
    assert sorted(map(tuple, chat.op7_chat(spark, SF).select(cols).collect())) == sorted(con.execute(f"select {', '.join(cols)} from ({chat.ORACLE})").fetchall())
    turns = spark.createDataFrame([(None, 1, "user", "a"), (None, None, None, None), (1, 1, "assistant", "é"), (1, 1, "assistant", "é"), (1, 0, "user", "")], "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: (r.text, [tuple(s) for s in r.spans]) for r in chat.format_chats(turns).collect()}
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert got[None] == (turn("", "") + turn("user", "a"), [])
    assert got[1][0] == turn("user", "") + 2 * turn("assistant", "é")
    assert [got[1][0].encode()[a:b].decode() for a, b in got[1][1]] == ["é", "é"]
    assert chat.format_chats(turns.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ("<p>a<p>b", "a\n\nb"), ("<ul><li>x<li>y</ul>", "- x\n- y"), ("<ol><li>x<li>y</ol>", "1. x\n2. y"), ("<p>a<script>no()</script>b", "ab"), ("<div hidden>no</div>yes", "yes"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a   | bb\nccc | d"), ("<pre>a\n  b</pre>", "a\n  b"), ("a &amp; b &nope;", "a & b &nope;"), ("a<br>b", "a\nb"), ("<p style='display: none'>x</p>y<!-- z", "y"), ("", ""), (None, None),
])
def test_html(page, text):
    assert html.to_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td>a</td></tr><p>rest<p>of the page</body>", "rest\n\nof the page\n\na"), ("<div><table><tr><td>a</td></tr></div>tail", "tail\n\na"), ("<table><form><tr><td>a<td>b</tr></form></table>", "a | b"),
    ("<table><tr><form><td>a</td></form></tr></table>", "a"), ("<table><div>text</div><tr><td>a</table>", "text\n\na"), ("<table>stray<tr>more<td>a</td></tr></table>z", "straymore\n\na\n\nz"), ("<table><tr><div>x<td>a<td>b</table>", "x\n\na | b"),
    ("<table><tr><td><table><tr><td>in<p>p</table>out</table>", "in p out"), ("<table><tr><td>a<table><tr><b>bold</b><td>c</table></table>", "abold c"), ("<table><colgroup><col>x<tr><td>a</table>", "x\n\na"),
])
def test_html_keeps_what_stands_in_a_table_but_in_no_cell(page, text):
    assert html.to_text(page) == text


def test_html_on_odd_rows(spark):
    pages = spark.createDataFrame([(None, None, "u"), (1, "<p>" * 5000 + "deep", "u"), (1, "<b>x", "v")], "page_id bigint, html string, text string")
    assert sorted((str(r.page_id), str(r.text)) for r in html.extract(pages).collect()) == [("1", "deep"), ("1", "x"), ("None", "None")]
    assert html.extract(pages.limit(0)).count() == 0


def test_quality_held_out(spark, odd):
    docs, grades = table(spark, "/root/testdata/sf0.01", "documents"), quality.graded(table(spark, "/root/testdata/sf0.01", "labels"))
    model = quality.train(docs, grades.where("doc_id % 3 <> 0"))
    held = quality.score(docs, model).join(grades.where("doc_id % 3 = 0"), "doc_id").collect()
    assert np.mean([r.keep == (r.grade == 2) for r in held]) >= 0.9
    assert (np.diff(model.thresholds) >= 0).all()
    got = {(r.doc_id, r.expected_grade, r.keep) for r in quality.score(odd, model).collect()}
    assert {(1, 0.0, False), (2, 0.0, False), (3, 0.0, False), (None, 0.0, False)} <= got
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns and quality.keep_good(none(spark), model).count() == 0
    assert quality.train(docs, grades.limit(0)).scores(np.zeros(0, np.uint64), np.zeros(1, np.int64)).shape == (0,)


def test_langid_held_out(spark, odd):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    field = langid.train(docs.where("doc_id % 2 = 0"))
    rows = docs.where("doc_id % 2 = 1").select("doc_id", "lang", "text")
    got = langid.label(rows.select("doc_id", "text"), field).withColumnRenamed("lang", "found").join(rows, "doc_id").where("length(text) > 20").collect()
    assert np.mean([r.found == r.lang for r in got]) >= 0.95
    out = langid.label(odd, field).collect()
    assert len(out) == 12 and {(r.doc_id, r.lang, len(r.spans)) for r in out} >= {(1, None, 0), (2, None, 0), (3, None, 0)}
    assert langid.label(none(spark), field).count() == 0 and langid.train(none(spark)).labels == ["und"]


def test_forward_backward_is_brute_force():
    from itertools import product

    r = np.random.default_rng(0)
    e, moves, begin = r.normal(size=(4, 3)).astype(np.float32), r.normal(size=(3, 3)).astype(np.float32), r.normal(size=3).astype(np.float32)
    want = np.zeros((4, 3))
    for path in product(range(3), repeat=4):
        p = np.exp(begin[path[0]] + sum(e[i, c] for i, c in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for i, c in enumerate(path):
            want[i, c] += p
    assert np.allclose(langid.forward_backward(e, np.array([0, 4]), moves, begin), want / want.sum(1, keepdims=True), atol=1e-4)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert name == "bpe" or docs.columns == columns
    assert 0 < docs.count() < 200
