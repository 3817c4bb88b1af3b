"""The operators that SQL can't express, against plain versions written from their definitions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import bpe, decontaminate, edits, html, langid, quality, secrets
from spanloom.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_secrets_are_those_of_all_parts(spark):
    """Every part of every run, scored character by character."""
    automata = secrets.learn(secrets.labelled_credentials())
    r = random.Random(4)
    held = [run for _, run in secrets.labelled_credentials(4, seed=5)]
    texts = [" ".join(r.choice(["{}", "key={}", "{}.", "a/{}/b", "x {}-tail", "{}=={}"]).format(r.choice(held), r.choice(held)) for _ in range(3)) for _ in range(60)]
    texts += [texts[0], "short=ab", "a.b.c", "=" * 20, ""]

    def loglike(a, part):
        total, state = 0.0, 0
        for c in part:
            total, state = total + a.logp[state, secrets._CODE[c]], a.follow[state, secrets._CODE[c]]
        return total + a.logp[state, secrets.END]

    def plain(text):
        found, i = [], 0
        while i < len(text):
            if text[i] not in secrets.ALPHABET:
                i += 1
                continue
            j = i
            while j < len(text) and text[j] in secrets.ALPHABET:
                j += 1
            starts = [k for k in range(i, j) if k == i or text[k - 1] in secrets.SEPARATORS]
            stops = [k for k in range(i + 1, j + 1) if k == j or text[k] in secrets.SEPARATORS]
            for a in starts:
                for b in stops:
                    for f, auto in enumerate(automata[:-1]):
                        if b > a and (s := loglike(auto, text[a:b])) > -np.inf:
                            score = s - max(loglike(automata[-1], text[a:b]), -1e6)
                            if score >= secrets.MARGIN:
                                found.append((-round(score, 9), a - b, a, f))
            i = j
        taken, out = set(), []
        for score, n, a, f in sorted(found):
            if taken.isdisjoint(range(a, a - n)):
                taken.update(range(a, a - n))
                out.append((a, a - n, automata[f].name, -score))
        return out

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted((x.doc_id, x.start, x.end, x.format, round(x.score, 5)) for x in secrets.scan(docs, automata).collect())
    assert got == sorted((i, a, b, f, round(s, 5)) for i, t in enumerate(texts) for a, b, f, s in plain(t)) and len(got) > 100


def test_tiles_are_those_of_a_search_of_all_matches():
    """Greedy string tiling by its definition: at each step the longest match of unmarked words, the first in document, then in item."""

    def plain(doc, item, least):
        used_d, used_i, out = [False] * len(doc), [False] * len(item), []
        while True:
            best = None
            for a in range(len(doc)):
                for b in range(len(item)):
                    n = 0
                    while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and not used_d[a + n] and not used_i[b + n]:
                        n += 1
                    if n >= least and (best is None or (-n, a, b) < best):
                        best = (-n, a, b)
            if best is None:
                return out
            n, a, b = -best[0], best[1], best[2]
            used_d[a : a + n], used_i[b : b + n] = [True] * n, [True] * n
            out.append((n, a, b))

    r = random.Random(8)
    for _ in range(150):
        doc, item = ([r.randrange(4) for _ in range(r.randrange(30))] for _ in range(2))
        for least in (2, 3):
            assert decontaminate.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), least) == plain(doc, item, least)


def test_decontamination_of_hot_and_long_texts_and_clashing_names(spark):
    """Both ways, on an item that a third of the documents hold, a very long one, and columns named as the operator's own."""
    r = random.Random(2)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 6)))
    items = [" ".join(word() for _ in range(n)) for n in (2, 3, 12, 30)]
    texts = [" ".join(word() for _ in range(50)) + (" " + items[k % 4] if k % 3 == 0 else "") for k in range(60)]
    halves = items[3].split()
    texts += [" ".join(halves[15:]) + " middle of it " + " ".join(halves[:15]), " ".join(word() for _ in range(100_000)) + " " + items[2], None, ""]
    docs = spark.createDataFrame([(k, t, "x", "y", k) for k, t in enumerate(texts)], "doc_id bigint, text string, key string, item string, gone bigint")
    tests = spark.createDataFrame([(k, t, "z", 1.0) for k, t in enumerate(items)] + [(9, items[2], "z", 1.0)], "item_id bigint, text string, key string, coverage double")
    rows = lambda **k: sorted(map(tuple, decontaminate.contaminated(docs, tests, **k).collect()))
    got = rows()
    assert got == rows(broadcast_mb=0)
    assert {(k, k % 4) for k in range(0, 60, 3)} | {(60, 3), (61, 2), (61, 9)} <= {(d, i) for d, i, _ in got}
    assert decontaminate.keep_clean(docs, tests).columns == docs.columns


def test_ordinal_fit_is_where_its_gradient_vanishes():
    """Numeric derivatives of the penalised likelihood, by its definition, at the fitted thresholds and weights."""
    r = np.random.default_rng(3)
    n, words = 400, 6
    x = r.random((n, words)) < 0.4
    score = x @ np.array([2.0, -2.0, 1.0, 0.0, 0.0, 1.5]) + r.logistic(size=n)
    grade = np.digitize(score, [0.0, 2.0])
    hashes = np.concatenate([np.flatnonzero(row).astype(np.uint64) + 1 for row in x])
    bounds = np.concatenate([[0], np.cumsum(x.sum(1))])
    penalty = 0.05
    model = quality.fit(hashes, bounds, grade, steps=3000, penalty=penalty, again=0.0)
    w = np.zeros(words)
    w[model.keys.astype(int) - 1] = model.weights

    def loss(w, cut):
        s = x @ w
        edges = np.concatenate([[-np.inf], cut, [np.inf]])
        logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return -np.mean(np.log(logistic(edges[grade + 1] - s) - logistic(edges[grade] - s)))

    shrink = penalty / np.sqrt(n)
    for k in range(words):
        step = np.eye(words)[k] * 1e-5
        g = (loss(w + step, model.thresholds) - loss(w - step, model.thresholds)) / 2e-5
        assert abs(g + shrink * np.sign(w[k])) < 2e-3 if w[k] else abs(g) <= shrink + 2e-3
    for k in range(2):
        step = np.eye(2)[k] * 1e-5
        assert abs(loss(w, model.thresholds + step) - loss(w, model.thresholds - step)) / 2e-5 < 2e-3


def test_quality_of_repeated_rows_ties_and_clashing_labels(spark):
    docs = spark.createDataFrame([(k, t, 0.5, "x") for k, t in [(1, "good plain words here"), (1, "good plain words here"), (2, "!!! $$$ !!!"), (None, "good plain words here"), (3, None)]], "doc_id bigint, text string, tail_prob double, grade string")
    labels = spark.createDataFrame([(1, 1, 0, "a"), (1, 0, 0, "b"), (2, 0, 0, "c"), (3, None, 0, "d"), (None, 1, 0, "e")], "doc_id bigint, quality int, toxic int, text string")
    assert {(x.doc_id, x.grade) for x in quality.graded(labels).collect()} == {(1, 0), (2, 0)}
    model = quality.train(docs, quality.graded(labels))
    out = quality.score(docs, model).collect()
    assert len(out) == 5 and len({(x.expected_grade, x.tail_prob) for x in out if x.doc_id == 1}) == 1
    assert quality.keep_good(docs, model).columns == docs.columns


def test_words_of_code_switched_texts(spark):
    """Held-out words of two languages in turns: the share that gets its own language."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    field = langid.train(docs.where("doc_id % 2 = 0"))
    r = random.Random(6)
    by = {}
    for x in docs.where("doc_id % 2 = 1 and length(text) between 200 and 3000").select("lang", "text").orderBy("doc_id").collect():
        by.setdefault(x.lang, []).append([w for w in x.text.split() if w.isalpha()])
    texts, truth = [], []
    for k in range(60):
        words, spans, at = [], [], 0
        for _ in range(6):
            lang = r.choice(sorted(by))
            own = r.choice(by[lang])
            first = r.randrange(max(1, len(own) - 20))
            for w in own[first : first + r.randint(8, 20)]:
                words.append(w)
                spans.append((at, at + len(w), lang))
                at += len(w) + 1
        texts.append(" ".join(words))
        truth.append(spans)
    rows = {x.doc_id: x for x in langid.label(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), field).collect()}
    right = total = 0
    for k, spans in enumerate(truth):
        labelled = [(s["start"], s["end"], s["lang"]) for s in rows[k].spans]
        for a, b, lang in spans:
            total += 1
            right += any(x <= a and b <= y and z == lang for x, y, z in labelled)
    assert right >= 0.95 * total


def test_bpe_encode_and_decode_by_themselves(spark):
    texts = [(1, "Hello, wörld 😀"), (1, ""), (None, None), (2, "a" * 5000), (3, "<|im_start|>\u0000\n\n  x")]
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts], "doc_id bigint, text string, token_ids string")
    ids = bpe.encode(docs)
    back = bpe.decode(ids, to="token_text").collect()
    assert sorted((str(x.doc_id), str(x.token_text)) for x in back) == sorted((str(k), str(t)) for k, t in texts)
    bad = spark.createDataFrame([([0, 10**6],), ([-1],), ([1, None],)], "token_ids array<int>")
    for x in range(3):
        with pytest.raises(Exception):
            bpe.decode(spark.createDataFrame([bad.collect()[x]], bad.schema)).collect()
    assert bpe.decode(spark.createDataFrame([(None,)], bad.schema)).first().text is None


def test_html_is_that_of_a_plain_recursive_renderer():
    """Random trees of blocks, inline elements and hidden ones, rendered from their definition."""
    r = random.Random(12)

    def tree(deep):
        kind = r.choice(["div", "p", "span", "b", "hidden", "script", "text", "text"]) if deep else "text"
        if kind == "text":
            return ("text", "".join(r.choices("abc", k=3)))
        return (kind, [tree(0 if kind == "p" and r.random() < 0.5 else deep - 1) for _ in range(r.randint(1, 3))] if kind != "p" else [tree(0) for _ in range(2)])

    def source(node):
        kind, inner = node
        if kind == "text":
            return inner
        body = "".join(map(source, inner))
        return {"hidden": f"<div hidden>{body}</div>", "script": f"<script>{body.replace('<', '')}</script>"}.get(kind, f"<{kind}>{body}</{kind}>")

    def plain(node, out):
        kind, inner = node
        if kind == "text":
            out.append(inner)
        elif kind not in ("hidden", "script"):
            gap = {"p": 2, "div": 1}.get(kind, 0)
            out.append(gap)
            for x in inner:
                plain(x, out)
            out.append(gap)

    def text(node):
        out, made, due = [], "", 0
        plain(node, out)
        for x in out:
            if isinstance(x, int):
                due = max(due, x)
            else:
                made += ("\n" * due if made else "") + x
                due = 0
        return made

    for _ in range(300):
        node = ("div", [tree(3) for _ in range(3)])
        assert html.to_text(source(node)) == text(node), source(node)


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls in any column, empty and very long texts, ties and repeats, an empty table, and names that clash."""
    import corpus_pipeline

    long = " ".join(random.Random(1).choices("river stone cloud amber north quiet lamp field paper glass".split(), k=30_000))
    good = [x.text for x in table(spark, SF, "documents").where("length(text) > 200").orderBy("doc_id").limit(12).collect()]
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, gone string"
    rows = [(k, t, None, "s", len(t), "x", None) for k, t in enumerate([*good, good[0], good[0] + " more", long, long, "", " \n "])]
    rows += [(None, good[1], "en", None, None, None, "y"), (None, None, None, None, None, None, None), (3, good[3], "en", "s", 1, "x", "z"), (0, None, None, None, None, None, None)]
    for docs in (spark.createDataFrame(rows, kinds), spark.createDataFrame([], kinds)):
        before, count = docs, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, before, SF)
            n = docs.count()
            assert name == "bpe" or docs.columns == before.columns
            assert n <= count
            before, count = docs, n


def test_pipeline_as_registered(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    docs = table(spark, SF, "documents")
    assert 0 < out.count() < docs.count() and out.join(docs, "doc_id", "left_anti").isEmpty()


def test_a_hot_bucket_holds_all_its_members_together(spark, monkeypatch):
    """Two near texts that meet in one bucket only, with 140 others, and have more buckets of their own."""
    r = random.Random(8)
    texts = ["".join(r.choice("abcdefghij klmnop") for _ in range(300)) for _ in range(142)]
    texts[71] = texts[70][:150] + "z" + texts[70][151:]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = edits.sketches

    def hot(plain, bands):
        own = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.col("key") * 10 + i)
        return made(plain, bands).withColumn("buckets", F.concat(F.array(F.lit(0).cast("long")), own))

    monkeypatch.setattr(edits, "sketches", hot)
    assert [(x.a, x.b) for x in edits.near_pairs(docs).collect()] == [(70, 71)]


def test_workers_give_free_memory_back():
    import os
    from pathlib import Path

    from spanloom.llm import minhash, textkit

    held = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6
    r = random.Random(9)
    col = pa.array([" ".join(r.choice("abcdefghijklmnop") * r.randint(1, 9) for _ in range(400)) for _ in range(4000)])
    before = held()
    for part in textkit.chunks(pa.RecordBatch.from_arrays([col], ["text"]), "text"):
        row, element, weight = minhash.shingles(textkit.words(part.column("text")), 3)
        minhash.signatures(row, element, weight, part.num_rows, 120)
        del row, element, weight
    assert held() - before < 60


def test_short_pairs_are_verified_together_and_exactly(monkeypatch):
    """Shares of texts up to the length of one word's band are exact, and none of them goes through the way for long pairs."""
    r = random.Random(10)
    a, b = [None, "", "x", "ab" * 200], ["x", "x", "X", "ab" * 200]
    for _ in range(1500):
        letters = r.choice(["ab", "abcd", "abcdefghijklmnop", "aé日😀İ"])
        x = "".join(r.choices(letters, k=r.randint(1, 280)))
        share = r.choice([0, 0.04, 0.09, 0.12, 0.3])
        y = "".join(r.choice(["", r.choice(letters), c + r.choice(letters)]) if r.random() < share else c for c in x)
        a.append(x)
        b.append(y[r.choice([0, 0, 5]) :] or x)
    want = []
    for x, y in zip(a, b):
        x, y = (x or "").lower(), (y or "").lower()
        n = max(len(x), len(y), 1)
        distance = edits.edit_distance(x, y)
        want.append(distance / n if x and y and distance <= 0.1 * n else None)
    long, one = [], edits.near_share
    monkeypatch.setattr(edits, "near_share", lambda x, y, most: long.append(max(len(x), len(y), len(x.lower()), len(y.lower()))) or one(x, y, most))
    got = edits.near_shares(a, b, edits.MOST)
    assert [x is None for x in got] == [x is None for x in want] and sum(x is not None for x in want) > 500
    assert all(x == y for x, y, p, q in zip(got, want, a, b) if y is not None and max(len(p.lower()), len(q.lower())) <= edits.TOGETHER)
    assert long and min(long) > edits.TOGETHER
    assert edits.near_shares([], [], edits.MOST) == []


def test_pairs_of_one_passage_are_verified_in_cells(spark):
    """Texts that share a passage are verified in cells, whole or split, and give the groups of all their pairs; keys may have several texts."""
    from spanloom.llm import groups

    r = random.Random(12)
    some = lambda n: "".join(r.choice("abcdefghij klmnop") for _ in range(n))
    passage, texts = some(150), {}
    for k in range(0, 90, 3):
        texts[k] = passage + some(200)
        texts[k + 1] = texts[k][:100] + "Z" + texts[k][101:]
        texts[k + 2] = texts[k + 1][:250] + "YY" + texts[k + 1][252:]
    docs = spark.createDataFrame([*texts.items(), (0, some(350)), (1, None), (2, "")], "key long, text string")
    every = [(a, b, r.random(), a % 4 // 3) for a in texts for b in texts if a < b]
    pairs = spark.createDataFrame(every, "a long, b long, share double, lead long")
    sizes = spark.createDataFrame([(k, len(t)) for k, t in texts.items()], "key long, size long")
    want = {(k + i, k) for k in range(0, 90, 3) for i in (1, 2)}
    for cell, many in ((100, 10**6), (5000, 10**6), (10**6, 100), (10**6, 10**6)):
        found = groups.verified_in_cells(pairs, docs, sizes, lambda a, b: edits.near_shares(a, b, edits.MOST), cell, many).cache()
        assert all(x.value <= edits.MOST and x.a // 3 == x.b // 3 for x in found.collect())
        assert {(x.key, x.lead) for x in groups.components(found.select("a", "b")).collect()} == want
    assert found.count() < 90  # of three near pairs one joins ends that are joined
    assert groups.verified_in_cells(pairs.where("a < 0"), docs, sizes, lambda a, b: edits.near_shares(a, b, edits.MOST)).count() == 0


def test_a_member_is_sent_once_for_the_buckets_of_a_lowest_key(spark):
    """Pairs of members that share several buckets come once, in blocks and across them, and those that share none don't."""
    from spanloom.llm import groups

    sig = lambda k: bytes([255] * 16 + [k % 2] * 16)
    members = {k: [100 + k % 3, 200 + k % 3, 300 + k // 5] for k in range(150)}
    want = {(a, b) for a in members for b in members if a < b and set(members[a]) & set(members[b]) and a // 2 != b // 2}
    for blocks in (1, 3):
        rows = [(7, 1, min(k % blocks, o), max(k % blocks, o), k % blocks, k // 2, k, 100, sig(k), members[k]) for k in members for o in range(blocks)]
        found = groups._compare(spark.createDataFrame(rows, "lead long, part int, lo long, hi long, side long, group long, key long, size long, sig binary, buckets array<long>"), groups.Near(groups.byte_agreement, 0.0)).collect()
        got = [(min(x.a, x.b), max(x.a, x.b)) for x in found]
        assert len(got) == len(set(got)) and set(got) == want and {x.lead for x in found} == {7}
