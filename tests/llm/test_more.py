"""Clashing names, hot groups, exact replays, empty tables, the pipeline."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from test_operators import _groups, _removed, _shingles

import corpus_pipeline
from eddy.llm import cdc_dedup, html_extract, licenses, mixing, ngram_jaccard, nn_descent, suffix_dedup, toxicity
from eddy.llm.common import in_table, key_table
from eddy.session import read_table

SF = "/root/testdata/sf0.001"
NAMES = ("_text _ord _row _low _dkey _md5 _later _spans _doc_id _size _source _hash _bucket _tie _s _b target taken source_size "
         "_id _tkey id key row gone_id gone_key rid set_id n b p i j own first digest any component_id").split()


@pytest.fixture(scope="module")
def clashing(spark):
    rnd = random.Random(3)
    base = [" ".join(f"w{rnd.randint(0, 500)}" for _ in range(rnd.choice([3, 30, 60]))) for _ in range(10)]
    rows = [(i, rnd.choice(base) + rnd.choice(["", " end", " other end"]), rnd.choice("abc")) for i in range(40)]
    rows += [(40, None, None), (None, base[0], "a"), (41, "", "b"), (7, rows[7][1], "a"), (7, "another text", "a")]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return plain, plain.select("*", *[F.lit(f"<{n}>").alias(n) for n in NAMES])


def test_names_of_columns_do_not_matter(clashing):
    plain, wide = clashing
    for op in (suffix_dedup.dedup, ngram_jaccard.keep_first, mixing.mixed):
        a, b = op(plain), op(wide)
        assert b.columns == wide.columns
        assert sorted(map(str, b.select(plain.columns).collect())) == sorted(map(str, a.collect())), op
        assert all(r[n] == f"<{n}>" for r in b.collect() for n in NAMES)
        assert op(wide.limit(0)).count() == 0
    assert sorted(map(str, mixing.mixed(wide.repartition(4)).collect())) == sorted(map(str, mixing.mixed(wide).collect()))


def test_tiles_in_blocks(spark, monkeypatch):
    """Every member through tiles, tiles in blocks, one group with blocks of its own."""
    rnd = random.Random(9)
    one = [f"v{rnd.randint(0, 90)}" for _ in range(40)]
    rows = []
    for _ in range(90):
        w = list(one)
        for _ in range(rnd.choice([0, 1, 1, 2, 6, 12])):
            w[rnd.randrange(40)] = f"z{rnd.randint(0, 5)}"
        rows.append((len(rows), " ".join(w)))
    sets = [_shingles(t) for _, t in rows]
    want = _groups(sets, lambda a, b: 100 * len(a & b) >= 75 * len(a | b))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_jaccard, "FEW", 1)
    monkeypatch.setattr(ngram_jaccard, "STARS", 1)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 3)
    assert {r.doc_id: r.component_id for r in ngram_jaccard.groups(df).collect()} == dict(enumerate(want))


def test_block_pairs_meet_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 4)
    rows = [(1, 0, 7 if i < 20 else i, i) for i in range(33)] + [(2, 0, i, i) for i in range(3)]
    frame = spark.createDataFrame(rows, "token long, band int, root long, set_id long")
    got = ngram_jaccard._blocks(frame).collect()
    for t, n in ((1, 33), (2, 3)):
        mine = [r for r in got if r.token == t]
        meet = {}
        for x in mine:
            for y in mine:
                if (x.i, x.j) == (y.i, y.j) and x.set_id < y.set_id and (x.i == x.j or x.b != y.b):
                    meet[x.set_id, y.set_id] = meet.get((x.set_id, y.set_id), 0) + 1
        roots = {r.set_id: r.root for r in mine}
        pairs = {(a, b) for a in roots for b in roots if a < b}
        assert {p for p in pairs if roots[p[0]] != roots[p[1]]} <= set(meet) and set(meet.values()) <= {1}
        heavy = {p for p in pairs if roots[p[0]] == roots[p[1]] == 7}
        assert not heavy & set(meet)


def test_previous_factors_against_brute_force():
    rnd = random.Random(1)
    for length in (16, 23, 100):
        for _ in range(4):
            texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(length, length + 25))) for _ in range(5)]
            texts += [texts[0][:length], texts[1]]
            doc, start = np.array([rnd.randint(0, 3) for _ in texts]), np.array([1000 * i for i in range(len(texts))])
            windows = [(d, s + o, t[o:o + length]) for t, d, s in zip(texts, doc, start) for o in range(len(t) - length + 1)]
            want = [max((next((k for k in range(length) if w[k] != v[k]), length) for d2, s2, v in windows if (d2, s2) < (d, s)),
                        default=0) for d, s, w in windows]
            assert np.concatenate(suffix_dedup.previous_factors(texts, doc, start, length)).tolist() == want
            long = np.concatenate(suffix_dedup.previous_factors(texts, doc, start, length, length))
            assert [x for x in long.tolist() if x >= length] == [x for x in want if x >= length]
            assert (long >= length).tolist() == [x >= length for x in want]
    assert suffix_dedup.previous_factors([b"x" * 16, b"y" * 16], np.array([1, 2]), np.array([0, 0]), 16, 16)[1].tolist() == [0]


def test_hot_anchor_is_dealt_further(spark, monkeypatch):
    rnd = random.Random(6)
    common = "click here to subscribe to our weekly letter"
    noise = [" ".join(f"{rnd.randint(0, 10**9)}" for _ in range(8)) for _ in range(60)]
    rows = [(i, rnd.choice(noise) + common + rnd.choice(noise)) for i in range(120)]
    monkeypatch.setattr(suffix_dedup, "HOT", 5)
    want = _removed([(i, t.encode()) for i, t in rows], 100)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: sum(m) for i, m in want.items()} and sum(got.values()) > 0


def _replay(rows):
    """The chunk dedup in plain Python."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        spans, at = [], 0
        for e in cdc_dedup.chunk_ends(t):
            if t[at:e] in seen:
                spans.append((at, e))
            seen.add(t[at:e])
            at = e
        spans = [(a, b) for a, b in suffix_dedup.merged(spans) if b - a >= cdc_dedup.MIN_RUN]
        out[i] = (len(t), sum(b - a for a, b in spans), len(spans), hashlib.sha256(suffix_dedup._cut(t, spans)).hexdigest())
    return out


def test_chunk_dedup_equals_a_replay(spark):
    docs = read_table(spark, SF, "documents")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    got = {r.doc_id: tuple(r)[1:] for r in cdc_dedup.digest(docs).collect()}
    assert got == _replay(rows)


def test_toxicity_score_equals_a_dense_pass(spark):
    rnd = random.Random(8)
    words = ["good", "fine", "vile", "awful", "grüße"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12)))) for i in range(80)]
    labels = spark.createDataFrame([(i, int("vile" in t)) for i, t in rows], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(df, labels)
    dense = np.zeros(1 << toxicity.BITS)
    dense[model.used] = model.values
    for r in toxicity.score(df, model).collect():
        bags = [h & (len(dense) - 1) for w in toxicity.words(rows[r.doc_id][1].encode()) for h in toxicity.grams(w)]
        z = dense[bags].sum() / (len(bags) + toxicity.SMOOTH) + model.bias
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-9)
    # one gradient step equals the derivative of the loss
    bags = [toxicity.bag(t.encode()) for _, t in rows]
    data, y = toxicity.Packed(bags), np.array([int("vile" in t) for _, t in rows])
    a = toxicity.train(data, y, rounds=0)
    x = np.zeros((len(rows), 1 << toxicity.BITS))
    for i, (at, share) in enumerate(bags):
        x[i, at] = share
    assert np.allclose(x[:, data.used] @ a.values, [sum(v * a.values[list(data.used).index(b)] for b, v in zip(*bag) if b in data.used)
                                                   for bag in bags], atol=1e-5)
    assert toxicity.score(df.limit(0), model).count() == 0 and toxicity.keep_clean(df.limit(0), model).count() == 0


def test_toxicity_sample_is_bounded_by_rows(spark):
    rows = spark.range(3000).select((F.col("id") % 10).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int")
    a, b = (toxicity.fit(rows.repartition(n), labels) for n in (1, 7))
    assert (a.used == b.used).all() and np.allclose(a.values, b.values) and a.bias == b.bias
    # at most one text an id and two excerpts: no bucket of a single row's number is left
    assert len(a.used) < 100


def test_key_table(spark):
    keys = spark.range(0, 5000, 7, 9)
    table = key_table(keys, "id")
    assert in_table(table, np.arange(0, 5000, 7)).all() and in_table(table, np.arange(10**6, 2 * 10**6)).mean() < 0.01
    assert not key_table(keys.limit(0), "id").any()


def test_pipeline_runs(spark):
    docs = read_table(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).persist()
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and ids
        if name == "toxicity":
            model = toxicity.fit(docs, read_table(spark, SF, "labels"))
            assert ids == {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
        elif name == "ngram_jaccard":
            groups = {r.doc_id: r.component_id for r in ngram_jaccard.groups(before).collect()}
            assert ids == {i for i, c in groups.items() if i == c}
        elif name == "suffix_dedup":
            want = _removed([(r.doc_id, r.text.encode()) for r in before.collect()], suffix_dedup.LENGTH)
            for r in kept.collect():
                text = before.where(F.col("doc_id") == r.doc_id).first().text.encode() if sum(want[r.doc_id]) else None
                if text is not None:
                    assert r.text == bytes(c for c, x in zip(text, want[r.doc_id]) if not x).decode(errors="ignore")
        elif name == "mixing":
            words = mixing.mix(before).agg(F.sum("taken")).first()[0]
            assert kept.agg(F.sum(mixing.word_count("text"))).first()[0] == words
    last = corpus_pipeline.run(spark, SF)
    assert last.count() == kept.count()
    texts = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in kept.collect())
    assert sorted(r.decoded_sha256 for r in last.collect()) == texts
    assert P.PATTERN


HARD_PAGES = [
    ("<article><p>one two three</p><svg-icon>x</svg-icon><p>four five</p></article>", "one two three\nx\nfour five"),
    ("<article><p>one two</p><select-box>y</select-box><svg/><p>three</p></article>", "one two\ny\nthree"),
    ("<article><p title='the hidden world'>one two</p></article>", "one two"),
    ("<article><p data-n=O'Brien>one</p><p>two's</p></article>", "one\ntwo's"),
    ('<article><p class="a"">one</p><p>two</p></article>', "one\ntwo"),
    ("<nav data-u=/menu/>menu words</nav><article><p>one two</p></article>", "one two"),
    ('<body class="layout with-sidebar"><div class="post no-comments"><article class="page has-header"><p>one two three</p>'
     "</article></div></body>", "one two three"),
    ('<div class="sidebar"><article><p>one two three</p></article></div>', "one two three"),   # it holds most of the words
    ('<div class="page has-header"><article><p>one two three four</p><div class="ad">buy it</div><p>x</p></article>'
     '<div class="sidebar">a b</div></div>', "one two three four\nx"),
    ("<article><p>one<script>x<p>two</article>", "one\ntwo"), ("<article>a <script>if (a<b) x</SCRIPT > b</article>", "a b"),
    ("<article><header><h1>One</h1></header><p>two &amp; three</p></article><footer>f</footer>", "One\ntwo & three"),
    ("<nav><ul>" + "<li>menu " * 70 + "</ul></nav><article><ul><li>one<li>two</ul></article>", "one\ntwo"),
    ("", ""), ("<p>", ""), ("<!-- a", ""), ("text", "text"), ("<p title=\">one<p>two", "one\ntwo"),
]


def test_html_parsing():
    for page, text in HARD_PAGES:
        assert html_extract.extract(page, {}) == text, page


def test_html_region_against_all_ranges():
    rnd = random.Random(4)
    for _ in range(300):
        s = [rnd.choice([-3.0, -1.0, -0.5, 0.0, 0.5, 2.0]) for _ in range(rnd.randint(0, 12))]
        lo, hi = html_extract.best_region(s)
        assert sum(s[lo:hi]) == max([0.0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)])


def test_html_places_are_learnt(spark, monkeypatch):
    """Without the lists the labelled pages alone tell main text from the rest."""
    pages = read_table(spark, SF, "pages")
    want = {r.page_id: r.text for r in html_extract.main_text(pages).collect()}
    for name in ("DROPPED", "MARKS"):
        monkeypatch.setattr(html_extract, name, set())
    weights = html_extract.learn_weights(pages)
    got = [html_extract.extract(r.html, weights) == want[r.page_id] for r in pages.collect()]
    assert sum(got) >= 0.95 * len(got)
    plain = [html_extract.extract(r.html, {}) == want[r.page_id] for r in pages.collect()]
    assert sum(plain) < 0.5 * len(plain)       # it is the weights that decide
    wide = pages.select("*", F.lit("x").alias("text"), F.lit("y").alias("n_chars"), F.lit("z").alias("_h"))
    assert {r.page_id: r.text for r in html_extract.main_text(wide, weights).collect()}.keys() == want.keys()
    assert html_extract.main_text(pages.limit(0)).count() == 0


def test_licence_spans_and_short_phrases(spark):
    notice = licenses.TEMPLATES["bsd-text"]
    df = spark.createDataFrame([(1, f"{notice}. And again: {notice}."), (2, "do wtfpl what"), (3, "wtfpl"), (4, None)],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df, phrases={"wtfpl": "wtfpl"}).collect()}
    assert [s.label for s in got[1].spans] == ["bsd-text"] * 2 and all(s.cover == 1.0 for s in got[1].spans)
    assert (got[2].n_base, got[2].first_word, got[3].n_base, got[4].n_base) == (1, 1, 1, 0)
    assert licenses.scan(df.limit(0)).count() == 0


def test_licence_base_equals_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    phrases = [(p.encode().split(), lab) for p, lab in licenses.PHRASES.items()]
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for r in licenses.scan(docs).collect():
        w = licenses.words(texts[r.doc_id])
        hits = [(i, lab) for p, lab in phrases for i in range(len(w)) if w[i:i + len(p)] == p]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(hits), ",".join(sorted({x for _, x in hits})))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))


def test_neighbours_of_many_lengths(spark, monkeypatch):
    """Seventy vector lengths, the rare ones larger than one leaf."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3 + i % 70).tolist()) for i in range(2800)] + [(10_000 + i, rng.normal(size=2).tolist()) for i in range(90)]
    monkeypatch.setattr(nn_descent, "LEAF", 15)
    monkeypatch.setattr(nn_descent, "FITTED", 3)
    got = {}
    for r in nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = total = 0
    by = {}
    for i, v in rows:
        by.setdefault(len(v), []).append((i, np.array(v)))
    for q, v in rows:
        if q % 50 == 0:
            near = sorted((float(np.sqrt(((np.array(v) - x) ** 2).sum())), i) for i, x in by[len(v)] if i != q)[:10]
            hits += len({i for _, i in near} & set(got[q]))
            total += len(near)
    assert hits >= 0.9 * total
