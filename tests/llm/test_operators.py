"""Operators against brute force, and their edge cases."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from eddy.llm import (bpe, cdc_dedup, embedding_dedup, html_extract, licenses, mixing, ngram_jaccard, nn_descent, suffix_dedup,
                      toxicity)

PATH = P.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, source string, set_id string, token string, key string"
# A clashing column in every row; nulls in any column, empty and long texts, repeated rows, ties.
BODY = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, BODY, "a"), (2, BODY + " tail", "a"), (3, None, "b"), (4, "", None), (5, " \t\n", "b"), (None, BODY, "a"),
        (6, "one two", "c"), (6, "one two", "c"), (7, "One TWO", "c"), (8, "x" * 5000, None), (9, BODY.upper(), "a")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "s", "t", "k") for r in ROWS], DOCS)


def _shingles(text):
    words = [w for w in (text or "").lower().replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _groups(sets, linked):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def test_jaccard_edge_cases(docs):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in ngram_jaccard.groups(docs).collect())
    assert got == sorted([(1, 56, 1), (2, 57, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (0, 56, 1), (6, 1, 6), (6, 1, 6), (7, 1, 6),
                          (8, 1, 8), (9, 56, 1)])
    assert ngram_jaccard.groups(docs.limit(0)).count() == 0
    assert {r.doc_id for r in ngram_jaccard.keep_first(docs).collect()} == {1, 3, 4, 5, 6, 8, None}


def test_jaccard_against_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    rows = []
    for g in range(12):
        base = [f"v{rnd.randint(0, 400)}" for _ in range(rnd.choice([5, 8, 40, 90]))]
        for _ in range(8):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = f"z{rnd.randint(0, 9)}"
            rows.append((len(rows), " ".join(w)))
    sets = [_shingles(t) for _, t in rows]
    want = _groups(sets, lambda a, b: 100 * len(a & b) >= 75 * len(a | b))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for few in (128, 1):      # 1: every shared prefix member goes through tiles
        monkeypatch.setattr(ngram_jaccard, "FEW", few)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.groups(df).collect()}
        assert got == {i: (len(s), w) for i, (s, w) in enumerate(zip(sets, want))}


def _removed(rows, n):
    seen, out = {}, {}
    order = sorted(rows, key=lambda r: r[0])
    for i, t in order:
        for s in range(len(t) - n + 1):
            seen.setdefault(t[s:s + n], (i, s))
    for i, t in order:
        mask = bytearray(len(t))
        for s in range(len(t) - n + 1):
            if seen[t[s:s + n]] < (i, s):
                mask[s:s + n] = b"\1" * n
        out[i] = mask
    return out


def test_suffix_dedup_against_brute_force(spark):
    rnd = random.Random(7)
    part = ["".join(rnd.choice("abcdé ") for _ in range(150)) for _ in range(4)]
    rows = []
    for i in range(40):
        bits = [rnd.choice(part) if rnd.random() < 0.4 else "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, 120)))
                for _ in range(rnd.randint(0, 4))]
        rows.append((i, "".join(bits)))
    rows += [(40, "a" * 700), (41, "ab" * 300), (42, rows[3][1]), (43, ""), (44, part[0][:99]), (45, part[0])]
    data = [(i, t.encode()) for i, t in rows]
    want = _removed(data, 100)
    got = {r.doc_id: r for r in suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, t in data:
        kept = bytes(b for b, x in zip(t, want[i]) if not x)
        spans = sum(1 for k in range(len(t)) if want[i][k] and not (k and want[i][k - 1]))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(t), sum(want[i]), spans), i
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_suffix_dedup_edge_cases(docs):
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.digest(docs).collect()]
    n = len(BODY)
    assert (1, n, 0) in got and (2, n + 5, n) in got and (None, n, n) in got and (3, 0, 0) in got and (9, n, 0) in got
    assert (8, 5000, 4999) in got and got.count((6, 7, 0)) == 2 and len(got) == len(ROWS)
    out = suffix_dedup.dedup(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    assert out.where("doc_id = 3 and text is null").count() == 1
    assert suffix_dedup.digest(docs.limit(0)).count() == 0


def test_chunk_borders_follow_content():
    rnd = random.Random(2)
    text = bytes(rnd.randrange(256) for _ in range(20_000))
    a, b = cdc_dedup.chunk_ends(text), cdc_dedup.chunk_ends(b"inserted" + text)
    assert a[-1] == len(text) and len({e + 8 for e in a} & set(b)) > 0.98 * len(a)
    # the vectorised hash equals the rolling one
    h, ends = 0, []
    for i, c in enumerate(text):
        h = ((h << 1) + int(cdc_dedup._GEAR[c])) & 0xFFFFFFFF
        if h >> (32 - cdc_dedup.MASK_BITS) == 0:
            ends.append(i + 1)
    assert set(a) - set(ends) <= {e for e in a if e == len(text) or e - a[max(0, a.index(e) - 1)] == cdc_dedup.HIGH}


def test_chunk_dedup(spark, docs):
    rnd = random.Random(3)
    passage = " ".join(f"p{rnd.randint(0, 10**6)}" for _ in range(60))
    rows = [(i, " ".join(f"q{rnd.randint(0, 10**6)}" for _ in range(50)) + passage + str(i)) for i in range(6)]
    rows.append((9, " ".join(f"q{rnd.randint(0, 10**6)}" for _ in range(90))))
    got = {r.doc_id: r.n_removed for r in cdc_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == got[9] == 0 and all(got[i] > 200 for i in range(1, 6))
    assert cdc_dedup.digest(docs).count() == len(ROWS) and cdc_dedup.digest(docs.limit(0)).count() == 0


def test_bpe_equals_the_library(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab Zé漢字🙂\t\n\x1c\x85\xa0　²½٣'s!?#") for _ in range(rnd.randint(0, 80))) for _ in range(200)]
    texts += ["a" * 3000, "ab" * 900 + "é" * 700, " " * 2000, ""]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in bpe.digest(spark.createDataFrame(rows, "doc_id long, text string"), PATH, P.PATTERN).collect()}
    for i, t in rows:
        ids = np.array(enc.encode_ordinary(t), dtype="<u4")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest()), repr(t)
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert bpe.encode(docs, PATH, P.PATTERN).where("doc_id = 3").collect()[0].ids == []
    assert bpe.digest(docs, PATH, P.PATTERN).count() == len(ROWS) and bpe.digest(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    by = {}
    for r in rows:
        k = (r.source_size, r.target)
        by[k] = by.get(k, 0) + r.taken
    assert all(abs(v - t) <= 1 for (_, t), v in by.items())
    total = sum(r.size for r in rows)
    assert sum(t for _, t in by) == pytest.approx(1.5 * total)
    assert sorted(map(str, mixing.mix(docs.repartition(3)).collect())) == sorted(map(str, rows))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.select(F.sum(mixing.word_count("text"))).first()[0] == sum(r.taken for r in rows)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_licenses(spark, docs):
    texts = ["Released under the MIT License. mit license", "Licensed under CC BY-NC 4.0.", None, "",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish", "the of and to in", "the GNU general public license apache LICENSE"]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert (got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels, got[0].score) == (2, 3, 5, "mit", 1.0)
    assert got[1].labels == "cc-by-nc" and got[1].base_labels == "" and got[1].first_word is None
    assert got[4].labels == "mit-text" and 0.5 <= got[4].score <= 1
    assert all(got[i].n_base == 0 and got[i].score == 0 for i in (2, 3, 5))
    assert (got[6].n_base, got[6].base_labels, got[6].first_word, got[6].last_word) == (2, "apache,gpl", 2, 5)
    assert licenses.scan(docs).count() == len(ROWS)


def test_html_extraction(spark):
    page = ("<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><header>Site</header><nav><ul><li><a>Home</a>"
            "</li></ul></nav><div class='ad banner'>Buy now</div><article><h1>Head &amp; tail</h1><p>First\n  <b>bold</b> text of the "
            "article.</p><aside>Side</aside><p>Second one&nbsp;here, with more words.</p></article><section id=comments><p>Nice post "
            "from a reader</p></section><form>Mail <input></form><footer>&copy; 2020</footer></body></html>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "<p>only words here</p>"), (1, "u", page), (4, "u", "<p"),
            (5, "u", "<br>" * 30000 + "<p>" + "long words " * 20000)]
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = "Head & tail\nFirst bold text of the article.\nSecond one here, with more words."
    assert [r.text for r in got if r.page_id == 1] == [text, text]
    by = {r.page_id: r for r in got}
    assert by[2].text == by[3].text == by[4].text == "" and by[None].text == "only words here"
    assert by[5].n_chars == 20000 * 11 - 1 and all(r.n_chars == len(r.text) for r in got)


def test_html_unclosed_elements():
    body = "<article><p>One of the article's words.<aside>" + "<p>side" * 80 + "</aside><p>Two of the article's words.</article>"
    for menu in ("<nav><ul>" + "<li>item" * 70 + "</ul></nav>", "<form>" + "<span>x" * 70 + "</form>",
                 "<nav><dl>" + "<dt>a<dd>b" * 70 + "</dl></nav>", "<nav><table>" + "<tr><td>a<td>b" * 70 + "</table></nav>"):
        got = html_extract.extract(f"<body>{menu}{body}</body>", {})
        assert got == "One of the article's words.\nTwo of the article's words."
    # a list inside an item doesn't end it; the next item ends a marked one
    page = html_extract.Page("<ul><li class=ad>a<ul><li>b</ul>c<li>d and more words</ul>")
    place = html_extract.places(page, {})
    assert [(v, place[e] < 0) for k, v, e in page.events if k == "text"] == [("a", True), ("b", True), ("c", True),
                                                                            ("d and more words", False)]


def test_toxicity_learns_and_generalises(spark, docs):
    rnd = random.Random(6)
    clean = ["".join(rnd.choice("bdfgklmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = [rnd.choice(clean) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            words[3] = rnd.choice(["wretchful", "wretched", "wretchy", "wretches"])
            words[9] = f"wretch{rnd.choice('abcdefgh')}{rnd.choice('aeiou')}"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = [r for r in toxicity.score(df, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 40 and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.9 * len(held)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    none = toxicity.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.predicted == 0 for r in toxicity.score(docs, none).collect())


VECS = "vec_id long, embedding array<float>, key string, dim string"


def _vectors():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(260, 12)).astype(np.float32)
    x[200:240] = x[5] + rng.normal(scale=0.25, size=(40, 12)).astype(np.float32)
    x[240:] = x[7]
    return x


BAD = [(900, None), (901, [0.0] * 12), (902, [float("nan")] + [1.0] * 11), (903, [None] + [1.0] * 11), (904, []), (905, [float("inf")] * 12),
       (906, [1.0, 2.0])]


def test_embedding_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    x = _vectors()
    rows = [(i, v.tolist(), "k", "d") for i, v in enumerate(x)] + [(i, v, "k", "d") for i, v in BAD]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    want = _groups(list(range(len(x))), lambda a, b: links[a, b])
    got = {r.vec_id: r for r in embedding_dedup.near_groups(spark.createDataFrame(rows, VECS)).collect()}
    assert links.sum() > 100
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i].sum(), want[i], want[i] == i)
    assert all(got[i].n_links == 0 and got[i].kept for i, _ in BAD)
    assert embedding_dedup.near_groups(spark.createDataFrame([], VECS)).count() == 0


def test_nearest_neighbours_recall(spark):
    x = np.random.default_rng(8).normal(size=(1500, 16)).astype(np.float32)
    x[1000:1030] = x[100]
    rows = [(i, v.tolist(), "k", "d") for i, v in enumerate(x)] + [(i + 1100, v, "k", "d") for i, v in BAD]
    got = {}
    for r in nn_descent.nearest(spark.createDataFrame(rows, VECS), every=50).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 1500, 50):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(1500), d)) if j != q][:10]
        assert sorted(got[q]) == list(range(1, 11)) and all(v < 1500 for v, _ in got[q].values())
        assert all(abs(d[v] - s) < 1e-9 for v, s in got[q].values())
        hits += len({v for v, _ in got[q].values()} & set(order))
    assert hits >= 0.9 * 300 and 2000 not in got
    assert [v for v, _ in (got[100][k] for k in range(1, 11))] == list(range(1000, 1010))
    assert nn_descent.nearest(spark.createDataFrame([], VECS)).count() == 0


def test_nearest_neighbours_among_tight_copies(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2000, 64))
    x[:1500] = x[0] + 0.003 * rng.normal(size=(1500, 64))
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), "k", "d") for i, v in enumerate(x)]
    got = {}
    for r in nn_descent.nearest(spark.createDataFrame(rows, VECS), every=50).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 1500, 50):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.9 * 300


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cut = corpus_pipeline.cut_repeats(spark, docs, sf)
    assert cut.dtypes == docs.dtypes and cut.count() == docs.count()
    out = corpus_pipeline.mix_sources(spark, cut, sf)
    assert out.dtypes == docs.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "suffix_dedup", "mixing", "bpe"]
