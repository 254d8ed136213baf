"""Randomised parity: tokenizer and keywords in Spark equal the DuckDB rendering
of the same rules on generated strings full of punctuation and contractions."""

import random

import duckdb

from eddy.functions.text import sql_is_alpha, sql_raw_tokens, sql_stopword_list
from eddy.operators.keywords import extract_keywords, token_rows

ALPHABET = list("abcdeéxyz AEIOU") + list(" \t\n") + list(".,;:!?'\"()[]{}<>-_*|`$%&@#0123456789") + \
    ["n't", "'s", "...", "--", "don't", "U.S.", "can't", "the", "and"]


def _strings(n=300, seed=11):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60)))) for _ in range(n)]


def test_tokens_match_duckdb(spark):
    texts = _strings()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in token_rows(df).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE d(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", list(enumerate(texts)))
    want = con.execute(f"""
        WITH s AS (SELECT doc_id, {sql_raw_tokens('text')} AS toks FROM d),
        t AS (SELECT doc_id, unnest(toks) AS token, unnest(generate_series(0, len(toks) - 1)) AS pos FROM s)
        SELECT doc_id, CAST(pos AS INTEGER), token FROM t WHERE length(token) > 0""").fetchall()
    assert got == sorted(want)


def test_keywords_match_duckdb(spark):
    texts = _strings(200, seed=5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: list(r.keywords) for r in extract_keywords(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE d(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", list(enumerate(texts)))
    rows = con.execute(f"""
        WITH s AS (SELECT doc_id, {sql_raw_tokens('text')} AS toks FROM d WHERE length(text) > 0),
        t AS (SELECT doc_id, unnest(toks) AS w, unnest(generate_series(0, len(toks) - 1)) AS pos FROM s),
        k AS (SELECT * FROM t WHERE {sql_is_alpha('w')} AND w NOT IN {sql_stopword_list()}),
        tf AS (SELECT doc_id, w, count(*) AS n, min(pos) AS fp FROM k GROUP BY doc_id, w),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, fp) AS rk FROM tf)
        SELECT doc_id, list(w ORDER BY rk) FROM r WHERE rk <= 3 GROUP BY doc_id""").fetchall()
    assert got == {d: list(k) for d, k in rows}
