"""DuckDB statements equivalent to each registered query.

Run against the supplied tables registered as views.  Text rules are rendered
from the same constants the Spark expressions use (``eddy.functions.text``).
"""

from __future__ import annotations

from eddy.functions.text import sql_is_alpha, sql_raw_tokens, sql_stopword_list

ORACLE: dict[str, str] = {}

# --------------------------------- keywords -----------------------------------

_TOKENS = f"""
tok_src AS (
  SELECT doc_id, {sql_raw_tokens('text')} AS toks
  FROM documents WHERE text IS NOT NULL AND length(text) > 0),
tok_all AS (
  SELECT doc_id, unnest(toks) AS token, unnest(generate_series(0, len(toks) - 1)) AS pos FROM tok_src),
tok AS (
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM tok_all WHERE length(token) > 0)"""

_KEPT = f"""
kept AS (
  SELECT * FROM tok WHERE {sql_is_alpha('token')} AND token NOT IN {sql_stopword_list()})"""

_TF = """
tf AS (
  SELECT doc_id, token AS w, count(*) AS n, min(pos) AS first_pos FROM kept GROUP BY doc_id, token)"""


def _topk(k: int) -> str:
    return f"""
ranked{k} AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_pos ASC) AS INTEGER) AS rank, w, n
  FROM tf),
top{k} AS (SELECT * FROM ranked{k} WHERE rank <= {k})"""


_KW = """
kwa AS (
  SELECT doc_id, list(w ORDER BY rank) AS keywords FROM top3 GROUP BY doc_id)"""

_KW_CTES = "WITH " + ",".join([_TOKENS, _KEPT, _TF, _topk(3), _KW])

ORACLE["tokens"] = "WITH " + _TOKENS + "\nSELECT doc_id, pos, token FROM tok"
ORACLE["stopword_filter"] = "WITH " + ",".join([_TOKENS, _KEPT]) + "\nSELECT doc_id, pos, token FROM kept"
ORACLE["term_freq"] = "WITH " + ",".join([_TOKENS, _KEPT, _TF]) + "\nSELECT doc_id, w, n, first_pos FROM tf"
ORACLE["keywords_top3"] = "WITH " + ",".join([_TOKENS, _KEPT, _TF, _topk(3)]) + "\nSELECT doc_id, rank, w, n FROM top3"
ORACLE["keywords_top5"] = "WITH " + ",".join([_TOKENS, _KEPT, _TF, _topk(5)]) + "\nSELECT doc_id, rank, w, n FROM top5"
ORACLE["keyword_arrays"] = _KW_CTES + "\nSELECT doc_id, keywords FROM kwa"
ORACLE["has_keywords"] = _KW_CTES + "\nSELECT doc_id, CAST(len(keywords) AS INTEGER) AS n_keywords FROM kwa WHERE len(keywords) > 0"
ORACLE["keyword_counts"] = _KW_CTES + """
SELECT keyword, count(*) AS n FROM (SELECT unnest(keywords) AS keyword FROM kwa) GROUP BY keyword"""
ORACLE["top10_keywords"] = _KW_CTES + """,
kc AS (SELECT keyword, count(*) AS n FROM (SELECT unnest(keywords) AS keyword FROM kwa) GROUP BY keyword)
SELECT keyword, n, row_number() OVER (ORDER BY n DESC, keyword ASC) AS rank
FROM kc ORDER BY n DESC, keyword ASC LIMIT 10"""
ORACLE["keyword_ranking"] = _KW_CTES + """,
kc AS (SELECT keyword, count(*) AS n FROM (SELECT unnest(keywords) AS keyword FROM kwa) GROUP BY keyword)
SELECT keyword, n, row_number() OVER (ORDER BY n DESC, keyword ASC) AS rank FROM kc"""

# --------------------------- ingest, codecs, topics ---------------------------

_CREATED = "epoch_us(e.ts) / 1e6"
_COMMENTS_T = f"""comments_t AS (
  SELECT d.doc_id AS row_index, d.text, CAST(d.doc_id AS VARCHAR) AS comment_id, {_CREATED} AS created_utc
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id)"""
_MSG = """msg AS (
  SELECT doc_id AS row_index,
         json_object('Unnamed: 0', doc_id, '1', text, '2', CAST(doc_id AS VARCHAR))::VARCHAR AS value
  FROM documents),
msgk AS (
  SELECT row_index, value, CASE WHEN length(value) > 0 THEN md5(value) END AS key FROM msg),
msgp AS (
  SELECT row_index, value, key,
         CAST(coalesce((('0x' || substr(key, 1, 8))::BIGINT) % 5, 0) AS INTEGER) AS partition FROM msgk)"""
_PROC = f"""proc AS (
  SELECT CAST(event_id AS VARCHAR) AS id, epoch_us(ts) / 1e6 AS timestamp,
         epoch_us(ts) / 1e6 + value AS processing_time,
         'consumer_' || CAST(event_id % 10 AS VARCHAR) AS processed_by,
         CAST(event_id % 5 AS INTEGER) AS partition, event_id // 5 AS "offset", event_type
  FROM events)"""

ORACLE["scan_comments"] = "WITH " + _COMMENTS_T + "\nSELECT row_index, text, comment_id, created_utc, 'n,' || comment_id AS note FROM comments_t"
ORACLE["stride_shard"] = "SELECT doc_id AS row_index, CAST(doc_id % 2 AS INTEGER) AS producer_id FROM documents"
ORACLE["json_encode"] = "WITH " + _MSG + "\nSELECT row_index, value FROM msg"
ORACLE["json_decode"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
ORACLE["json_decode_double"] = """
SELECT event_id, 'plain' AS form, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
UNION ALL
SELECT event_id, 'double' AS form, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""
ORACLE["message_key"] = "WITH " + _MSG + "\nSELECT row_index, key FROM msgk"
ORACLE["partition_assign"] = "WITH " + _MSG + "\nSELECT row_index, key, partition FROM msgp"
ORACLE["partition_counts"] = "WITH " + _MSG + "\nSELECT partition, count(*) AS n FROM msgp GROUP BY partition"
ORACLE["consumer_assign"] = "WITH " + _MSG + """
SELECT partition, 'consumer_' || CAST(least(partition // 2, 1) AS VARCHAR) AS consumer, count(*) AS n
FROM msgp GROUP BY partition"""
ORACLE["end_offsets"] = "WITH " + _PROC + "\nSELECT partition, max(\"offset\") + 1 AS end_offset FROM proc GROUP BY partition"

# ------------------------------- validation ----------------------------------

ORACLE["field_default"] = "SELECT doc_id AS row_index, 'unknown' AS id, CAST(length(coalesce(text, '')) AS INTEGER) AS text_length FROM documents"
ORACLE["valid_text"] = "SELECT doc_id AS row_index FROM documents WHERE text IS NOT NULL AND doc_id % 7 <> 0"
ORACLE["nonempty_text"] = "SELECT doc_id AS row_index FROM documents WHERE text IS NOT NULL AND length(text) > 0 AND doc_id % 7 NOT IN (0, 1)"
ORACLE["nonempty_message"] = "WITH " + _MSG + "\nSELECT row_index FROM msg WHERE value IS NOT NULL AND row_index % 5 NOT IN (0, 1)"
_BAD_TIME = "created_utc IS NULL OR created_utc = 0 OR isnan(created_utc) OR created_utc < -62135596800 OR created_utc >= 253402300800"
_TIMES = f"""times AS (
  SELECT e.event_id AS row_index,
         CASE e.event_id % 11 WHEN 0 THEN 0.0 WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE WHEN 3 THEN 1e15
                              WHEN 4 THEN NULL ELSE {_CREATED} END AS created_utc
  FROM events e),
texts AS (
  SELECT doc_id AS row_index, CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS text FROM documents),
bodies AS (
  SELECT row_index, CASE row_index % 5 WHEN 0 THEN '{{}}' WHEN 1 THEN '' ELSE value END AS value FROM msg),
done AS (
  SELECT id, timestamp, CASE WHEN id::BIGINT % 13 <> 0 THEN processing_time END AS processing_time FROM proc),
checked AS (
  SELECT row_index::VARCHAR AS row_key, 'text' AS stage,
         CASE WHEN text IS NULL THEN 'text not a string' WHEN length(text) = 0 THEN 'empty text' ELSE 'ok' END AS reason FROM texts
  UNION ALL SELECT row_index::VARCHAR, 'convert', CASE WHEN {_BAD_TIME} THEN 'missing time' ELSE 'ok' END FROM times
  UNION ALL SELECT row_index::VARCHAR, 'consume',
         CASE WHEN value IS NULL OR trim(value) IN ('', '{{}}', 'null') THEN 'empty message' ELSE 'ok' END FROM bodies
  UNION ALL SELECT id, 'latency', CASE WHEN timestamp IS NULL OR processing_time IS NULL THEN 'missing time' ELSE 'ok' END FROM done)"""
_CHECKED = "WITH " + _MSG + ", " + _PROC + ", " + _TIMES
ORACLE["valid_time"] = _CHECKED + f"\nSELECT row_index, created_utc FROM times WHERE NOT ({_BAD_TIME})"
ORACLE["latency_inputs"] = "WITH " + _PROC + "\nSELECT id FROM proc WHERE timestamp IS NOT NULL AND processing_time IS NOT NULL AND id::BIGINT % 13 <> 0"
ORACLE["rejects"] = _CHECKED + "\nSELECT row_key, stage, reason FROM checked WHERE reason <> 'ok'"
ORACLE["validation_summary"] = _CHECKED + "\nSELECT stage, reason AS status, count(*) AS n FROM checked GROUP BY 1, 2"

# ------------------------------ time, latency ---------------------------------

_US = "CAST(round(({x}) * 1000000) AS BIGINT)"


def _iso(x: str) -> str:
    us = _US.format(x=x)
    return (f"CASE WHEN {us} % 1000000 <> 0 THEN strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S.%f') "
            f"ELSE strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S') END")


_LAT = "WITH " + _PROC + """,
lat AS (
  SELECT coalesce(id, 'unknown') AS message_id, (processing_time - timestamp) * 1000.0 AS latency_ms,
         make_timestamp(""" + _US.format(x="timestamp") + """) AS original_time,
         make_timestamp(""" + _US.format(x="processing_time") + """) AS processing_time,
         coalesce(processed_by, 'unknown') AS processed_by, partition
  FROM proc WHERE timestamp IS NOT NULL AND processing_time IS NOT NULL)"""

ORACLE["processed_records"] = "WITH " + _PROC + "\nSELECT id, timestamp, processing_time, processed_by FROM proc"
ORACLE["epoch_to_iso"] = f"WITH t AS (SELECT e.event_id AS row_index, {_CREATED} AS created_utc FROM events e)\nSELECT row_index, created_utc, {_iso('created_utc')} AS iso_datetime FROM t"
ORACLE["epoch_to_ts"] = "WITH " + _PROC + f"\nSELECT id, make_timestamp({_US.format(x='timestamp')}) AS original_time FROM proc"
ORACLE["latency_rows"] = _LAT + "\nSELECT * FROM lat"
ORACLE["latency_report"] = _LAT + """
SELECT count(*) AS total_messages, round(max(latency_ms), 6) AS max_latency_ms, round(min(latency_ms), 6) AS min_latency_ms,
       round(avg(latency_ms), 6) AS avg_latency_ms,
       round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms, round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms
FROM lat"""
ORACLE["latency_percentiles"] = _LAT + """
SELECT round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms, round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms
FROM lat"""
ORACLE["consumer_stats"] = _LAT + """
SELECT processed_by, round(CAST(count(*) AS DOUBLE), 6) AS count, round(avg(latency_ms), 6) AS mean,
       round(min(latency_ms), 6) AS min, round(max(latency_ms), 6) AS max
FROM lat GROUP BY processed_by"""
ORACLE["latency_report_tumbling"] = _LAT + """,
win AS (SELECT *, time_bucket(INTERVAL 60 SECOND, processing_time) AS window_start FROM lat)
SELECT window_start, window_start + INTERVAL 60 SECOND AS window_end,
       count(*) AS total_messages, round(max(latency_ms), 6) AS max_latency_ms, round(min(latency_ms), 6) AS min_latency_ms,
       round(avg(latency_ms), 6) AS avg_latency_ms,
       round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms, round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms
FROM win GROUP BY window_start"""

# --------------------------- sentiment, language ------------------------------

from eddy.functions.text import sql_sentiment_words  # noqa: E402
from eddy.operators import sentiment as _se  # noqa: E402


def _lex_values() -> str:
    rows = ", ".join(f"({_q(w)}, {v!r}, {s!r}, {n})" for w, v, s, n in _se.default_lexicon_rows())
    return (f"lexv(word, valence, scalar, negation) AS (VALUES {rows}),\n"
            "lex AS (SELECT word, CAST(valence AS DOUBLE) AS valence, CAST(scalar AS DOUBLE) AS scalar, "
            "CAST(negation AS INTEGER) AS negation FROM lexv)")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sentiment_ctes(src: str = "documents", id_col: str = "doc_id") -> str:
    emph = (f"coalesce(least(len(string_split(_t, '!')) - 1, {_se.EXCLAMATION_MAX}) * {_se.EXCLAMATION_STEP} + "
            f"CASE WHEN len(string_split(_t, '?')) - 1 <= 1 THEN 0.0 "
            f"WHEN len(string_split(_t, '?')) - 1 <= 3 THEN (len(string_split(_t, '?')) - 1) * {_se.QUESTION_STEP} "
            f"ELSE {_se.QUESTION_CAP} END, 0.0)")
    look = []
    for d in (1, 2, 3):
        frame = f"OVER (PARTITION BY {id_col} ORDER BY pos RANGE BETWEEN {d} PRECEDING AND {d} PRECEDING)"
        look.append(f"coalesce(max(CASE WHEN valence = 0 THEN scalar END) {frame}, 0.0) AS s{d}")
        look.append(f"coalesce(max(CASE WHEN valence = 0 AND neg THEN 1 END) {frame}, 0) AS n{d}")
    v = "valence"
    for d in (1, 2, 3):
        s = f"(s{d} * {_se.BOOST_DAMPING[d]!r})"
        v = (f"(({v}) + (CASE WHEN ({v}) < 0 THEN -1.0 ELSE 1.0 END) * {s}) * "
             f"(CASE WHEN n{d} = 1 THEN {_se.NEGATION_SCALAR!r} ELSE 1.0 END)")
    but = (f"(CASE WHEN first_but IS NULL THEN 1.0 WHEN pos < first_but THEN {_se.BUT_BEFORE!r} "
           f"WHEN pos > first_but THEN {_se.BUT_AFTER!r} ELSE 1.0 END)")
    words = sql_sentiment_words("coalesce(_t, '')")
    return f"""{_lex_values()},
sb AS (SELECT {id_col}, text AS _t FROM {src}),
swl AS (SELECT {id_col}, list_filter({words}, lambda w: length(w) > 0) AS ws FROM sb),
sw AS (SELECT {id_col}, unnest(ws) AS word, CAST(unnest(generate_series(0, len(ws) - 1)) AS INTEGER) AS pos FROM swl),
shits AS (
  SELECT {id_col}, pos, coalesce(l.valence, 0.0) AS valence, coalesce(l.scalar, 0.0) AS scalar,
         (coalesce(l.negation, 0) = 1 OR contains(sw.word, 'n''t')) AS neg, (sw.word = 'but') AS is_but, CAST(0.0 AS DOUBLE) AS emph
  FROM sw LEFT JOIN lex l ON l.word = sw.word),
srows AS (
  SELECT * FROM shits WHERE valence <> 0 OR scalar <> 0 OR neg OR is_but
  UNION ALL
  SELECT {id_col}, CAST(NULL AS INTEGER), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), false, false, CAST({emph} AS DOUBLE) FROM sb),
slook AS (
  SELECT *, min(CASE WHEN is_but THEN pos END) OVER (PARTITION BY {id_col}) AS first_but, {", ".join(look)}
  FROM srows),
sdoc AS (
  SELECT {id_col},
         sum(CASE WHEN valence <> 0 THEN CAST(round(({v}) * {but} * 1000000.0) AS BIGINT) ELSE 0 END) / 1000000.0 AS s0,
         max(emph) AS e
  FROM slook GROUP BY {id_col}),
sscore AS (
  SELECT {id_col}, round(s1 / sqrt(s1 * s1 + {_se.NORMALIZATION_ALPHA!r}), 4) AS compound
  FROM (SELECT {id_col}, CASE WHEN s0 > 0 THEN s0 + e WHEN s0 < 0 THEN s0 - e ELSE s0 END AS s1 FROM sdoc)),
slabel AS (
  SELECT {id_col}, compound, CASE WHEN compound >= 0 THEN 'Positive' ELSE 'Negative' END AS sentiment FROM sscore)"""


_NORM = "' ' || regexp_replace(lower({x}), '[^\\p{{L}}]+', ' ', 'g') || ' '"


def _trigram_cte(name: str, src: str, key_expr: str, text: str, where: str = "TRUE") -> str:
    norm = _NORM.format(x=text)
    return f"""{name}_t AS (
  SELECT {key_expr} AS k, string_split({norm}, '') AS cs FROM {src}
  WHERE {text} IS NOT NULL AND regexp_matches({text}, '\\p{{L}}') AND {where}),
{name} AS (
  SELECT k, g, count(*) AS n FROM (
    SELECT k, unnest(list_transform(range(1, len(cs) - 1), lambda i: cs[i] || cs[i + 1] || cs[i + 2])) AS g FROM {name}_t)
  GROUP BY k, g)"""


_PROFILE = _trigram_cte("ptri", "documents", "lang", "text", "lang IS NOT NULL") + """,
pv AS (SELECT count(DISTINCT g) AS V FROM ptri),
profile AS (
  SELECT k AS lang, g, n AS c,
         CAST(round(ln((n + 1) / CAST(T + V AS DOUBLE)) * 1000000) AS BIGINT) AS lp,
         CAST(round(ln(1.0 / CAST(T + V AS DOUBLE)) * 1000000) AS BIGINT) AS lp0
  FROM (SELECT *, sum(n) OVER (PARTITION BY k) AS T FROM ptri), pv)"""


def _detect_ctes(src: str, key_expr: str, text: str, out_key: str) -> str:
    # score(k, L) = sum over the comment's in-vocabulary trigrams of n * lp(L, g),
    # with lp0(L) for trigrams never seen in L, for every language L.
    return _trigram_cte("dtri", src, key_expr, text) + f""",
dn AS (SELECT k, sum(n) AS N FROM dtri WHERE g IN (SELECT g FROM profile) GROUP BY k),
ds AS (SELECT d.k, p.lang, sum(d.n * (p.lp - p.lp0)) AS x FROM dtri d JOIN profile p ON p.g = d.g GROUP BY d.k, p.lang),
langs AS (SELECT DISTINCT lang, lp0 FROM profile),
dscore AS (
  SELECT dn.k, langs.lang, dn.N * langs.lp0 + coalesce(ds.x, 0) AS score
  FROM dn CROSS JOIN langs LEFT JOIN ds ON ds.k = dn.k AND ds.lang = langs.lang),
det AS (
  SELECT k, lang AS detected FROM (
    SELECT k, lang, row_number() OVER (PARTITION BY k ORDER BY score DESC, lang ASC) AS r FROM dscore) WHERE r = 1),
dlang AS (
  SELECT s.{out_key}, coalesce(det.detected, 'unknown') AS language
  FROM (SELECT {key_expr} AS {out_key} FROM {src}) s LEFT JOIN det ON det.k = s.{out_key})"""


_ENRICH = "WITH " + ",".join([_TOKENS, _KEPT, _TF, _topk(3), _KW]) + ",\n" + _sentiment_ctes() + ",\n" + \
    _PROFILE + ",\n" + _detect_ctes("documents", "doc_id", "text", "doc_id")
_REPORTABLE = """,
rep AS (
  SELECT kwa.doc_id, dlang.language, slabel.sentiment, kwa.keywords
  FROM kwa JOIN dlang ON dlang.doc_id = kwa.doc_id JOIN slabel ON slabel.doc_id = kwa.doc_id)"""

ORACLE["sentiment_score"] = "WITH " + _sentiment_ctes() + "\nSELECT doc_id, compound FROM sscore"
ORACLE["sentiment_label"] = "WITH " + _sentiment_ctes() + "\nSELECT doc_id, sentiment FROM slabel"
ORACLE["language_profile"] = "WITH " + _PROFILE + "\nSELECT lang, g, c, lp, lp0 FROM profile"
ORACLE["detect_language"] = "WITH " + _PROFILE + ",\n" + _detect_ctes("documents", "doc_id", "text", "doc_id") + \
    "\nSELECT doc_id, language FROM dlang"
ORACLE["lang_unknown"] = "WITH " + _PROFILE + """,
turns AS (SELECT conv_id, turn, CASE conv_id % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' || chr(10) ELSE text END AS text
          FROM conversations),
""" + _detect_ctes(
    "turns", "CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)", "text", "turn_id") + \
    "\nSELECT turn_id, language FROM dlang"
ORACLE["enriched"] = _ENRICH + """
SELECT dlang.doc_id, documents.text, documents.source, dlang.language, slabel.compound, slabel.sentiment,
       coalesce(kwa.keywords, CAST([] AS VARCHAR[])) AS keywords
FROM dlang JOIN documents ON documents.doc_id = dlang.doc_id JOIN slabel ON slabel.doc_id = dlang.doc_id LEFT JOIN kwa ON kwa.doc_id = dlang.doc_id"""
ORACLE["language_counts"] = _ENRICH + _REPORTABLE + "\nSELECT language, count(*) AS n FROM rep GROUP BY language"
ORACLE["sentiment_counts"] = _ENRICH + _REPORTABLE + "\nSELECT sentiment, count(*) AS n FROM rep GROUP BY sentiment"
_REPORT = _ENRICH + _REPORTABLE + """,
rl AS (SELECT language AS key, count(*) AS n FROM rep GROUP BY language),
rs AS (SELECT sentiment AS key, count(*) AS n FROM rep GROUP BY sentiment),
rk AS (SELECT keyword AS key, count(*) AS n FROM (SELECT unnest(keywords) AS keyword FROM rep) GROUP BY keyword),
rall AS (
  SELECT 'languages' AS dimension, key, n, row_number() OVER (ORDER BY n DESC, key ASC) AS rank FROM rl
  UNION ALL SELECT 'sentiments', key, n, row_number() OVER (ORDER BY n DESC, key ASC) FROM rs
  UNION ALL SELECT 'keywords', key, n, row_number() OVER (ORDER BY n DESC, key ASC) FROM rk),
report AS (
  SELECT * FROM rall
  UNION ALL SELECT 'top_keywords', key, n, rank FROM rall WHERE dimension = 'keywords' AND rank <= 10)"""
ORACLE["report"] = _REPORT + "\nSELECT dimension, key, n, rank FROM report"
ORACLE["report_json"] = _REPORT + """
SELECT json_object('dimension', dimension, 'key', key, 'n', n, 'rank', rank)::VARCHAR AS json FROM report"""


# ------------------------------- sentences ------------------------------------

from eddy.functions.text import TOKEN_SPLIT, WORD_END, _sql_str, sql_word_tokens  # noqa: E402
from eddy.operators import sentences as _sn  # noqa: E402
from eddy.sources.tables import SPOKEN  # noqa: E402

_SPOKEN = f"""spoken AS (
  SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN {_q(SPOKEN)} || text ELSE text END AS text FROM documents)"""
ORACLE["pair_tokens"] = "WITH " + _SPOKEN + "," + _TOKENS.replace("FROM documents", "FROM spoken") + "\nSELECT doc_id, pos, token FROM tok"


def _core(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {_sql_str(_sn._OPENERS)}, ''), {_sql_str(_sn._CLOSERS)}, '')"


_NUM = _sql_str(r"^-?[.,]?[0-9][0-9,.-]*$")


def _type(x: str) -> str:
    bare = f"lower(regexp_replace({x}, '\\.$', ''))"
    return f"CASE WHEN regexp_matches({bare}, {_NUM}) THEN '{_sn.NUMBER}' ELSE {bare} END"


def _part(k: str, m: str, p: str) -> str:
    return f"(CASE WHEN {k} = 0 THEN 0 ELSE ({k}) * ln({p}) END + CASE WHEN {m} - ({k}) = 0 THEN 0 ELSE ({m} - ({k})) * ln(1 - {p}) END)"


_PAIR_RATIO = (f"2 * ({_part('k', 'a', 'k / a')} + {_part('b - k', 't - a', '((b - k) / (t - a))')} "
               f"- {_part('k', 'a', '(b / t)')} - {_part('b - k', 't - a', '(b / t)')})")
_MODEL = _SPOKEN + f""",
swl_ AS (SELECT doc_id, list_filter(regexp_split_to_array(text, {_sql_str(TOKEN_SPLIT)}), lambda w: length(w) > 0) AS ws FROM spoken
         WHERE text IS NOT NULL),
sw_ AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(0, len(ws) - 1)) AS pos, ws FROM swl_),
sc_ AS (SELECT doc_id, pos::INTEGER AS pos, word, ws[pos + 2] AS next, {_core('word')} AS core, {_core('ws[pos + 2]')} AS after FROM sw_),
mk_ AS (SELECT *, {_type('core')} AS type, regexp_matches(core, '[^.]\\.$') AS period, regexp_matches(word, {_sql_str(WORD_END)}) AS stop,
               regexp_matches(core, '^\\p{{Lu}}') AS upper, {_type('after')} AS next_type,
               coalesce(regexp_matches(after, '^\\p{{L}}'), false) AS next_letter FROM sc_),
cnt_ AS (SELECT type, count(*) AS n, sum(period::INT)::BIGINT AS with_period, max(upper::INT) AS capital FROM mk_ WHERE type <> '' GROUP BY type),
tot_ AS (SELECT sum(n)::DOUBLE AS t, sum(with_period)::DOUBLE / sum(n) AS r FROM cnt_),
rat_ AS (SELECT cnt_.*, round(-2 * (with_period * ln(r) + (n - with_period) * ln(1 - r) - with_period * ln({_sn.PERIOD_RATE}::DOUBLE)
                - (n - with_period) * ln(1 - {_sn.PERIOD_RATE}::DOUBLE)), 6) AS ratio,
                len(regexp_extract_all(type, '\\.')) + 1 AS inner_, length(type) - len(regexp_extract_all(type, '\\.')) AS letters
         FROM cnt_, tot_ WHERE with_period > 0),
typ_ AS (SELECT type, n, with_period, capital, ratio, round(ratio * exp(-letters) * inner_ * pow(letters::DOUBLE, -(n - with_period)), 6) AS score
         FROM rat_),
model_ AS (SELECT *, regexp_matches(type, '\\p{{L}}') AND score >= {_sn.ABBREVIATION} AS abbreviation FROM typ_),
both_ AS (SELECT type, next_type, count(*) AS together FROM mk_ WHERE period AND next IS NOT NULL AND next_type <> ''
          AND (regexp_matches(type, '^\\p{{L}}$') OR type = '{_sn.NUMBER}') GROUP BY 1, 2),
prat_ AS (SELECT *, round({_PAIR_RATIO}, 6) AS ratio FROM (
            SELECT p.*, together::DOUBLE AS k, f.with_period::DOUBLE AS a, s.n::DOUBLE AS b, t
            FROM both_ p JOIN cnt_ f ON p.type = f.type JOIN cnt_ s ON p.next_type = s.type, tot_)),
pair_ AS (SELECT type, next_type, together, ratio, together > 1 AND k / a > b / t AND ratio >= {_sn.COLLOCATION} AS collocation FROM prat_),
end_ AS (SELECT mk_.doc_id, pos, word, next IS NULL OR stop OR (period AND NOT (
                coalesce(abbreviation, false) OR coalesce(collocation, false)
                OR ((regexp_matches(mk_.type, '^\\p{{L}}$') OR mk_.type = '{_sn.NUMBER}') AND next_letter))) AS ends
         FROM mk_ LEFT JOIN model_ ON mk_.type = model_.type LEFT JOIN pair_ ON mk_.type = pair_.type AND mk_.next_type = pair_.next_type),
stokl_ AS (SELECT doc_id, pos, CASE WHEN ends THEN {sql_word_tokens('word', True)} ELSE {sql_word_tokens('word', False)} END AS ts FROM end_),
stok_ AS (SELECT doc_id, pos, unnest(generate_series(0, len(ts) - 1))::INTEGER AS sub, unnest(ts) AS token FROM stokl_)"""

ORACLE["abbreviation_model"] = "WITH " + _MODEL + "\nSELECT * FROM model_"
ORACLE["collocation_model"] = "WITH " + _MODEL + "\nSELECT * FROM pair_"
ORACLE["sentences"] = "WITH " + _MODEL + """
SELECT doc_id, sentence, min(pos) AS first, count(*) AS words FROM (
  SELECT doc_id, pos, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER
         AS sentence FROM end_) GROUP BY doc_id, sentence"""
ORACLE["sentence_tokens"] = "WITH " + _MODEL + "\nSELECT doc_id, pos, sub, token FROM stok_"
ORACLE["sentence_keywords"] = "WITH " + _MODEL + f""",
skept AS (SELECT * FROM stok_ WHERE {sql_is_alpha('token')} AND token NOT IN {sql_stopword_list()}),
stf AS (SELECT doc_id, token AS w, count(*) AS n, min(pos * 1000000::BIGINT + sub) AS first_pos FROM skept GROUP BY doc_id, token)
SELECT doc_id, rank, w, n FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_pos)::INTEGER AS rank, w, n FROM stf) WHERE rank <= 3"""

# ------------------------- languages, 1- to 3-grams ---------------------------

_GRAMS3 = ("list_concat(list_concat(cs, list_transform(range(1, len(cs)), lambda i: cs[i] || cs[i + 1])), "
           "list_transform(range(1, len(cs) - 1), lambda i: cs[i] || cs[i + 1] || cs[i + 2]))")


def _grams_cte(name: str, key: str, where: str) -> str:
    return _trigram_cte(name, "documents", key, "text", where).replace(
        "list_transform(range(1, len(cs) - 1), lambda i: cs[i] || cs[i + 1] || cs[i + 2])", _GRAMS3)


ORACLE["language_posterior"] = "WITH " + _PROFILE.replace(
    _trigram_cte("ptri", "documents", "lang", "text", "lang IS NOT NULL"), _grams_cte("ptri", "lang", "lang IS NOT NULL")) + ",\n" + \
    _grams_cte("dtri", "doc_id", "TRUE") + """,
dn AS (SELECT k, sum(n) AS N FROM dtri WHERE g IN (SELECT g FROM profile) GROUP BY k),
ds AS (SELECT d.k, p.lang, sum(d.n * (p.lp - p.lp0)) AS x FROM dtri d JOIN profile p ON p.g = d.g GROUP BY d.k, p.lang),
langs AS (SELECT DISTINCT lang, lp0 FROM profile),
top AS (SELECT lang FROM langs ORDER BY lp0 DESC, lang LIMIT 1),
cand AS (SELECT k, lang, x FROM ds UNION ALL SELECT dn.k, top.lang, 0 FROM dn, top
         WHERE NOT EXISTS (SELECT 1 FROM ds WHERE ds.k = dn.k AND ds.lang = top.lang)),
sc AS (SELECT cand.k AS doc_id, cand.lang, (N * lp0 + x)::BIGINT AS score FROM cand JOIN dn USING (k) JOIN langs USING (lang)),
od AS (SELECT *, exp((score - max(score) OVER (PARTITION BY doc_id)) / 1000000.0) AS o FROM sc)
SELECT doc_id, lang, score, round(o / sum(o) OVER (PARTITION BY doc_id), 6) AS posterior FROM od"""


# ------------------------- arrival-driven intervals ---------------------------

def _arrival(key: str, name: str) -> str:
    return "WITH RECURSIVE " + _PROC + f""",
arr AS (SELECT {key} AS k, id::BIGINT AS id, processing_time AS t, (processing_time - timestamp) * 1000.0 AS latency_ms
        FROM proc WHERE timestamp IS NOT NULL AND processing_time IS NOT NULL),
num AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, id) AS i FROM arr),
mrg AS (SELECT k, t, 1 AS kind, i FROM num UNION ALL SELECT k, t + 3600.0::DOUBLE, 0, i FROM num),
nxt AS (SELECT k, i, s FROM (
          SELECT k, kind, i, min(CASE WHEN kind = 1 THEN i END) OVER (
            PARTITION BY k ORDER BY t, kind ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS s FROM mrg)
        WHERE kind = 0 AND s IS NOT NULL),
chain(k, i) AS (
  SELECT DISTINCT k, 1::BIGINT FROM num
  UNION ALL
  SELECT chain.k, nxt.s FROM chain JOIN nxt ON chain.k = nxt.k AND chain.i = nxt.i),
closing AS (SELECT c.k, c.i, num.t FROM chain c JOIN num ON c.k = num.k AND c.i = num.i WHERE c.i > 1),
win AS (SELECT num.k, num.latency_ms, closing.t AS closed_at, closing.i AS w
        FROM num ASOF JOIN closing ON num.k = closing.k AND num.i <= closing.i)
SELECT k AS {name}, round(closed_at, 6) AS closed_at, count(*) AS total_messages, round(max(latency_ms), 6) AS max_latency_ms,
       round(min(latency_ms), 6) AS min_latency_ms, round(avg(latency_ms), 6) AS avg_latency_ms,
       round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms, round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms
FROM win GROUP BY k, w, closed_at"""


ORACLE["latency_report_arrival"] = _arrival("event_type", "event_type")
ORACLE["latency_report_arrival_all"] = _arrival("'all'", "monitor")


# ------------------------ ranking with ties by arrival ------------------------

ORACLE["keyword_ranking_arrival"] = _KW_CTES + """,
ko AS (SELECT doc_id, unnest(keywords) AS keyword, unnest(generate_series(1, len(keywords))) AS place FROM kwa),
kl AS (SELECT keyword, count(*) AS n, list(doc_id ORDER BY doc_id DESC) AS back, arg_min(place, doc_id) AS place FROM ko GROUP BY keyword)
SELECT keyword, n, row_number() OVER (ORDER BY n DESC, back, place) AS rank FROM kl"""


# ----------------------------- induced lexicon --------------------------------

from eddy.operators import lexicon as _lx  # noqa: E402

_EDGES = f"""lw AS (
  SELECT doc_id, list_filter({sql_sentiment_words("coalesce(text, '')")}, lambda w: regexp_matches(w, {_sql_str(_lx.WORD)})) AS w FROM documents),
la AS (SELECT doc_id, unnest(w) AS a, unnest(generate_series(1, len(w))) AS i, w FROM lw WHERE len(w) > 1),
lb AS (SELECT a, unnest(w[i + 1 : i + {_lx.REACH}]) AS b FROM la),
lp AS (SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS n FROM lb WHERE a <> b GROUP BY 1, 2),
l2 AS (SELECT a, b, n FROM lp UNION ALL SELECT b, a, n FROM lp),
ls AS (SELECT a, sum(n)::BIGINT AS s FROM l2 GROUP BY a),
edge AS (
  SELECT * FROM (
    SELECT l2.a, l2.b, l2.n, round(ln(l2.n::DOUBLE * (SELECT sum(s)::DOUBLE FROM ls) / (x.s::DOUBLE * y.s::DOUBLE)), 6) AS weight
    FROM l2 JOIN ls x ON l2.a = x.a JOIN ls y ON l2.b = y.a WHERE l2.n >= {_lx.LEAST} AND x.s >= {_lx.LEAST} AND y.s >= {_lx.LEAST})
  WHERE weight > 0)"""


def _odds(hit: str, of: str) -> str:
    return f"round(ln((({hit} + 0.5) / ({of} + 1.0)) / ((n - {hit} + 0.5) / (tn - {of} + 1.0))), 6)"


_SEEDS = """kn AS (
  SELECT doc_id, max(coalesce((toxic = 1)::INT, 0)) AS bad, max(coalesce((quality = 1 AND toxic = 0)::INT, 0)) AS good
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
kt AS (SELECT count(*)::DOUBLE AS tn, sum(bad)::DOUBLE AS tb, sum(good)::DOUBLE AS tg FROM kn JOIN documents USING (doc_id)),
kw_ AS (SELECT word, count(*) AS n, sum(bad) AS bad, sum(good) AS good
        FROM (SELECT doc_id, unnest(list_distinct(w)) AS word FROM lw) JOIN kn USING (doc_id) GROUP BY word),
seed AS (
  SELECT word, CASE WHEN """ + _odds("bad", "tb") + f""" >= {_lx.ODDS} THEN -{_lx.SEED}::DOUBLE
                    WHEN """ + _odds("good", "tg") + f""" >= {_lx.ODDS} THEN {_lx.SEED}::DOUBLE END AS valence
  FROM kw_, kt WHERE n >= {_lx.LEAST})"""

ORACLE["word_edges"] = "WITH " + _EDGES + "\nSELECT a, b, n, weight FROM edge"
ORACLE["sentiment_seeds"] = "WITH " + _EDGES + ",\n" + _SEEDS + "\nSELECT word, valence FROM seed WHERE valence IS NOT NULL"
ORACLE["lexicon_step"] = "WITH " + _EDGES + ",\n" + _SEEDS + f""",
sd AS (SELECT word, valence FROM seed WHERE valence IS NOT NULL),
far AS (SELECT a, sum(weight) AS s FROM edge GROUP BY a)
SELECT word, valence FROM sd
UNION ALL
SELECT e.a, round({_lx.DAMPING}::DOUBLE * sum(e.weight * sd.valence) / max(far.s), 6)
FROM edge e JOIN sd ON e.b = sd.word JOIN far ON e.a = far.a
WHERE e.a NOT IN (SELECT word FROM sd) GROUP BY e.a"""
