"""Text column expressions: the keyword tokenizer and the sentiment word split.

Everything here is a built-in Spark expression (regexp_replace / split /
rlike), so it runs inside whole-stage code generation with no Python in the
row path.  The same rules are rendered as DuckDB SQL for the oracle, from the
same constants, so the two cannot drift apart.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Treebank-style word tokenizer.  The text is lower-cased, these
# rewrites are applied in this order ($1/$2/$3 are capture groups), the result
# is split on Unicode white space, and only purely alphabetic tokens are kept.
TOKEN_RULES: list[tuple[str, str]] = [
    (r'([;@#$%&?!()\[\]{}<>"`*|])', r" $1 "),
    (r"([:,])([^0-9])", r" $1 $2"),
    (r"([:,])$", r" $1 "),
    (r"(\.\.+)", r" $1 "),
    (r"--", r" -- "),
    (r"([^.\s])\.(\s|$)", r"$1 . $2"),
    (r"([^' ])('ll|'re|'ve|n't|'[smd]|')(\s|$)", r"$1 $2$3"),
]
TOKEN_SPLIT = (r"[ \t\n\r\x0B\f\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}"
               r"\x{3000}]+")
# Words written as one that are two tokens, after the rewrites above.  A match
# takes the characters beside it along, so each rule is applied twice.
_OTHER = r"[^\p{L}\p{N}_]"
PAIR_RULES: list[tuple[str, str]] = [
    (rf"(^|{_OTHER})({first})({second})(\z|{_OTHER})", "$1 $2 $3 $4") for first, second in (
        ("can", "not"), ("gim|lem", "me"), ("gon", "na"), ("got", "ta"), ("d", "'ye"), ("more", "'n"))
] + [
    (rf"(^|{_OTHER})(wan)(na)(\z|{TOKEN_SPLIT[:-1]})", "$1 $2 $3 $4"),
    (rf"(^| )('t)(is|was)(\z|{_OTHER})", "$1 $2 $3 $4"),
]
# Pairs of letters only, with what becomes of them.
PAIRS = {"cannot": "can not", "gimme": "gim me", "lemme": "lem me", "gonna": "gon na", "gotta": "got ta", "wanna": "wan na"}
PAIR_HINT = r"cannot|gimme|lemme|gonna|gotta|d'ye|more'n|wanna|'tis|'twas"   # nothing else is rewritten
# A word that ends a sentence by a mark of its own.
WORD_END = r"""[?!][)"'\]}>*_`”’»]*$"""
PERIOD_RULE = 5     # of TOKEN_RULES: the one that splits off a last period
ALPHA_TOKEN = r"^\p{L}+\z"
# Forms of the constants above that match the same and that Java's engine runs faster:
# words in ASCII leave the class of white space at its first test, and a clitic is
# tried only at an apostrophe or an n.  The SQL keeps the plain forms.
_QUICK_RULES = {TOKEN_RULES[6][0]: r"([^' ])('(?:ll|re|ve|[smd])?|n't)(\s|$)"}
QUICK_SPLIT = f"(?=[^!-~]){TOKEN_SPLIT}"
# What the rewrites take as white space, and what they find across it: texts that
# hold none of these are rewritten word by word.
RULE_SPACE = r"[ \t\n\x0B\f\r]+"
_ACROSS = ("'tis", "'twas", "\u0085", "\u2028", "\u2029")
MARKS = ".,:;!?"        # one of them after a word is a token of its own
# Sentiment words: split on white space, strip this outer punctuation, keep
# inner apostrophes (so "don't" survives as a negation).
WORD_SPLIT = r"\s+"
WORD_STRIP = r"^[^\p{L}\p{N}']+|[^\p{L}\p{N}']+$"
# ---------------------------------------------------------------------------


@lru_cache(maxsize=None)
def english_stopwords() -> tuple[str, ...]:
    """The fixed English stopword list shipped in ``eddy/data``."""
    text = resources.files("eddy.data").joinpath("stopwords_en.txt").read_text("utf-8")
    return tuple(w.strip() for w in text.splitlines() if w.strip() and not w.startswith("#"))


def normalized_text(text: Column) -> Column:
    """Lower-case and apply the tokenizer rewrites (T1 + first half of T2)."""
    c = F.lower(text)
    for pattern, repl in TOKEN_RULES:
        c = F.regexp_replace(c, _QUICK_RULES.get(pattern, pattern), repl)
    return _paired(c)


def _hinted(c: Column) -> Column:
    """Whether PAIR_HINT, a list of plain words, occurs."""
    return reduce(lambda a, b: a | b, (c.contains(w) for w in PAIR_HINT.split("|")))


def _paired(c: Column) -> Column:
    def rewritten(x: Column) -> Column:
        paired = x
        for pattern, repl in PAIR_RULES + PAIR_RULES:
            paired = F.regexp_replace(paired, pattern, repl)
        return F.when(_hinted(x), paired).otherwise(x)
    # A lambda's argument is evaluated once a row, a column named twice is not.
    return F.transform(F.array(c), rewritten)[0]


def raw_tokens(text: Column) -> Column:
    """array<string> of all tokens, punctuation included."""
    return F.split(normalized_text(text), QUICK_SPLIT)


def word_tokens(word: Column, closing: bool) -> Column:
    """array<string> of the tokens of one white-space word, lower-cased.  A last
    period is a token of its own only in a word that closes a sentence."""
    c = F.lower(word)
    for k, (pattern, repl) in enumerate(TOKEN_RULES):
        if closing or k != PERIOD_RULE:
            c = F.regexp_replace(c, _QUICK_RULES.get(pattern, pattern), repl)
    return F.filter(F.split(_paired(c), QUICK_SPLIT), lambda t: F.length(t) > 0)


def is_one_token(low: Column) -> Column:
    """Whether a lower-cased word is all letters and no pair: ``word_tokens`` gives it whole."""
    return low.rlike(ALPHA_TOKEN) & ~low.isin([w for w in PAIR_HINT.split("|") if w.isalpha()])


def alpha_tokens(text: Column) -> Column:
    """Per-row array of alphabetic tokens, order kept (T2 + T3)."""
    return F.filter(raw_tokens(text), lambda t: t.rlike(ALPHA_TOKEN))


def alpha_words(text: Column) -> Column:
    """``alpha_tokens`` word by word: for each white-space word its alphabetic tokens with
    a space between them, mostly one.  Most words are letters with at most one of
    ``MARKS`` behind them; they are left as they are, for ``plain_tokens``."""
    plain = rf"^\p{{L}}+[{MARKS}]?\z"

    def of_word(w: Column) -> Column:
        return F.when(w.rlike(plain), w).otherwise(F.array_join(F.filter(word_tokens(w, True), lambda t: t.rlike(ALPHA_TOKEN)), " "))

    def of_text(low: Column) -> Column:
        across = reduce(lambda a, b: a | b, (low.contains(w) for w in _ACROSS))
        return F.when(across, alpha_tokens(low)).otherwise(F.transform(F.split(low, RULE_SPACE), of_word))
    return F.transform(F.array(F.lower(text)), of_text)[0]


def plain_tokens(word: str) -> list[str]:
    """The alphabetic tokens of one of the ``alpha_words``."""
    bare = word.rstrip(MARKS)
    return [t for t in PAIRS.get(bare, bare).split(" ") if t]


def sentiment_words(text: Column, lower: bool = True) -> Column:
    """Words for sentiment scoring, lower-cased by default, apostrophes kept."""
    words = F.split(F.lower(text) if lower else text, WORD_SPLIT)
    return F.transform(words, lambda w: F.when(w.rlike("[^a-z]"), F.regexp_replace(w, WORD_STRIP, "")).otherwise(w))


# ----------------------------- DuckDB renderings -----------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _duck_repl(repl: str) -> str:
    return repl.replace("$", "\\")


def _sql_rules(expr: str, rules: list[tuple[str, str]]) -> str:
    for pattern, repl in rules:
        expr = f"regexp_replace({expr}, {_sql_str(pattern)}, {_sql_str(_duck_repl(repl))}, 'g')"
    return expr


def sql_normalized_text(expr: str) -> str:
    return _sql_rules(f"lower({expr})", TOKEN_RULES + PAIR_RULES + PAIR_RULES)


def sql_word_tokens(expr: str, closing: bool) -> str:
    rules = [r for k, r in enumerate(TOKEN_RULES) if closing or k != PERIOD_RULE]
    out = _sql_rules(f"lower({expr})", rules + PAIR_RULES + PAIR_RULES)
    return f"list_filter(regexp_split_to_array({out}, {_sql_str(TOKEN_SPLIT)}), lambda t: length(t) > 0)"


def sql_raw_tokens(expr: str) -> str:
    return f"regexp_split_to_array({sql_normalized_text(expr)}, {_sql_str(TOKEN_SPLIT)})"


def sql_is_alpha(expr: str) -> str:
    return f"regexp_matches({expr}, {_sql_str(ALPHA_TOKEN)})"


def sql_stopword_list() -> str:
    return "(" + ", ".join(_sql_str(w) for w in english_stopwords()) + ")"


def sql_sentiment_words(expr: str) -> str:
    return (f"list_transform(regexp_split_to_array(lower({expr}), {_sql_str(WORD_SPLIT)}), "
            f"lambda w: regexp_replace(w, {_sql_str(WORD_STRIP)}, '', 'g'))")
