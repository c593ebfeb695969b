"""Registered queries: text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectloom.functions import stemming
from subjectloom.functions import text as X
from subjectloom.operators.tokens import lemmatize_tokens, stem_tokens
from subjectloom.plans.catalog import query, with_ctes
from subjectloom.plans.frames import table, texts
from subjectloom.session import written

_W = f"[{X.WORD}]"
_S = f"[{X.SPACE}]"
_PUNCT = X.PUNCTUATION.replace("'", "''")
_STOP = ", ".join(f"'{w}'" for w in X.ENGLISH_STOP_WORDS)


def _mark(sql: str) -> str:
    """Word runs between chr(1) and chr(2): word boundaries in Unicode terms for RE2."""
    return f"regexp_replace({sql}, '({_W}+)', chr(1) || '\\1' || chr(2), 'g')"


def _unmark(sql: str) -> str:
    return f"replace(replace({sql}, chr(1), ''), chr(2), '')"


def _urls(sql: str) -> str:
    return f"regexp_replace({sql}, 'https?://[^{X.SPACE}]+|www\\.[^{X.SPACE}]+', ' ', 'g')"


def _numbers(sql: str) -> str:
    number = "'\\x01\\p{Nd}+\\x02(\\.\\x01\\p{Nd}+\\x02)?'"
    return _unmark(f"regexp_replace({_mark(sql)}, {number}, ' ', 'g')")


def _bare(column: str) -> str:
    numberless = _numbers(_urls(f"lower({column})"))
    return f"translate({numberless}, '{_PUNCT}', '')"


def _tokens(bare: str) -> str:
    parted = _mark(f"regexp_replace({bare}, '([{X.QUOTES}])', ' \\1 ', 'g')")
    for first, second in X.FUSED_WORDS:
        parted = f"replace({parted}, chr(1) || '{first}{second}' || chr(2), '{first} {second}')"
    split = f"regexp_split_to_array({_unmark(parted)}, '{_S}+')"
    return f"list_filter({split}, lambda t: t <> '')"


def _words(tokens: str) -> str:
    return (
        f"list_filter({tokens}, lambda t: regexp_full_match(t, '\\p{{L}}+') AND t NOT IN ({_STOP}))"
    )


def _long(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: length(t) >= 2)"


BARE = f"bare AS (SELECT doc_id, {_bare('text')} AS bare FROM documents)"
TOKENS = f"tokens AS (SELECT doc_id, {_tokens('bare')} AS tokens FROM bare)"
WORDS = f"words AS (SELECT doc_id, {_words('tokens')} AS tokens FROM tokens)"
CLEAN = f"""clean AS (
  SELECT doc_id, array_to_string({_long('tokens')}, ' ') AS text_clean FROM words)"""
CLEAN_CTES = (BARE, TOKENS, WORDS, CLEAN)


@query("text_lower", "SELECT doc_id, lower(text) AS text_lower FROM documents")
def text_lower(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", X.lowercase(F.col("text")).alias("text_lower"))


@query("strip_urls", f"""
SELECT page_id, {_urls("lower(url || ' ' || html || ' see ' || url)")} AS stripped FROM pages""")
def strip_urls(spark, sf_dir):
    text = F.concat("url", F.lit(" "), "html", F.lit(" see "), "url")
    return table(spark, sf_dir, "pages").select(
        "page_id", X.strip_urls(X.lowercase(text)).alias("stripped")
    )


@query("strip_numbers", f"SELECT doc_id, {_numbers('lower(text)')} AS stripped FROM documents")
def strip_numbers(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "doc_id", X.strip_numbers(X.lowercase(F.col("text"))).alias("stripped")
    )


@query("strip_punct", f"SELECT doc_id, translate(text, '{_PUNCT}', '') AS stripped FROM documents")
def strip_punct(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "doc_id", X.strip_punctuation(F.col("text")).alias("stripped")
    )


@query("tokenize", with_ctes(BARE, TOKENS) + """
SELECT doc_id, len(tokens) AS n_tokens, array_to_string(tokens, '|') AS tokens FROM tokens""")
def tokenize(spark, sf_dir):
    tokens = X.tokenize(X.bare_text(F.col("text")))
    return texts(spark, sf_dir).select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", "|").alias("tokens")
    )


@query("stopword_filter", with_ctes(BARE, TOKENS, WORDS) + """
SELECT doc_id, array_to_string(tokens, ' ') AS words FROM words""")
def stopword_filter(spark, sf_dir):
    tokens = X.tokenize(X.bare_text(F.col("text")))
    return texts(spark, sf_dir).select(
        "doc_id", F.array_join(X.keep_words(tokens), " ").alias("words")
    )


@query("min_len_filter", """
SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda t: length(t) >= 4), ' ')
  AS kept FROM documents""")
def min_len_filter(spark, sf_dir):
    tokens = F.split("text", " ")
    return texts(spark, sf_dir).select(
        "doc_id", F.array_join(X.drop_short(tokens, 4), " ").alias("kept")
    )


@query("normalize_text", with_ctes(*CLEAN_CTES) + " SELECT doc_id, text_clean FROM clean")
def normalize_text(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "doc_id", X.normalize_text(F.col("text")).alias("text_clean")
    )


def _word_frame(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", X.word_tokens(F.col("text")).alias("tokens"))


def _joined(df):
    return df.select(
        "doc_id", F.array_join(X.drop_short(F.col("tokens")), " ").alias("text_clean")
    )


_PLACED = """
placed AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM words)
"""


def _rejoined(replacement: str, source: str) -> str:
    return f"""
SELECT w.doc_id, coalesce(r.text_clean, '') AS text_clean FROM words w LEFT JOIN (
  SELECT doc_id, string_agg({replacement}, ' ' ORDER BY pos) AS text_clean
  FROM {source} WHERE length({replacement}) >= 2 GROUP BY doc_id) r USING (doc_id)"""


def _stem_ctes() -> list[str]:
    ctes, source = ["step0 AS (SELECT DISTINCT token FROM placed)"], "step0"
    for i, step in enumerate(stemming.projections(), 1):
        columns = ", ".join(f"{sql} AS {name}" for name, sql in step.items())
        columns = columns.replace("'[^aeiouy]', 'c')", "'[^aeiouy]', 'c', 'g')")
        ctes.append(f"step{i} AS (SELECT token, {columns} FROM {source})")
        source = f"step{i}"
    ctes.append(f"stems AS (SELECT token, {stemming.final_choice()} AS stem FROM {source})")
    return ctes


@query("stem_tokens", with_ctes(BARE, TOKENS, WORDS, _PLACED, *_stem_ctes())
       + _rejoined("stem", "placed JOIN stems USING (token)"))
def stems(spark, sf_dir):
    return _joined(stem_tokens(_word_frame(spark, sf_dir)))


@query("lemma_join", with_ctes(BARE, TOKENS, WORDS, _PLACED, """
vocab AS (SELECT DISTINCT token FROM placed)""", """
lemmas AS (
  SELECT p.token, s.token AS lemma FROM vocab p JOIN vocab s ON p.token = s.token || 's')""")
       + _rejoined("coalesce(lemma, token)", "placed LEFT JOIN lemmas USING (token)"))
def lemma_join(spark, sf_dir):
    """The lemma table is read off the corpus: a word in -s whose stem also occurs."""
    words = written(_word_frame(spark, sf_dir), "tokens")
    # A word counts for itself, and for the one it is the -s form of, in one aggregation.
    itself, form = F.lit(1), F.lit(2)
    parts = F.transform(F.array_distinct("tokens"), lambda t: F.array(
        F.struct(t.alias("lemma"), itself.alias("as")),
        F.struct(F.when(t.endswith("s"), t.substr(F.lit(1), F.length(t) - 1)).alias("lemma"),
                 form.alias("as")),
    ))
    seen = words.select(F.explode(F.flatten(parts)).alias("one")).select("one.*")
    both = seen.where("lemma IS NOT NULL").groupBy("lemma").agg(F.bit_or("as").alias("as"))
    lemmas = both.where(F.col("as") == 3).select(
        F.concat("lemma", F.lit("s")).alias("token"), F.lit("n").alias("tag"), "lemma"
    )
    return _joined(lemmatize_tokens(words, lemmas, "doc_id"))
