"""The frames that registered queries start from, in Spark and as SQL common table
expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.functions.labels import multi_hot, subjects
from subjectloom.operators.splitting import split_random
from subjectloom.sources.readers import spread

# Top-level labels of the test corpus: four languages, a quality mark, a toxicity mark.
CLASSES = ("de", "en", "es", "fr", "q", "t")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``, spread over the cores for work on whole texts."""
    return spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")


def _marks(quality: Column, toxic: Column) -> Column:
    good = F.when(quality == 1, " q.good").otherwise("")
    bad = F.when(toxic == 1, " t.toxic").otherwise("")
    return F.concat(good, bad)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a hierarchical, multi-valued label string."""
    marks = table(spark, sf_dir, "labels")
    rows = spread(documents(spark, sf_dir), "doc_id")
    return rows.join(marks, "doc_id", "left").withColumn(
        "label", F.concat("lang", F.lit("."), "source", _marks(F.col("quality"), F.col("toxic")))
    )


LABELLED = """
labelled AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic,
         d.lang || '.' || d.source
         || CASE WHEN l.quality = 1 THEN ' q.good' ELSE '' END
         || CASE WHEN l.toxic = 1 THEN ' t.toxic' ELSE '' END AS label
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""


def messy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same labels as people type them: every delimiter, mixed case, repeats, nulls."""
    df = labelled(spark, sf_dir)
    typed = F.concat(
        F.lit(" "), F.upper("lang"), F.lit("."), F.col("source"), F.lit(", "), F.col("lang"),
        F.lit("."), F.col("source"), F.lit(";"),
        F.coalesce(F.concat(F.lit("Q."), F.col("quality").cast("string")), F.lit("")),
        F.lit("/"), F.col("lang"), F.lit("|"),
        F.coalesce(F.concat(F.lit("T"), F.col("toxic").cast("string")), F.lit("")), F.lit("  "),
    )
    missing = F.col("quality").isNull() & (F.col("lang") == "es")
    return df.select("doc_id", F.when(~missing, typed).alias("raw"))


MESSY = """
messy AS (
  SELECT doc_id, CASE WHEN quality IS NULL AND lang = 'es' THEN NULL ELSE
    ' ' || upper(lang) || '.' || source || ', ' || lang || '.' || source || ';'
    || coalesce('Q.' || quality::VARCHAR, '') || '/' || lang || '|'
    || coalesce('T' || toxic::VARCHAR, '') || '  ' END AS raw
  FROM labelled)
"""


def subject_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text, labels)``: sorted top-level label sets."""
    return labelled(spark, sf_dir).select(
        "doc_id", "text", subjects(F.col("label"), CLASSES).alias("labels")
    )


SUBJECTS = """
label_rows AS (
  SELECT DISTINCT doc_id, split_part(tok, '.', 1) AS label
  FROM (SELECT doc_id, unnest(string_split(label, ' ')) AS tok FROM labelled))
"""

# Marker words of the lexical scorers: (model, scale, words per language class).
SCORERS = {
    "articles": (4.0, 0.3, 2.2, {
        "de": ("der", "die", "das", "den", "ein"), "en": ("the", "a", "an"),
        "es": ("el", "la", "los", "las", "un"), "fr": ("le", "la", "les", "un", "des"),
    }),
    "joiners": (6.0, 0.9, 1.0, {
        "de": ("und", "in", "zu", "mit", "von"), "en": ("and", "of", "to", "in", "for"),
        "es": ("y", "de", "que", "en", "por"), "fr": ("et", "de", "que", "en", "pour"),
    }),
    "both": (3.0, 0.6, 1.2, {
        "de": ("der", "die", "und", "in", "ist"), "en": ("the", "a", "and", "of", "is"),
        "es": ("el", "la", "de", "que", "es"), "fr": ("le", "la", "de", "et", "est"),
    }),
}


#: All marker words of all scorers.
_MARKERS = sorted({w for *_, words in SCORERS.values() for names in words.values() for w in names})


def _scores(tokens: Column, marks: Column, text: Column, model: str) -> Column:
    """Share of marker words per language, share of distinct words, share of non-letters."""
    scale, q_scale, t_scale, words = SCORERS[model]
    size = F.greatest(F.size(tokens), F.lit(1))
    one = F.lit(1.0)

    def marked(names: tuple[str, ...]) -> Column:
        return F.size(F.filter(marks, lambda w: w.isin(*names)))

    cells = [F.least(one, marked(words[c]) / size * scale) for c in ("de", "en", "es", "fr")]
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    other = (F.length(text) - letters) / F.greatest(F.length(text), F.lit(1))
    cells.append(F.least(one, F.size(F.array_distinct(tokens)) / size * q_scale))
    cells.append(F.least(one, other * t_scale))
    return F.array(*cells)


def with_words(df: DataFrame) -> DataFrame:
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    return df.withColumn("words", words)


def _with_marks(df: DataFrame) -> DataFrame:
    """``words`` and, picked from them once, those that are marker words, ``_marks``."""
    return with_words(df).withColumn(
        "_marks", F.filter("words", lambda w: w.isin(*_MARKERS))
    )


def lexical_scorer(model: str):
    """A stateless scorer: adds ``scores`` to any frame with ``text``, streaming or not."""
    def score(df: DataFrame) -> DataFrame:
        return _with_marks(df).withColumn(
            "scores", _scores(F.col("words"), F.col("_marks"), F.col("text"), model)
        ).drop("words", "_marks")

    return score


def scored(spark: SparkSession, sf_dir: str, model: str = "both") -> DataFrame:
    """``(doc_id, y, scores)`` of one scorer, with the true label vector."""
    df = subject_sets(spark, sf_dir)
    return lexical_scorer(model)(df).select(
        "doc_id", multi_hot(F.col("labels"), CLASSES).alias("y"), "scores"
    )


def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, by_model)``: the scores of all scorers in name order, the text being read and
    split once and never moved."""
    df = _with_marks(texts(spark, sf_dir))
    models = F.array(*[
        F.struct(F.lit(m).alias("model"),
                 _scores(F.col("words"), F.col("_marks"), F.col("text"), m).alias("scores"))
        for m in sorted(SCORERS)
    ])
    return df.select("doc_id", models.alias("by_model"))


def _marker_rows() -> str:
    rows = []
    for model, (_, _, _, words) in SCORERS.items():
        for idx, name in enumerate(("de", "en", "es", "fr")):
            rows += [f"('{model}', {idx}, '{w}')" for w in words[name]]
    return ", ".join(rows)


def _model_rows() -> str:
    return ", ".join(
        f"('{m}', {s}::DOUBLE, {q}::DOUBLE, {t}::DOUBLE)" for m, (s, q, t, _) in SCORERS.items()
    )


EVIDENCE = f"""
models(model, scale, q_scale, t_scale) AS (VALUES {_model_rows()}),
markers(model, class_idx, word) AS (VALUES {_marker_rows()}),
classes(class_idx, label) AS (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(CLASSES))}),
toks AS (
  SELECT doc_id, text, list_filter(
    regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda w: w <> '') AS words
  FROM documents),
counts AS (
  SELECT w.doc_id, m.model, m.class_idx, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word FROM toks) w JOIN markers m USING (word)
  GROUP BY ALL),
sizes AS (
  SELECT doc_id, greatest(len(words), 1) AS size, len(list_distinct(words)) AS n_distinct,
         (length(text) - length(regexp_replace(text, '[^\\p{{L}}]+', '', 'g')))
           / greatest(length(text), 1) AS other
  FROM toks),
evidence AS (
  SELECT s.doc_id, m.model, c.class_idx,
    CASE WHEN c.class_idx = 4 THEN least(1.0::DOUBLE, s.n_distinct / s.size * m.q_scale)
         WHEN c.class_idx = 5 THEN least(1.0::DOUBLE, s.other * m.t_scale)
         ELSE least(1.0::DOUBLE, coalesce(n.n, 0) / s.size * m.scale) END AS score
  FROM sizes s CROSS JOIN models m CROSS JOIN classes c
  LEFT JOIN counts n ON n.doc_id = s.doc_id AND n.model = m.model AND n.class_idx = c.class_idx),
truth AS (
  SELECT d.doc_id, c.class_idx, (r.label IS NOT NULL)::INT AS y
  FROM documents d CROSS JOIN classes c
  LEFT JOIN label_rows r ON r.doc_id = d.doc_id AND r.label = c.label),
one AS (SELECT doc_id, class_idx, score FROM evidence WHERE model = 'both')
"""


def decided_sql(source: str, name: str, rule: str, top_k: int, key: str = "doc_id") -> str:
    """A CTE ``name(key, class_idx, score, p)``: ``rule`` on ``score``, then the fallback."""
    return f"""
{name} AS (
  SELECT *, CASE WHEN sum(hit) OVER (PARTITION BY {key}) > 0 THEN hit
                 WHEN row_number() OVER (PARTITION BY {key} ORDER BY score DESC, class_idx)
                      <= {top_k} THEN 1 ELSE 0 END AS p
  FROM (SELECT *, ({rule})::INT AS hit FROM {source}))
"""


def bits(vector: Column) -> Column:
    """A 0/1 vector as text, e.g. ``010010``."""
    return F.array_join(F.transform(vector, lambda x: x.cast("string")), "")


BITS = "string_agg(p::VARCHAR, '' ORDER BY class_idx)"


def long_scores(df: DataFrame, id_col: str, column: str = "scores") -> DataFrame:
    """One row per class. The outer form keeps the optimiser from adding a filter on the
    array's size, which would work out the scores a second time."""
    return df.select(id_col, F.posexplode_outer(column).alias("class_idx", "score"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with two labels each and an exact 20 % validation split."""
    labels = F.array(
        F.concat(F.lit("c."), F.col("label").cast("string")),
        F.concat(F.lit("m."), (F.col("label") % 3).cast("string")),
    )
    df = table(spark, sf_dir, "embeddings").withColumn("labels", labels)
    return split_random(df, "vec_id")


VECTOR_CLASSES = (*(f"c.{i}" for i in range(10)), *(f"m.{i}" for i in range(3)))

VECTORS = """
vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS embedding, label,
         ['c.' || label, 'm.' || (label % 3)] AS labels,
         CASE WHEN row_number() OVER (ORDER BY md5(vec_id || ':42'), vec_id)
                   <= ceil(0.2 * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split
  FROM embeddings)
"""
