"""Registered queries: decision rules and ensembles, on scores read off the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectloom import jobs
from subjectloom.functions import decide as D
from subjectloom.functions.labels import labels_of
from subjectloom.operators.ensembles import hard_vote, soft_vote
from subjectloom.plans.catalog import query, with_ctes
from subjectloom.plans.frames import (
    BITS,
    CLASSES,
    EVIDENCE,
    LABELLED,
    SUBJECTS,
    bits,
    decided_sql,
    documents,
    labelled,
    lexical_scorer,
    long_scores,
    scored,
    side_by_side,
)
from subjectloom.session import fresh_path
from subjectloom.streaming import scoring as streaming

L = len(CLASSES)
BASE = (LABELLED, SUBJECTS, EVIDENCE)


def _vector(name: str, column: str = "p") -> str:
    """Each document's decision as a string of bits."""
    return f" SELECT doc_id, {BITS} AS {column} FROM {name} GROUP BY doc_id"


def _shift(amount: float):
    return F.transform("scores", lambda x: x - F.lit(amount))


@query("scores_pad_truncate", with_ctes(*BASE) + """
SELECT o.doc_id, w.width, g.class_idx, coalesce(o2.score, 0.0) AS score
FROM (SELECT DISTINCT doc_id FROM one) o CROSS JOIN (VALUES (4), (8)) w(width)
JOIN (SELECT unnest(range(8))::INT AS class_idx) g ON g.class_idx < w.width
LEFT JOIN one o2 ON o2.doc_id = o.doc_id AND o2.class_idx = g.class_idx""")
def scores_pad_truncate(spark, sf_dir):
    df = scored(spark, sf_dir).select(
        "doc_id",
        F.inline_outer(F.array(*[
            F.struct(F.lit(w).alias("width"), D.fit_width(F.col("scores"), w).alias("sized"))
            for w in (4, 8)
        ])),
    )
    return df.select(
        "doc_id", "width", F.posexplode_outer("sized").alias("class_idx", "score")
    )


@query("raw_scores", with_ctes(*BASE) + """
SELECT doc_id, i AS class_idx,
  CASE WHEN i = 0 THEN -(score - 0.2::DOUBLE) ELSE score - 0.2::DOUBLE END AS score
FROM one CROSS JOIN (VALUES (0), (1)) g(i) WHERE class_idx = 1""")
def raw_scores(spark, sf_dir):
    """The single decision value of a two-class problem, English or not."""
    decision = F.get("scores", F.lit(1)) - 0.2
    df = scored(spark, sf_dir).select("doc_id", D.two_sided(decision).alias("scores"))
    return long_scores(df, "doc_id")


@query("scores_sigmoid", with_ctes(*BASE) + """
SELECT doc_id, class_idx, round(1 / (1 + exp(-(score - 0.2::DOUBLE))), 6) AS score FROM one""")
def scores_sigmoid(spark, sf_dir):
    df = scored(spark, sf_dir).select("doc_id", D.sigmoid(_shift(0.2)).alias("scores"))
    return long_scores(df, "doc_id").withColumn("score", F.round("score", 6))


@query("index_to_one_hot", """
SELECT doc_id, repeat('0', i) || '1' || repeat('0', 5 - i) AS p
FROM (SELECT doc_id, CASE WHEN length(text) % 8 - 1 BETWEEN 0 AND 5
                          THEN length(text) % 8 - 1 ELSE 0 END AS i FROM documents)""")
def index_to_one_hot(spark, sf_dir):
    index = F.length("text") % 8 - 1
    return documents(spark, sf_dir).select("doc_id", bits(D.one_hot(index, L)).alias("p"))


@query("uniform_fallback", with_ctes(*BASE) + """
SELECT doc_id, class_idx, CASE WHEN l.quality IS NULL THEN 1.0 / 6 ELSE score END AS score
FROM one JOIN labelled l USING (doc_id)""")
def uniform_fallback(spark, sf_dir):
    """Documents without marks count as not scored."""
    rows = labelled(spark, sf_dir).select("doc_id", "text", "quality")
    df = lexical_scorer("both")(rows).withColumn(
        "scores", F.when(F.col("quality").isNotNull(), F.col("scores"))
    )
    return long_scores(
        df.withColumn("scores", D.uniform_if_missing(F.col("scores"), L)), "doc_id"
    )


@query("threshold_labels", with_ctes(*BASE) + """
SELECT doc_id, string_agg((score >= 0.35::DOUBLE)::INT::VARCHAR, '' ORDER BY class_idx) AS p
FROM one GROUP BY doc_id""")
def threshold_labels(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", bits(D.at_least(F.col("scores"))).alias("p"))


@query("topk_fallback", with_ctes(*BASE, decided_sql("one", "d", "score >= 0.7::DOUBLE", 2))
       + _vector("d"))
def topk_fallback(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "doc_id", bits(D.from_probabilities(F.col("scores"), 0.7, 2)).alias("p")
    )


@query("raw_score_rule", with_ctes(
    *BASE, "shifted AS (SELECT doc_id, class_idx, score - 0.5::DOUBLE AS score FROM one)",
    decided_sql("shifted", "d", "score > 0", 1)) + _vector("d"))
def raw_score_rule(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "doc_id", bits(D.from_raw_scores(_shift(0.5))).alias("p")
    )


@query("hard_first_class", with_ctes(*BASE, """
hits AS (SELECT doc_id, class_idx, (class_idx < 5 AND score >= 0.7::DOUBLE)::INT AS hit FROM one)""",
"""
d AS (SELECT *, CASE WHEN sum(hit) OVER (PARTITION BY doc_id) > 0 THEN hit
                     ELSE (class_idx = 0)::INT END AS p FROM hits)""") + _vector("d"))
def hard_first_class(spark, sf_dir):
    """Predicted vectors one class short; rows without any label get class 0."""
    hard = D.at_least(F.slice("scores", 1, L - 1), 0.7)
    return scored(spark, sf_dir).select("doc_id", hard.alias("h")).select(
        "doc_id", bits(D.from_hard_labels(F.col("h"), L)).alias("p")
    )


@query("select_interactive", with_ctes(
    *BASE, "shifted AS (SELECT doc_id, class_idx, score - 0.2::DOUBLE AS score FROM one)",
    decided_sql("shifted", "d", "score >= 0.35::DOUBLE", 3)) + """
SELECT doc_id, string_agg(p::VARCHAR, '' ORDER BY class_idx) AS p_scores,
       string_agg(hit::VARCHAR, '' ORDER BY class_idx) AS p_plain,
       string_agg((score > 0)::INT::VARCHAR, '' ORDER BY class_idx) AS p_hard
FROM d GROUP BY doc_id""")
def select_interactive(spark, sf_dir):
    """Raw scores held against the threshold, with and without fallback, and hard values."""
    df = scored(spark, sf_dir).select("doc_id", _shift(0.2).alias("s"))
    return df.select(
        "doc_id",
        bits(D.interactive(F.col("s"), "score", 0.35, 3)).alias("p_scores"),
        bits(D.interactive(F.col("s"), "score", 0.35, 0)).alias("p_plain"),
        bits(D.interactive(F.col("s"), "hard")).alias("p_hard"),
    )


_INDEX = "(length(text) % 8 - 1)"


@query("select_interactive_index", f"""
SELECT doc_id, CASE WHEN {_INDEX} < 0 THEN repeat('0', n)
  ELSE repeat('0', {_INDEX}) || '1' || repeat('0', n - 1 - {_INDEX}) END AS p
FROM documents CROSS JOIN (SELECT max({_INDEX}) + 1 AS n FROM documents)""")
def select_interactive_index(spark, sf_dir):
    """Predicted class numbers become vectors as wide as the highest number needs."""
    df = documents(spark, sf_dir).select("doc_id", (F.length("text") % 8 - 1).alias("c"))
    width = df.agg(F.max("c")).first()[0] + 1
    return df.select("doc_id", bits(D.one_hot_or_none(F.col("c"), width)).alias("p"))


@query("predict_default", with_ctes(*BASE) + """
SELECT doc_id, coalesce(string_agg(label, ' ' ORDER BY class_idx) FILTER (score > 0.5), '') AS labels
FROM one JOIN classes USING (class_idx) GROUP BY doc_id""")
def predict_default(spark, sf_dir):
    df = scored(spark, sf_dir).select("doc_id", D.by_default(F.col("scores")).alias("p"))
    return df.select("doc_id", F.array_join(labels_of(F.col("p"), CLASSES), " ").alias("labels"))


MEAN = """
mean AS (
  SELECT doc_id, class_idx, (max(score) FILTER (model = 'articles')
    + max(score) FILTER (model = 'both') + max(score) FILTER (model = 'joiners')) / 3 AS score
  FROM evidence GROUP BY doc_id, class_idx)
"""
VOTES = decided_sql("evidence", "votes", "score >= 0.7::DOUBLE", 1, "doc_id, model")
SHARES = """
shares AS (
  SELECT doc_id, class_idx, sum(p)::DOUBLE / 3 AS score, sum(p) AS n_votes
  FROM votes GROUP BY doc_id, class_idx)
"""


@query("ensemble_soft", with_ctes(*BASE, MEAN, decided_sql("mean", "d", "score >= 0.35::DOUBLE", 1))
       + """
SELECT doc_id, string_agg(p::VARCHAR, '' ORDER BY class_idx) AS p, round(max(score), 6) AS best
FROM d GROUP BY doc_id""")
def ensemble_soft(spark, sf_dir):
    return soft_vote(side_by_side(spark, sf_dir), "doc_id", L).select(
        "doc_id", bits(F.col("p")).alias("p"), F.round(F.array_max("scores"), 6).alias("best")
    )


@query("ensemble_hard", with_ctes(*BASE, VOTES, SHARES) + """
SELECT doc_id, string_agg((n_votes * 2 > 3)::INT::VARCHAR, '' ORDER BY class_idx) AS p
FROM shares GROUP BY doc_id""")
def ensemble_hard(spark, sf_dir):
    """Strict majority only; documents without one stay empty."""
    return hard_vote(side_by_side(spark, sf_dir), "doc_id", L, 0.7).select(
        "doc_id", bits(D.above(F.col("share"), 0.5)).alias("p")
    )


@query("ensemble_hard_fallback", with_ctes(
    *BASE, VOTES, SHARES, decided_sql("shares", "d", "n_votes * 2 > 3", 1)) + _vector("d"))
def ensemble_hard_fallback(spark, sf_dir):
    return hard_vote(side_by_side(spark, sf_dir), "doc_id", L, 0.7).select(
        "doc_id", bits(F.col("p")).alias("p")
    )


@query("stream_score_model", """
SELECT count(*) AS n_docs, count(*) AS n_same, count(*) AS n_decided FROM documents""")
def stream_score_model(spark, sf_dir):
    """The documents table read as a stream and scored with a model that the jobs have trained
    and saved: how many rows arrive, how many have the batch's scores, how many have labels."""
    folder = fresh_path(spark, "trained")
    rows = labelled(spark, sf_dir).select(F.col("doc_id").alias("id"), "text", "label")
    jobs.preprocess(rows, f"{folder}/clean", label_col="label", id_col="id")
    jobs.split(spark.read.parquet(f"{folder}/clean"), folder, categories=CLASSES)
    jobs.train(spark, folder, ["transformer"], n_features=256)
    stream = streaming.read_table(
        spark, f"{sf_dir}/documents.parquet", documents(spark, sf_dir).schema
    ).select(F.col("doc_id").alias("id"), "text")
    out = fresh_path(spark, "scores")
    jobs.stream(spark, folder, "transformer", stream, out, f"{out}-progress").awaitTermination()
    batch = jobs.predict(spark, folder, "transformer", rows.select("id", "text"))
    apart = F.exists(F.zip_with("a", "b", lambda x, y: F.abs(x - y)), lambda d: d > 1e-9)
    both = spark.read.parquet(out).select("id", F.col("scores").alias("a"), "labels").join(
        batch.select("id", F.col("scores").alias("b")), "id"
    )
    return both.agg(
        F.count("*").alias("n_docs"), F.count_if(~apart).alias("n_same"),
        F.count_if(F.size("labels") > 0).alias("n_decided"),
    )


@query("stream_score", with_ctes(*BASE, decided_sql("one", "d", "score >= 0.35::DOUBLE", 1))
       + _vector("d"))
def stream_score(spark, sf_dir):
    """The documents table read as a stream, scored, and written; then the sink's rows."""
    out, marks = fresh_path(spark, "scores"), fresh_path(spark, "scores-progress")
    schema = documents(spark, sf_dir).schema
    stream = streaming.read_table(spark, f"{sf_dir}/documents.parquet", schema)
    result = streaming.score_documents(stream, lexical_scorer("both")).select(
        "doc_id", bits(F.col("p")).alias("p")
    )
    streaming.write_scores(result, out, marks).awaitTermination()
    return spark.read.parquet(out)
