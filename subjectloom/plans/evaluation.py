"""Registered queries: evaluation of the lexical scorer against the true label sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectloom.functions import decide as D
from subjectloom.functions.labels import multi_hot, subjects
from subjectloom.operators import metrics as M
from subjectloom.operators.ensembles import hard_vote, soft_vote
from subjectloom.operators.one_vs_rest import balanced_weights as weigh
from subjectloom.plans.catalog import query, with_ctes
from subjectloom.plans.frames import (
    CLASSES,
    EVIDENCE,
    LABELLED,
    SUBJECTS,
    decided_sql,
    documents,
    labelled,
    lexical_scorer,
    scored,
    side_by_side,
    subject_sets,
    texts,
)
from subjectloom.plans.scoring import MEAN, SHARES, VOTES, L
from subjectloom.session import written

BASE = (LABELLED, SUBJECTS, EVIDENCE, decided_sql("one", "d", "score >= 0.35::DOUBLE", 1))
PAIRS = "pairs AS (SELECT d.doc_id, class_idx, y, p FROM d JOIN truth USING (doc_id, class_idx))"

_COUNTS = """
  count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
  count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn"""
CELLS = f"cells AS (SELECT class_idx, {_COUNTS} FROM pairs GROUP BY class_idx)"
_P = "CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END"
_R = "CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END"
_F = "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END"
_MACRO = (
    f"round(avg({_P}), 6) AS precision, round(avg({_R}), 6) AS recall, round(avg({_F}), 6) AS f1"
)


def predicted(spark, sf_dir):
    """``(doc_id, y, p)``."""
    return scored(spark, sf_dir).select(
        "doc_id", "y", D.from_probabilities(F.col("scores")).alias("p")
    )


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


_PRF = ("precision", "recall", "f1")


@query("metric_exact_match", with_ctes(*BASE, PAIRS) + """
SELECT round(avg(same), 6) AS accuracy FROM (
  SELECT doc_id, min((y = p)::INT) AS same FROM pairs GROUP BY doc_id)""")
def metric_exact_match(spark, sf_dir):
    return rounded(M.exact_match(predicted(spark, sf_dir)), "accuracy")


@query("confusion_per_class", with_ctes(*BASE, PAIRS, CELLS) + """
SELECT class_idx, label, tp, fp, fn, tn FROM cells JOIN classes USING (class_idx)""")
def confusion_per_class(spark, sf_dir):
    return M.confusion_per_class(predicted(spark, sf_dir), CLASSES)


@query("metric_macro", with_ctes(*BASE, PAIRS, CELLS) + f" SELECT {_MACRO} FROM cells")
def metric_macro(spark, sf_dir):
    per_class = M.confusion_per_class(predicted(spark, sf_dir), CLASSES)
    return rounded(M.macro(per_class), *_PRF)


@query("metric_micro", with_ctes(*BASE, PAIRS, CELLS) + """
SELECT round(sum(tp) / (sum(tp) + sum(fp)), 6) AS precision,
       round(sum(tp) / (sum(tp) + sum(fn)), 6) AS recall,
       round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS f1 FROM cells""")
def metric_micro(spark, sf_dir):
    per_class = M.confusion_per_class(predicted(spark, sf_dir), CLASSES)
    return rounded(M.micro(per_class), *_PRF)


@query("metric_hamming", with_ctes(*BASE, PAIRS) + """
SELECT round(avg((y <> p)::INT), 6) AS hamming_loss FROM pairs""")
def metric_hamming(spark, sf_dir):
    per_class = M.confusion_per_class(predicted(spark, sf_dir), CLASSES)
    return rounded(M.hamming(per_class), "hamming_loss")


@query("classification_report", with_ctes(*BASE, PAIRS, CELLS, f"""
rep AS (SELECT label, tp, fp, fn, {_P} AS pr, {_R} AS re, {_F} AS f, tp + fn AS n
        FROM cells JOIN classes USING (class_idx))""", f"""
docs AS (SELECT doc_id, {_COUNTS} FROM pairs GROUP BY doc_id)""") + f"""
SELECT 'class' AS kind, label, round(pr, 6) AS precision, round(re, 6) AS recall,
       round(f, 6) AS f1, n AS support FROM rep
UNION ALL SELECT 'average', 'micro avg', round(sum(tp) / (sum(tp) + sum(fp)), 6),
  round(sum(tp) / (sum(tp) + sum(fn)), 6),
  round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6), sum(n)::BIGINT FROM rep
UNION ALL SELECT 'average', 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f), 6),
  sum(n)::BIGINT FROM rep
UNION ALL SELECT 'average', 'weighted avg', round(sum(pr * n) / sum(n), 6),
  round(sum(re * n) / sum(n), 6), round(sum(f * n) / sum(n), 6), sum(n)::BIGINT FROM rep
UNION ALL SELECT 'average', 'samples avg', round(avg({_P}), 6), round(avg({_R}), 6),
  round(avg({_F}), 6), sum(tp + fn)::BIGINT FROM docs""")
def classification_report(spark, sf_dir):
    return rounded(M.classification_report(predicted(spark, sf_dir), CLASSES), *_PRF)


@query("confusion_argmax", with_ctes(*BASE, PAIRS, """
firsts AS (
  SELECT doc_id, coalesce(min(class_idx) FILTER (y = 1), 0) AS t,
         coalesce(min(class_idx) FILTER (p = 1), 0) AS q FROM pairs GROUP BY doc_id)""") + """
SELECT a.label AS true_label, b.label AS predicted_label, count(f.doc_id) AS n_docs
FROM classes a CROSS JOIN classes b
LEFT JOIN firsts f ON f.t = a.class_idx AND f.q = b.class_idx GROUP BY a.label, b.label""")
def confusion_argmax(spark, sf_dir):
    return M.confusion_by_first(predicted(spark, sf_dir), CLASSES)


@query("label_distribution", with_ctes(*BASE, PAIRS) + """
SELECT label, sum(y)::BIGINT AS n_true, sum(p)::BIGINT AS n_predicted
FROM pairs JOIN classes USING (class_idx) GROUP BY label""")
def label_distribution(spark, sf_dir):
    return M.label_distribution(predicted(spark, sf_dir), CLASSES)


@query("metric_multiclass", with_ctes(LABELLED, SUBJECTS, EVIDENCE, """
best AS (
  SELECT doc_id, label AS predicted FROM one JOIN classes USING (class_idx) WHERE class_idx < 4
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class_idx) = 1)""", """
sides AS (SELECT lang AS truth, predicted FROM documents JOIN best USING (doc_id))""", """
names AS (SELECT truth AS name FROM sides UNION SELECT predicted FROM sides)""", """
cells AS (
  SELECT name, count(*) FILTER (truth = name AND predicted = name) AS tp,
         count(*) FILTER (truth <> name AND predicted = name) AS fp,
         count(*) FILTER (truth = name AND predicted <> name) AS fn
  FROM names CROSS JOIN sides GROUP BY name)""") + f"""
SELECT (SELECT round(avg((truth = predicted)::INT), 6) FROM sides) AS accuracy, {_MACRO}
FROM cells""")
def metric_multiclass(spark, sf_dir):
    """One language per document: the best of the four language scores."""
    languages = F.slice("scores", 1, 4)
    best = F.get(F.array(*[F.lit(c) for c in CLASSES]), F.get(D.best_k(languages, 1), F.lit(0)))
    guesses = scored(spark, sf_dir).select("doc_id", best.alias("predicted"))
    df = documents(spark, sf_dir).select("doc_id", "lang").join(guesses, "doc_id")
    return rounded(M.single_label_metrics(df, "lang", "predicted"), "accuracy", *_PRF)


@query("model_comparison", with_ctes(
    LABELLED, SUBJECTS, EVIDENCE, MEAN, VOTES, SHARES,
    decided_sql("evidence", "single", "score >= 0.35::DOUBLE", 1, "doc_id, model"),
    decided_sql("mean", "soft", "score >= 0.35::DOUBLE", 1),
    decided_sql("shares", "hard", "n_votes * 2 > 3", 1), """
preds AS (
  SELECT model, doc_id, class_idx, p FROM single
  UNION ALL SELECT 'ensemble soft', doc_id, class_idx, p FROM soft
  UNION ALL SELECT 'ensemble hard', doc_id, class_idx, p FROM hard)""", """
pairs AS (SELECT model, doc_id, class_idx, y, p FROM preds JOIN truth USING (doc_id, class_idx))""",
    f"cells AS (SELECT model, class_idx, {_COUNTS} FROM pairs GROUP BY model, class_idx)", """
exact AS (
  SELECT model, avg(same) AS accuracy FROM (
    SELECT model, doc_id, min((y = p)::INT) AS same FROM pairs GROUP BY model, doc_id)
  GROUP BY model)""") + f"""
SELECT model, round(any_value(accuracy), 6) AS accuracy, {_MACRO}
FROM cells JOIN exact USING (model) GROUP BY model""")
def model_comparison(spark, sf_dir):
    """Every model and both ensembles, scored from one pass over the texts."""
    scores = written(side_by_side(spark, sf_dir), "scores")
    single = scores.select("doc_id", F.inline("by_model")).select(
        "doc_id", "model", D.from_probabilities(F.col("scores")).alias("p")
    )
    soft = soft_vote(scores, "doc_id", L).select("doc_id", F.lit("ensemble soft").alias("model"), "p")
    hard = hard_vote(scores, "doc_id", L, 0.7).select(
        "doc_id", F.lit("ensemble hard").alias("model"), "p"
    )
    truth = subject_sets(spark, sf_dir).select(
        "doc_id", multi_hot(F.col("labels"), CLASSES).alias("y")
    )
    both = M.align(truth, single.unionByName(soft).unionByName(hard), "doc_id")
    return rounded(M.model_comparison(both, CLASSES), "accuracy", *_PRF)


@query("align_truth_pred", with_ctes(*BASE, PAIRS, """
truth_side AS (SELECT doc_id FROM labelled WHERE quality IS NOT NULL)""", """
pred_side AS (SELECT doc_id FROM documents WHERE length(text) > 500)""") + """
SELECT count(*) FILTER (t.doc_id IS NOT NULL AND p.doc_id IS NOT NULL) AS n_both,
       count(*) FILTER (p.doc_id IS NULL) AS n_truth_only,
       count(*) FILTER (t.doc_id IS NULL) AS n_predicted_only,
       (SELECT round(avg(same), 6) FROM (
          SELECT doc_id, min((y = p)::INT) AS same FROM pairs
          WHERE doc_id IN (SELECT doc_id FROM truth_side)
            AND doc_id IN (SELECT doc_id FROM pred_side) GROUP BY doc_id)) AS accuracy
FROM truth_side t FULL JOIN pred_side p USING (doc_id)""")
def align_truth_pred(spark, sf_dir):
    """Truth for marked documents against predictions for the longer ones."""
    truth = labelled(spark, sf_dir).where("quality IS NOT NULL").select(
        "doc_id", multi_hot(subjects(F.col("label"), CLASSES), CLASSES).alias("y")
    )
    longer = texts(spark, sf_dir).where(F.length("text") > 500)
    guesses = lexical_scorer("both")(longer).select(
        "doc_id", D.from_probabilities(F.col("scores")).alias("p")
    )
    return rounded(M.alignment_accuracy(truth, guesses, "doc_id"), "accuracy")


@query("balanced_weights", with_ctes(LABELLED, SUBJECTS, EVIDENCE) + """
SELECT class_idx, label, sum(y)::BIGINT AS n_pos, sum(1 - y)::BIGINT AS n_neg,
       round(count(*) / (2 * sum(y)), 6) AS w_pos, round(count(*) / (2 * sum(1 - y)), 6) AS w_neg
FROM truth JOIN classes USING (class_idx) GROUP BY class_idx, label""")
def balanced_weights(spark, sf_dir):
    y = subject_sets(spark, sf_dir).select(multi_hot(F.col("labels"), CLASSES).alias("y"))
    return rounded(weigh(y, CLASSES), "w_pos", "w_neg")
