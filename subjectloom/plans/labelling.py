"""Registered queries: label strings, sets, vocabularies and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectloom.functions import labels as L
from subjectloom.functions import text as X
from subjectloom.operators import vocabulary as V
from subjectloom.plans.catalog import query, with_ctes
from subjectloom.plans.cleaning import CLEAN_CTES
from subjectloom.plans.frames import (
    CLASSES,
    LABELLED,
    MESSY,
    SUBJECTS,
    bits,
    labelled,
    messy_labels,
    subject_sets,
)
from subjectloom.session import fresh_path
from subjectloom.sources import sinks

_NAMES = ", ".join(f"'{c}'" for c in CLASSES)
_ROWS = ", ".join(f"({i}, {c!r})" for i, c in enumerate(CLASSES))
_GRID = f"classes(class_idx, label) AS (VALUES {_ROWS})"


def _parsed(pattern: str, lower: bool, distinct: bool) -> str:
    raw = "lower(raw)" if lower else "raw"
    kept = f"list_filter(regexp_split_to_array({raw}, '{pattern}'), lambda x: x <> '')"
    out = "list_filter(k, lambda x, i: list_position(k, x) = i)" if distinct else "k"
    return with_ctes(LABELLED, MESSY) + f"""
SELECT doc_id, len(coalesce({out}, [])) AS n, coalesce(array_to_string({out}, '+'), '') AS labels
FROM (SELECT doc_id, {kept} AS k FROM messy)"""


def _parse_query(how):
    def run(spark, sf_dir):
        parsed = messy_labels(spark, sf_dir).select(
            "doc_id", L.parse_labels(F.col("raw"), how).alias("k")
        )
        return parsed.select(
            "doc_id", F.size("k").cast("long").alias("n"), F.array_join("k", "+").alias("labels")
        )

    return run


for _how, _fmt in L.FORMATS.items():
    query(f"labels_parse_{_how}", _parsed(*_fmt))(_parse_query(_how))


@query("labels_toplevel", with_ctes(LABELLED, MESSY) + """
SELECT d.doc_id, coalesce(string_agg(split_part(tok, '.', 1), '+' ORDER BY pos), '') AS tops
FROM documents d LEFT JOIN (
  SELECT doc_id, unnest(k) AS tok, generate_subscripts(k, 1) AS pos FROM (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(raw), '[,;/|]|\\s+'),
                               lambda x: x <> '') AS k
    FROM messy WHERE raw IS NOT NULL)) t USING (doc_id) GROUP BY d.doc_id""")
def labels_toplevel(spark, sf_dir):
    parsed = L.parse_labels(F.col("raw"), "evaluate")
    return messy_labels(spark, sf_dir).select(
        "doc_id", F.array_join(L.top_level(parsed), "+").alias("tops")
    )


@query("labels_intersect", with_ctes(LABELLED, SUBJECTS) + """
SELECT d.doc_id, coalesce(string_agg(r.label, ' ' ORDER BY r.label), '') AS labels
FROM documents d LEFT JOIN label_rows r ON r.doc_id = d.doc_id AND r.label IN ('en', 'fr', 'q')
GROUP BY d.doc_id""")
def labels_intersect(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "doc_id",
        L.to_stored(L.subjects(F.col("label"), ("EN", "fr", "Q"))).alias("labels"),
    )


@query("filter_categories", with_ctes(LABELLED, SUBJECTS) + """
SELECT r.doc_id, length(d.text) AS n_chars, string_agg(r.label, ' ' ORDER BY r.label) AS labels
FROM label_rows r JOIN documents d USING (doc_id) WHERE r.label IN ('es', 'fr', 'q')
GROUP BY r.doc_id, d.text""")
def filter_categories(spark, sf_dir):
    """Rows with at least one allowed label."""
    kept = labelled(spark, sf_dir).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        L.subjects(F.col("label"), ("es", "fr", "q")).alias("set"),
    ).where(F.size("set") > 0)
    return kept.select("doc_id", "n_chars", L.to_stored(F.col("set")).alias("labels"))


@query("labels_join_list", with_ctes(LABELLED) + """
SELECT doc_id, array_to_string(string_split(label, ' '), ';') AS label FROM labelled""")
def labels_join_list(spark, sf_dir):
    as_list = F.split("label", " ")
    return labelled(spark, sf_dir).select("doc_id", L.join_list(as_list).alias("label"))


@query("labels_parse_list", with_ctes(LABELLED) + """
SELECT doc_id, upper(label) AS raw, lower(array_to_string(string_split(label, ' '), '+')) AS labels
FROM labelled""")
def labels_parse_list(spark, sf_dir):
    """Labels that arrive as an array, with blanks and stray spaces."""
    df = labelled(spark, sf_dir).select("doc_id", F.upper("label").alias("raw"))
    padded = F.concat(F.transform(F.split("raw", " "), lambda x: F.concat(F.lit(" "), x)),
                      F.array(F.lit(" ")))
    return df.select("doc_id", "raw", F.array_join(L.parse_label_list(padded), "+").alias("labels"))


@query("labels_to_string", with_ctes(LABELLED, SUBJECTS) + """
SELECT doc_id, string_agg(label, ' ' ORDER BY label) AS label FROM label_rows GROUP BY doc_id""")
def labels_to_string(spark, sf_dir):
    return subject_sets(spark, sf_dir).select(
        "doc_id", L.to_stored(F.col("labels")).alias("label")
    )


@query("label_vocab", with_ctes(LABELLED, SUBJECTS) + """
SELECT (row_number() OVER (ORDER BY label) - 1)::INT AS class_idx, label
FROM (SELECT DISTINCT label FROM label_rows)""")
def label_vocab(spark, sf_dir):
    """Learnt from the data, saved, and read back."""
    path = fresh_path(spark, "vocabulary")
    sinks.write_vocabulary(V.learn_vocabulary(subject_sets(spark, sf_dir)), path)
    return sinks.read_vocabulary(spark, path)


@query("multi_hot", with_ctes(LABELLED, SUBJECTS, _GRID) + """
SELECT d.doc_id, string_agg((r.label IS NOT NULL)::INT::VARCHAR, '' ORDER BY c.class_idx) AS y
FROM documents d CROSS JOIN classes c
LEFT JOIN label_rows r ON r.doc_id = d.doc_id AND r.label = c.label GROUP BY d.doc_id""")
def multi_hot(spark, sf_dir):
    return subject_sets(spark, sf_dir).select(
        "doc_id", bits(L.multi_hot(F.col("labels"), CLASSES)).alias("y")
    )


@query("inverse_labels", with_ctes(LABELLED, SUBJECTS) + """
SELECT d.doc_id, coalesce(string_agg(r.label, ' ' ORDER BY r.label), '') AS labels
FROM documents d LEFT JOIN label_rows r ON r.doc_id = d.doc_id AND r.label <> 'en'
GROUP BY d.doc_id""")
def inverse_labels(spark, sf_dir):
    """To 0/1 vectors over a vocabulary that lacks ``en``, and back."""
    vocabulary = [c for c in CLASSES if c != "en"]
    return subject_sets(spark, sf_dir).select(
        "doc_id", L.multi_hot(F.col("labels"), vocabulary).alias("y")
    ).select("doc_id", F.array_join(L.labels_of(F.col("y"), vocabulary), " ").alias("labels"))


@query("label_counts", with_ctes(LABELLED, SUBJECTS) + """
SELECT label, count(*) AS n_docs FROM label_rows GROUP BY label""")
def label_counts(spark, sf_dir):
    return V.label_counts(subject_sets(spark, sf_dir))


_WANTED = ("de", "DE", "en", "it", "Q", "q", "xx")


@query("label_counts_wanted", with_ctes(LABELLED, MESSY) + f"""
, tokens AS (
  SELECT DISTINCT doc_id, split_part(tok, '.', 1) AS label FROM (
    SELECT doc_id, unnest(list_filter(regexp_split_to_array(raw, '{L.FORMATS["count"][0]}'),
                                      lambda x: x <> '')) AS tok FROM messy))
SELECT w.label, count(t.label) AS n_docs
FROM (VALUES {", ".join(f"('{w}')" for w in _WANTED)}) w(label) LEFT JOIN tokens t USING (label)
GROUP BY w.label""")
def label_counts_wanted(spark, sf_dir):
    """Labels as typed: the counter keeps their case."""
    df = messy_labels(spark, sf_dir).select(
        L.top_level(L.parse_labels(F.col("raw"), "count"), lower=False).alias("labels")
    )
    return V.label_counts_wanted(df, _WANTED)


@query("clean_label_counts", with_ctes(*CLEAN_CTES, LABELLED, SUBJECTS) + """
SELECT r.label, count(*) AS n_docs, sum(length(c.text_clean)) ::BIGINT AS n_clean_chars,
       count(CASE WHEN c.text_clean = '' THEN 1 END) AS n_empty
FROM label_rows r JOIN clean c USING (doc_id) GROUP BY r.label""")
def clean_label_counts(spark, sf_dir):
    """Corpus to clean text to label sets to counts: the preparation stage in one plan."""
    prepared = labelled(spark, sf_dir).select(
        X.normalize_text(F.col("text")).alias("text_clean"),
        L.subjects(F.col("label"), CLASSES).alias("labels"),
    ).where(F.size("labels") > 0)
    sized = prepared.select("labels", F.length("text_clean").alias("size"))
    return sized.select("size", F.explode("labels").alias("label")).groupBy("label").agg(
        F.count("*").alias("n_docs"),
        F.sum("size").alias("n_clean_chars"),
        F.count_if(F.col("size") == 0).alias("n_empty"),
    )
