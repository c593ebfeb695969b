"""Label vocabularies and label counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def fixed_vocabulary(spark: SparkSession, categories: Sequence[str]) -> DataFrame:
    """``(class_idx, label)`` for given categories: case-folded, sorted."""
    names = sorted({c.lower() for c in categories})
    return spark.createDataFrame(list(enumerate(names)), "class_idx int, label string")


#: More labels than this are taken for free text, and refused: each is a class of its own, a
#: column of every label vector and a fitted model.
MAX_LABELS = 10_000


def learn_vocabulary(df: DataFrame, labels_col: str = "labels") -> DataFrame:
    """``(class_idx, label)`` of the labels that occur, sorted. The numbering runs over the
    distinct labels only."""
    distinct = df.select(F.explode(labels_col).alias("label")).distinct()
    return distinct.select(
        (F.row_number().over(Window.orderBy("label")) - 1).alias("class_idx"), "label"
    )


def vocabulary_list(vocabulary: DataFrame) -> list[str]:
    """The vocabulary on the driver: one short string per class."""
    rows = vocabulary.limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    return [r["label"] for r in sorted(rows, key=lambda r: r["class_idx"])]


def label_counts(df: DataFrame, labels_col: str = "labels") -> DataFrame:
    """Documents per label, each label counted once per document."""
    return (
        df.select(F.explode(F.array_distinct(labels_col)).alias("label"))
        .groupBy("label")
        .agg(F.count("*").alias("n_docs"))
    )


def label_counts_wanted(
    df: DataFrame, wanted: Sequence[str], labels_col: str = "labels"
) -> DataFrame:
    """Counts for a given list of labels, zero where a label does not occur."""
    names = df.sparkSession.createDataFrame([(w,) for w in wanted], "label string")
    return names.join(label_counts(df, labels_col), "label", "left").select(
        "label", F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs")
    )
