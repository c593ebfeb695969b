"""Multi-label evaluation of ``(id, y, p)`` frames, ``y`` and ``p`` being 0/1 arrays.

Everything but exact match and the per-document averages is read off one table of counts per
class, made in one pass; ``by`` adds grouping columns such as the model name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectloom.session import settled


def _count_cells(df: DataFrame, cells: Column, by: Sequence[str]) -> DataFrame:
    """A pair of 0/1 cells comes as one number, truth * 2 + prediction, so what is exploded is
    one small integer per document and class. (The outer form keeps the optimiser from adding
    a filter that would work out ``y`` and ``p`` twice.)"""
    return (
        df.select(*by, F.posexplode_outer(cells).alias("class_idx", "cell"))
        .where(F.col("class_idx").isNotNull())
        .groupBy(*by, "class_idx")
        .agg(
            F.count_if(F.col("cell") == 3).alias("tp"),
            F.count_if(F.col("cell") == 1).alias("fp"),
            F.count_if(F.col("cell") == 2).alias("fn"),
            F.count_if(F.col("cell") == 0).alias("tn"),
        )
    )


_CELLS = ("y", "p", lambda t, q: t * 2 + q)


def confusion_per_class(
    df: DataFrame, vocabulary: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """``(by…, class_idx, label, tp, fp, fn, tn)``."""
    counted = _count_cells(df, F.zip_with(*_CELLS), by)
    name = F.get(F.array(*[F.lit(v) for v in vocabulary]), F.col("class_idx"))
    return counted.select(*by, "class_idx", name.alias("label"), "tp", "fp", "fn", "tn")


def _ratio(top: Column, bottom: Column) -> Column:
    """Nothing to divide by counts as zero."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def precision(tp: Column, fp: Column) -> Column:
    return _ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return _ratio(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def macro(per_class: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean over all classes of the vocabulary."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return per_class.groupBy(*by).agg(
        F.avg(precision(tp, fp)).alias("precision"),
        F.avg(recall(tp, fn)).alias("recall"),
        F.avg(f1(tp, fp, fn)).alias("f1"),
    )


def micro(per_class: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    return per_class.groupBy(*by).agg(
        precision(tp, fp).alias("precision"),
        recall(tp, fn).alias("recall"),
        f1(tp, fp, fn).alias("f1"),
    )


def hamming(per_class: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Wrong cells over all cells."""
    wrong = F.sum(F.col("fp") + F.col("fn"))
    cells = F.sum(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return per_class.groupBy(*by).agg(_ratio(wrong, cells).alias("hamming_loss"))


def exact_match(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.coalesce(F.avg((F.col("y") == F.col("p")).cast("double")), F.lit(0.0)).alias("accuracy")
    )


def _counts_and_samples(df: DataFrame, n_classes: int) -> DataFrame:
    """One pass over the documents: counts per class, and as class ``n_classes`` the averages of
    each document's precision, recall and F1."""
    ones = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    both = F.zip_with("y", "p", lambda t, q: t * q)
    sized = df.select(
        F.zip_with(*_CELLS).alias("cells"), ones(both).alias("d_tp"), ones("y").alias("d_t"),
        ones("p").alias("d_q"),
    )
    cells = F.concat("cells", F.array(F.lit(-1)))
    rows = sized.select("d_tp", "d_t", "d_q", F.posexplode_outer(cells).alias("class_idx", "cell"))
    tp, fp, fn = F.col("d_tp"), F.col("d_q") - F.col("d_tp"), F.col("d_t") - F.col("d_tp")
    whole = F.col("class_idx") == n_classes
    return rows.groupBy("class_idx").agg(
        F.count_if(F.col("cell") == 3).alias("tp"),
        F.count_if(F.col("cell") == 1).alias("fp"),
        F.count_if(F.col("cell") == 2).alias("fn"),
        F.avg(F.when(whole, precision(tp, fp))).alias("precision"),
        F.avg(F.when(whole, recall(tp, fn))).alias("recall"),
        F.avg(F.when(whole, f1(tp, fp, fn))).alias("f1"),
        F.coalesce(F.sum(F.when(whole, F.col("d_t"))), F.lit(0)).alias("support"),
    )


def classification_report(df: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """``(kind, label, precision, recall, f1, support)``: one row per class, then the micro,
    macro, weighted and samples averages. The documents are read once; all rows come from the
    small table of counts."""
    counted = settled(_counts_and_samples(df, len(vocabulary)))
    name = F.get(F.array(*[F.lit(v) for v in vocabulary]), F.col("class_idx"))
    per_class = counted.where(F.col("class_idx") < len(vocabulary)).select(
        "class_idx", name.alias("label"), "tp", "fp", "fn"
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rows = per_class.select(
        "class_idx", "label", "tp", "fp", "fn",
        precision(tp, fp).alias("precision"),
        recall(tp, fn).alias("recall"),
        f1(tp, fp, fn).alias("f1"),
        (tp + fn).alias("support"),
    )
    support = F.sum("support")
    weighted = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), support)
    m_tp, m_fp, m_fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    averages = rows.agg(
        F.array(
            F.struct(F.lit("micro avg").alias("label"), precision(m_tp, m_fp).alias("precision"),
                     recall(m_tp, m_fn).alias("recall"), f1(m_tp, m_fp, m_fn).alias("f1"),
                     support.alias("support")),
            F.struct(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                     support.alias("support")),
            F.struct(F.lit("weighted avg").alias("label"),
                     weighted("precision").alias("precision"),
                     weighted("recall").alias("recall"), weighted("f1").alias("f1"),
                     support.alias("support")),
        ).alias("averages")
    ).select(F.inline("averages"))
    columns = ["label", "precision", "recall", "f1", "support"]
    samples = counted.where(F.col("class_idx") == len(vocabulary)).select(
        F.lit("samples avg").alias("label"), *columns[1:]
    )
    return (
        rows.select(F.lit("class").alias("kind"), *columns)
        .unionByName(averages.select(F.lit("average").alias("kind"), *columns))
        .unionByName(samples.select(F.lit("average").alias("kind"), *columns))
    )


def confusion_by_first(df: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """``(true_label, predicted_label, n_docs)`` over the full grid, where a row stands for
    its first positive class, or class 0 when it has none."""
    names = F.array(*[F.lit(v) for v in vocabulary])
    first = lambda c: F.greatest(F.array_position(c, 1) - 1, F.lit(0)).cast("int")
    counted = df.groupBy(first("y").alias("t"), first("p").alias("q")).agg(F.count("*").alias("n"))
    size = len(vocabulary)
    grid = df.sparkSession.range(size * size).select(
        (F.col("id") / size).cast("int").alias("t"), (F.col("id") % size).cast("int").alias("q")
    )
    return grid.join(counted, ["t", "q"], "left").select(
        F.get(names, F.col("t")).alias("true_label"),
        F.get(names, F.col("q")).alias("predicted_label"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_docs"),
    )


def label_distribution(df: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """``(label, n_true, n_predicted)``."""
    return confusion_per_class(df, vocabulary).select(
        "label",
        (F.col("tp") + F.col("fn")).alias("n_true"),
        (F.col("tp") + F.col("fp")).alias("n_predicted"),
    )


def single_label_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy and macro scores where each row has one class on either side; the classes
    are those that occur on either side."""
    sides = F.array(
        F.struct(F.col(truth).alias("label"), (F.col(truth) == F.col(predicted)).alias("hit"),
                 F.lit(True).alias("is_truth")),
        F.struct(F.col(predicted).alias("label"), (F.col(truth) == F.col(predicted)).alias("hit"),
                 F.lit(False).alias("is_truth")),
    )
    truth_side = F.col("is_truth")
    per_class = (
        df.select(F.inline(sides))
        .groupBy("label")
        .agg(
            F.count_if(truth_side & F.col("hit")).alias("tp"),
            F.count_if(~truth_side & ~F.col("hit")).alias("fp"),
            F.count_if(truth_side & ~F.col("hit")).alias("fn"),
        )
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return per_class.agg(
        (F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("accuracy"),
        F.avg(precision(tp, fp)).alias("precision"),
        F.avg(recall(tp, fn)).alias("recall"),
        F.avg(f1(tp, fp, fn)).alias("f1"),
    )


def model_comparison(df: DataFrame, vocabulary: Sequence[str], by: str = "model") -> DataFrame:
    """Accuracy and macro scores of several models' predictions in one pass: the exact match is
    counted as one more class, after the last."""
    n = len(vocabulary)
    exact = F.when(F.col("y") == F.col("p"), F.lit(3)).otherwise(F.lit(0))
    counted = _count_cells(df, F.concat(F.zip_with(*_CELLS), F.array(exact)), [by])
    is_class = F.col("class_idx") < n
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    hits = F.when(~is_class, _ratio(tp, tp + F.col("tn")))
    return counted.groupBy(by).agg(
        F.max(hits).alias("accuracy"),
        F.avg(F.when(is_class, precision(tp, fp))).alias("precision"),
        F.avg(F.when(is_class, recall(tp, fn))).alias("recall"),
        F.avg(F.when(is_class, f1(tp, fp, fn))).alias("f1"),
    )


def align(truth: DataFrame, predicted: DataFrame, id_col: str) -> DataFrame:
    """Puts ``(id, y)`` and ``(id, p)`` side by side; rows on one side only drop out."""
    return truth.join(predicted, id_col)


def alignment_summary(truth: DataFrame, predicted: DataFrame, id_col: str) -> DataFrame:
    """How many rows are on both sides, and how many drop out of either."""
    return alignment_accuracy(truth, predicted, id_col).drop("accuracy")


def alignment_accuracy(truth: DataFrame, predicted: DataFrame, id_col: str) -> DataFrame:
    """How many rows of ``(id, y)`` and ``(id, p)`` are on both sides, how many drop out of
    either, and the share of exact matches among those on both."""
    left = truth.select(id_col, "y", F.lit(1).alias("in_truth"))
    right = predicted.select(id_col, "p", F.lit(1).alias("in_predicted"))
    on_both = F.col("in_truth").isNotNull() & F.col("in_predicted").isNotNull()
    same = F.when(on_both, (F.col("y") == F.col("p")).cast("double"))
    return left.join(right, id_col, "full").agg(
        F.count_if(on_both).alias("n_both"),
        F.count_if(F.col("in_predicted").isNull()).alias("n_truth_only"),
        F.count_if(F.col("in_truth").isNull()).alias("n_predicted_only"),
        F.coalesce(F.avg(same), F.lit(0.0)).alias("accuracy"),
    )
