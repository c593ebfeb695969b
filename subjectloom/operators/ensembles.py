"""Combining several models' scores.

Two forms: long, ``(id, model, scores)``, for models that are scored apart, such as neighbour
models, which join; and side by side, ``(id, by_model)`` with one array of ``(model, scores)`` per
document, for models that score row by row. Votes on the second need no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectloom.functions.decide import THRESHOLD, TOP_K, above, fill_empty, from_probabilities


def stack_models(scored: dict[str, DataFrame], id_col: str) -> DataFrame:
    """``(id, model, scores)`` from one ``(id, scores)`` frame per model."""
    parts = [
        df.select(id_col, F.lit(name).alias("model"), "scores") for name, df in scored.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def gather_models(stacked: DataFrame, id_col: str) -> DataFrame:
    """Long form to side by side, models in name order: one shuffle on the id."""
    ordered = F.array_sort(F.collect_list(F.struct("model", "scores")))
    return stacked.groupBy(id_col).agg(ordered.alias("by_model"))


def _side_by_side(df: DataFrame, id_col: str) -> DataFrame:
    return df if "by_model" in df.columns else gather_models(df, id_col)


def _mean(vectors: Column, n_classes: int) -> Column:
    """Class by class mean of an array of vectors, added in their order."""
    zeros = F.array_repeat(F.lit(0.0), n_classes)
    total = F.aggregate(vectors, zeros, lambda t, v: F.zip_with(t, v, lambda a, b: a + b))
    return F.transform(total, lambda x: x / F.size(vectors))


def soft_vote(
    scored: DataFrame, id_col: str, n_classes: int, threshold: float = THRESHOLD, top_k: int = TOP_K
) -> DataFrame:
    """``(id, scores, p)``: mean scores over the models, then threshold and fallback."""
    df = _side_by_side(scored, id_col).select(
        id_col, _mean(F.col("by_model.scores"), n_classes).alias("scores")
    )
    return df.select(
        id_col, "scores", from_probabilities(F.col("scores"), threshold, top_k).alias("p")
    )


def hard_vote(
    scored: DataFrame, id_col: str, n_classes: int, threshold: float = THRESHOLD, top_k: int = TOP_K
) -> DataFrame:
    """``(id, share, p)``: each model decides alone, a class wins with more than half of the
    votes; without a winner the ``top_k`` classes of the largest vote share are taken."""
    votes = F.transform(
        F.col("by_model.scores"),
        lambda s: F.transform(from_probabilities(s, threshold, top_k), lambda x: x * F.lit(1.0)),
    )
    df = _side_by_side(scored, id_col).select(id_col, votes.alias("votes"))
    df = df.select(id_col, _mean(F.col("votes"), n_classes).alias("share"))
    won = above(F.col("share"), 0.5)
    return df.select(id_col, "share", fill_empty(won, F.col("share"), top_k).alias("p"))
