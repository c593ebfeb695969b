"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.llm.common import free_name, in_small_batches, in_train_fold, table, with_row_key
from subjectloom.llm.hashing import AS_TERMS, word_hashes
from subjectloom.operators.lookup import lookup_join
from subjectloom.session import settled

#: Words and their first bytes, by these lengths, are hashed to so many columns, as a power of two.
PREFIXES = (4, 5, 6, 8)
BITS = 18
#: The classifiers see only so many columns: those most surely more frequent in confirmed than in
#: unlabelled texts, in standard errors of the difference of shares, by a factor of at least LIFT.
FEATURES = 512
SURE = 5.0
LIFT = 3.0
#: The classifiers learn from at most so many different texts of each kind; the counts that the
#: columns are chosen by are taken over all of them.
MAX_POSITIVE = 8192
MAX_UNLABELLED = 16384
#: Classifiers, each on its own half of the unlabelled sample; their probabilities are averaged.
MEMBERS = 3
ROUNDS = 400
RATE = 0.05
DECAY = 1e-4
#: Share of toxic texts to assume where no row is labelled as not toxic.
PRIOR = 0.1


def _columns(texts: pd.Series, bits: int) -> Iterator[np.ndarray]:
    for hashes in word_hashes(texts, AS_TERMS, PREFIXES):
        yield np.unique(hashes >> np.uint64(64 - bits)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit_linear(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = ROUNDS,
    rate: float = RATE, decay: float = DECAY,
) -> tuple[np.ndarray, float]:
    """Weights and offset that minimise the non-negative risk with the sigmoid loss, which is
    bounded, so that few confident scores cannot outweigh the rest.

    With g the score, the risk of a text being positive is estimated from the positives; that
    of being negative from the unlabelled texts, less what the positives among them add:
    ``prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])``, ``l(g) = 1 / (1 + e^g)``.
    Where the second part falls below zero, the step goes the other way on it, so it cannot be
    driven down by memorising. Adam over all rows. The offset is then lowered to the cut of
    ``best_cut``, if that is below zero.
    """
    w = np.zeros(positive.shape[1] + 1)
    p = np.hstack([positive, np.ones((len(positive), 1), positive.dtype)])
    u = np.hstack([unlabelled, np.ones((len(unlabelled), 1), unlabelled.dtype)])
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        from_p = prior * ((sp * (1 - sp)) @ p) / len(p)
        from_u = ((su * (1 - su)) @ u) / len(u)
        grad = from_u - 2 * from_p if su.mean() >= prior * sp.mean() else from_p - from_u
        grad[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1] - min(0.0, best_cut(p @ w, u @ w, prior)))


def best_cut(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The score from which on texts should count as positive, by what positive and unlabelled
    texts can tell: the largest ``r * r / f``, which grows with precision and recall, where r is
    the share of positives and f that of unlabelled texts at or above it (no less than the
    positives among them). It lies half way to the next lower score."""
    cuts = np.unique(positive)
    p, u = np.sort(positive), np.sort(unlabelled)
    r = 1 - np.searchsorted(p, cuts) / len(p)
    f = np.maximum(1 - np.searchsorted(u, cuts) / len(u), np.maximum(prior * r, 1 / len(u)))
    cut = cuts[int(np.argmax(r * r / f))]
    below = max((x[np.searchsorted(x, cut) - 1] for x in (p, u) if x[0] < cut), default=cut - 1.0)
    return float(cut + below) / 2


class Model(NamedTuple):
    columns: np.ndarray  # sorted
    weights: np.ndarray  # a row per column, a column per classifier
    offsets: np.ndarray
    bits: int

    def score(self, texts: pd.Series) -> pd.Series:
        out = []
        for found in _columns(texts, self.bits):
            hit = np.flatnonzero(np.isin(self.columns, found, assume_unique=True))
            out.append(float(_sigmoid(self.offsets + self.weights[hit].sum(axis=0)).mean()))
        return pd.Series(out, dtype=float)


def _counts(rows: DataFrame, bits: int) -> DataFrame:
    """``(bucket, positive, unlabelled)``: texts that have a word in a bucket; -1 for all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((1 << bits, 2), np.int64)
        texts = np.zeros(2, np.int64)
        for batch in batches:
            kinds = batch["positive"].to_numpy()
            for found, kind in zip(_columns(batch["text"], bits), kinds, strict=True):
                side = 0 if kind else 1
                sums[found, side] += 1
                texts[side] += 1
        used = np.flatnonzero(sums.any(axis=1))
        yield pd.DataFrame(
            {"bucket": np.append(used, -1), "positive": np.append(sums[used, 0], texts[0]),
             "unlabelled": np.append(sums[used, 1], texts[1])}
        )

    return (
        rows.mapInPandas(count, "bucket long, positive long, unlabelled long")
        .groupBy("bucket")
        .agg(F.sum("positive").alias("positive"), F.sum("unlabelled").alias("unlabelled"))
    )


def _sample(
    rows: DataFrame, columns: np.ndarray, most: int, different: int, bits: int
) -> np.ndarray:
    """0/1 rows of at most ``most`` different texts, those with the smallest hash. About
    ``different`` of them exist; the range of hashes that are looked at follows from that."""

    @F.pandas_udf("array<int>")
    def seen(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [np.flatnonzero(np.isin(columns, x)).astype(np.int32) for x in _columns(texts, bits)],
            dtype=object,
        )

    share = min(1.0, 2.0 * most / max(different, 1))
    near = rows.withColumn("hash", F.xxhash64("text")).where(
        F.pmod("hash", F.lit(1 << 30)) < int(share * (1 << 30))
    )
    chosen = near.groupBy("hash").agg(F.min("text").alias("text")) if share == 1.0 else near
    small = chosen.select("hash", seen("text").alias("seen")).groupBy("hash").agg(
        F.min("seen").alias("seen")
    )
    picked = small.orderBy(F.pmod("hash", F.lit(1 << 30)), "hash").limit(most).toArrow()
    out = np.zeros((picked.num_rows, len(columns)), np.float32)
    for i, found in enumerate(picked["seen"].to_pylist()):
        out[i, found] = 1
    return out


def fit(
    rows: DataFrame, text_col: str, label_col: str, prior: float | None = None, bits: int = BITS,
    features: int = FEATURES, max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED, members: int = MEMBERS, seed: int = 42,
) -> Model:
    """Learns from rows labelled 1 and from rows without a label (null).

    Rows labelled 0 only serve to estimate ``prior``, the share of toxic texts, where none is
    given; where no row is unlabelled they stand in for unlabelled text. A null text is the
    empty text. Texts that occur repeatedly count once in the sample, however often they occur.
    Without positives or without other rows the model has no words and every text scores the
    prior.
    """
    in_small_batches(rows.sparkSession)
    labelled = rows.select(
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{label_col}`").alias("label"),
    )
    hashed, label = F.xxhash64("text"), F.col("label")
    tally = labelled.agg(
        F.count_if(label == 1).alias("ones"), F.count_if(label == 0).alias("zeros"),
        F.count_if(label.isNull()).alias("open"),
        *[F.approx_count_distinct(F.when(kind, hashed)).alias(f"different_{name}")
          for name, kind in (("ones", label == 1), ("zeros", label == 0), ("open", label.isNull()))],
    ).first()
    ones, zeros, unlabelled = tally["ones"], tally["zeros"], tally["open"]
    if prior is None:
        prior = ones / (ones + zeros) if ones and zeros else PRIOR
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    base = float(np.log(prior / (1 - prior)))
    nothing = Model(np.empty(0, np.int64), np.zeros((0, 1)), np.array([base]), bits)
    if not ones or not (zeros or unlabelled):
        return nothing
    other = F.col("label").isNull() if unlabelled else F.col("label") == 0
    both = labelled.where((F.col("label") == 1) | other).select(
        "text", (F.col("label").isNotNull() & (F.col("label") == 1)).alias("positive")
    )
    counts = _counts(both, bits).toPandas().sort_values("bucket")
    totals, counts = counts.iloc[0], counts.iloc[1:]
    n_p, n_u = float(totals["positive"]), float(totals["unlabelled"])
    in_p = (counts["positive"].to_numpy() + 0.5) / (n_p + 1)
    in_u = (counts["unlabelled"].to_numpy() + 0.5) / (n_u + 1)
    pooled = (counts["positive"] + counts["unlabelled"] + 0.5).to_numpy() / (n_p + n_u + 1)
    sure = (in_p - in_u) / np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))
    buckets = counts["bucket"].to_numpy()
    fit_for_use = np.flatnonzero((sure >= SURE) & (in_p >= LIFT * in_u))
    order = fit_for_use[np.lexsort((buckets[fit_for_use], -sure[fit_for_use]))][:features]
    columns = np.sort(buckets[order])
    if not len(columns):
        return nothing
    others = tally["different_open" if unlabelled else "different_zeros"]
    p = _sample(both.where("positive"), columns, max_positive, tally["different_ones"], bits)
    u = _sample(both.where("NOT positive"), columns, max_unlabelled, others, bits)
    rng, fits = np.random.default_rng(seed), []
    for _ in range(members):
        half = rng.permutation(len(u))[: max(1, (len(u) + 1) // 2)]
        fits.append(fit_linear(p, u[np.sort(half)], prior))
    return Model(
        columns, np.stack([w for w, _ in fits], axis=1), np.array([b for _, b in fits]), bits
    )


def score(docs: DataFrame, text_col: str, model: Model, out: str = "toxicity") -> DataFrame:
    """Adds the probability that a text is toxic, from its words alone; a null or empty text
    gets that of a text without any telling word. Equal texts score alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        return shared.value.score(texts)

    return docs.withColumn(out, toxic(F.col(f"`{text_col}`").cast("string")))


def with_labels(
    docs: DataFrame, id_col: str, labels: DataFrame, label_id: str, label_col: str, out: str
) -> DataFrame:
    """Adds each document's label as ``out``, null where there is none, in place of a column of
    that name. Of several labels of an id the largest counts; labels without id or value are left
    out."""
    docs = docs.drop(out)
    given = labels.where(f"`{label_id}` IS NOT NULL AND `{label_col}` IS NOT NULL")
    one = settled(
        given.groupBy(F.col(f"`{label_id}`").alias(id_col)).agg(F.max(f"`{label_col}`").alias(out))
    )
    spread = free_name(docs, "spread")
    return lookup_join(with_row_key(docs, spread), one, [id_col], spread).drop(spread)


def train_on_fold(docs: DataFrame, labels: DataFrame) -> Model:
    """The model learned from the training fold of ``documents`` and ``labels``."""
    fold: Column = in_train_fold("doc_id")
    rows = docs.select("doc_id", "text").where(fold)
    known = labels.select("doc_id", "toxic").where(fold)
    return fit(with_labels(rows, "doc_id", known, "doc_id", "toxic", "toxic"), "text", "toxic")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_on_fold(docs, table(spark, sf_dir, "labels"))
    return score(docs, "text", model, "score").select(
        "doc_id", F.coalesce(~in_train_fold("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {"op10_toxicity": op10_toxicity}
