"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.llm.common import in_small_batches, in_train_fold, table

#: n-grams of one to three characters go to so many columns, as a power of two.
BITS = 16
#: Added to every count.
SMOOTHING = 0.5
#: The matrix has ``languages * 2**BITS`` numbers; more languages than this are refused.
MAX_LANGUAGES = 1000
#: Characters that are worked on at once.
STEP = 1 << 18
#: Counts that are multiplied at once.
CELLS = 1 << 18

UNKNOWN = "und"


def grams(text: str, bits: int = BITS) -> Iterator[np.ndarray]:
    """The columns of all n-grams of a lower-cased text, stretch by stretch."""
    one, two, three = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
    shift = np.uint32(32 - bits)
    for at in range(0, len(text), STEP):
        part = text[at : at + STEP + 2].lower()
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(1)
        c = c * one
        c ^= c >> np.uint32(15)
        pair = (c[:-1] * two) ^ c[1:]
        triple = (pair[:-1] * three) ^ c[2:]
        found = [c[:STEP] * two, pair[:STEP] * three, triple[:STEP] * one]
        yield np.concatenate([(x ^ (x >> np.uint32(16))) * two >> shift for x in found])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Model(NamedTuple):
    languages: list[str]
    log_prob: np.ndarray  # 2**bits rows, a column per language
    log_prior: np.ndarray
    bits: int

    def predict(self, texts: Iterable[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its probability; of equally likely ones the
        first by name. Null texts, texts without a letter, and any text where no language was
        learned, are unknown with score 0.

        The texts' counts are rows of a sparse matrix, which is multiplied with the matrix of
        log-probabilities about ``CELLS`` counts at a time.
        """
        texts = list(texts)
        total = np.tile(self.log_prior, (len(texts), 1))
        known = [bool(self.languages and t and has_letter(t)) for t in texts]
        rows, used, counts, held = [], [], [], 0

        def multiply() -> None:
            cells = self.log_prob[np.concatenate(used)] * np.concatenate(counts)[:, None]
            starts = np.cumsum([0, *[len(u) for u in used[:-1]]])
            # A long text has several rows.
            np.add.at(total, np.array(rows), np.add.reduceat(cells, starts, axis=0))

        for row, text in enumerate(texts):
            if not known[row]:
                continue
            for columns in grams(text, self.bits):
                own = np.unique(columns, return_counts=True)
                rows.append(row)
                used.append(own[0])
                counts.append(own[1])
                held += len(own[0])
                if held >= CELLS:
                    multiply()
                    rows, used, counts, held = [], [], [], 0
        if rows:
            multiply()
        if not any(known):
            return [(UNKNOWN, 0.0)] * len(texts)
        best = total.argmax(axis=1)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        share = share[np.arange(len(best)), best] / share.sum(axis=1)
        return [
            (self.languages[b], float(s)) if k else (UNKNOWN, 0.0)
            for b, s, k in zip(best.tolist(), share.tolist(), known, strict=True)
        ]


def fit(
    docs: DataFrame, text_col: str, lang_col: str, bits: int = BITS,
    smoothing: float = SMOOTHING, max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Counts the n-grams of every row that has a text with a letter and a language.

    Counting is done in the tasks that read the texts; what is shuffled and collected are
    counts per language and column, whose number does not depend on the number of texts.
    Languages stand in order of their names. An empty table gives a model without languages.
    """

    in_small_batches(docs.sparkSession)
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                if not has_letter(text):
                    continue
                own = sums.setdefault(lang, np.zeros(1 << bits, np.int64))
                texts[lang] = texts.get(lang, 0) + 1
                for columns in grams(text, bits):
                    own += np.bincount(columns, minlength=1 << bits)
        for lang, own in sums.items():
            used = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": used, "n": own[used]})
            yield pd.DataFrame({"lang": lang, "bucket": [-1], "n": [texts[lang]]})

    rows = docs.select(
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    counted = (
        rows.mapInPandas(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    per_lang = counted.groupBy("lang").agg(
        F.collect_list(F.struct("bucket", "n")).alias("counts")
    ).limit(max_languages + 1).toArrow().to_pylist()
    if len(per_lang) > max_languages:
        raise ValueError(f"more than {max_languages} languages; pass a larger max_languages")
    per_lang.sort(key=lambda row: row["lang"])
    sums = np.full((1 << bits, len(per_lang)), float(smoothing))
    priors = np.zeros(len(per_lang))
    for j, row in enumerate(per_lang):
        for cell in row["counts"]:
            if cell["bucket"] < 0:
                priors[j] = cell["n"]
            else:
                sums[cell["bucket"], j] += cell["n"]
    log_prob = np.log(sums) - np.log(sums.sum(axis=0)) if per_lang else sums
    log_prior = np.log(priors) - np.log(priors.sum()) if per_lang else priors
    return Model([row["lang"] for row in per_lang], log_prob, log_prior, bits)


def identify(docs: DataFrame, text_col: str, model: Model) -> DataFrame:
    """Adds ``lang_pred`` and ``lang_score``, in place of columns of those names; nothing but the
    text is looked at, and all of it. Equal texts get equal answers, equally likely languages go
    by name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        return pd.DataFrame(own.predict(texts), columns=["lang", "score"])

    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "lang_score")]
    guess = predict(F.col(f"`{text_col}`").cast("string"))
    return docs.select(
        *rest, guess["lang"].alias("lang_pred"), guess["score"].alias("lang_score")
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(in_train_fold("doc_id")), "text", "lang")
    return identify(docs.select("doc_id", "text"), "text", model).select(
        "doc_id", F.coalesce(~in_train_fold("doc_id"), F.lit(False)).alias("held_out"),
        "lang_pred", F.col("lang_score").alias("score"),
    )


QUERIES = {"op8_language_id": op8_language_id}
