"""From raw documents to token ids: filter, clean, deduplicate, mix and encode.

Each stage takes what the one before kept, read back from Parquet, and all but the last return
the columns of ``documents``. ``run`` removes what a stage has written for itself once its result
has been written. Stages called on their own leave it in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.llm import bpe, jaccard_join, line_dedup, mixing, toxicity
from subjectloom.llm.common import free_name, table
from subjectloom.session import noting, release, remove, written

VOCABULARY = "byte_bpe_50k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not find toxic; it learns from the training fold of
    ``docs`` and of the table ``labels``. Null and empty texts stay, as nothing speaks against
    them; without labels all stay."""
    model = toxicity.train_on_fold(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "toxicity")
    scored = toxicity.score(docs, "text", model, score)
    return scored.where(F.col(score) < 0.5).drop(score)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has. A document of which nothing is
    left goes: all its passages stand elsewhere. ``n_chars`` follows the text."""
    edited = line_dedup.remove_repeats(docs, "doc_id", "text", whole=True)
    changed = F.size("cut") > 0
    return (
        edited.where(~changed | (F.col("text") != ""))
        .withColumn(
            "n_chars",
            F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")),
        )
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    return jaccard_join.one_of_each(docs, "doc_id", "text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, so some twice and some not at all."""
    return mixing.mix(docs, "doc_id", "text", "source")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, source, n_tokens, ids)`` per document of the mix."""
    ids = bpe.encode_ids(docs, "text", public_tokenizers.path(VOCABULARY))
    return ids.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids"
    )


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_passages),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: Three of the stages have no SQL form; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read back."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with noting() as made:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        remove(spark, [path for path in made if path != docs.shared_path])
        if before is not None:
            release(before)
        before = docs
    return docs
