"""Scoring documents as they arrive.

Cleaning, features, models of the one-vs-rest and cluster kind, and the decision rules are all
row by row, so the batch code runs on a stream unchanged and without state. A neighbour model
joins each micro-batch with its training table, in ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from subjectloom.functions.decide import THRESHOLD, TOP_K, from_probabilities
from subjectloom.functions.text import normalize_text
from subjectloom.sources.readers import drop_blank_text

Scorer = Callable[[DataFrame], DataFrame]


def read_documents(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(folder)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """A Parquet table as a stream, whether it is one file or a folder of part files. A stream
    needs a folder, so a single file is picked out of the one it lies in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getFileStatus(place).isDirectory():
        return read_documents(spark, path, schema, files_per_batch=files_per_batch)
    folder, name = path.rstrip("/").rsplit("/", 1)
    return read_documents(spark, folder, schema, name, files_per_batch)


def score_documents(
    df: DataFrame,
    scorer: Scorer,
    features: PipelineModel | None = None,
    threshold: float = THRESHOLD,
    top_k: int = TOP_K,
    text_col: str = "text",
) -> DataFrame:
    """Blank texts dropped, the rest cleaned, scored and decided: adds ``scores`` and ``p``.
    The same for batch and streaming frames."""
    ready = drop_blank_text(df, text_col).withColumn("text_clean", normalize_text(F.col(text_col)))
    ready = ready if features is None else features.transform(ready)
    return scorer(ready).withColumn(
        "p", from_probabilities(F.col("scores"), threshold, top_k)
    )


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to a Parquet table and stops when what has arrived is done."""
    return (
        scored.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def write_scores_by_batch(
    documents: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """The same for models that join. A batch that is run again replaces what it wrote."""

    def run(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        documents.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
