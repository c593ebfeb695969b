"""Writing clean tables, splits, configurations and vocabularies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectloom.operators.splitting import split_summary

SPLIT_CONFIG = T.StructType([
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("text_col", T.StringType()),
    T.StructField("label_col", T.StringType()),
    T.StructField("seed", T.LongType()),
    T.StructField("test_size", T.DoubleType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("train_samples", T.LongType()),
    T.StructField("val_samples", T.LongType()),
    T.StructField("total_samples", T.LongType()),
])

TRAIN_CONFIG = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("text_col", T.StringType()),
    T.StructField("label_col", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("train_samples", T.LongType()),
    T.StructField("val_samples", T.LongType()),
])


def _sized(df: DataFrame, file_bytes: int | None, *by: str) -> DataFrameWriter:
    """A writer whose files hold about ``file_bytes`` of uncompressed rows at most. Rows are
    dealt anew so that each side has few small files, a large side being dealt over several
    tasks; how many rows a file may hold follows from the mean size of a row."""
    if file_bytes is None:
        return df.write.mode("overwrite")
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    size = F.lit(8 * len(df.columns))
    for name in texts:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    mean = df.agg(F.avg(size)).first()[0] or 1.0
    dealt = df.hint("rebalance", *[F.col(c) for c in by])
    return dealt.write.mode("overwrite").option(
        "maxRecordsPerFile", max(1, int(file_bytes / mean))
    )


def write_clean(
    df: DataFrame, path: str, fmt: str = "parquet", file_bytes: int | None = None
) -> None:
    """A clean table as Parquet, or as CSV that other tools read back unchanged, in files of
    about ``file_bytes`` at most if given."""
    writer = _sized(df, file_bytes)
    if fmt == "csv":
        writer.options(header="true", quote='"', escape='"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_split(
    df: DataFrame, path: str, labels_col: str = "labels", file_bytes: int | None = None
) -> None:
    """Train and validation rows in one write, labels stored as one string, in files of about
    ``file_bytes`` at most if given."""
    stored = df.withColumn("label", F.array_join(labels_col, " "))
    if labels_col != "label":
        stored = stored.drop(labels_col)
    _sized(stored, file_bytes, "split").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """One side is read without touching the other's files."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def _texts(values: Sequence[str]) -> F.Column:
    return F.array(*[F.lit(v) for v in values])


def split_config(
    split: DataFrame, categories: Sequence[str], classes: Sequence[str], *,
    text_col: str, label_col: str, seed: int, test_size: float,
) -> DataFrame:
    """The one-row description of a split."""
    return split_summary(split).select(
        _texts(categories).alias("categories"),
        F.lit(text_col).alias("text_col"),
        F.lit(label_col).alias("label_col"),
        F.lit(seed).cast("long").alias("seed"),
        F.lit(float(test_size)).alias("test_size"),
        _texts(classes).alias("classes"),
        "train_samples", "val_samples", "total_samples",
    )


def train_config(
    split: DataFrame, model_name: str, classes: Sequence[str], *, text_col: str, label_col: str
) -> DataFrame:
    """The one-row description of a training run."""
    return split_summary(split).select(
        F.lit(model_name).alias("model_name"),
        F.lit(text_col).alias("text_col"),
        F.lit(label_col).alias("label_col"),
        _texts(classes).alias("classes"),
        "train_samples", "val_samples",
    )


def write_config(config: DataFrame, path: str) -> None:
    config.coalesce(1).write.mode("overwrite").json(path)


def read_config(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    vocabulary.coalesce(1).write.mode("overwrite").parquet(path)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
