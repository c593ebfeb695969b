"""Reading corpora: Parquet, JSON, CSV, plain text, and files of unknown layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectloom.functions.text import SPACE, strip

# Suffixes read as one document per line, and the separators tried on a CSV.
TEXT_SUFFIXES = (".txt", ".md")
SEPARATORS = (",", ";", "\t", "|")

# Quoting as other tools write it (a quote inside a field is doubled).
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}

# A partition may hold so many times a core's share of the rows.
UNEVEN = 2


def scan_corpus(
    spark: SparkSession, path: str, text_col: str, label_col: str | None = None,
    id_col: str | None = None, fmt: str = "parquet",
) -> DataFrame:
    """The columns asked for from a Parquet or JSON corpus; the scan reads no others."""
    wanted = [c for c in (id_col, text_col, label_col) if c]
    return spark.read.format(fmt).load(path).select(*wanted)


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ","
) -> DataFrame:
    """CSV with a header row and quoted line breaks. Give a schema where it is known: without
    one all columns are strings, and no pass over the data is spent on guessing."""
    reader = spark.read.options(**CSV_OPTIONS).option("sep", sep)
    return (reader.schema(schema) if schema else reader).csv(path)


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(text)``: one document per line that is not blank, trimmed. Bytes that are no UTF-8
    are dropped."""
    value = F.col("value")
    readable = F.when(F.is_valid_utf8(value), value).otherwise(
        F.replace(F.make_valid_utf8(value), F.lit("\ufffd"), F.lit(""))
    )
    lines = spark.read.text(path).select(strip(readable).alias("text"))
    return lines.where(F.col("text") != "")


def _separator(spark: SparkSession, path: str) -> str:
    """The likeliest separator, judged by the header line."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0]["value"] if head else ""
    return max(SEPARATORS, key=lambda s: (line.count(s), -SEPARATORS.index(s)))


def scan_any(spark: SparkSession, path: str) -> DataFrame:
    """``(text[, label])`` from a file or folder of any of the known layouts.

    Text files give a document per line. A table gives its ``text_clean`` column, with
    ``label`` where there is one; a one-column table gives that column. Any other table is
    taken as one document per file.
    """
    if path.lower().rstrip("/").endswith(TEXT_SUFFIXES):
        return scan_text_lines(spark, path)
    table = scan_csv(spark, path)
    if "text_clean" not in table.columns:
        other = scan_csv(spark, path, sep=_separator(spark, path))
        table = other if "text_clean" in other.columns else table
    if "text_clean" in table.columns:
        text = [filled("text_clean").alias("text")]
        return table.select(*text, *([filled("label").alias("label")]
                                     if "label" in table.columns else []))
    if len(table.columns) == 1:
        return table.select(filled(table.columns[0]).alias("text"))
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))


def spread(df: DataFrame, id_col: str) -> DataFrame:
    """For a bare scan with fewer partitions than there are cores, as of one small file, or with
    most rows in few of them, as of a large file in few row groups, which are never cut: rows are
    dealt out by id before costly work on texts. Other scans are left as they are. Not for
    frames with a join in them: their partitions can only be counted by running it."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if parts >= cores:
        sizes = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
        told = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
        if not told["rows"] or told["most"] * cores <= UNEVEN * told["rows"]:
            return df
    return df.repartition(max(parts, cores), id_col)


def filled(column: str) -> Column:
    """As text, null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def drop_null_rows(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    return df.dropna(subset=[text_col, label_col])


def drop_blank_text(df: DataFrame, text_col: str) -> DataFrame:
    return df.where(F.col(text_col).rlike(f"[^{SPACE}]"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stops with an error when a filter has left nothing to work on."""
    if df.isEmpty():
        raise ValueError(f"no rows remain after {what}")
    return df


# Size of a preview.
PREVIEW_ROWS = 5
PREVIEW_CHARS = 150


def preview(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, n_more)``: the first rows by id, long texts cut, and how many follow."""
    more = F.lit(max(df.count() - PREVIEW_ROWS, 0)).cast("long")
    text = F.col(text_col)
    cut = F.when(
        F.length(text) > PREVIEW_CHARS,
        F.concat(F.substring(text, 1, PREVIEW_CHARS), F.lit("...")),
    ).otherwise(text)
    return df.orderBy(id_col).limit(PREVIEW_ROWS).select(
        id_col, cut.alias(text_col), more.alias("n_more")
    )
