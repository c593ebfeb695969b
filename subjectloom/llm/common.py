"""Small pieces that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.session import written

# A word is a run of characters outside these blanks; five words to a shingle.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """As text; null is the empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, or a longer name if the frame has a column called that already."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """Adds a key that no two rows share, whatever their ids, for a single job.

    The key follows from the place of a row in its partition, so ``df`` has to be a table or a
    narrow projection of one, which a lost executor's successor reads in the same order. How
    files fall into partitions follows from the cores at hand when a job begins, so other jobs
    that read the table again need ``with_lasting_key``.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def _places(df: DataFrame) -> tuple[Column, Column]:
    """A number for the file a row stands in, and its place there."""
    file = df.metadataColumn("_metadata")
    # Two bits less, so that a place can be added.
    return F.shiftright(F.xxhash64(file["file_path"]), 2), file["row_index"]


def _tells_rows_apart(df: DataFrame) -> bool:
    """Whether ``df`` is a Parquet table, or columns of one, whose files' keys do not overlap."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "SubqueryAlias"):
        node = node.children().head()
    if node.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = node.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return False
    if relation.fileFormat().toString() != "Parquet":
        return False
    start, place = _places(df)
    path = df.metadataColumn("_metadata")["file_path"]
    files = df.select(path.alias("path"), start.alias("start"), place.alias("place"))
    files = files.groupBy("path", "start").agg(
        F.max("place").alias("last"), F.count(F.lit(1)).alias("rows")
    ).collect()
    ranges = sorted((f["start"], f["last"]) for f in files)
    return all(f["rows"] == f["last"] + 1 for f in files) and all(
        a[0] + a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False)
    )


def scanned(df: DataFrame) -> DataFrame:
    """``df`` if it is a Parquet table, or columns of one, else what it holds now as such a
    table in the shared folder. Frames that are to get the same lasting keys twice go through
    here first."""
    while not getattr(df, "tells_rows_apart", False):
        if _tells_rows_apart(df):
            df.tells_rows_apart = True
        else:
            df = written(df, "rows")
    return df


def with_lasting_key(df: DataFrame, name: str) -> DataFrame:
    """Adds a key that no two rows share, whatever their ids, and that is the same in every job:
    it follows from the file of a row and its place in it, however the files are split. What is
    no such table is written together with its keys."""
    if not getattr(df, "tells_rows_apart", False) and not _tells_rows_apart(df):
        return written(df.withColumn(name, F.monotonically_increasing_id()), "rows")
    start, place = _places(df)
    return df.withColumn(name, start + place)


def in_train_fold(id_column: str) -> Column:
    """True for the rows that models may learn labels from: four fifths, by CRC-32 of the id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 != 0


#: Bytes of rows that are handed to Python at once.
BATCH_BYTES = 1 << 20


def in_small_batches(spark: SparkSession) -> None:
    """Bounds the batches that go to Python by bytes, for this session: ten thousand rows, the
    usual bound, can be any amount of text."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
