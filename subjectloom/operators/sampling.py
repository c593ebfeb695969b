"""Exact-size seeded samples without sorting or shuffling the documents.

Rows are ordered by ``md5(id:seed)``. The row that closes the sample (the *cut*) is found
from a histogram over the first four hex digits plus a ranking inside the one bucket that
holds it. The sample itself is then a filter: ``(hash, id) <= cut``. Only ids pass through a
shuffle; texts never do. Ids must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subjectloom.operators.lookup import lookup_join
from subjectloom.session import settled

BUCKET_DIGITS = 4
BUCKETS = 16**BUCKET_DIGITS


def id_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def _bucket(hashed: Column) -> Column:
    return F.conv(F.substring(hashed, 1, BUCKET_DIGITS), 16, 10).cast("int")


def histogram(df: DataFrame, id_col: str, seed: int, stratum: Column | None = None) -> DataFrame:
    """``(stratum, bucket, n)``: at most 65,536 rows per stratum, kept for several passes."""
    group = F.lit("") if stratum is None else stratum
    return settled(
        df.select(group.alias("stratum"), _bucket(id_hash(id_col, seed)).alias("bucket"))
        .groupBy("stratum", "bucket")
        .agg(F.count("*").alias("n"))
    )


def cuts(
    df: DataFrame,
    counts: DataFrame,
    quotas: DataFrame,
    id_col: str,
    seed: int,
    stratum: Column | None = None,
) -> DataFrame:
    """``(stratum, cut_hash, cut_id)``: the last row of each stratum's quota.

    ``quotas`` holds ``(stratum, quota)``; strata with quota 0 get no cut.
    """
    group = F.lit("") if stratum is None else stratum
    upto = Window.partitionBy("stratum").orderBy("bucket")
    edge = settled(
        counts.withColumn("upto", F.sum("n").over(upto))
        .join(quotas, "stratum")
        .where((F.col("quota") <= F.col("upto")) & (F.col("quota") > F.col("upto") - F.col("n")))
        .select(
            "stratum", "bucket", (F.col("quota") - F.col("upto") + F.col("n")).alias("place")
        )
    )
    keyed = df.select(
        group.alias("stratum"), F.col(id_col).alias("id"), id_hash(id_col, seed).alias("hashed")
    ).withColumn("bucket", _bucket(F.col("hashed")))
    inside = lookup_join(keyed, edge, ["stratum", "bucket"], spread_by="id", how="inner")
    rank = Window.partitionBy("stratum", "bucket").orderBy("hashed", "id")
    return (
        inside.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") == F.col("place"))
        .select("stratum", F.col("hashed").alias("cut_hash"), F.col("id").alias("cut_id"))
    )


def within_cut(id_col: str, seed: int, cut_hash: Column, cut_id: Column) -> Column:
    hashed = id_hash(id_col, seed)
    return (hashed < cut_hash) | ((hashed == cut_hash) & (F.col(id_col) <= cut_id))


def lowest(df: DataFrame, id_col: str, n: int, seed: int) -> Column:
    """Predicate for exactly the ``n`` rows of lowest hash. Finding the cut runs two jobs
    over the id column; using the predicate is a filter on any scan of the same rows."""
    if n <= 0:
        return F.lit(False)
    counts = histogram(df, id_col, seed)
    total = counts.agg(F.sum("n")).first()[0] or 0
    if n >= total:
        return F.lit(True)
    quotas = df.sparkSession.createDataFrame([("", n)], "stratum string, quota long")
    cut = cuts(df, counts, quotas, id_col, seed).first()
    return within_cut(id_col, seed, F.lit(cut["cut_hash"]), F.lit(cut["cut_id"]))


def sample_exact(df: DataFrame, id_col: str, n: int | None, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows; everything when ``n`` is not set or not below the row count."""
    return df if not n else df.where(lowest(df, id_col, n, seed))


def hash_share(id_col: str, share: float, seed: int = 42) -> Column:
    """Predicate for about ``share`` of the rows, with no job and no shuffle at all."""
    return _bucket(id_hash(id_col, seed)) < F.lit(int(share * BUCKETS))
