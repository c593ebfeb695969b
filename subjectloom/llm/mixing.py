"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subjectloom.llm.common import WORD, free_name, scanned, table, text_of, with_lasting_key
from subjectloom.session import written

# Weights of the sources in order, repeating; the share of all words to take;
# how often a source may be taken at most.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Adds ``target`` to ``(source, source_size)``, one row per source.

    Sources stand in order of their code points, null last, and take the weights in turn. The
    words to take are ``share`` of all; each source gets its part by weight but never over
    ``most`` times its size, and what is cut goes to the others by weight. So a target is the
    smaller of its ceiling and ``level * weight``; with sources sorted by ceiling / weight, the
    level is the largest over all ways to cut the first few. A source without words gets 0.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(in_order) - 1
    weighed = sizes.withColumn(
        "weight", F.element_at(cycle, (place % len(weights) + 1).cast("int"))
    ).withColumn("ceiling", F.col("source_size") * float(most))
    rising = Window.orderBy(
        F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = F.coalesce(
        F.sum("ceiling").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    onward = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * share
    return (
        weighed.withColumn("_level", (wanted - before) / onward)
        .withColumn("_level", F.max("_level").over(everything))
        .withColumn("target", F.least("ceiling", F.col("_level") * F.col("weight")))
        .select("source", "source_size", "target")
    )


def plan(
    docs: DataFrame, id_col: str, text_col: str, source_col: str,
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 42,
) -> DataFrame:
    """``(row_key, id, source, size, source_size, target, copies)`` per row of ``docs``.

    A document's expected copies are its source's target over its size. Within a source the
    documents stand in order of size, largest first, and then of a hash of the id; their
    expected copies are summed up from the front, one random offset per source is added, and
    a document is emitted once per integer that its stretch of the sum crosses. Because
    neighbours are alike in size, a source's words come within about one large document of
    its target. The order depends on ids and sizes only, so reruns agree.

    The sum needs no task that sees a whole source: rows are dealt by ranges of (source, size,
    hash), counted per range, and ranked within a range, where a source of any size is spread
    over many ranges. Sizes count words; a null or blank text has size 0, costs nothing and
    is sampled like the others of its source. A null source is a source; null ids and
    repeated rows take places of their own. An empty table gives an empty plan.
    """
    key = free_name(docs, "row_key")
    measured = with_lasting_key(docs, key).select(
        F.col(key).alias("row_key"), F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
    )
    rows = written(measured, "mix-sizes")
    hashed = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    order = [F.col("size").desc(), F.col("hash"), F.col("id"), F.col("row_key")]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        rows.withColumn("hash", hashed)
        .repartitionByRange(ranges, F.col("source").asc_nulls_last(), *order)
        .withColumn("range", F.spark_partition_id())
    )
    dealt = written(dealt, "mix-ranges")
    counts = dealt.groupBy("range", "source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words")
    )
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = counts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    sizes = counts.groupBy("source").agg(F.sum("words").alias("source_size"))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    offset = F.conv(F.substring(F.md5(named.cast("binary")), 1, 8), 16, 10).cast("double")
    aims = targets(sizes, weights, share, most).select(
        F.col("source").alias("_source"), "source_size", "target",
        (offset / F.lit(2.0**32)).alias("offset"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0).alias("rate"),
    )
    starts = counts.join(aims, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("range").alias("_range"), "_source", "before", "source_size", "target", "offset",
        "rate",
    )
    within = Window.partitionBy("range", "source").orderBy(*order)
    ranked = dealt.withColumn("place", F.row_number().over(within)).join(
        written(starts, "mix-starts"),
        (F.col("range") == F.col("_range")) & F.col("source").eqNullSafe(F.col("_source")),
    )
    last = (F.col("before") + F.col("place")).cast("double")
    crossed = F.floor(last * F.col("rate") + F.col("offset")) - F.floor(
        (last - 1.0) * F.col("rate") + F.col("offset")
    )
    return ranked.select(
        "row_key", "id", "source", "size", "source_size", "target",
        F.least(crossed, F.lit(most)).cast("long").alias("copies"),
    )


def mix(
    docs: DataFrame, id_col: str, text_col: str, source_col: str,
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 42,
) -> DataFrame:
    """The rows of ``docs``, each as often as the plan takes it, with its own columns only."""
    docs = scanned(docs)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key, copies = free_name(docs, "row_key"), free_name(docs, "copies")
    taken = plan(docs, id_col, text_col, source_col, weights, share, most, seed)
    taken = taken.where("copies > 0").select(
        F.col("row_key").alias(key), F.sequence(F.lit(1), F.col("copies").cast("int")).alias(copies)
    )
    joined = with_lasting_key(docs, key).join(taken, key)
    return joined.withColumn(copies, F.explode(copies)).select(*columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return planned.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


QUERIES = {"op7_mixing": op7_mixing}

SQL = {
    "op7_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS hash,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size, 2.0::DOUBLE * source_size AS ceiling,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
    FROM sources
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(ceiling) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING), 0))
        / sum(weight) OVER (rising ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed WINDOW rising AS (ORDER BY ceiling / weight, source NULLS LAST)
), aims AS (
    SELECT source, source_size,
        least(ceiling, max(level) OVER () * weight) AS target,
        CAST(CAST('0x' || substr(md5('42:' || coalesce('s' || source, 'n')), 1, 8) AS BIGINT)
            AS DOUBLE) / 4294967296.0::DOUBLE AS start
    FROM levels
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, hash, doc_id) AS place
    FROM sized
), rated AS (
    SELECT r.doc_id, r.size, r.place, a.source_size, a.target, a.start,
        CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0 END AS rate
    FROM ranked r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target, size * least(2, CAST(
    floor(CAST(place AS DOUBLE) * rate + start)
    - floor((CAST(place AS DOUBLE) - 1.0::DOUBLE) * rate + start) AS BIGINT)) AS taken
FROM rated
""",
}
