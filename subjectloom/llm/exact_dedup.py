"""Exact duplicates against a persistent index of digests, by DataFrame operations only."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.llm.common import (
    free_name, lower_ascii, table, text_of, with_lasting_key, with_row_key,
)
from subjectloom.session import fresh_path, release, written

#: Digests that a bucket of the index is to hold.
BUCKET_DIGESTS = 4_000_000
MOST_BUCKETS = 1 << 15


class DigestIndex:
    """A table ``(digest, keep_id, batch)`` bucketed and sorted by digest, kept at ``path``.

    Each batch of documents is reduced to its distinct digests, set against the index by a
    sort-merge anti-join that reads the index bucket by bucket (it is never shuffled), and what
    is new is appended. Opening the same path again, in this session or another, goes on where
    the last batch ended.

    The number of buckets is chosen once: that given, or by the digests of the first batch, a
    bucket for every ``BUCKET_DIGESTS``; give it where later batches are to be far larger. It is
    kept in a record beside the index, which later openings read.

    A batch may be added again under its name, for instance after a job has died between the
    append and the writing of its result: digests that the batch brought itself are its own, so
    the same rows stay as the first time.

    Texts are equal when identical after lower-casing A-Z; null is the empty text. Within a
    batch the row with the largest id stays, null ids last; of repeated rows (same id, same
    text) exactly one. A text that an earlier batch brought is not kept again. An empty batch
    gives an empty result and leaves the index as it is. Digests are SHA-256. Other columns
    of the batch play no part, whatever their names.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        self.buckets = self._recorded()
        if self.buckets is None and buckets is not None:
            self._create(buckets)
        elif self.buckets is not None:
            self._open()

    @property
    def _record(self) -> str:
        return f"{self.path}-record"

    def _recorded(self) -> int | None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._record}/_SUCCESS")
        store = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return self.spark.read.json(self._record).first()["buckets"] if store.exists(place) else None

    def _create(self, buckets: int) -> None:
        self.spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").json(
            self._record
        )
        self.buckets = buckets
        self._open()

    def _open(self) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} "
            "(digest BINARY, keep_id STRING, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(
        self, docs: DataFrame, id_col: str, text_col: str, batch: str | None = None
    ) -> DataFrame:
        """``(row_key, id, digest, keep_id, group_size, kept)`` per row of ``docs``.

        ``group_size`` counts the rows of this batch with the same text, ``keep_id`` is the id
        of the row that stays (of an earlier batch, if the index knew the text). ``batch`` names
        the batch; without it, each call is a batch of its own.
        """
        key = free_name(docs, "row_key")
        return self._decided(with_row_key(docs, key), key, id_col, text_col, batch)

    def _decided(
        self, docs: DataFrame, key: str, id_col: str, text_col: str, batch: str | None
    ) -> DataFrame:
        batch = uuid.uuid4().hex if batch is None else batch
        kind = docs.schema[id_col].dataType
        keyed = docs.select(
            F.col(key).alias("row_key"), F.col(f"`{id_col}`").alias("id"),
            F.unhex(F.sha2(lower_ascii(text_of(text_col)), 256)).alias("digest"),
        )
        rows = written(keyed, "digests")
        groups = rows.groupBy("digest").agg(
            F.max(F.struct("id", "row_key")).alias("best"),
            F.count(F.lit(1)).alias("group_size"),
        )
        groups = written(groups, "digest-groups")
        if self.buckets is None:
            wanted = -(-groups.count() // BUCKET_DIGESTS)
            self._create(min(1 << max(3, (wanted - 1).bit_length()), MOST_BUCKETS))
        new = groups.join(self.table().hint("merge"), "digest", "left_anti").select(
            "digest", F.col("best.id").cast("string").alias("keep_id"),
            F.lit(batch).alias("batch"),
        )
        new.repartition(self.buckets, "digest").write.insertInto(self.name)
        decided = groups.join(self.table().hint("merge"), "digest").select(
            "digest", F.col("keep_id").cast(kind).alias("keep_id"), "group_size",
            F.when(F.col("batch") == batch, F.col("best.row_key")).alias("kept_key"),
        )
        decided = written(decided, "digest-decisions")
        release(groups)
        # Both sides of this join are shuffled, so that a text held by many rows can be split.
        return rows.join(decided, "digest").select(
            "row_key", "id", "digest", "keep_id", "group_size",
            F.coalesce(F.col("kept_key") == F.col("row_key"), F.lit(False)).alias("kept"),
        )

    def dedup(
        self, docs: DataFrame, id_col: str, text_col: str, batch: str | None = None
    ) -> DataFrame:
        """The rows of ``docs`` that stay, with all their columns. Rows are told apart by keys
        that are the same in every job, however the table is split."""
        key = free_name(docs, "row_key")
        keyed = with_lasting_key(docs, key)
        kept = self._decided(keyed, key, id_col, text_col, batch).where("kept")
        return keyed.join(kept.select(F.col("row_key").alias(key)), key, "left_semi").drop(key)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, fresh_path(spark, "digest-index"))
    result = index.add(table(spark, sf_dir, "documents"), "doc_id", "text")
    return result.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


QUERIES = {"op2_exact_dedup": op2_exact_dedup}

SQL = {
    "op2_exact_dedup": """
WITH hashed AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)
""",
}
