"""The digest index over one batch and over several."""

import uuid

import pytest

from subjectloom.llm import exact_dedup
from subjectloom.llm.exact_dedup import DigestIndex
from subjectloom.session import fresh_path

SCHEMA = "doc_id long, text string, row_key string, digest int"


def rows_of(texts):
    return [(i, t, "own", 1) for i, t in texts]


def decisions(index, df):
    return {
        (r["id"], r["keep_id"], r["group_size"], r["kept"])
        for r in index.add(df, "doc_id", "text").collect()
    }


def test_batches(spark, frame):
    path = fresh_path(spark, "index")
    index = DigestIndex(spark, path, 4)
    first = frame(rows_of([(1, "A b"), (2, "a B"), (3, "Ä"), (4, "ä"), (5, None), (6, "")]), SCHEMA)
    assert decisions(index, first) == {
        (1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True),
        (5, 6, 2, False), (6, 6, 2, True),
    }
    second = frame(rows_of([(9, "A B"), (10, "new"), (11, "NEW")]), SCHEMA)
    assert decisions(DigestIndex(spark, path, 4), second) == {
        (9, 2, 1, False), (10, 11, 2, False), (11, 11, 2, True),
    }
    assert index.table().count() == 5
    assert decisions(index, first.limit(0)) == set()


def test_index_is_not_shuffled(spark, frame):
    index = DigestIndex(spark, fresh_path(spark, "index"), 4)
    index.add(frame(rows_of([(1, "x")]), SCHEMA), "doc_id", "text")
    new = index.table().select("digest").groupBy("digest").count()
    plan = new.join(index.table().hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text


def test_repeated_rows_and_null_ids(spark, frame):
    index = DigestIndex(spark, fresh_path(spark, "index"), 4)
    df = frame(rows_of([(1, "x"), (1, "x"), (None, "x"), (None, "y"), (None, "y")]), SCHEMA)
    found = index.add(df, "doc_id", "text").collect()
    assert sorted(r["kept"] for r in found if r["group_size"] == 3) == [False, False, True]
    assert sorted(r["kept"] for r in found if r["group_size"] == 2) == [False, True]
    assert all(r["keep_id"] == (1 if r["group_size"] == 3 else None) for r in found)


def test_rows_that_stay_keep_their_columns(spark, frame):
    index = DigestIndex(spark, fresh_path(spark, f"index-{uuid.uuid4().hex}"), 4)
    long = "w" * 200_000
    df = frame(rows_of([(1, long), (2, long), (3, "z")]), SCHEMA)
    kept = index.dedup(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert {tuple(r) for r in kept.collect()} == {(2, long, "own", 1), (3, "z", "own", 1)}


def test_a_batch_may_be_added_again(spark, frame):
    index = DigestIndex(spark, fresh_path(spark, "index"), 4)
    decisions(index, frame(rows_of([(1, "old")]), SCHEMA))
    df = frame(rows_of([(2, "OLD"), (3, "a"), (4, "A"), (5, "b")]), SCHEMA)

    def named(frame, name="monday"):
        return {(r["id"], r["keep_id"], r["kept"]) for r in index.add(
            frame, "doc_id", "text", name).collect()}

    want = {(2, 1, False), (3, 4, False), (4, 4, True), (5, 5, True)}
    assert named(df) == named(df) == want
    assert index.table().count() == 3
    assert named(df, "tuesday") == {(i, k, False) for i, k, _ in want}


def test_a_job_that_dies_after_the_append_loses_nothing(spark, frame, monkeypatch):
    path = fresh_path(spark, "index")
    df = frame(rows_of([(1, "a"), (2, "A"), (3, "b")]), SCHEMA)
    real = exact_dedup.written

    def dies(frame, name):
        if name == "digest-decisions":
            raise RuntimeError("lost")
        return real(frame, name)

    monkeypatch.setattr(exact_dedup, "written", dies)
    with pytest.raises(RuntimeError):
        DigestIndex(spark, path).dedup(df, "doc_id", "text", "monday")
    monkeypatch.undo()
    index = DigestIndex(spark, path)
    assert index.table().count() == 2
    again = index.dedup(df, "doc_id", "text", "monday")
    assert {r["doc_id"] for r in again.collect()} == {2, 3}


def test_buckets_follow_the_first_batch_and_stay(spark, frame, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", 3)
    path = fresh_path(spark, "index")
    index = DigestIndex(spark, path)
    df = frame(rows_of([(i, f"t{i}") for i in range(40)]), SCHEMA)
    assert index.dedup(df, "doc_id", "text").count() == 40
    assert index.buckets == 16
    again = DigestIndex(spark, path, 4)  # what is on record counts
    assert again.buckets == 16
    assert again.dedup(df, "doc_id", "text").count() == 0


def test_rows_are_told_apart_however_the_table_is_split(spark, tmp_path):
    rows = [(i, f"text {i // 2}", "x", 1) for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    kept = DigestIndex(spark, fresh_path(spark, "index")).dedup(docs, "doc_id", "text")
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(key, "2k")
        got = sorted(r["doc_id"] for r in kept.collect())
    finally:
        spark.conf.set(key, before)
    assert got == list(range(1, 400, 2))
