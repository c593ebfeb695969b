"""Keys that stay the same however a table is split between two jobs."""

import pytest
from pyspark.sql import functions as F

from subjectloom.llm import jaccard_join, line_dedup, mixing
from subjectloom.llm.common import scanned, with_lasting_key

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def resplit(spark):
    """Sets the size of splits, which follows from the executors otherwise."""
    before = spark.conf.get(SPLIT)
    yield lambda size: spark.conf.set(SPLIT, size)
    spark.conf.set(SPLIT, before)


@pytest.fixture
def path(spark, tmp_path):
    out = str(tmp_path / "table")
    spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.md5(F.col("id").cast("string")), 4).alias("text")
    ).repartition(3, "doc_id").write.option("parquet.block.size", 65536).parquet(out)
    return out


def keys(df):
    return {r["doc_id"]: r["k"] for r in df.select("doc_id", "k").collect()}


def test_keys_do_not_follow_the_splits(spark, path, resplit):
    found, parts = [], []
    for size in ("64m", "20k"):
        resplit(size)
        df = with_lasting_key(spark.read.parquet(path).select("doc_id", "text"), "k")
        parts.append(df.rdd.getNumPartitions())
        found.append(keys(df))
    assert parts[0] < parts[1]
    assert found[0] == found[1]
    assert len(set(found[0].values())) == 4000


@pytest.mark.parametrize("make", [
    lambda spark, path: spark.read.parquet(path).where("doc_id % 2 = 0"),
    lambda spark, path: spark.read.parquet(path).unionByName(spark.read.parquet(path)),
    lambda spark, path: spark.createDataFrame([(1, "a")] * 3, "doc_id long, text string"),
    lambda spark, path: spark.read.parquet(path).repartition(5),
    lambda spark, path: spark.createDataFrame([], "doc_id long, text string"),
    lambda spark, path: spark.read.parquet(path).withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))),
])
def test_other_frames_are_written_first(spark, path, make):
    df = make(spark, path)
    kept = scanned(df)
    assert scanned(kept) is kept
    first, again = with_lasting_key(kept, "k"), with_lasting_key(kept, "k")
    assert first.select("k").distinct().count() == df.count() == first.count()
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_operators_agree_when_splits_change_between_jobs(spark, path, resplit, monkeypatch):
    """Every table that an operator writes changes the splits of what it reads next."""
    def changing(real):
        def write(*args, **kwargs):
            out = real(*args, **kwargs)
            changing.n += 1
            resplit("20k" if changing.n % 2 else "64m")
            return out

        changing.n = 0
        return write

    docs = spark.read.parquet(path).select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for module in (line_dedup, jaccard_join, mixing):
        monkeypatch.setattr(module, "written", changing(module.written))
    got = line_dedup.remove_repeats(docs, "doc_id", "text", whole=True).collect()
    assert {r["doc_id"]: r["text"] for r in got} == texts
    one = jaccard_join.one_of_each(docs, "doc_id", "text").collect()
    assert {r["doc_id"]: r["text"] for r in one} == texts
    alike = docs.withColumn("text", F.concat_ws(" ", F.lit("same words"), F.col("doc_id") % 7))
    for _ in range(2):
        resplit("64m")
        left = jaccard_join.one_of_each(alike, "doc_id", "text").collect()
        assert sorted(r["doc_id"] for r in left) == list(range(7))
    resplit("64m")
    sources = docs.withColumn("source", F.lit("a"))
    taken = {r["id"] for r in mixing.plan(sources, "doc_id", "text", "source")
             .where("copies > 0").collect()}
    resplit("64m")
    assert {r["doc_id"] for r in mixing.mix(sources, "doc_id", "text", "source").collect()} == taken
