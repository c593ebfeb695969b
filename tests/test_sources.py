import pytest
from pyspark.sql import functions as F

from subjectloom.operators.vocabulary import fixed_vocabulary
from subjectloom.sources import readers as R
from subjectloom.sources import sinks

NASTY = ['plain', 'a "quoted", comma', 'two\nlines', 'semi;colon', '']


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def texts(df):
    return sorted(r["text"] for r in df.collect())


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(NASTY)], "id int, text string")
    sinks.write_clean(df, str(tmp_path / "c"), "csv")
    back = R.scan_csv(spark, str(tmp_path / "c"), "id int, text string")
    assert {(r["id"], r["text"] or "") for r in back.collect()} == set(enumerate(NASTY))


def test_lines(spark, tmp_path):
    path = write(tmp_path / "a.md", "  one \n\n \ntwo\n")
    assert texts(R.scan_any(spark, path)) == ["one", "two"]


def test_layouts(spark, tmp_path):
    clean = R.scan_any(spark, write(tmp_path / "c.csv", "text_clean,label,x\nab,cs,1\n,math,2\n"))
    assert {tuple(r) for r in clean.collect()} == {("ab", "cs"), ("", "math")}
    bare = R.scan_any(spark, write(tmp_path / "b.csv", "text_clean\nab\n"))
    assert bare.columns == ["text"] and texts(bare) == ["ab"]
    other = R.scan_any(spark, write(tmp_path / "s.csv", "text_clean;label\nab;cs\n"))
    assert {tuple(r) for r in other.collect()} == {("ab", "cs")}
    one = R.scan_any(spark, write(tmp_path / "o.csv", "words\nab\ncd\n"))
    assert texts(one) == ["ab", "cd"]
    whole = R.scan_any(spark, write(tmp_path / "w.csv", "p,q\n1,2\n3,4\n"))
    assert texts(whole) == ["p,q\n1,2\n3,4\n"]


def test_json_corpus(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", "cs", "extra")], "id int, abstract string, cat string, z string")
    df.write.json(str(tmp_path / "j"))
    got = R.scan_corpus(spark, str(tmp_path / "j"), "abstract", "cat", fmt="json")
    assert got.columns == ["abstract", "cat"] and got.count() == 1


def test_scan_reads_only_what_is_asked_for(spark, small):
    df = R.scan_corpus(spark, f"{small}/documents.parquet", "text", id_col="doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_row_filters(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "l"), (3, "  ", "l")],
                               "id int, t string, l string")
    assert [r["id"] for r in R.drop_null_rows(df, "t", "l").collect()] == [3]
    assert [r["id"] for r in R.drop_blank_text(df.dropna(), "t").collect()] == []
    with pytest.raises(ValueError, match="after the category filter"):
        R.require_rows(df.where("id > 9"), "the category filter")
    assert R.require_rows(df, "nothing").count() == 3


def test_preview(spark):
    df = spark.range(7).select("id", F.repeat(F.lit("x"), F.when(F.col("id") == 0, 151).otherwise(150)).alias("t"))
    rows = R.preview(df, "id", "t").collect()
    assert [r["id"] for r in rows] == [0, 1, 2, 3, 4]
    assert rows[0]["t"] == "x" * 150 + "..." and rows[1]["t"] == "x" * 150
    assert rows[0]["n_more"] == 2


def test_split_and_config(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, ["a", "b"], "train"), (2, ["b"], "val"), (3, ["a"], "train")],
        "id int, labels array<string>, split string")
    sinks.write_split(df, str(tmp_path / "s"))
    val = sinks.read_split(spark, str(tmp_path / "s"), "val")
    assert [(r["id"], r["label"]) for r in val.collect()] == [(2, "b")]
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()
    config = sinks.split_config(df, ["b", "a"], ["a", "b"], text_col="t", label_col="l",
                                seed=42, test_size=0.2)
    sinks.write_config(config, str(tmp_path / "c"))
    row = sinks.read_config(spark, str(tmp_path / "c"), sinks.SPLIT_CONFIG).first()
    assert row["categories"] == ["b", "a"] and row["train_samples"] == 2
    assert row["val_samples"] == 1 and row["total_samples"] == 3 and row["seed"] == 42
    sinks.write_vocabulary(fixed_vocabulary(spark, ["z", "y"]), str(tmp_path / "v"))
    names = sinks.read_vocabulary(spark, str(tmp_path / "v")).orderBy("class_idx").collect()
    assert [r["label"] for r in names] == ["y", "z"]


def test_spread_leaves_wide_scans_alone(spark):
    assert R.spread(spark.range(10).coalesce(1), "id").rdd.getNumPartitions() == 8
    wide = spark.range(100).repartition(20)
    assert R.spread(wide, "id") is wide


def test_bytes_that_are_no_text_are_dropped(spark, tmp_path):
    path = tmp_path / "x.txt"
    path.write_bytes(b"caf\xc3\xa9 \xff\xfebar\n\xff\nplain \xef\xbf\xbd kept\n")
    got = [r["text"] for r in R.scan_text_lines(spark, str(path)).collect()]
    assert got == ["café bar", "plain � kept"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_files_keep_to_a_size(spark, tmp_path, fmt):
    """Also where nine rows in ten are on one side."""
    df = spark.range(5000).select(
        "id", F.repeat(F.md5(F.col("id").cast("string")), 10).alias("text"),
        F.array(F.lit("a")).alias("labels"),
        F.when(F.col("id") % 10 == 0, "val").otherwise("train").alias("split"),
    ).repartition(16)
    limit = 100_000
    path = f"{tmp_path}/{fmt}"
    if fmt == "csv":
        sinks.write_clean(df.select("id", "text"), path, "csv", limit)
    else:
        sinks.write_split(df, path, file_bytes=limit)
    files = [(f.stat().st_size, str(f)) for f in (tmp_path / fmt).rglob("part-*")]
    assert max(size for size, _ in files) <= 1.2 * limit
    if fmt == "parquet":
        back = sinks.read_split(spark, path)
        assert back.count() == 5000 and back.where("split = 'val'").count() == 500
        train = [size for size, f in files if "split=train" in f]
        assert 10 <= len(train) <= 60


def test_rows_of_few_row_groups_are_dealt_out(spark, tmp_path):
    """A file is cut by bytes, but its row groups go to one task each."""
    cores = spark.sparkContext.defaultParallelism
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    df.coalesce(1).write.parquet(one)
    df.repartition(2 * cores).write.parquet(many)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        for path, even in ((one, False), (many, True)):
            scan = spark.read.parquet(path)
            assert scan.rdd.getNumPartitions() >= cores
            dealt = R.spread(scan, "id")
            sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 4000 and max(sizes) * cores <= 2 * 4000
            assert (dealt is scan) == even
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
