from pyspark.sql import functions as F

from subjectloom.operators import models as N
from subjectloom.operators.encoding import feature_stages
from subjectloom.functions.labels import multi_hot
from subjectloom.functions.text import normalize_text
from subjectloom.plans.frames import CLASSES, subject_sets
from subjectloom.streaming import scoring as S


def trained(spark, small, name):
    df = subject_sets(spark, small).select(
        F.col("doc_id").alias("id"), "text", "labels",
        multi_hot(F.col("labels"), CLASSES).alias("y"),
        normalize_text(F.col("text")).alias("text_clean"),
    )
    features = feature_stages(n_features=64).fit(df)
    return features, N.fit_model(name, features.transform(df), CLASSES)


def inbox(spark, small, tmp_path):
    """Documents arriving in several files, a blank one among them."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    blank = spark.createDataFrame([(-1, "  \n ")], docs.schema)
    folder = str(tmp_path / "inbox")
    docs.unionByName(blank).repartition(6).write.parquet(folder)
    return folder, docs.schema


def decisions(df):
    return {r["id"]: r["p"] for r in df.select("id", "p").collect()}


def test_stream_equals_batch(spark, small, tmp_path):
    features, model = trained(spark, small, "kmeans")
    folder, schema = inbox(spark, small, tmp_path)
    stream = S.read_documents(spark, folder, schema, files_per_batch=2)
    scored = S.score_documents(stream, model.score, features).select("id", "p")
    S.write_scores(scored, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    batch = S.score_documents(spark.read.parquet(folder), model.score, features)
    got = decisions(spark.read.parquet(str(tmp_path / "out")))
    assert got == decisions(batch) and -1 not in got and len(got) == 200


def test_neighbours_by_batch(spark, small, tmp_path):
    features, model = trained(spark, small, "knn")
    folder, schema = inbox(spark, small, tmp_path)
    stream = S.read_documents(spark, folder, schema, files_per_batch=3)

    def score(batch):
        return S.score_documents(batch, model.score, features).select("id", "p")

    query = S.write_scores_by_batch(stream, score, str(tmp_path / "o"), str(tmp_path / "m"))
    query.awaitTermination()
    got = decisions(spark.read.parquet(str(tmp_path / "o")))
    assert got == decisions(score(spark.read.parquet(folder)))


def test_a_table_is_a_stream_as_file_and_as_folder(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    folder = str(tmp_path / "docs.parquet")
    docs.repartition(3).write.parquet(folder)
    for name, path in (("one", f"{small}/documents.parquet"), ("many", folder)):
        stream = S.read_table(spark, path, docs.schema).select("doc_id")
        out = str(tmp_path / name)
        S.write_scores(stream, out, str(tmp_path / f"{name}-marks")).awaitTermination()
        assert spark.read.parquet(out).count() == docs.count()
