import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from subjectloom import jobs
from subjectloom.functions.labels import parse_labels
from subjectloom.operators.encoding import encode_with
from subjectloom.plans.frames import labelled
from subjectloom.sources import sinks


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """All stages on the smallest corpus, with labels as lists."""
    root = str(tmp_path_factory.mktemp("jobs"))
    corpus = labelled(spark, "/root/testdata/sf0.001").select(
        "doc_id", F.col("text").alias("abstract"), F.split("label", " ").alias("categories"))
    jobs.preprocess(corpus, f"{root}/clean", text_col="abstract", label_col="categories",
                    id_col="doc_id", sample=190)
    jobs.split(spark.read.parquet(f"{root}/clean"), root, categories=["EN", "fr", "de", "es", "Q"])
    jobs.train(spark, root, ["KNN", "kmeans"], n_features=128)
    jobs.train(spark, root, ["transformer"], n_features=128)
    return root


def test_stages(spark, folder):
    clean = spark.read.parquet(f"{folder}/clean")
    assert clean.count() == 190 and clean.columns == ["id", "text_clean", "label"]
    assert clean.where("label RLIKE '^[a-z]+[.]src[0-9]+(;|$)'").count() == 190
    config = sinks.read_config(spark, f"{folder}/split_config", sinks.SPLIT_CONFIG).first()
    assert config["classes"] == ["de", "en", "es", "fr", "q"] and config["val_samples"] == 38
    trained = sinks.read_config(spark, f"{folder}/train_config/knn", sinks.TRAIN_CONFIG).first()
    assert trained["model_name"] == "KNN" and trained["train_samples"] == 152


def val(spark, folder):
    return sinks.read_split(spark, f"{folder}/split", "val")


def test_predict(spark, folder):
    texts = val(spark, folder).select("id", F.col("text_clean").alias("text"))
    blank = spark.createDataFrame([(-1, None)], texts.schema)
    rows = jobs.predict(spark, folder, "transformer", texts.unionByName(blank)).collect()
    assert len(rows) == 39 and all(sum(r["p"]) > 0 and r["labels"] for r in rows)
    truth = {r["id"]: r["label"].split()[0] for r in val(spark, folder).collect()}
    hits = sum(truth[r["id"]] in r["labels"] for r in rows if r["id"] in truth)
    assert hits > 30


@pytest.mark.parametrize("voting", ["soft", "hard"])
def test_ensemble(spark, folder, voting):
    rows = val(spark, folder)
    result = jobs.ensemble(spark, folder, rows, text_col="text_clean", voting=voting)
    assert result.votes.count() == 38 and result.stacked.count() == 3 * 38
    truth = rows.select("id", parse_labels(F.col("label"), "stored").alias("labels"))
    table = {r["model"]: r for r in jobs.compare(result, truth).collect()}
    assert set(table) == {"ensemble", "knn", "kmeans", "transformer"}
    assert table["transformer"]["f1"] > 0.4


def test_ensemble_needs_models(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="no models"):
        jobs.ensemble(spark, str(tmp_path), val(spark, folder))
    with pytest.raises(ValueError, match="'soft' or 'hard'"):
        jobs.ensemble(spark, folder, val(spark, folder), voting="loud")


def test_evaluate(spark, folder):
    raw = val(spark, folder).withColumn("label", F.concat("label", F.lit(", other.x")))
    totals, report = jobs.evaluate(spark, folder, "transformer", raw)
    row = totals.first()
    assert row["n_docs"] == 38 and 0 < row["f1_micro"] <= 1 and row["hamming_loss"] < 0.5
    assert report.count() == 9
    with pytest.raises(ValueError, match="no rows remain"):
        jobs.evaluate(spark, folder, "transformer", raw.withColumn("label", F.lit("zz")))


def test_stems_and_missing_ids(spark, tmp_path):
    corpus = spark.createDataFrame([("Running cats", "a"), ("The dogs", "b")], "text string, label string")
    jobs.preprocess(corpus, str(tmp_path / "s"), label_col="label", use_stem=True)
    rows = spark.read.parquet(str(tmp_path / "s")).select("text_clean", "label").collect()
    assert {tuple(r) for r in rows} == {("run cat", "a"), ("dog", "b")}
    lemmas = spark.createDataFrame([("dogs", "n", "dog")], "token string, tag string, lemma string")
    jobs.preprocess(corpus, str(tmp_path / "l"), lemmas=lemmas, fmt="csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "l"))
    assert back.columns == ["id", "text_clean"]
    assert {r["text_clean"] for r in back.collect()} == {"running cats", "dog"}


def decisions(df):
    return {r["id"]: (r["p"], [round(x, 6) for x in r["scores"]]) for r in df.collect()}


@pytest.mark.parametrize("name", ["transformer", "knn"])
def test_stream_equals_batch_on_raw_text(spark, folder, tmp_path, name):
    """Raw text is prepared as the training texts were, in batch and stream alike."""
    raw = labelled(spark, "/root/testdata/sf0.001").select(F.col("doc_id").alias("id"), "text")
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    documents = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    jobs.stream(spark, folder, name, documents, out, str(tmp_path / "marks")).awaitTermination()
    batch = decisions(jobs.predict(spark, folder, name, raw))
    assert decisions(spark.read.parquet(out)) == batch
    clean = spark.read.parquet(f"{folder}/clean").select("id", "text_clean")
    ready = decisions(jobs.predict(spark, folder, name, clean, text_col="text_clean"))
    assert ready == {i: batch[i] for i in ready}


def test_judge(spark, folder):
    rows = val(spark, folder)
    truth = rows.select("id", parse_labels(F.col("label"), "stored").alias("labels"))
    guesses = jobs.predict(spark, folder, "transformer", rows, text_col="text_clean")
    seen = jobs.judge(guesses, truth, ["de", "en", "es", "fr", "q"])
    assert seen.totals.count() == 1 and 0 <= seen.totals.first()["accuracy"] <= 1
    assert seen.per_class.count() == 5 and seen.by_first.count() == 25
    assert {r["tp"] + r["fp"] + r["fn"] + r["tn"] for r in seen.per_class.collect()} == {38}
    assert sum(r["n_docs"] for r in seen.by_first.collect()) == 38
    assert seen.distribution.count() == 5


def test_own_encoder_and_ready_vectors(spark, folder, tmp_path):
    def vowels():
        return lambda texts: [[t.count(a) + 0.0 for a in "aeiouäéñ"] for t in texts]

    root, rows = str(tmp_path / "own"), val(spark, folder)
    sides = sinks.read_split(spark, f"{folder}/split").select("id", "text_clean", "label", "split")
    sinks.write_split(sides.withColumn("labels", F.split("label", " ")).drop("label"), f"{root}/split")
    jobs.train(spark, root, ["knn"], make_encoder=vowels)
    with pytest.raises(ValueError, match="pass it again"):
        jobs.predict(spark, root, "knn", rows, text_col="text_clean")
    own = decisions(jobs.predict(
        spark, root, "knn", rows, text_col="text_clean", make_encoder=vowels))
    result = jobs.ensemble(spark, root, rows, text_col="text_clean", make_encoder=vowels)
    assert len(own) == 38 and result.votes.count() == 38

    vectors = encode_with(sides, "text_clean", vowels, "vector").select("id", "vector")
    jobs.train(spark, root, ["knn"], vectors=vectors)
    ready = decisions(jobs.predict(spark, root, "knn", rows.join(vectors, "id")))
    assert ready == own
    with pytest.raises(ValueError, match="not both"):
        jobs.train(spark, root, ["knn"], make_encoder=vowels, vectors=vectors)


def test_counts_come_with_the_writing(spark, tmp_path):
    rows = [(1, "One two three", "en.x"), (2, None, "fr.y"), (3, "!!", "de.z;en.x"), (4, "four", None),
            (5, "five six", "zz.q")]
    corpus = spark.createDataFrame(rows, "id long, text string, label string")
    told = jobs.preprocess(corpus, f"{tmp_path}/clean", label_col="label", id_col="id",
                           file_bytes=1000)
    assert told == {"n_rows": 5, "n_null_label": 1, "n_blank": 2}
    clean = spark.read.parquet(f"{tmp_path}/clean")
    told = jobs.split(clean, str(tmp_path), categories=["en", "de", "fr"])
    assert told == {"n_loaded": 5, "n_null_text": 0, "n_null_label": 1, "n_kept": 3, "n_labels": 4,
                    "n_train": 2, "n_val": 1}
    with pytest.raises(ValueError, match="category filter"):
        jobs.split(clean, f"{tmp_path}/none", categories=["xx"])


def test_predictions_are_counted(spark, folder):
    texts = val(spark, folder).select("id", F.col("text_clean").alias("text"))
    counts = Observation()
    guesses = jobs.predict(spark, folder, "transformer", texts, counts=counts, top_k=0)
    rows = guesses.collect()
    assert counts.get == {"n_rows": 38, "n_without": sum(not r["labels"] for r in rows),
                          "n_labels": sum(len(r["labels"]) for r in rows)}


def test_trained_word_vectors(spark, folder, tmp_path):
    """Models on trained word vectors are saved and used like those on TF-IDF."""
    root = str(tmp_path)
    for side in ("split", "vocabulary"):
        spark.read.parquet(f"{folder}/{side}").write.partitionBy(
            *(["split"] if side == "split" else [])).parquet(f"{root}/{side}")
    jobs.train(spark, root, ["transformer"], encoding="word2vec",
               encoding_options={"vector_size": 16, "min_count": 1, "partitions": 1, "rounds": 3})
    texts = val(spark, folder).select("id", F.col("text_clean").alias("text"))
    blank = spark.createDataFrame([(-1, None)], texts.schema)
    rows = jobs.predict(spark, root, "transformer", texts.unionByName(blank)).collect()
    assert len(rows) == 39 and all(r["labels"] for r in rows)
    truth = {r["id"]: r["label"].split()[0] for r in val(spark, folder).collect()}
    assert sum(truth[r["id"]] in r["labels"] for r in rows if r["id"] in truth) > 25
    with pytest.raises(ValueError, match="no encoding"):
        jobs.train(spark, root, ["transformer"], encoding="other")
