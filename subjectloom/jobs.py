"""The stages as whole jobs joined by tables on shared storage: preprocess, split, train,
predict, judge, ensemble, evaluate, stream. Each is a composition of the operators; options are arguments."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from subjectloom.functions import decide as D
from subjectloom.functions import labels as L
from subjectloom.functions import text as X
from subjectloom.functions.vectors import as_vector
from subjectloom.operators import metrics as M
from subjectloom.operators.encoding import Encoder, encode_with, feature_stages
from subjectloom.operators.ensembles import hard_vote, soft_vote, stack_models
from subjectloom.operators.models import Model, fit_model
from subjectloom.operators.sampling import sample_exact
from subjectloom.operators.splitting import SEED, TEST_SIZE, split_balanced
from subjectloom.operators.tokens import lemmatize_tokens, stem_tokens
from subjectloom.operators.vocabulary import fixed_vocabulary, learn_vocabulary, vocabulary_list
from subjectloom.session import written
from subjectloom.sources import sinks
from subjectloom.sources.model_store import load_model, load_models, save_model
from subjectloom.sources.readers import drop_null_rows, filled, require_rows
from subjectloom.streaming.scoring import write_scores_by_batch


def with_ids(df: DataFrame) -> DataFrame:
    """Numbers the rows of a corpus that has no ids, and writes them down, so that every later
    pass sees the same number on the same row."""
    return written(df.withColumn("id", F.monotonically_increasing_id()), "numbered")


def _label_text(df: DataFrame, label_col: str) -> Column:
    is_list = df.schema[label_col].dataType.typeName() == "array"
    return L.join_list(F.col(label_col)) if is_list else F.col(label_col)


def _told(counts: Observation, *names: str) -> dict[str, int]:
    """What was counted. Where Spark has found at run time that there are no rows, it leaves out
    the rest of the plan and with it the counting."""
    try:
        found = counts.get
    except Py4JJavaError:
        found = {}
    return {name: found.get(name) or 0 for name in names}


def preprocess(
    corpus: DataFrame,
    path: str,
    *,
    text_col: str = "text",
    label_col: str | None = None,
    id_col: str | None = None,
    sample: int | None = None,
    use_stem: bool = False,
    lemmas: DataFrame | None = None,
    min_length: int = 2,
    fmt: str = "parquet",
    file_bytes: int | None = None,
) -> dict[str, int]:
    """Corpus to the clean table ``(id, text_clean[, label])``: an exact seeded sample if one
    is asked for, then cleaning, with stems or with the lemmas of a table. Gives the numbers of
    rows written, of blank texts and of missing labels among them, counted while writing."""
    if use_stem and lemmas is not None:
        raise ValueError("choose stems or lemmas, not both")
    df = corpus.select(*[c for c in (id_col, text_col, label_col) if c])
    df = df.withColumnRenamed(id_col, "id") if id_col else with_ids(df)
    df = sample_exact(df, "id", sample, SEED)
    label = [_label_text(df, label_col).alias("label")] if label_col else []
    text = F.col(text_col)
    if not use_stem and lemmas is None:
        clean_text = X.normalize_text(text, min_length=min_length).alias("text_clean")
        clean = df.select("id", clean_text, *label)
    elif use_stem:
        words = stem_tokens(df.select("id", X.word_tokens(text).alias("tokens"), *label))
        joined = F.array_join(X.drop_short(F.col("tokens"), min_length), " ")
        clean = words.withColumn("tokens", joined).withColumnRenamed("tokens", "text_clean")
    else:
        words = df.select("id", X.word_tokens(text).alias("tokens"))
        words = lemmatize_tokens(words, lemmas, "id")
        joined = F.array_join(X.drop_short(F.col("tokens"), min_length), " ")
        clean = words.select("id", joined.alias("text_clean"))
        clean = clean.join(df.select("id", *label), "id") if label else clean
    seen = Observation()
    missing = F.count_if(F.col("label").isNull()) if label else F.count("*")
    clean = clean.observe(
        seen, F.count("*").alias("n_rows"), missing.alias("n_null_label"),
        F.count_if(F.col("text_clean") == "").alias("n_blank"),
    )
    sinks.write_clean(clean, path, fmt, file_bytes)
    return _told(seen, "n_rows", "n_null_label", "n_blank")


def split(
    clean: DataFrame,
    folder: str,
    *,
    categories: Sequence[str] = L.DEFAULT_CATEGORIES,
    text_col: str = "text_clean",
    label_col: str = "label",
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    file_bytes: int | None = None,
) -> dict[str, int]:
    """Clean table to ``folder/split`` (train and validation), ``folder/vocabulary`` and
    ``folder/split_config``. Gives the numbers of rows read, of missing texts and labels, of rows
    and labels kept, and of rows on either side, counted in passes that are made anyhow."""
    spark = clean.sparkSession
    loaded, left, put = Observation(), Observation(), Observation()
    read = clean.observe(
        loaded, F.count("*").alias("n_loaded"),
        F.count_if(F.col(text_col).isNull()).alias("n_null_text"),
        F.count_if(F.col(label_col).isNull()).alias("n_null_label"),
    )
    kept = drop_null_rows(read, text_col, label_col).select(
        "id", text_col, L.subjects(F.col(label_col), categories).alias("labels")
    ).where(F.size("labels") > 0)
    kept = kept.observe(
        left, F.count("*").alias("n_kept"), F.sum(F.size("labels")).alias("n_labels")
    )
    sides = split_balanced(kept, "id", "labels", test_size, seed)
    held = _told(left, "n_kept", "n_labels")
    if not held["n_kept"]:
        require_rows(kept, "the category filter")
    is_val = F.col("split") == "val"
    sides = sides.observe(
        put, F.count_if(~is_val).alias("n_train"), F.count_if(is_val).alias("n_val")
    )
    sinks.write_split(sides, f"{folder}/split", file_bytes=file_bytes)
    vocabulary = fixed_vocabulary(spark, categories)
    sinks.write_vocabulary(vocabulary, f"{folder}/vocabulary")
    config = sinks.split_config(
        sinks.read_split(spark, f"{folder}/split"), categories, vocabulary_list(vocabulary),
        text_col=text_col, label_col="label", seed=seed, test_size=test_size,
    )
    sinks.write_config(config, f"{folder}/split_config")
    read_counts = _told(loaded, "n_loaded", "n_null_text", "n_null_label")
    return {**read_counts, **held, **_told(put, "n_train", "n_val")}


def _stored(df: DataFrame) -> DataFrame:
    return df.withColumn("labels", L.parse_labels(F.col("label"), "stored"))


_ENCODER = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("column", T.StringType()),
    T.StructField("use_stem", T.BooleanType()), T.StructField("min_length", T.IntegerType()),
])


def _cleaned(df: DataFrame, text_col: str, use_stem: bool, min_length: int) -> DataFrame:
    """Adds ``text_clean``: raw text prepared as ``preprocess`` does."""
    if not use_stem:
        clean = X.normalize_text(F.col(text_col), min_length=min_length)
        return df.withColumn("text_clean", clean)
    words = stem_tokens(df.withColumn("_tokens", X.word_tokens(F.col(text_col))), "_tokens")
    kept = F.array_join(X.drop_short(F.col("_tokens"), min_length), " ")
    return words.withColumn("text_clean", kept).drop("_tokens")


def train(
    spark: SparkSession,
    folder: str,
    names: Sequence[str],
    *,
    text_col: str = "text_clean",
    n_features: int = 1024,
    pca_components: int | None = None,
    make_encoder: Callable[[], Encoder] | None = None,
    vectors: DataFrame | None = None,
    encoding: str = "tfidf",
    encoding_options: dict | None = None,
    use_stem: bool = False,
    min_length: int = 2,
    **params,
) -> None:
    """Fits the named models on ``folder/split`` and saves them under ``folder/models``. The
    training texts are encoded once, for all of them: by stages fitted here (TF-IDF, or trained
    word vectors with ``encoding='word2vec'``), by an encoder of the caller's (``make_encoder``), or
    not at all, with ready ``vectors (id, vector)``.

    ``use_stem`` and ``min_length`` say how ``preprocess`` prepared the texts. They are saved, so
    that raw texts are prepared the same way before a TF-IDF encoder sees them.
    """
    if make_encoder is not None and vectors is not None:
        raise ValueError("give an encoder or ready vectors, not both")
    rows = _stored(sinks.read_split(spark, f"{folder}/split", "train")).withColumnRenamed(
        text_col, "text_clean"
    )
    vocabulary = vocabulary_list(learn_vocabulary(rows))
    rows = rows.withColumn("y", L.multi_hot(F.col("labels"), vocabulary))
    kind = encoding
    if vectors is not None:
        kind = "vectors"
        ready = vectors.select("id", as_vector(F.col("vector")).alias("features"))
        featured = rows.join(ready, "id")
    elif make_encoder is not None:
        kind = "plugged"
        featured = _plugged(rows, "text_clean", make_encoder)
    else:
        encoder = feature_stages(
            "text_clean", n_features, pca_components, encoding, **(encoding_options or {})
        ).fit(rows)
        encoder.write().overwrite().save(f"{folder}/encoder")
        featured = encoder.transform(rows)
    config = spark.createDataFrame([(kind, text_col, use_stem, min_length)], _ENCODER)
    sinks.write_config(config, f"{folder}/encoder_config")
    encoded = written(featured.select("id", "features", "labels", "y"), "features")
    for name in names:
        model = fit_model(name, encoded, vocabulary, **params)
        save_model(spark, model, f"{folder}/models/{name.lower()}")
        config = sinks.train_config(
            sinks.read_split(spark, f"{folder}/split"), name, vocabulary,
            text_col=text_col, label_col="label",
        )
        sinks.write_config(config, f"{folder}/train_config/{name.lower()}")


def _plugged(df: DataFrame, text_col: str, make_encoder: Callable[[], Encoder]) -> DataFrame:
    encoded = encode_with(df, text_col, make_encoder, "_vector")
    return encoded.withColumn("features", as_vector(F.col("_vector"))).drop("_vector")


def encode(
    spark: SparkSession, folder: str, texts: DataFrame, text_col: str = "text",
    make_encoder: Callable[[], Encoder] | None = None,
) -> DataFrame:
    """``(…, features)`` as the models of ``folder`` were trained, blank and missing texts
    included. A column of another name than the training texts' holds raw text, which is prepared
    for a TF-IDF encoder as those were; a plugged encoder sees it as it is, and has to be given
    again. Where models were trained on ready vectors, ``texts`` has them in ``vector``.
    """
    config = sinks.read_config(spark, f"{folder}/encoder_config", _ENCODER).first()
    if config["kind"] == "vectors":
        return texts.withColumn("features", as_vector(F.col("vector")))
    wanted = [c for c in texts.columns if c != "text_clean"]
    if config["kind"] == "plugged":
        if make_encoder is None:
            raise ValueError("the models were trained on an encoder of your own; pass it again")
        ready = _plugged(texts.withColumn("text_clean", filled(text_col)), "text_clean", make_encoder)
        return ready.select(*wanted, "text_clean", "features")
    if text_col == config["column"]:
        ready = texts.withColumn("text_clean", filled(text_col))
    else:
        ready = _cleaned(texts, text_col, config["use_stem"], config["min_length"])
    encoder = PipelineModel.load(f"{folder}/encoder")
    return encoder.transform(ready).select(*wanted, "text_clean", "features")


def predict(
    spark: SparkSession,
    folder: str,
    name: str,
    texts: DataFrame,
    *,
    text_col: str = "text",
    threshold: float = D.THRESHOLD,
    top_k: int = D.TOP_K,
    make_encoder: Callable[[], Encoder] | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """``(id, scores, p, labels)`` of one saved model. ``counts`` gets the numbers of rows, of rows
    without a positive label, and of positive labels, when the result is first written."""
    model = load_model(spark, f"{folder}/models/{name.lower()}")
    encoded = encode(spark, folder, texts, text_col, make_encoder)
    decided = _decided(model, encoded, threshold, top_k)
    if counts is None:
        return decided
    return decided.observe(
        counts, F.count("*").alias("n_rows"), F.count_if(F.size("labels") == 0).alias("n_without"),
        F.sum(F.size("labels")).alias("n_labels"),
    )


def _decided(model: Model, encoded: DataFrame, threshold: float, top_k: int) -> DataFrame:
    decided = model.score(encoded).select(
        "id", "scores", D.from_probabilities(F.col("scores"), threshold, top_k).alias("p")
    )
    return decided.withColumn("labels", L.labels_of(F.col("p"), model.vocabulary))


class Judgement(NamedTuple):
    totals: DataFrame
    per_class: DataFrame
    by_first: DataFrame
    distribution: DataFrame


def judge(
    decisions: DataFrame, truth: DataFrame, vocabulary: Sequence[str]
) -> Judgement:
    """Predictions ``(id, p)`` held against ``truth (id, labels)``, from one written table of both:
    accuracy and macro scores, counts per class, the grid of first labels, and how often each label
    is true and predicted. Rows on one side only are left out."""
    y = truth.select("id", L.multi_hot(F.col("labels"), vocabulary).alias("y"))
    both = written(M.align(y, decisions.select("id", "p"), "id"), "judged")
    named = both.withColumn("model", F.lit("model"))
    return Judgement(
        M.model_comparison(named, vocabulary).drop("model"),
        M.confusion_per_class(both, vocabulary),
        M.confusion_by_first(both, vocabulary),
        M.label_distribution(both, vocabulary),
    )


def stream(
    spark: SparkSession,
    folder: str,
    name: str,
    documents: DataFrame,
    path: str,
    marks: str,
    *,
    text_col: str = "text",
    threshold: float = D.THRESHOLD,
    top_k: int = D.TOP_K,
    make_encoder: Callable[[], Encoder] | None = None,
) -> StreamingQuery:
    """Scores a stream of documents ``(id, text)`` with a saved model, as ``predict`` does, into
    the Parquet table at ``path``; ``marks`` holds the stream's progress. Each micro-batch is a
    batch job, so models that join can be used too."""
    model = load_model(spark, f"{folder}/models/{name.lower()}")

    def score(batch: DataFrame) -> DataFrame:
        encoded = encode(spark, folder, batch, text_col, make_encoder)
        return _decided(model, encoded, threshold, top_k)

    return write_scores_by_batch(documents, score, path, marks)


class Ensemble(NamedTuple):
    vocabulary: list[str]
    votes: DataFrame
    stacked: DataFrame


def ensemble(
    spark: SparkSession,
    folder: str,
    texts: DataFrame,
    *,
    text_col: str = "text",
    voting: str = "soft",
    threshold: float = D.THRESHOLD,
    top_k: int = D.TOP_K,
    make_encoder: Callable[[], Encoder] | None = None,
) -> Ensemble:
    """All saved models on the same texts: ``votes`` is ``(id, p, …)``, ``stacked`` the scores
    per model. Texts are encoded once and every model scores them once."""
    if voting not in ("soft", "hard"):
        raise ValueError(f"voting is 'soft' or 'hard', not {voting!r}")
    models = load_models(spark, f"{folder}/models")
    if not models:
        raise ValueError(f"no models under {folder}/models")
    vocabularies = {tuple(m.vocabulary) for m in models.values()}
    if len(vocabularies) > 1:
        raise ValueError("the models were trained on different labels")
    vocabulary = list(vocabularies.pop())
    ready = encode(spark, folder, texts, text_col, make_encoder).select("id", "features")
    ready = written(ready, "encoded")
    scored = stack_models({n: m.score(ready) for n, m in models.items()}, "id")
    stacked = written(scored, "scores")
    vote = soft_vote if voting == "soft" else hard_vote
    return Ensemble(vocabulary, vote(stacked, "id", len(vocabulary), threshold, top_k), stacked)


def compare(
    result: Ensemble, truth: DataFrame, threshold: float = D.THRESHOLD, top_k: int = D.TOP_K
) -> DataFrame:
    """``(model, accuracy, precision, recall, f1)`` of the ensemble and of each model, against
    ``truth(id, labels)``."""
    single = result.stacked.select(
        "id", "model", D.from_probabilities(F.col("scores"), threshold, top_k).alias("p")
    )
    every = single.unionByName(result.votes.select("id", F.lit("ensemble").alias("model"), "p"))
    y = truth.select("id", L.multi_hot(F.col("labels"), result.vocabulary).alias("y"))
    return M.model_comparison(M.align(y, every, "id"), result.vocabulary)


def evaluate(
    spark: SparkSession, folder: str, name: str, labelled: DataFrame, *,
    text_col: str = "text_clean", label_col: str = "label",
    make_encoder: Callable[[], Encoder] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A saved model on texts with raw labels: one row of totals, and the report per class.
    Uses the model's plain predictions, without threshold options or fallback."""
    model = load_model(spark, f"{folder}/models/{name.lower()}")
    vocabulary = [v.lower() for v in model.vocabulary]
    ready = ["vector"] if "vector" in labelled.columns else []
    rows = drop_null_rows(labelled, text_col, label_col).select(
        "id", text_col, L.subjects(F.col(label_col), vocabulary, "evaluate").alias("labels"), *ready
    ).where(F.size("labels") > 0)
    rows = require_rows(rows, "the category filter").withColumn(
        "y", L.multi_hot(F.col("labels"), vocabulary)
    )
    scored = model.score(encode(spark, folder, rows, text_col, make_encoder))
    judged = written(
        scored.select("id", "y", D.by_default(F.col("scores")).alias("p")), "judged"
    )
    per_class = M.confusion_per_class(judged, vocabulary)
    one = F.lit(1).alias("_row")
    parts = [
        M.micro(per_class).select(F.col("f1").alias("f1_micro"), one),
        M.macro(per_class).select(F.col("f1").alias("f1_macro"), one),
        M.hamming(per_class).select("hamming_loss", one),
        M.exact_match(judged).select(F.col("accuracy").alias("subset_accuracy"), one),
    ]
    totals = judged.agg(F.count("*").alias("n_docs")).select("n_docs", one)
    for part in parts:
        totals = totals.join(part, "_row")
    return totals.drop("_row"), M.classification_report(judged, vocabulary)
