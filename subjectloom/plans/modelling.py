"""Registered queries: vectors, neighbours, clusters, and fitted models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from subjectloom.functions import decide as D
from subjectloom.functions import vectors as X
from subjectloom.functions.labels import multi_hot
from subjectloom.functions.text import normalize_text
from subjectloom.operators import clusters as C
from subjectloom.operators import models as N
from subjectloom.operators import sampling
from subjectloom.operators.encoding import (
    encode_with,
    feature_stages,
    halves,
    projection_stages,
)
from subjectloom.operators.logistic import LinearModel
from subjectloom.operators.neighbors import nearest_neighbors, neighbor_vote
from subjectloom.operators.one_vs_rest import fit_one_vs_rest
from subjectloom.operators.sparse_neighbors import nearest_sparse
from subjectloom.operators.splitting import split_random
from subjectloom.plans.catalog import query, with_ctes
from subjectloom.plans.cleaning import CLEAN_CTES
from subjectloom.plans.frames import (
    BITS,
    CLASSES,
    LABELLED,
    SUBJECTS,
    VECTOR_CLASSES,
    VECTORS,
    bits,
    decided_sql,
    documents,
    long_scores,
    subject_sets,
    table,
    texts,
    vectors,
    with_words,
)
from subjectloom.session import fresh_path, release, written
from subjectloom.sources.model_store import load_model, load_models, save_model

N_FEATURES = 256
#: Columns of hashed terms where vectors stay sparse, so that hardly any two terms share one.
SPARSE_FEATURES = 1 << 18

_VOCAB = "classes(class_idx, label) AS (VALUES " + ", ".join(
    f"({i}, '{c}')" for i, c in enumerate(VECTOR_CLASSES)
) + ")"


# --- vectors -------------------------------------------------------------------------------

@query("l2_normalize", """
SELECT vec_id, dim, round(CASE WHEN norm = 0 THEN 0.0 ELSE x / norm END, 6) AS x FROM (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1)::INT - 1 AS dim,
         sqrt(list_sum(list_transform(v, lambda a: a * a))) AS norm
  FROM (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda a: a * label) AS v
        FROM embeddings))""")
def l2_normalize(spark, sf_dir):
    """Vectors stretched by their label; label 0 gives zero rows, which stay zero."""
    stretched = F.transform(F.col("embedding").cast("array<double>"), lambda a: a * F.col("label"))
    df = table(spark, sf_dir, "embeddings").select("vec_id", stretched.alias("v"))
    return X.l2_normalize(df, "v", "unit").select(
        "vec_id", F.posexplode("unit").alias("dim", "x")
    ).withColumn("x", F.round("x", 6))


_ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def letter_encoder():
    """A stand-in for a pre-trained encoder: how often each letter occurs."""
    def encode(texts):
        return np.array([[t.count(a) for a in _ALPHABET] for t in map(str.lower, texts)])

    return encode


_LETTERS = ", ".join(
    f"(length(t) - length(replace(t, '{a}', '')))::DOUBLE" for a in _ALPHABET
)


@query("embed_plug", f"""
SELECT doc_id, dim, round((CASE WHEN norm = 0 THEN 0.0 ELSE x / norm END)::FLOAT::DOUBLE, 5) AS x
FROM (SELECT doc_id, unnest(v) AS x, generate_subscripts(v, 1)::INT - 1 AS dim,
             sqrt(list_sum(list_transform(v, lambda a: a * a))) AS norm
      FROM (SELECT doc_id, [{_LETTERS}] AS v FROM (SELECT doc_id, lower(text) AS t FROM documents)))
""")
def embed_plug(spark, sf_dir):
    """A user's encoder, made once per partition and fed 64 texts at a time."""
    df = encode_with(texts(spark, sf_dir), "text", letter_encoder)
    return df.select("doc_id", F.posexplode_outer("embedding").alias("dim", "x")).withColumn(
        "x", F.round(F.col("x").cast("double"), 5)
    )


@query("pca_project", """
WITH cells AS (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS dim
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)),
axes AS (SELECT dim, var_samp(x) AS spread FROM cells GROUP BY dim)
SELECT 16 AS n_components, 0 AS n_skew, 0 AS n_off, round(sum(spread), 6) AS total,
       true AS first_leads, true AS falling FROM axes""")
def pca_project(spark, sf_dir):
    """Onto 16 of 64 components: pairs that are not orthonormal, components whose projections do
    not have the share of the variance the model states, the variance of all axes, whether the
    first component has more than any axis, and whether the shares fall."""
    df = table(spark, sf_dir, "embeddings").select(
        "vec_id", X.as_vector(F.col("embedding")).alias("raw")
    )
    model = Pipeline(stages=projection_stages("raw", "features", 16)).fit(df)
    axes, shares = model.stages[-1].pc.toArray(), model.stages[-1].explainedVariance.toArray()

    def spreads(frame, column):
        cells = frame.select(F.posexplode(X.as_array(F.col(column))).alias("dim", "x"))
        return cells.groupBy("dim").agg(F.var_samp("x").alias("spread"))

    whole = spreads(df, "raw").agg(F.sum("spread").alias("total"), F.max("spread").alias("widest"))
    total, widest = whole.first()
    stated = spark.createDataFrame(list(enumerate((shares * total).tolist())), "dim int, want double")
    kept = spreads(model.transform(df), "features").join(stated, "dim")
    skew = int((np.abs(axes.T @ axes - np.eye(axes.shape[1])) > 1e-6).sum())
    return kept.agg(
        F.count("*").cast("int").alias("n_components"),
        F.lit(skew).alias("n_skew"),
        F.count_if(F.abs(F.col("spread") - F.col("want")) > 1e-6).cast("int").alias("n_off"),
        F.round(F.lit(total), 6).alias("total"),
        (F.max("spread") >= widest).alias("first_leads"),
        F.lit(bool((np.diff(shares) <= 1e-12).all())).alias("falling"),
    )


# --- neighbours ----------------------------------------------------------------------------

_KNN = """
pairs AS (
  SELECT q.vec_id AS query_id, t.vec_id AS neighbor_id, t.labels,
         list_distance(q.embedding, t.embedding) AS distance
  FROM vectors q JOIN vectors t ON q.split = 'val' AND t.split = 'train'),
near AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank
  FROM pairs QUALIFY rank <= 5)
"""


def _neighbors(spark, sf_dir):
    df = vectors(spark, sf_dir)
    return nearest_neighbors(
        df.where("split = 'val'"), df.where("split = 'train'"),
        query_id="vec_id", train_id="vec_id",
    )


@query("knn_topk", with_ctes(VECTORS, _KNN) + """
SELECT query_id, neighbor_id, rank::INT AS rank, round(distance, 6) AS distance FROM near""")
def knn_topk(spark, sf_dir):
    return _neighbors(spark, sf_dir).select(
        "query_id", "neighbor_id", "rank", F.round("distance", 6).alias("distance")
    )


@query("knn_vote", with_ctes(VECTORS, _KNN, _VOCAB, """
weighted AS (
  SELECT query_id, labels, CASE WHEN min(distance) OVER (PARTITION BY query_id) = 0
    THEN (distance = 0)::INT::DOUBLE ELSE 1 / distance END AS w FROM near)""") + """
SELECT query_id, class_idx, round(coalesce(sum(w) FILTER (list_contains(labels, label)), 0)
                                  / sum(w), 6) AS score
FROM weighted CROSS JOIN classes GROUP BY query_id, class_idx""")
def knn_vote(spark, sf_dir):
    votes = neighbor_vote(_neighbors(spark, sf_dir), VECTOR_CLASSES)
    return long_scores(votes, "query_id").withColumn("score", F.round("score", 6))


#: Words of the texts that are counted together, at least.
COUNTED_WORDS = 2_000_000


def _word_counts(df: DataFrame) -> DataFrame:
    """``(block, ids, copies, words, n_docs, lengths, code, tf)``: a block has each of its words once, with the
    number of its documents that have it, and per document which words these are, and how often.
    Texts of one id are one document, that comes so many times."""
    id_type = df.schema["doc_id"].dataType
    out = pa.schema([
        ("block", pa.int64()), ("ids", pa.list_(to_arrow_type(id_type))), ("copies", pa.list_(pa.int32())),
        ("words", pa.list_(pa.string())), *((c, pa.list_(pa.int32())) for c in ("n_docs", "lengths", "code", "tf")),
    ])

    def count(batches):
        block, held = TaskContext.get().partitionId() << 32, None

        def put(rows: pa.Table) -> pa.RecordBatch:
            nonlocal block
            block += 1
            doc = rows["doc_id"].combine_chunks().dictionary_encode(null_encoding="encode")
            lists = rows["words"].combine_chunks()
            word = lists.flatten().dictionary_encode()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            line = np.repeat(doc.indices.to_numpy(), lengths)
            n = max(1, len(word.dictionary))
            cell, tf = np.unique(line * n + word.indices.to_numpy(), return_counts=True)
            line, code = np.divmod(cell, n)
            columns = [
                doc.dictionary, np.bincount(doc.indices.to_numpy()), word.dictionary,
                np.bincount(code, minlength=len(word.dictionary)),
                np.bincount(line, minlength=len(doc.dictionary)), code, tf,
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), *(pa.ListArray.from_arrays([0, len(c)], pa.array(c).cast(f.type.value_type))
                                      for c, f in zip(columns, [*out][1:], strict=True))], schema=out)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if (pc.sum(pc.list_value_length(held["words"])).as_py() or 0) > COUNTED_WORDS:
                last = held["doc_id"][-1]
                same = pc.is_null(held["doc_id"]) if not last.is_valid else pc.equal(held["doc_id"], last)
                done = held.filter(pc.invert(pc.fill_null(same, False)))
                if len(done):
                    yield put(done)
                    held = held.filter(pc.fill_null(same, False))
        if held is not None and len(held):
            yield put(held)

    return with_words(df.repartition("doc_id").sortWithinPartitions("doc_id")).select(
        "doc_id", "words").mapInArrow(count, f"block long, ids array<{id_type.simpleString()}>, "
        "copies array<int>, words array<string>, n_docs array<int>, lengths array<int>, code array<int>, tf array<int>")


def weighted_words(spark, sf_dir) -> DataFrame:
    """``(id, terms)``: each document's words, as numbers, with tf-idf weights, of unit length."""
    df = documents(spark, sf_dir).select("doc_id", "text")
    n, id_type = df.count(), df.schema["doc_id"].dataType
    counts = written(_word_counts(df), "counts")
    every = counts.select("block", F.posexplode(F.arrays_zip("words", "n_docs")).alias("place", "c"))
    every = every.select("block", "place", F.col("c.words").alias("term"), F.col("c.n_docs").alias("n_docs"))
    rarity = written(every.groupBy("term").agg(
        F.log(F.lit(n + 1.0) / (F.sum("n_docs") + 1)).alias("rarity")
    ).withColumn("number", F.monotonically_increasing_id()), "rarity")
    told = every.join(rarity, "term").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "number", "rarity"))).alias("told"))
    cell = pa.struct([("term", pa.int64()), ("w", pa.float64())])
    out = pa.schema([("id", to_arrow_type(id_type)), ("terms", pa.list_(cell))])

    def weigh(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                ids, copies, lengths, code, tf = (
                    batch.column(c)[at].values for c in ("ids", "copies", "lengths", "code", "tf"))
                number, rarity = (
                    np.asarray(batch.column(c)[at].values) if batch.column(c)[at].is_valid else np.empty(0)
                    for c in ("number", "rarity"))
                code, line = np.asarray(code), np.repeat(np.arange(len(ids)), np.asarray(lengths))
                w = np.asarray(tf) * rarity[code]
                length = np.sqrt(np.bincount(line, w * w, len(ids)))
                # A document without an id is told apart from no other, and has no words.
                held = (w > 0) & ids.is_valid().to_numpy(zero_copy_only=False)[line]
                line, term, w = line[held], number[code[held]], w[held] / length[line[held]]
                order = np.lexsort((term, line))
                starts = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(ids)))])
                cells = pa.StructArray.from_arrays(
                    [pa.array(term[order].astype(np.int64)), pa.array(w[order])], fields=[*cell])
                terms = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), cells)
                rows = pa.RecordBatch.from_arrays([ids, terms], schema=out)
                again = np.asarray(copies)
                yield rows if (again == 1).all() else rows.take(pa.array(np.repeat(np.arange(len(ids)), again)))

    met = counts.join(told.select(
        "block", F.col("told.number").alias("number"), F.col("told.rarity").alias("rarity")), "block", "left")
    weighed = written(met.mapInArrow(
        weigh, f"id {id_type.simpleString()}, terms array<struct<term:long,w:double>>"), "weighted-words")
    release(counts, rarity)
    return weighed


@query("knn_sparse_topk", """
WITH val AS (
  SELECT doc_id FROM documents
  QUALIFY row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) <= ceil(0.2 * count(*) OVER ())),
counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(list_filter(
      regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda w: w <> '')) AS term
    FROM documents) GROUP BY ALL),
rarity AS (
  SELECT term, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1)) AS rarity
  FROM counts GROUP BY term),
weighed AS (SELECT doc_id, term, tf * rarity AS w FROM counts JOIN rarity USING (term)),
lengths AS (SELECT doc_id, sqrt(sum(w * w)) AS length FROM weighed GROUP BY doc_id),
unit AS (
  SELECT doc_id, term, w / length AS w, doc_id IN (SELECT doc_id FROM val) AS is_val
  FROM weighed JOIN lengths USING (doc_id) WHERE w > 0),
squares AS (
  SELECT d.doc_id, d.doc_id IN (SELECT doc_id FROM val) AS is_val,
         coalesce(sum(w * w), 0) AS square
  FROM documents d LEFT JOIN unit USING (doc_id) GROUP BY d.doc_id),
dots AS (
  SELECT q.doc_id AS query_id, t.doc_id AS neighbor_id, sum(q.w * t.w) AS dot
  FROM unit q JOIN unit t ON q.term = t.term AND q.is_val AND NOT t.is_val GROUP BY ALL),
pairs AS (
  SELECT q.doc_id AS query_id, t.doc_id AS neighbor_id,
         sqrt(abs(greatest(round(q.square + t.square - 2 * coalesce(dot, 0), 12), 0))) AS distance
  FROM squares q JOIN squares t ON q.is_val AND NOT t.is_val
  LEFT JOIN dots d ON d.query_id = q.doc_id AND d.neighbor_id = t.doc_id)
SELECT query_id, neighbor_id, rank::INT AS rank, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), neighbor_id)
    AS rank FROM pairs) WHERE rank <= 5""")
def knn_sparse_topk(spark, sf_dir):
    """Neighbours of texts by their weighted words, over the whole vocabulary."""
    rows = split_random(weighted_words(spark, sf_dir), "id")
    train = rows.where("split = 'train'").select(
        "id", "terms", F.array().cast("array<string>").alias("labels")
    )
    found = nearest_sparse(rows.where("split = 'val'").select("id", "terms"), train, 5)
    return found.select(
        "query_id", "neighbor_id", "rank", F.round("distance", 6).alias("distance")
    )


# --- clusters ------------------------------------------------------------------------------

_CLUSTERS = """
centres AS (
  SELECT embedding AS centre, (row_number() OVER (ORDER BY md5(vec_id || ':42'), vec_id) - 1)::INT
    AS cluster FROM vectors QUALIFY cluster < 5),
assigned AS (
  SELECT vec_id, labels, cluster, list_distance(embedding, centre) AS distance
  FROM vectors CROSS JOIN centres
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)
"""
_MAP = """
votes AS (
  SELECT cluster, class_idx, count(*) AS n
  FROM (SELECT cluster, unnest(labels) AS label FROM assigned) JOIN classes USING (label)
  GROUP BY ALL),
winners AS (
  SELECT cluster, class_idx, n FROM votes
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, class_idx) = 1),
label_map AS (
  SELECT c.cluster, coalesce(w.class_idx, 0) AS class_idx, coalesce(n, 0) AS n_docs
  FROM centres c LEFT JOIN winners w USING (cluster))
"""


def _assigned(spark, sf_dir):
    """All vectors around five centroids, drawn with the exact sampler."""
    df = vectors(spark, sf_dir)
    drawn = sampling.sample_exact(df, "vec_id", 5).orderBy(sampling.id_hash("vec_id", 42), "vec_id")
    centroids = [r["embedding"] for r in drawn.select("embedding").collect()]
    return df.withColumn("near", C.assign_to_centroids(F.col("embedding"), centroids)).select(
        "vec_id", "labels", "near.cluster", "near.distance"
    )


@query("kmeans_assign", with_ctes(VECTORS, _CLUSTERS) + """
SELECT vec_id, cluster, round(distance, 6) AS distance FROM assigned""")
def kmeans_assign(spark, sf_dir):
    return _assigned(spark, sf_dir).select(
        "vec_id", "cluster", F.round("distance", 6).alias("distance")
    )


@query("cluster_label_map", with_ctes(VECTORS, _CLUSTERS, _VOCAB, _MAP) + """
SELECT cluster, class_idx, n_docs FROM label_map""")
def cluster_label_map(spark, sf_dir):
    return C.cluster_label_map(_assigned(spark, sf_dir), 5, VECTOR_CLASSES)


@query("kmeans_majority_predict", with_ctes(VECTORS, _CLUSTERS, _VOCAB, _MAP) + """
SELECT vec_id, repeat('0', class_idx) || '1' || repeat('0', 12 - class_idx) AS p
FROM assigned JOIN label_map USING (cluster)""")
def kmeans_majority_predict(spark, sf_dir):
    assigned = _assigned(spark, sf_dir)
    class_of = C.label_map_list(C.cluster_label_map(assigned, 5, VECTOR_CLASSES))
    hot = C.majority_scores(F.col("cluster"), class_of, len(VECTOR_CLASSES))
    return assigned.select("vec_id", bits(D.above(hot, 0.0)).alias("p"))


# --- fitted models -------------------------------------------------------------------------

def embedded(
    spark, sf_dir, pca_components: int | None = None, n_features: int = N_FEATURES
) -> DataFrame:
    """Clean text, encoded once and written, so that fits and scores read vectors only."""
    rows = split_random(subject_sets(spark, sf_dir), "doc_id")
    df = rows.select(
        F.col("doc_id").alias("id"), normalize_text(F.col("text")).alias("text_clean"),
        "labels", multi_hot(F.col("labels"), CLASSES).alias("y"), "split",
    )
    # The stages up to term counts learn nothing, so texts are cut into terms once, before the fit.
    first, learning = halves(feature_stages("text_clean", n_features, pca_components))
    counted = first.transform(df).select("id", "_counts", "labels", "y", "split")
    counts = written(counted, "term-counts", partition_by="split")
    encoder = learning.fit(counts.where("split = 'train'"))
    encoded = encoder.transform(counts).select("id", "features", "labels", "y", "split")
    return written(encoded, "features", partition_by="split")


def sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("split = 'train'"), df.where("split = 'val'")


_VAL = """
val AS (
  SELECT doc_id FROM documents
  QUALIFY row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) <= ceil(0.2 * count(*) OVER ()))
"""
_GRID = "classes(class_idx) AS (VALUES " + ", ".join(f"({i})" for i in range(len(CLASSES))) + ")"

# What any fit of the validation side has to hold, per class: every document scored, scores within
# [0, 1], decisions as the rule says. The languages, which words tell apart, are found better
# than by always saying no, whose share of right answers is given; other classes may not be.
_FITTED = with_ctes(_VAL, _GRID, f"""
truth AS (
  SELECT c.class_idx, count(*) AS n_docs FROM val CROSS JOIN classes c GROUP BY c.class_idx)""") + """
SELECT class_idx, n_docs, n_docs AS n_in_range, n_docs AS n_by_rule, true AS tells_languages
FROM truth"""


def fitted_facts(scored: DataFrame) -> DataFrame:
    """``(class_idx, n_docs, n_in_range, n_by_rule, tells_languages)`` of scored documents with
    their true vectors ``y``. The rule is put down here anew, on scores one by one."""
    rows = scored.select(
        "id", "y", "scores", D.from_probabilities(F.col("scores")).alias("p"),
        F.exists("scores", lambda x: x >= 0.35).alias("any"),
        (F.array_position("scores", F.array_max("scores")) - 1).alias("best"),
    )
    cells = rows.select(
        "any", "best", F.posexplode_outer(F.arrays_zip("y", "scores", "p")).alias("class_idx", "c")
    ).select("any", "best", "class_idx", "c.*")
    ruled = F.when(F.col("any"), F.col("scores") >= 0.35).otherwise(
        F.col("class_idx") == F.col("best")
    )
    right = F.avg((F.col("p") == F.col("y")).cast("double"))
    no = F.avg((F.col("y") == 0).cast("double"))
    return cells.groupBy("class_idx").agg(
        F.count("*").alias("n_docs"),
        F.count_if(F.col("scores").between(0.0, 1.0)).alias("n_in_range"),
        F.count_if((F.col("p") == 1) == ruled).alias("n_by_rule"),
        ((F.col("class_idx") >= 4) | (right > F.least(no, F.lit(1.0) - no))).alias(
            "tells_languages"),
    )


@query("embed_tfidf", with_ctes(*CLEAN_CTES) + """
SELECT doc_id, text_clean <> '' AS has_terms, CASE WHEN text_clean <> '' THEN 1.0 ELSE 0.0 END
  ::DOUBLE AS norm FROM clean""")
def embed_tfidf(spark, sf_dir):
    """Unit vectors, but for texts without terms, which are zero vectors."""
    values = X.as_array(F.col("features"))
    return embedded(spark, sf_dir).select(
        F.col("id").alias("doc_id"), F.exists(values, lambda v: v != 0).alias("has_terms"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v * v), 6).alias("norm"),
    )


@query("embed_word2vec", with_ctes(*CLEAN_CTES, _VAL, """
held AS (SELECT doc_id, unnest(string_split(text_clean, ' ')) AS word FROM clean
         WHERE text_clean <> ''),
known AS (SELECT DISTINCT word FROM held WHERE doc_id NOT IN (SELECT doc_id FROM val)),
told AS (SELECT DISTINCT doc_id FROM held JOIN known USING (word))""") + """
SELECT d.lang, count(*) AS n_docs, count(told.doc_id) AS n_unit, true AS near_ones_agree
FROM documents d JOIN val USING (doc_id) LEFT JOIN told USING (doc_id) GROUP BY d.lang""")
def embed_word2vec(spark, sf_dir):
    """Trained word vectors, averaged per text: per language how many validation texts there are,
    how many have vectors of length one (the others hold no word of a training text), and whether most of their
    nearest training texts are of the same language."""
    rows = split_random(subject_sets(spark, sf_dir), "doc_id")
    clean = written(rows.select(
        F.col("doc_id").alias("id"), normalize_text(F.col("text")).alias("text_clean"),
        "labels", "split",
    ), "clean-split")
    train = clean.where("split = 'train'")
    encoder = feature_stages("text_clean", kind="word2vec", vector_size=32, min_count=1).fit(train)
    vectors = written(encoder.transform(clean).select(
        "id", "labels", "split", X.as_array(F.col("features")).alias("embedding")
    ), "word-vectors")
    val = vectors.where("split = 'val'")
    nearest = nearest_neighbors(val, vectors.where("split = 'train'"), 1)
    lang = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    found = val.join(lang, "id").join(
        nearest.select(F.col("query_id").alias("id"), "neighbor_labels"), "id", "left"
    )
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    agree = F.avg(F.array_contains("neighbor_labels", F.col("lang")).cast("double"))
    return found.groupBy("lang").agg(
        F.count("*").alias("n_docs"),
        F.count_if(F.abs(length - 1) < 1e-6).alias("n_unit"),
        (agree > 0.5).alias("near_ones_agree"),
    )


@query("staged_fit", _FITTED)
def staged_fit(spark, sf_dir):
    """Text to TF-IDF to principal components to a classifier."""
    train, val = sides(embedded(spark, sf_dir, pca_components=16))
    return fitted_facts(N.fit_logistic(train, CLASSES).score(val))


@query("ovr_fit", _FITTED)
def ovr_fit(spark, sf_dir):
    """Any binary estimator per label; here one that the registry does not hold."""
    train, val = sides(embedded(spark, sf_dir))
    return fitted_facts(fit_one_vs_rest(train, NaiveBayes(), CLASSES).score(val))


@query("score_matrix", with_ctes(_VAL, _GRID) + """
SELECT doc_id AS id, class_idx, true AS in_range FROM val CROSS JOIN classes""")
def score_matrix(spark, sf_dir):
    train, val = sides(embedded(spark, sf_dir))
    model = fit_one_vs_rest(train, LogisticRegression(maxIter=50), CLASSES)
    return long_scores(model.score(val), "id").select(
        "id", "class_idx", F.col("score").between(0.0, 1.0).alias("in_range")
    )


def _fit_and_check(name, n_features=N_FEATURES, **params):
    def run(spark, sf_dir):
        train, val = sides(embedded(spark, sf_dir, n_features=n_features))
        return fitted_facts(N.fit_model(name, train, CLASSES, **params).score(val))

    return run


query("tree_fit_score", _FITTED)(_fit_and_check("decision_tree"))
query("logreg_fit_score", _FITTED)(_fit_and_check("transformer"))

#: Letters of a hundred characters are counted so far, which leaves few different values.
MOST_PER_HUNDRED = 20
_NAMED = "classes(class_idx, label) AS (VALUES " + ", ".join(
    f"({i}, '{c}')" for i, c in enumerate(CLASSES)
) + ")"


@query("tree_best_split", with_ctes(LABELLED, SUBJECTS, _NAMED, f"""
letters(feature, letter) AS (VALUES {", ".join(f"({i}, '{a}')" for i, a in enumerate(_ALPHABET))}),
counted AS (
  SELECT doc_id, feature, least({MOST_PER_HUNDRED},
         100 * (length(t) - length(replace(t, letter, ''))) // greatest(length(t), 1)) AS v
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) CROSS JOIN letters),
truth AS (
  SELECT d.doc_id, c.class_idx, (r.doc_id IS NOT NULL)::INT AS y
  FROM documents d CROSS JOIN classes c LEFT JOIN label_rows r USING (doc_id, label)),
totals AS (SELECT class_idx, count(*) - sum(y) AS n0, sum(y) AS n1 FROM truth GROUP BY class_idx),
cells AS (
  SELECT class_idx, feature, v, sum(1 - y) AS c0, sum(y) AS c1
  FROM counted JOIN truth USING (doc_id) GROUP BY class_idx, feature, v),
known AS (SELECT DISTINCT feature, v FROM counted),
sides AS (
  SELECT class_idx, feature, v,
         lead(v) OVER w AS above, sum(coalesce(c0, 0)) OVER w AS l0, sum(coalesce(c1, 0)) OVER w AS l1
  FROM (known CROSS JOIN (SELECT class_idx FROM classes)) LEFT JOIN cells USING (class_idx, feature, v)
  WINDOW w AS (PARTITION BY class_idx, feature ORDER BY v)),
shares AS (
  SELECT s.*, t.n0, t.n1, l0 / n0 AS a0, l1 / n1 AS a1, 1 - l0 / n0 AS b0, 1 - l1 / n1 AS b1
  FROM sides s JOIN totals t USING (class_idx) WHERE above IS NOT NULL AND n0 > 0 AND n1 > 0
    AND l0 + l1 > 0 AND l0 + l1 < n0 + n1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY class_idx ORDER BY round(
      (a0 * a0 + a1 * a1) / (a0 + a1) / 2 + (b0 * b0 + b1 * b1) / (b0 + b1) / 2 - 0.5, 10) DESC,
      feature, v) AS place
  FROM shares)""") + """
SELECT class_idx, feature, (v + above) / 2.0::DOUBLE AS "limit", l0::BIGINT AS l0, l1::BIGINT AS l1,
       (n0 - l0)::BIGINT AS r0, (n1 - l1)::BIGINT AS r1
FROM ranked WHERE place = 1""")
def tree_best_split(spark, sf_dir):
    """Per label, the first split of its tree over all documents, and what goes to either side.
    Features are how many of a hundred characters are a certain letter."""
    text = F.coalesce("text", F.lit(""))
    share = [F.least(F.lit(MOST_PER_HUNDRED), F.floor(
        F.lit(100) * (F.length(text) - F.length(F.replace(text, F.lit(a))))
        / F.greatest(F.length(text), F.lit(1)))).cast("double") for a in _ALPHABET]
    rows = subject_sets(spark, sf_dir).select(
        array_to_vector(F.array(*share)).alias("features"),
        multi_hot(F.col("labels"), CLASSES).alias("y"),
    )
    trees = N.fit_trees(rows, CLASSES, max_depth=1).trees
    split = [
        (i, int(trees.feature[i]), float(trees.limit[i]),
         *(int(n[side[i]]) for side in (trees.left, trees.right) for n in (trees.n0, trees.n1)))
        for i in range(len(CLASSES)) if trees.feature[i] >= 0
    ]
    return spark.createDataFrame(
        split, "class_idx int, feature int, limit double, l0 long, l1 long, r0 long, r1 long"
    )


@query("logreg_settled", with_ctes(_VAL, _GRID) + """
SELECT class_idx, (SELECT count(*) FROM documents) - (SELECT count(*) FROM val) AS n_train,
       true AS settled, true AS spoilt_fails FROM classes""")
def logreg_settled(spark, sf_dir):
    """Per class: whether the fit has no slope left, worked out anew cell by cell, and whether
    the same question finds weights that are a little off."""
    train, _ = sides(embedded(spark, sf_dir))
    model = N.fit_logistic(train, CLASSES)
    spoilt = LinearModel(model.vocabulary, model.weights * 0.98, model.constants)
    good, bad = (largest_slope(m, train).alias(a) for m, a in ((model, "g"), (spoilt, "b")))
    return good.join(bad, "class_idx").select(
        "class_idx", F.col("g.n").alias("n_train"), (F.col("g.slope") < 1e-5).alias("settled"),
        (F.col("b.slope") > 1e-5).alias("spoilt_fails"),
    )


def largest_slope(model: LinearModel, train: DataFrame) -> DataFrame:
    """``(class_idx, n, slope)``: the largest part of the gradient of each label's penalised
    mean loss, with C = 1."""
    scored = model.score(train).select(
        "id", "y", "scores", F.concat(X.as_array(F.col("features")), F.array(F.lit(1.0))).alias("x")
    )
    rows = written(scored.select("x", F.posexplode(F.arrays_zip("y", "scores")).alias(
        "class_idx", "c")).select("x", "class_idx", "c.y", "c.scores"), "slopes")
    sums = rows.groupBy("class_idx").agg(F.count("*").alias("n"), F.sum("y").alias("n_pos"))
    rows = rows.join(F.broadcast(sums), "class_idx")
    ones = F.col("y") > 0
    weight = F.col("n") / (2.0 * F.when(ones, F.col("n_pos")).otherwise(F.col("n") - F.col("n_pos")))
    pull = weight * (F.col("scores") - F.col("y")) / F.col("n")
    cells = rows.select("class_idx", "n", pull.alias("pull"), F.posexplode("x").alias("place", "v"))
    slopes = cells.groupBy("class_idx", "n", "place").agg(F.sum(F.col("pull") * F.col("v")).alias("s"))
    held = train.sparkSession.createDataFrame(
        [(i, p, w) for i, row in enumerate(model.weights.tolist()) for p, w in enumerate(row)],
        "class_idx int, place int, w double",
    )
    whole = slopes.join(held, ["class_idx", "place"])
    return whole.groupBy("class_idx", "n").agg(
        F.max(F.abs(F.col("s") + F.col("w") / F.col("n"))).alias("slope")
    )


query("mlp_fit_score", _FITTED)(_fit_and_check("neural_net"))
query("knn_text_fit_score", _FITTED)(_fit_and_check("knn", SPARSE_FEATURES))


@query("knn_fit_score", with_ctes(VECTORS, _KNN, _VOCAB, """
weighted AS (
  SELECT query_id, labels, CASE WHEN min(distance) OVER (PARTITION BY query_id) = 0
    THEN (distance = 0)::INT::DOUBLE ELSE 1 / distance END AS w FROM near)""", """
votes AS (
  SELECT query_id, class_idx, coalesce(sum(w) FILTER (list_contains(labels, label)), 0)
                              / sum(w) AS score
  FROM weighted CROSS JOIN classes GROUP BY query_id, class_idx)""",
    decided_sql("votes", "d", "score >= 0.35::DOUBLE", 1, "query_id")) + f"""
SELECT query_id AS vec_id, {BITS} AS p FROM d GROUP BY query_id""")
def knn_fit_score(spark, sf_dir):
    """The registry's neighbour model, from fit to decision."""
    df = vectors(spark, sf_dir).select(
        F.col("vec_id").alias("id"), X.as_vector(F.col("embedding")).alias("features"), "labels",
        "split",
    )
    train, val = sides(df)
    return N.fit_model("knn", train, VECTOR_CLASSES).score(val).select(
        F.col("id").alias("vec_id"), bits(D.from_probabilities(F.col("scores"))).alias("p")
    )


def _cluster_facts(model, train: DataFrame, val: DataFrame) -> DataFrame:
    """Rows that are not at their nearest centre, and centres that are not the mean of their
    training rows: none, where a fit has converged."""
    centres = [c.tolist() for c in model.stages[-1].clusterCenters()]
    near = C.assign_to_centroids(X.as_array(F.col("features")), centres)["cluster"]
    both = model.transform(train.unionByName(val)).select(
        "cluster", near.alias("near"), X.as_array(F.col("features")).alias("v"), "split"
    )
    away = both.agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("cluster") != F.col("near")).alias("n_away")
    )
    cells = both.where("split = 'train'").select("cluster", F.posexplode("v").alias("dim", "x"))
    means = cells.groupBy("cluster", "dim").agg(F.avg("x").alias("mean"))
    fitted = train.sparkSession.createDataFrame(
        [(i, d, x) for i, c in enumerate(centres) for d, x in enumerate(c)],
        "cluster int, dim int, x double",
    )
    off = fitted.join(means, ["cluster", "dim"], "left").where(
        F.abs(F.col("x") - F.coalesce("mean", F.lit(0.0))) > 0.02
    )
    return away.withColumn("n_off", F.lit(off.count()).cast("long"))


_CONVERGED = "SELECT count(*) AS n_docs, 0::BIGINT AS n_away, 0::BIGINT AS n_off FROM documents"


@query("kmeans_fit", _CONVERGED)
def kmeans_fit(spark, sf_dir):
    train, val = sides(embedded(spark, sf_dir))
    return _cluster_facts(N.fit_model("kmeans", train, CLASSES).clusters, train, val)


@query("fit_unlabeled", _CONVERGED)
def fit_unlabeled(spark, sf_dir):
    """Clusters without labels; the prediction is the cluster's number as text."""
    train, val = sides(embedded(spark, sf_dir).drop("labels", "y"))
    model = N.fit_clusters(train)
    facts = _cluster_facts(model, train, val)
    named = N.cluster_names(model, train.unionByName(val))
    bad = named.where(~F.col("prediction").isin(*map(str, range(5)))).count()
    return facts.withColumn("n_away", F.col("n_away") + F.lit(bad))


@query("model_roundtrip", """
SELECT ceil(0.2 * count(*))::BIGINT AS n_docs, ceil(0.2 * count(*))::BIGINT AS n_same
FROM documents""")
def model_roundtrip(spark, sf_dir):
    """A saved and loaded model scores as before."""
    train, val = sides(embedded(spark, sf_dir))
    model = N.fit_model("transformer", train, CLASSES)
    path = fresh_path(spark, "model")
    save_model(spark, model, path)
    before = model.score(val).select("id", F.col("scores").alias("before"))
    after = load_model(spark, path).score(val).select("id", F.col("scores").alias("after"))
    return before.join(after, "id").agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("before") == F.col("after")).alias("n_same")
    )


@query("model_catalog", """
SELECT name AS model, ceil(0.2 * count(*))::BIGINT AS n_docs
FROM documents CROSS JOIN (VALUES ('kmeans'), ('knn')) m(name) GROUP BY name""")
def model_catalog(spark, sf_dir):
    """Of the known names, those found in a folder; each scores the validation side."""
    train, val = sides(embedded(spark, sf_dir))
    folder = fresh_path(spark, "models")
    for name in ("kmeans", "knn"):
        save_model(spark, N.fit_model(name, train, CLASSES), f"{folder}/{name}")
    counts = [
        model.score(val).agg(F.lit(name).alias("model"), F.count("scores").alias("n_docs"))
        for name, model in load_models(spark, folder).items()
    ]
    return counts[0].unionByName(counts[1])
