"""Registered queries: scans, sinks, row filters, samples and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subjectloom import jobs
from subjectloom.functions.text import normalize_text
from subjectloom.operators import sampling, splitting
from subjectloom.plans.catalog import query, with_ctes
from subjectloom.plans.cleaning import CLEAN_CTES
from subjectloom.plans.frames import (
    CLASSES,
    LABELLED,
    SUBJECTS,
    documents,
    labelled,
    subject_sets,
    table,
)
from subjectloom.session import fresh_path, written
from subjectloom.sources import readers, sinks


@query("scan_corpus", "SELECT doc_id, text, lang FROM documents")
def scan_corpus(spark, sf_dir):
    return readers.scan_corpus(spark, f"{sf_dir}/documents.parquet", "text", "lang", "doc_id")


@query("scan_csv", "SELECT doc_id, text, lang FROM documents")
def scan_csv(spark, sf_dir):
    """Texts with line breaks, quotes and commas through a CSV table and back."""
    path = fresh_path(spark, "csv")
    sinks.write_clean(documents(spark, sf_dir).select("doc_id", "text", "lang"), path, "csv")
    return readers.scan_csv(spark, path, "doc_id long, text string, lang string")


def _as_lines(spark, sf_dir) -> str:
    path = fresh_path(spark, "lines") + ".txt"
    documents(spark, sf_dir).select("text").write.text(path)
    return path


_LINES = """
lines AS (SELECT trim(unnest(string_split(text, chr(10)))) AS text FROM documents)"""


@query("scan_text_lines", with_ctes(_LINES) + " SELECT text FROM lines WHERE text <> ''")
def scan_text_lines(spark, sf_dir):
    return readers.scan_text_lines(spark, _as_lines(spark, sf_dir))


@query("scan_any", with_ctes(_LINES, LABELLED) + """
SELECT 'lines' AS layout, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars,
       0::BIGINT AS n_label_chars FROM lines WHERE text <> ''
UNION ALL SELECT 'clean', count(*), sum(length(text))::BIGINT, sum(length(label))::BIGINT
FROM labelled
UNION ALL SELECT 'column', count(*), sum(length(text))::BIGINT, 0 FROM documents
UNION ALL SELECT 'semicolons', count(*), sum(length(text))::BIGINT, sum(length(label))::BIGINT
FROM labelled""")
def scan_any(spark, sf_dir):
    """One reader for line files, clean tables, one-column tables and other separators."""
    clean, column, other = (fresh_path(spark, n) for n in ("clean", "column", "other"))
    rows = labelled(spark, sf_dir).select(F.col("text").alias("text_clean"), "label")
    sinks.write_clean(rows, clean, "csv")
    sinks.write_clean(documents(spark, sf_dir).select("text"), column, "csv")
    rows.write.options(header="true", quote='"', escape='"', sep=";").csv(other)
    layouts = {
        "lines": _as_lines(spark, sf_dir), "clean": clean, "column": column, "semicolons": other,
    }

    def summary(layout: str, path: str) -> DataFrame:
        df = readers.scan_any(spark, path)
        label = F.col("label") if "label" in df.columns else F.lit("")
        return df.agg(
            F.lit(layout).alias("layout"), F.count("*").alias("n_docs"),
            F.sum(F.length("text")).alias("n_chars"),
            F.sum(F.length(label)).alias("n_label_chars"),
        )

    return reduce(DataFrame.unionByName, [summary(n, p) for n, p in layouts.items()])


@query("project_clean", with_ctes(*CLEAN_CTES, LABELLED) + """
SELECT c.doc_id, c.text_clean, l.label FROM clean c JOIN labelled l USING (doc_id)""")
def project_clean(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "doc_id", normalize_text(F.col("text")).alias("text_clean"), "label"
    )


@query("sink_roundtrip", with_ctes(*CLEAN_CTES, LABELLED) + """
SELECT c.doc_id, c.text_clean, l.label FROM clean c JOIN labelled l USING (doc_id)""")
def sink_roundtrip(spark, sf_dir):
    """The clean table written and read back."""
    path = fresh_path(spark, "clean")
    sinks.write_clean(project_clean(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("drop_null_rows", """
SELECT d.doc_id, length(d.text) AS n_chars, l.quality::VARCHAR AS label
FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL""")
def drop_null_rows(spark, sf_dir):
    df = labelled(spark, sf_dir).select(
        "doc_id", "text", F.col("quality").cast("string").alias("mark")
    )
    return readers.drop_null_rows(df, "text", "mark").select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.col("mark").alias("label")
    )


@query("cast_fill", with_ctes(LABELLED) + """
SELECT doc_id, coalesce(quality::VARCHAR, '') AS quality, coalesce(toxic::VARCHAR, '') AS toxic
FROM labelled""")
def cast_fill(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "doc_id", readers.filled("quality").alias("quality"), readers.filled("toxic").alias("toxic")
    )


@query("drop_blank_text", """
SELECT doc_id, pos, line FROM (
  SELECT doc_id, unnest(k) AS line, generate_subscripts(k, 1)::INT AS pos
  FROM (SELECT doc_id, string_split(text, chr(10)) AS k FROM documents))
WHERE trim(line) <> ''""")
def drop_blank_text(spark, sf_dir):
    lines = documents(spark, sf_dir).select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    ).withColumn("pos", F.col("pos") + 1)
    return readers.drop_blank_text(lines, "line")


@query("preview", """
SELECT doc_id, CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...' ELSE text END AS text,
       greatest((SELECT count(*) FROM documents) - 5, 0) AS n_more
FROM documents ORDER BY doc_id LIMIT 5""")
def preview(spark, sf_dir):
    return readers.preview(documents(spark, sf_dir), "doc_id", "text")


@query("stage_counts", with_ctes(LABELLED, SUBJECTS) + """
SELECT (SELECT count(*) FROM documents) AS n_loaded,
       (SELECT count(*) FROM labelled WHERE quality IS NOT NULL) AS n_marked,
       (SELECT count(DISTINCT doc_id) FROM label_rows WHERE label IN ('es', 'fr', 'q')) AS n_kept,
       (SELECT count(*) FROM label_rows WHERE label IN ('es', 'fr', 'q')) AS n_labels""")
def stage_counts(spark, sf_dir):
    """Row counts of several stages in one pass."""
    kept = F.size(F.array_intersect("labels", F.array(*[F.lit(c) for c in ("es", "fr", "q")])))
    marked = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return subject_sets(spark, sf_dir).join(marked, "doc_id", "left").select(
        "quality", kept.alias("kept")
    ).agg(
        F.count("*").alias("n_loaded"), F.count("quality").alias("n_marked"),
        F.count_if(F.col("kept") > 0).alias("n_kept"),
        F.sum("kept").alias("n_labels"),
    )


_SAMPLE = 123


@query("sample_exact_n", f"""
SELECT doc_id, length(text) AS n_chars FROM documents
ORDER BY md5(doc_id || ':42'), doc_id LIMIT {_SAMPLE}""")
def sample_exact_n(spark, sf_dir):
    return sampling.sample_exact(documents(spark, sf_dir), "doc_id", _SAMPLE).select(
        "doc_id", F.length("text").cast("long").alias("n_chars")
    )


_RANDOM = """
split_rows AS (
  SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id)
                           <= ceil(0.2 * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split
  FROM documents)"""


@query("split_random", with_ctes(_RANDOM) + " SELECT doc_id, split FROM split_rows")
def split_random(spark, sf_dir):
    return splitting.split_random(documents(spark, sf_dir), "doc_id").select("doc_id", "split")


@query("split_hash_bucket", f"""
SELECT doc_id, CASE WHEN ('0x' || substr(md5(doc_id || ':42'), 1, 4))::INT
                         < {int(0.2 * sampling.BUCKETS)} THEN 'val' ELSE 'train' END AS split
FROM documents""")
def split_hash_bucket(spark, sf_dir):
    return splitting.split_by_hash(documents(spark, sf_dir), "doc_id").select("doc_id", "split")


_STRATIFIED = """
sets AS (
  SELECT doc_id, string_agg(label, ' ' ORDER BY label) AS stratum
  FROM label_rows GROUP BY doc_id),
strata AS (SELECT stratum, count(*) AS n FROM sets GROUP BY stratum),
quotas AS (
  SELECT stratum, floor(n * 0.2::DOUBLE) + CASE WHEN
    row_number() OVER (ORDER BY n * 0.2::DOUBLE - floor(n * 0.2::DOUBLE) DESC, n,
                                md5(stratum || ':42'), stratum)
    <= ceil(0.2::DOUBLE * sum(n) OVER ()) - sum(floor(n * 0.2::DOUBLE)) OVER ()
    THEN 1 ELSE 0 END AS quota
  FROM strata),
strat_rows AS (
  SELECT doc_id, stratum, CASE WHEN
    row_number() OVER (PARTITION BY stratum ORDER BY md5(doc_id || ':42'), doc_id) <= quota
    THEN 'val' ELSE 'train' END AS split
  FROM sets JOIN quotas USING (stratum))"""


def _stratified(spark, sf_dir):
    return splitting.split_stratified(subject_sets(spark, sf_dir), "doc_id", "labels")


@query("split_stratified", with_ctes(LABELLED, SUBJECTS, _STRATIFIED) + """
SELECT doc_id, stratum AS labels, split FROM strat_rows""")
def split_stratified(spark, sf_dir):
    return _stratified(spark, sf_dir).select(
        "doc_id", F.array_join("labels", " ").alias("labels"), "split"
    )


@query("split_balanced", with_ctes(LABELLED, SUBJECTS, """
sets AS (SELECT doc_id, string_agg(label, ' ' ORDER BY label) AS stratum
         FROM label_rows GROUP BY doc_id)""") + """
SELECT label, count(*) AS n_docs, count(DISTINCT stratum) AS n_sets, true AS keeps_share,
       true AS has_val, (SELECT ceil(0.2 * count(*)) FROM documents)::BIGINT AS n_val
FROM label_rows JOIN sets USING (doc_id) GROUP BY label""")
def split_balanced(spark, sf_dir):
    """Per label: whether its validation rows are within one row per label set that holds it of
    a fifth, whether a label of five or more rows has one, and the size of the whole side."""
    df = subject_sets(spark, sf_dir)
    sides = written(splitting.split_balanced(df, "doc_id", "labels"), "sides")
    rows = sides.select(
        F.explode("labels").alias("label"), F.array_join("labels", " ").alias("stratum"), "split"
    )
    is_val = F.col("split") == "val"
    n_val, n = F.count_if(is_val), F.count("*")
    return rows.groupBy("label").agg(
        n.alias("n_docs"), F.count_distinct("stratum").alias("n_sets"),
        (F.abs(n_val - 0.2 * n) < 1 + F.count_distinct("stratum")).alias("keeps_share"),
        ((n < 5) | (n_val > 0)).alias("has_val"),
        F.lit(sides.where(is_val).count()).cast("long").alias("n_val"),
    )


@query("split_disjoint_check", with_ctes(LABELLED, SUBJECTS, _STRATIFIED) + """
SELECT (SELECT count(*) FROM documents) AS n_docs, count(*) AS n_split_rows,
       count(DISTINCT doc_id) AS n_split_docs, 0::BIGINT AS n_on_both_sides,
       0::BIGINT AS n_missing FROM strat_rows""")
def split_disjoint_check(spark, sf_dir):
    """Every document is on exactly one side."""
    sides = _stratified(spark, sf_dir).groupBy("doc_id").agg(
        F.count("*").alias("n"), F.count_distinct("split").alias("n_sides")
    )
    both = documents(spark, sf_dir).select("doc_id").join(sides, "doc_id", "left")
    return both.agg(
        F.count("*").alias("n_docs"),
        F.sum("n").alias("n_split_rows"),
        F.count("n").alias("n_split_docs"),
        F.count_if(F.col("n_sides") > 1).alias("n_on_both_sides"),
        F.count_if(F.col("n").isNull()).alias("n_missing"),
    )


@query("sink_split_partitions", with_ctes(LABELLED, SUBJECTS, _STRATIFIED) + """
SELECT doc_id, length(text) AS n_chars, stratum AS label
FROM strat_rows JOIN documents USING (doc_id) WHERE split = 'val'""")
def sink_split_partitions(spark, sf_dir):
    """One partitioned write; the validation side is read back without the other's files."""
    path = fresh_path(spark, "split")
    sinks.write_split(_stratified(spark, sf_dir), path)
    return sinks.read_split(spark, path, "val").select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "label"
    )


@query("sink_sized_split", with_ctes(LABELLED, SUBJECTS, _STRATIFIED) + """
SELECT split, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars, true AS several_files,
       true AS files_in_limit
FROM strat_rows JOIN documents USING (doc_id) GROUP BY split""")
def sink_sized_split(spark, sf_dir):
    """Both sides in files of a stated size: what is read back of each, whether the larger one
    fills several files, and whether all files keep to the limit."""
    path, limit = fresh_path(spark, "sized-split"), 200_000
    sinks.write_split(_stratified(spark, sf_dir), path, file_bytes=limit)
    rows = sinks.read_split(spark, path).select(
        "split", "text", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
    )
    return rows.groupBy("split").agg(
        F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("n_chars"),
        ((F.col("split") == "val") | (F.count_distinct("file") > 1)).alias("several_files"),
        (F.max("size") <= 1.5 * limit).alias("files_in_limit"),
    )


@query("job_counts", with_ctes(LABELLED, SUBJECTS) + """
SELECT n_loaded, 0::BIGINT AS n_null_text, 0::BIGINT AS n_null_label, n_kept, n_labels,
       (n_kept - ceil(0.2 * n_kept))::BIGINT AS n_train, ceil(0.2 * n_kept)::BIGINT AS n_val
FROM (SELECT (SELECT count(*) FROM documents) AS n_loaded,
       (SELECT count(DISTINCT doc_id) FROM label_rows WHERE label IN ('es', 'fr', 'q')) AS n_kept,
       (SELECT count(*) FROM label_rows WHERE label IN ('es', 'fr', 'q')) AS n_labels)""")
def job_counts(spark, sf_dir):
    """What the split job tells of its stages, counted in the passes it makes anyhow."""
    clean = labelled(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.col("text").alias("text_clean"), "label"
    )
    told = jobs.split(clean, fresh_path(spark, "counted"), categories=("es", "fr", "q"))
    names = ["n_loaded", "n_null_text", "n_null_label", "n_kept", "n_labels", "n_train", "n_val"]
    return spark.createDataFrame([tuple(told[n] for n in names)],
                                 ", ".join(f"{n} long" for n in names))


@query("split_config", with_ctes(LABELLED, SUBJECTS, _STRATIFIED) + f"""
SELECT '{' '.join(reversed(CLASSES))}' AS categories, 'text_clean' AS text_col,
       'label' AS label_col, 42::BIGINT AS seed, 0.2::DOUBLE AS test_size,
       '{' '.join(CLASSES)}' AS classes, count(*) FILTER (split = 'train') AS train_samples,
       count(*) FILTER (split = 'val') AS val_samples, count(*) AS total_samples
FROM strat_rows""")
def split_config(spark, sf_dir):
    """The split's description as JSON, written and read back."""
    path = fresh_path(spark, "config")
    config = sinks.split_config(
        _stratified(spark, sf_dir), tuple(reversed(CLASSES)), CLASSES,
        text_col="text_clean", label_col="label", seed=42, test_size=0.2,
    )
    sinks.write_config(config, path)
    read = sinks.read_config(spark, path, sinks.SPLIT_CONFIG)
    return read.withColumn("categories", F.array_join("categories", " ")).withColumn(
        "classes", F.array_join("classes", " ")
    )


@query("train_config", with_ctes(_RANDOM) + f"""
SELECT 'knn' AS model_name, 'text_clean' AS text_col, 'label' AS label_col,
       '{' '.join(CLASSES)}' AS classes, count(*) FILTER (split = 'train') AS train_samples,
       count(*) FILTER (split = 'val') AS val_samples
FROM split_rows""")
def train_config(spark, sf_dir):
    path = fresh_path(spark, "train-config")
    split = splitting.split_random(documents(spark, sf_dir).select("doc_id"), "doc_id")
    config = sinks.train_config(split, "knn", CLASSES, text_col="text_clean", label_col="label")
    sinks.write_config(config, path)
    read = sinks.read_config(spark, path, sinks.TRAIN_CONFIG)
    return read.withColumn("classes", F.array_join("classes", " "))
