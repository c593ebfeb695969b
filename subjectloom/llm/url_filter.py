"""URL filters: rules on host and path, and boosted trees on the look of a URL for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.llm.common import free_name, table
from subjectloom.operators.lookup import lookup_join
from subjectloom.session import settled


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}/{self.path}"


# The rules of the registered query.
RULES = (
    Rule("org", "", "allow"),
    Rule("example.org", "es/", "block"),
    Rule("example.org", "en/1", "block"),
    Rule("com", "fr/", "allow"),
    Rule("com", "de/", "block"),
)

MAX_LABELLED = 50_000
TREES = 10
DEPTH = 4
#: Weight of the overall block rate in a suffix's own rate, in rows.
PRIOR_ROWS = 20.0

FEATURES = (
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio",
    "letter_ratio", "entropy", "parameters", "query_length", "has_fragment", "hyphens",
    "longest_part", "suffix_rate", "suffix_seen", "ending_rate", "ending_seen",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``(text, verdict)`` of the longest rule that fits, null if none does.

    A rule fits its host and all subdomains if the path starts with ``/`` and the rule's path.
    Longest: by host and path together; of equally long ones the first listed.
    """
    best = F.lit(None).cast("struct<text:string,verdict:string>")
    for _, rule in sorted(enumerate(rules), key=lambda r: (len(r[1].text), -r[0])):
        at_host = (host == rule.host) | host.endswith(f".{rule.host}")
        fits = at_host & path.startswith(f"/{rule.path}")
        best = F.when(
            fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(best)
    return best


def _entropy(text: Column) -> Column:
    """Bits per character, from the lengths of the runs of the sorted characters."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    total = F.size(chars).cast("double")
    parts = F.transform(
        F.array_distinct(chars),
        lambda c: (lambda n: -(n / total) * F.log2(n / total))(
            (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double")
        ),
    )
    return F.when(
        total > 0, F.aggregate(F.array_sort(parts), F.lit(0.0), lambda a, x: a + x)
    ).otherwise(0.0)


def lexical(df: DataFrame, url_col: str) -> DataFrame:
    """Adds ``_suffix``, ``_ending`` and the lexical features of a URL; a null URL counts as ''."""
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    length = F.greatest(F.length(url), F.lit(1)).cast("double")
    parts = F.filter(F.split(F.concat_ws("/", host, path), r"[./]"), lambda p: p != "")

    def count(pattern: str) -> Column:
        return F.regexp_count(url, F.lit(pattern)).cast("double")

    values = {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "host_depth": F.regexp_count(host, F.lit(r"[^.]+")).cast("double"),
        "path_depth": F.regexp_count(path, F.lit(r"[^/]+")).cast("double"),
        "digit_ratio": count("[0-9]") / length,
        "letter_ratio": count("[A-Za-z]") / length,
        "entropy": _entropy(url),
        "parameters": F.regexp_count(query, F.lit("[^&]+")).cast("double"),
        "query_length": F.length(query).cast("double"),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "hyphens": F.regexp_count(host, F.lit("-")).cast("double"),
        "longest_part": F.coalesce(
            F.array_max(F.transform(parts, F.length)), F.lit(0)
        ).cast("double"),
    }
    return df.withColumns(
        {
            **values,
            "_suffix": F.regexp_extract(host, r"([^.]*)$", 1),
            "_ending": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
        }
    )


class UrlModel(NamedTuple):
    trees: GBTClassificationModel | None
    rate: float
    suffixes: DataFrame
    endings: DataFrame

    def score(self, df: DataFrame, url_col: str, out: str) -> DataFrame:
        """Adds ``out``, the probability that a URL is to be blocked; the rest stays."""
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != out]).alias("row")
        joined = lexical(
            df.select(
                whole, F.col(f"`{url_col}`").alias("url"),
                F.monotonically_increasing_id().alias("spread"),
            ),
            "url",
        )
        for column, stats in (("_suffix", self.suffixes), ("_ending", self.endings)):
            joined = lookup_join(joined, stats, [column], "spread")
        joined = joined.fillna(
            {"suffix_rate": self.rate, "ending_rate": self.rate, "suffix_seen": 0.0,
             "ending_seen": 0.0}
        )
        if self.trees is None:
            return joined.select("row.*", F.lit(self.rate).alias(out))
        assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        return self.trees.transform(assembled.transform(joined)).select(
            "row.*", vector_to_array("probability")[1].alias(out)
        )


def _suffix_rates(labelled: DataFrame, column: str, rate: float, stem: str) -> DataFrame:
    seen = F.count(F.lit(1)).cast("double")
    share = (F.sum("label") + PRIOR_ROWS * rate) / (seen + PRIOR_ROWS)
    return settled(
        labelled.groupBy(column).agg(
            share.alias(f"{stem}_rate"), F.log1p(seen).alias(f"{stem}_seen")
        )
    )


def fit(
    labelled: DataFrame, url_col: str, label_col: str, max_rows: int = MAX_LABELLED,
    trees: int = TREES, depth: int = DEPTH, seed: int = 42,
) -> UrlModel:
    """Boosted trees that tell URLs to block (label 1) from URLs to keep (0).

    Suffix statistics (the host's last label, the path's file ending: how often seen, how often
    blocked, drawn towards the overall rate) are counted over all labelled rows. The trees learn
    from at most ``max_rows`` different URLs, those with the smallest hash. Rows without label
    are left out; with no rows, or rows of one class only, every URL scores the overall rate
    (0 without rows).
    """
    rows = lexical(
        labelled.where(F.col(f"`{label_col}`").isNotNull()).select(
            F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"),
            F.col(f"`{label_col}`").cast("double").alias("label"),
        ),
        "url",
    )
    total = rows.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("label"), F.lit(0.0)).alias("rate")
    ).first()
    rate = float(total["rate"])
    suffixes = _suffix_rates(rows, "_suffix", rate, "suffix")
    endings = _suffix_rates(rows, "_ending", rate, "ending")
    if rate in (0.0, 1.0):
        return UrlModel(None, rate, suffixes, endings)
    different = rows.select("url", "label").distinct()
    sample = lexical(
        settled(different.orderBy(F.xxhash64("url"), "url", "label").limit(max_rows)), "url"
    )
    sample = lookup_join(sample, suffixes, ["_suffix"], "url")
    sample = lookup_join(sample, endings, ["_ending"], "url")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    model = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, seed=seed
    ).fit(settled(vectors.select("features", "label")))
    return UrlModel(model, rate, suffixes, endings)


def judge(
    pages: DataFrame, url_col: str, rules: Sequence[Rule], labelled: DataFrame | None = None,
    label_col: str = "label", threshold: float = 0.5,
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``block_score`` and ``verdict`` to ``pages``, in place
    of columns of those names.

    The verdict is the longest fitting rule's, else ``block`` where the trees' score reaches the
    threshold. ``labelled`` are the URLs to learn from; without it, the URLs of ``pages`` that a
    rule decides, with the rule's verdict as their label. A null URL has an empty host and path,
    no rule, and is scored as the empty text. Repeated URLs are judged alike.
    """
    url = F.col(f"`{url_col}`").cast("string")
    if labelled is None:
        label_col = "label"
        decided = matched_rule(host_of(url), path_of(url), rules)
        labelled = pages.select(
            url.alias("url"), (decided["verdict"] == "block").cast("double").alias("label")
        )
        model = fit(labelled, "url", label_col)
    else:
        model = fit(labelled, url_col, label_col)
    scored = model.score(pages, url_col, "block_score")
    decided = free_name(scored, "decided")
    return (
        scored.withColumns({"host": host_of(url), "path": path_of(url)})
        .withColumn(decided, matched_rule(F.col("host"), F.col("path"), rules))
        .withColumn("rule", F.col(decided)["text"])
        .withColumn(
            "verdict",
            F.coalesce(
                F.col(decided)["verdict"],
                F.when(F.col("block_score") >= threshold, "block").otherwise("allow"),
            ),
        )
        .drop(decided)
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, "url", RULES).select(
        "page_id", "host", "path", "rule", "verdict", "block_score"
    )


QUERIES = {"op6_url_filter": op6_url_filter}
