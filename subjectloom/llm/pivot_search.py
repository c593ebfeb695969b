"""Exact top-k search by inner product, with candidates ruled out through a table of pivots."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subjectloom.llm.common import table
from subjectloom.session import written

# Fixed values of the registered query: steps per unit, results per query, every 20th is a query.
STEPS = 64
TOP = 20
QUERY_EVERY = 20

PIVOTS = 32
#: What meets in a task: so many queries and so many candidates.
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 16_384
#: Candidates evaluated at first, in the order of their bounds; then twice as many, and so on.
FIRST = 256


def in_steps(vector: Column, steps: int = STEPS) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(steps))))


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null, infinite or no number."""
    limit = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < limit)
    )


def _matrix(column: pd.Series) -> np.ndarray:
    rows = column.to_list()
    return np.stack(rows).astype(np.int64) if rows else np.zeros((0, 0), np.int64)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    a, b = rows.astype(np.float64), pivots.astype(np.float64)
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0)).astype(np.float32)


def pivot_table(vectors: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """Adds ``dim``, ``square`` (the squared length) and ``far``, the distances to the pivots.

    Pivots are the different vectors with the smallest hashes; a vector is measured against
    those of its own length only, so ``far`` may be short, or empty for a rare length.
    """
    different = vectors.select("vector").distinct()
    chosen = different.orderBy(F.xxhash64("vector"), "vector").limit(pivots).toArrow()
    by_dim: dict[int, list[np.ndarray]] = {}
    for vector in chosen["vector"].to_pylist():
        by_dim.setdefault(len(vector), []).append(np.array(vector, np.int64))
    tables = {dim: np.stack(rows) for dim, rows in by_dim.items()}

    @F.pandas_udf("array<float>")
    def measure(column: pd.Series) -> pd.Series:
        out = np.empty(len(column), dtype=object)
        dims = column.map(len).to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            if dim in tables and dim > 0:
                far = _distances(_matrix(column.iloc[at]), tables[dim])
            else:
                far = np.zeros((len(at), 0), np.float32)
            for i, row in zip(at, far, strict=True):
                out[i] = row
        return pd.Series(out, dtype=object)

    square = F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
    )
    return vectors.withColumns(
        {"dim": F.size("vector"), "square": square, "far": measure("vector")}
    )


def _scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return (rows @ query).astype(np.int64)


def best_of_block(queries: pd.DataFrame, rows: pd.DataFrame, top: int) -> pd.DataFrame:
    """Each query's ``top`` best rows, found by going through them in order of their bounds.

    With p a pivot, ``|d(q, p) - d(x, p)| <= d(q, x)``; the largest over all pivots bounds the
    distance from below and so, with both lengths, the inner product from above. Rows are
    evaluated from the highest bound on; once the next bound is below the last place, all
    that follow are ruled out. Bounds are widened by more than their rounding errors.
    """
    q, x = _matrix(queries["vector"]), _matrix(rows["vector"])
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if largest < 2**53:
        q, x = q.astype(np.float64), x.astype(np.float64)
    far_q, far_x = np.stack(queries["far"].to_list()), np.stack(rows["far"].to_list())
    far_x = np.ascontiguousarray(far_x.T)
    q2, x2 = queries["square"].to_numpy(), rows["square"].to_numpy()
    ids, keys = rows["vec_id"].to_numpy(), rows["row_key"].to_numpy()
    own = queries["row_key"].to_numpy()
    slack = 1e-5 * float(max(far_q.max(initial=0), far_x.max(initial=0)))
    found = []
    for i in range(len(q)):
        apart = np.zeros(len(x), np.float32)
        for j in range(far_q.shape[1]):
            np.maximum(apart, np.abs(far_x[j] - far_q[i, j]), out=apart)
        near = np.maximum(apart - slack, 0).astype(np.float64)
        both = q2[i] + x2
        bound = (both - near * near) / 2 + 1e-9 * both + 1
        order = np.argsort(-bound)
        order = order[keys[order] != own[i]]
        best_score, best = np.empty(0, np.int64), np.empty(0, np.int64)
        at, step = 0, max(FIRST, top)
        while at < len(order):
            some = order[at : at + step]
            last = best_score[-1] if len(best_score) == top else None
            if last is not None:
                if bound[some[0]] < last:
                    break
                some = some[bound[some] >= last]
            score = _scores(q[i], x[some])
            if last is not None:
                some, score = some[score >= last], score[score >= last]
            score, some = np.append(best_score, score), np.append(best, some)
            keep = np.lexsort((keys[some], ids[some], -score))[:top]
            best_score, best = score[keep], some[keep]
            at, step = at + step, step * 2
        found.append(
            pd.DataFrame(
                {"query_key": own[i], "query_id": queries["vec_id"].iloc[i],
                 "vec_id": ids[best], "row_key": keys[best], "score": best_score}
            )
        )
    return pd.concat(found, ignore_index=True)


def top_k(
    vectors: DataFrame, id_col: str, vector_col: str, is_query: Column, top: int = TOP,
    steps: int = STEPS, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its ``top`` highest inner products
    of vectors in whole steps, ties to the smaller id; all candidates if there are fewer.

    Rows where ``is_query`` holds are the queries, every row but the query's own a candidate.
    Vectors that are null or hold null or non-finite components, and rows without an id, take
    no part. Vectors of different lengths are not compared. Rows with the same id are rows of
    their own, as are equal vectors; a query row that occurs twice gets two answers. Products
    beyond 64 bits wrap around. An empty table gives an empty result. Other columns may have any
    names, and ``is_query`` may speak of all of them.

    Queries and candidates are dealt into blocks of bounded size, by hash, so that equal
    vectors spread too; each block of the one meets each of the other in a task of its own,
    which hands on ``top`` rows per query.
    """
    vector = F.col(f"`{vector_col}`")
    # One projection of the caller's columns, so that no name of theirs can clash.
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row_key"),
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("vector", in_steps(F.col("vector"), steps))
    measured = written(pivot_table(rows, pivots), "pivot-table")
    size = measured.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("query").alias("queries")
    ).first()
    parts = -(-size["rows"] // candidate_block) or 1
    query_parts = -(-size["queries"] // query_block) or 1

    def dealt(frame: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        block = F.pmod(F.xxhash64("row_key"), F.lit(n)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        return frame.withColumn(own, block).withColumn(other, copies)

    left = dealt(measured.where("query"), "query_part", query_parts, "part", parts)
    right = dealt(measured, "part", parts, "query_part", query_parts)
    keys = ["dim", "query_part", "part"]

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame(columns=["query_key", "query_id", "vec_id", "row_key", "score"])
        return best_of_block(queries, candidates, top)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        meet, "query_key long, query_id long, vec_id long, row_key long, score long"
    )
    return _ranked(found, top).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` of the blocks' best. What a task has of a query is cut to ``top`` before it
    is sent on (Spark does so where a rank is filtered)."""
    order = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id", "row_key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def op4_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, "vec_id", "embedding", F.col("vec_id") % QUERY_EVERY == 0)


QUERIES = {"op4_pivot_search": op4_pivot_search}

SQL = {
    "op4_pivot_search": """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS steps
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_dot_product(q.steps, c.steps) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.steps) = len(c.steps)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, vec_id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
}
