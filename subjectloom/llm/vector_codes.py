"""Compression of vectors to codes: a small codebook per part, whose nearest entry is found by
slicing sorted coordinates and intersecting bit masks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectloom.llm.common import free_name, table
from subjectloom.llm.pivot_search import usable
from subjectloom.operators.lookup import lookup_join
from subjectloom.session import settled, written

# Fixed values of the registered query: steps per unit, parts, entries a part, rounds.
STEPS = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

#: Components beyond so many steps are refused, as squared distances would leave 64 bits.
LIMIT = 1 << 27
#: Vectors that are worked on at once.
BLOCK = 4096


class Book(NamedTuple):
    """The entries of one part, and for each dimension their coordinates in order with masks:
    bit e of ``masks[d, k]`` is set if entry e is among the k smallest coordinates."""

    entries: np.ndarray  # a row per entry
    ordered: np.ndarray  # a row per dimension
    masks: np.ndarray  # dimension, prefix length, word of 64 entries

    @classmethod
    def of(cls, entries: np.ndarray) -> Book:
        n, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable").T
        masks = np.zeros((dims, n + 1, -(-n // 64)), np.uint64)
        for d in range(dims):
            for k, e in enumerate(order[d]):
                masks[d, k + 1] = masks[d, k]
                masks[d, k + 1, e // 64] |= np.uint64(1) << np.uint64(e % 64)
        return cls(entries, np.take_along_axis(entries.T, order, axis=1), masks)

    def _first(self, rows: np.ndarray) -> np.ndarray:
        """An entry for each row: the nearest by the dimension in which entries differ most."""
        if not rows.shape[1]:
            return np.zeros(len(rows), np.int64)
        d = int(np.argmax(self.ordered[:, -1] - self.ordered[:, 0]))
        by_value = np.argsort(self.entries[:, d], kind="stable")
        line, x = self.ordered[d], rows[:, d]
        right = np.clip(np.searchsorted(line, x), 0, len(line) - 1)
        left = np.maximum(right - 1, 0)
        return by_value[np.where(np.abs(line[left] - x) <= np.abs(line[right] - x), left, right)]

    def candidates(self, rows: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each row the mask of the entries that no dimension puts further off than its
        radius: those between two places in each dimension's order, intersected."""
        words = self.masks.shape[2]
        found = np.full((len(rows), words), ~np.uint64(0))
        for d in range(rows.shape[1]):
            low = np.searchsorted(self.ordered[d], rows[:, d] - radius, "left")
            high = np.searchsorted(self.ordered[d], rows[:, d] + radius, "right")
            found &= self.masks[d, high] ^ self.masks[d, low]
        return found

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry, ties to the lower index, and the squared distance.

        The distance to some entry is the radius; whatever is as near or nearer lies within it
        in every dimension, so it is among the candidates, all of which are then measured.
        """
        best = self._first(rows)
        apart = ((rows - self.entries[best]) ** 2).sum(axis=1)
        radius = np.ceil(np.sqrt(apart.astype(np.float64))).astype(np.int64) + 1
        masks = self.candidates(rows, radius)
        for e in range(len(self.entries)):
            bit = masks[:, e // 64] >> np.uint64(e % 64) & np.uint64(1)
            at = np.flatnonzero(bit.astype(bool) & (best != e))
            if not len(at):
                continue
            other = ((rows[at] - self.entries[e]) ** 2).sum(axis=1)
            better = (other < apart[at]) | ((other == apart[at]) & (e < best[at]))
            best[at[better]], apart[at[better]] = e, other[better]
        return best, apart


def _steps(column: pa.Array, steps: int, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * float(steps))
    if len(whole) and np.abs(whole).max() >= LIMIT:
        raise ValueError(f"components beyond {LIMIT // steps} are not coded")
    if len(column) * length != len(whole) or (len(column) and _lengths(column) != {length}):
        raise ValueError("vectors differ in length")
    return whole.astype(np.int64).reshape(len(column), length)


def _lengths(column: pa.Array) -> set[int]:
    return set(np.unique(np.asarray(column.value_lengths())).tolist())


def _books(entries: np.ndarray, parts: int) -> list[Book]:
    """A book per part of ``entries``, whole vectors one under the other."""
    return [Book.of(np.ascontiguousarray(e)) for e in np.split(entries, parts, axis=1)]


def encode(rows: np.ndarray, books: list[Book]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (a column per part) and squared distances summed over parts."""
    codes = np.empty((len(rows), len(books)), np.int64)
    apart = np.zeros(len(rows), np.int64)
    for p, part in enumerate(np.split(rows, len(books), axis=1)):
        codes[:, p], own = books[p].nearest(part)
        apart += own
    return codes, apart


def _sums(vectors: DataFrame, entries: np.ndarray, steps: int, parts: int) -> DataFrame:
    """``(part, entry, n, sums)``: how many parts have which entry, and their sums."""
    length = entries.shape[1]
    width = length // parts

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(entries, parts)
        total = np.zeros((parts, len(entries), width), np.int64)
        count = np.zeros((parts, len(entries)), np.int64)
        for batch in batches:
            column = batch.column("vector")
            for at in range(0, len(column), BLOCK):
                rows = _steps(column.slice(at, BLOCK), steps, length)
                codes, _ = encode(rows, books)
                for p, part in enumerate(np.split(rows, parts, axis=1)):
                    np.add.at(total[p], codes[:, p], part)
                    count[p] += np.bincount(codes[:, p], minlength=len(entries))
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)),
             pa.array(count[part, entry]),
             pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    added = vectors.select("vector").mapInArrow(
        add, "part int, entry int, n long, sums array<long>"
    )
    return added.groupBy("part", "entry").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("sums")[d]) for d in range(width)]).cast("array<long>").alias("sums"),
    )


def train(
    vectors: DataFrame, id_col: str, vector_col: str, parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, steps: int = STEPS,
) -> np.ndarray | None:
    """The codebooks after so many rounds: row e holds entry e of all parts, one part after the
    other. None if there is no vector to learn from.

    They begin as the vectors of the smallest ids (null ids last; of equal ids the smaller
    vector, component by component). In each round every part goes to its nearest entry, ties to
    the lower index, and each entry becomes the floor of the mean of its parts; an entry
    without parts stays. Vectors that are null or hold null or non-finite components take no
    part; repeated rows count as often as they occur. All vectors must be of one length that
    ``parts`` divides, and within ``LIMIT`` steps, else ValueError.

    A round is one pass over the vectors. What tasks hand on are sums per part and entry.
    """
    rows = _usable_rows(vectors, id_col, vector_col)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries)
    first = first.select("vector").toArrow()
    if not first.num_rows:
        return None
    column = first["vector"].combine_chunks()
    length = len(column[0])
    if length % parts:
        raise ValueError(f"vectors of length {length} have no {parts} equal parts")
    book = _steps(column, steps, length)
    width = length // parts
    for _ in range(rounds):
        for row in _sums(rows, book, steps, parts).toArrow().to_pylist():
            at = slice(row["part"] * width, (row["part"] + 1) * width)
            book[row["entry"], at] = np.floor_divide(np.array(row["sums"], np.int64), row["n"])
    return book


def _usable_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(f"`{vector_col}`")
    return vectors.where(usable(vector)).select(
        F.col(f"`{id_col}`").alias("id"), vector.alias("vector")
    )


def compress(
    vectors: DataFrame, vector_col: str, book: np.ndarray, parts: int = PARTS, steps: int = STEPS,
    code: str = "code", error: str = "error",
) -> DataFrame:
    """The rows with a usable vector, with ``code`` (the nearest entry of each part as two hex
    digits, more beyond 256 entries) and ``error`` (their squared distances summed) in place of
    columns of those names. The other columns stay."""
    length = book.shape[1]
    digits = max(2, -(-(len(book) - 1).bit_length() // 4))
    names = np.array([f"{e:0{digits}x}" for e in range(len(book))])
    kept = [c for c in vectors.columns if c not in (code, error)]
    vector = F.col(f"`{vector_col}`")
    own = free_name(vectors, "vector")
    rows = vectors.where(usable(vector)).select(
        *[F.col(f"`{c}`") for c in kept], vector.alias(own)
    )
    schema = rows.drop(own).schema.add(code, "string").add(error, "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(book, parts)
        for batch in batches:
            column = batch.column(own)
            codes, apart = [], []
            for at in range(0, len(column), BLOCK):
                found, far = encode(_steps(column.slice(at, BLOCK), steps, length), books)
                codes += ["".join(row) for row in names[found]]
                apart.append(far)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(codes, pa.string()),
                 pa.array(np.concatenate(apart) if apart else [], pa.int64())],
                names=[*kept, code, error],
            )

    return rows.mapInArrow(work, schema)


def decompress(codes: Column, book: np.ndarray, parts: int = PARTS, steps: int = STEPS) -> Column:
    """The vectors that codes stand for: the entries' components, in units."""
    width = book.shape[1] // parts
    digits = max(2, -(-(len(book) - 1).bit_length() // 4))
    pieces = []
    for p in range(parts):
        part = F.array(*[
            F.array(*[F.lit(float(x) / steps) for x in row[p * width : (p + 1) * width]])
            for row in book
        ])
        entry = F.conv(F.substring(codes, p * digits + 1, digits), 16, 10).cast("int")
        pieces.append(F.element_at(part, entry + 1))
    return F.concat(*pieces)


def books_sha256(book: np.ndarray, parts: int = PARTS) -> str:
    """Of all components in decimals, by part, entry and place, joined by commas."""
    numbers = [str(x) for part in np.split(book, parts, axis=1) for x in part.ravel().tolist()]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    book = train(vectors, "vec_id", "embedding")
    if book is None:
        empty = vectors.where(F.lit(False))
        none = F.lit(None)
        return empty.select(
            "vec_id", none.cast("string").alias("code"), none.cast("long").alias("error"),
            none.cast("long").alias("label_error"),
            none.cast("string").alias("codebooks_sha256"),
        )
    coded = written(compress(vectors, "embedding", book).drop("embedding"), "vector-codes")
    # A null label is a key of its own.
    coded = coded.withColumns(
        {"no_label": F.col("label").isNull(), "label": F.coalesce("label", F.lit(0))}
    )
    keys = ["no_label", "label"]
    sums = settled(coded.groupBy(*keys).agg(F.sum("error").alias("label_error")))
    return lookup_join(coded, sums, keys, "vec_id").select(
        "vec_id", "code", "error", "label_error",
        F.lit(books_sha256(book)).alias("codebooks_sha256"),
    )


QUERIES = {"op13_vector_codes": op13_vector_codes}


def _sql(rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> str:
    """The rounds written out one after the other."""
    squared = (
        "list_sum(list_transform(list_zip(r.v, b.v), "
        "lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS BIGINT)))"
    )
    steps = [f"""
WITH kept AS (
    SELECT row_number() OVER () AS k, vec_id, label, list_transform(embedding,
        lambda x: CAST(floor({STEPS} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
    SELECT k, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v
    FROM kept, range({parts}) AS parts(p)
), first AS (
    SELECT k, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept
), book0 AS MATERIALIZED (
    SELECT p, e, v FROM part JOIN first USING (k) WHERE e < {entries}
)"""]
    for i in range(rounds + 1):
        steps.append(f""", coded{i} AS MATERIALIZED (
    SELECT k, p, min(struct_pack(far := far, e := e)) AS best FROM (
        SELECT r.k, r.p, b.e, {squared} AS far FROM part r JOIN book{i} b ON r.p = b.p
    ) GROUP BY k, p
)""")
        if i < rounds:
            steps.append(f""", moved{i} AS (
    SELECT p, e, list(x ORDER BY d) AS v FROM (
        SELECT p, e, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
            SELECT r.p, c.best.e AS e, d, CAST(sum(r.v[d]) AS BIGINT) AS s, count(*) AS n
            FROM part r JOIN coded{i} c ON r.k = c.k AND r.p = c.p,
                unnest(range(1, len(r.v) + 1)) AS places(d)
            GROUP BY r.p, c.best.e, d))
    GROUP BY p, e
), book{i + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.v, b.v) AS v
    FROM book{i} b LEFT JOIN moved{i} m ON b.p = m.p AND b.e = m.e
)""")
    steps.append(f""", row_codes AS (
    SELECT k, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code,
        CAST(sum(best.far) AS BIGINT) AS error
    FROM coded{rounds} GROUP BY k
), hashed AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256
    FROM book{rounds}
)
SELECT vec_id, code, error,
    CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN row_codes USING (k) CROSS JOIN hashed
""")
    return "".join(steps)


SQL = {"op13_vector_codes": _sql()}
