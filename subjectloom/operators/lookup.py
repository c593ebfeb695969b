"""Joining a large frame to a lookup table whose keys are unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: Rows of one key that may meet in a task; a key with more of them is dealt over several.
ROWS_PER_TASK = 1_000_000


def row_bytes(table: DataFrame) -> Column:
    parts = [F.lit(16)]
    for field in table.schema.fields:
        if isinstance(field.dataType, T.StringType):
            parts.append(F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16))
        else:
            parts.append(F.lit(16))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def within_limits(rows: int, size: int | None) -> bool:
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def fits_broadcast(table: DataFrame) -> bool:
    """Measured, not guessed: true when the table is under both broadcast limits."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in table.schema):
        return False
    size = table.agg(F.count("*").alias("rows"), F.sum(row_bytes(table)).alias("bytes")).first()
    return within_limits(size["rows"], size["bytes"])


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    how: str = "left",
) -> DataFrame:
    """Join ``rows`` to ``table`` on ``keys``, which are unique in ``table``.

    The table is broadcast when its measured size allows. Otherwise both sides are shuffled on
    the keys. If the most frequent key has more than ``ROWS_PER_TASK`` rows, a salt taken from
    ``spread_by`` deals each key over as many tasks as that one needs. Pass a table that has been
    settled: it is measured first and joined afterwards.
    """
    keys = list(keys)
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), keys, how)
    most = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    salts = -(-(most or 0) // ROWS_PER_TASK)
    if salts <= 1:
        return rows.join(table, keys, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
