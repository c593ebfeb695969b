"""Train / validation splits: random, by hash range, and stratified by label set."""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subjectloom.operators.lookup import lookup_join
from subjectloom.operators.sampling import cuts, hash_share, histogram, lowest, within_cut
from subjectloom.session import settled, written

# Split defaults.
TEST_SIZE = 0.2
SEED = 42
#: Different label sets that the driver balances one by one.
MAX_SETS = 200_000


def _named(is_val) -> F.Column:
    return F.when(is_val, F.lit("val")).otherwise(F.lit("train"))


def split_random(
    df: DataFrame, id_col: str, test_size: float = TEST_SIZE, seed: int = SEED
) -> DataFrame:
    """Adds ``split``; exactly ``ceil(test_size * n)`` rows are ``val``."""
    total = df.count()
    n_val = math.ceil(test_size * total)
    return df.withColumn("split", _named(lowest(df, id_col, n_val, seed)))


def split_by_hash(
    df: DataFrame, id_col: str, test_size: float = TEST_SIZE, seed: int = SEED
) -> DataFrame:
    """Adds ``split`` by hash range: the share is approximate, nothing is counted or moved."""
    return df.withColumn("split", _named(hash_share(id_col, test_size, seed)))


def quotas_by_remainder(strata: DataFrame, test_size: float, seed: int) -> DataFrame:
    """``(stratum, n)`` to ``(stratum, quota)`` by largest remainder, ties by hash.

    A remainder depends on the stratum's size alone, so sizes are ranked and not strata:
    different sizes that add up to N rows number fewer than the root of 2 N. Only strata of
    the one size at the edge are told apart, by an exact hash cut.
    """
    share = F.col("n") * test_size
    whole, part = F.floor(share), share - F.floor(share)
    sizes = settled(strata.groupBy("n").agg(F.count("*").alias("strata")))
    totals = sizes.agg(
        F.sum(F.col("n") * F.col("strata")).alias("rows"),
        F.sum(whole * F.col("strata")).alias("given"),
    ).first()
    extra = math.ceil(test_size * (totals["rows"] or 0)) - (totals["given"] or 0)
    upto = F.sum("strata").over(Window.orderBy(part.desc(), "n"))
    ranked = settled(sizes.select("n", "strata", upto.alias("upto"), part.alias("part")))
    edge = ranked.where((F.col("upto") >= extra) & (F.col("upto") - F.col("strata") < extra)).first()
    if extra <= 0 or edge is None:
        return strata.select("stratum", whole.cast("long").alias("quota"))
    at_edge = strata.where(F.col("n") == edge["n"])
    rest = extra - (edge["upto"] - edge["strata"])
    better = (part > edge["part"]) | ((part == edge["part"]) & (F.col("n") < edge["n"]))
    chosen = better | ((F.col("n") == edge["n"]) & lowest(at_edge, "stratum", rest, seed))
    return strata.select("stratum", (whole + chosen.cast("int")).cast("long").alias("quota"))


def _by_quota(
    df: DataFrame, id_col: str, seed: int, stratum: F.Column, counts: DataFrame, quotas: DataFrame
) -> DataFrame:
    """Adds ``split``: of each stratum, as many rows of lowest hash are ``val`` as its quota."""
    name, cut_hash, cut_id = "_stratum", "cut_hash", "cut_id"
    found = settled(cuts(df, counts, quotas, id_col, seed, stratum)).withColumnRenamed(
        "stratum", name
    )
    joined = lookup_join(df.withColumn(name, stratum), found, [name], spread_by=id_col)
    is_val = F.coalesce(within_cut(id_col, seed, F.col(cut_hash), F.col(cut_id)), F.lit(False))
    return joined.withColumn("split", _named(is_val)).drop(name, cut_hash, cut_id)


def split_stratified(
    df: DataFrame,
    id_col: str,
    labels_col: str,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``split`` so that every label set gives its share of the validation rows.

    Counting, quotas and cuts work on ids and label sets; the documents themselves are only
    joined to the table of cuts, one row per label set. ``split_balanced`` looks at labels.
    """
    stratum = F.array_join(F.col(labels_col), " ")
    counts = histogram(df, id_col, seed, stratum)
    strata = counts.groupBy("stratum").agg(F.sum("n").alias("n"))
    quotas = quotas_by_remainder(strata, test_size, seed)
    return _by_quota(df, id_col, seed, stratum, counts, quotas)


def balanced_quotas(
    sets: Sequence[tuple[Sequence[str], int]], test_size: float, enough: int | None = None
) -> list[int]:
    """How many rows of each label set go to the validation side, so that labels keep their
    shares: iterative stratification on counts.

    Each set gives its share rounded down or up. Labels are taken from the rarest on; while one
    lacks half a row or more of its share, the sets that hold it and have not been rounded up
    are, those first whose labels lack most together. Then sets are rounded up, or down again,
    until the side has its size, in the order of what their labels lack; but no label that has
    ``enough`` rows (``1 / test_size`` of them) is left without one, be the side a little larger.
    """
    enough = math.ceil(1 / test_size) if enough is None else enough
    share = [test_size * n for _, n in sets]
    quota = [math.floor(s + 1e-9) for s in share]
    raisable = [s - q > 1e-9 for s, q in zip(share, quota, strict=True)]
    holders: dict[str, list[int]] = {}
    total, given = Counter(), Counter()
    for i, (labels, n) in enumerate(sets):
        for label in set(labels):
            holders.setdefault(label, []).append(i)
            total[label] += n
            given[label] += quota[i]
    raised: set[int] = set()

    def lacks(i: int) -> float:
        labels = set(sets[i][0])
        return sum(test_size * total[x] - given[x] for x in labels) / max(len(labels), 1)

    def turn(i: int, by: int) -> None:
        quota[i] += by
        (raised.add if by > 0 else raised.discard)(i)
        for label in set(sets[i][0]):
            given[label] += by

    for label in sorted(total, key=lambda x: (total[x], x)):
        able = [i for i in holders[label] if raisable[i] and i not in raised]
        for i in sorted(able, key=lambda i: (-lacks(i), i)):
            if test_size * total[label] - given[label] < 0.5:
                break
            turn(i, 1)
    wanted = math.ceil(test_size * sum(n for _, n in sets) - 1e-9)
    missing = wanted - sum(quota)
    able = [i for i in range(len(sets)) if raisable[i] and i not in raised]
    for i in sorted(able, key=lambda i: (-lacks(i), i))[: max(missing, 0)]:
        turn(i, 1)
    for i in sorted(raised, key=lambda i: (lacks(i), i)):
        if sum(quota) <= wanted:
            break
        if all(given[x] > 1 or total[x] < enough for x in set(sets[i][0])):
            turn(i, -1)
    return quota


def split_balanced(
    df: DataFrame,
    id_col: str,
    labels_col: str,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    max_sets: int = MAX_SETS,
) -> DataFrame:
    """Adds ``split`` so that every label keeps its share of the validation rows, also labels
    of rare label sets only: see ``balanced_quotas``. Which rows of a set are taken follows from
    their hashes.

    Label sets with their counts are balanced on the driver. Where there are more than
    ``max_sets`` different ones, rows are grouped by their rarest label instead, which
    keeps that label's share; there are no more such groups than labels.
    """
    labels = F.array_sort(F.array_distinct(F.col(labels_col)))
    stratum = F.coalesce(F.to_json(F.transform(labels, lambda x: x.cast("string"))), F.lit("[]"))
    if df.select(stratum.alias("s")).distinct().limit(max_sets + 1).count() > max_sets:
        known = settled(df.select(F.explode(labels).alias("label")).groupBy("label").count())
        order = F.array_sort(F.collect_list(F.struct("count", "label")))
        rarest = df.select(id_col, F.explode(labels).alias("label"))
        rarest = lookup_join(rarest, known, ["label"], spread_by=id_col).groupBy(id_col).agg(
            F.get(order, F.lit(0))["label"].alias("_rarest")
        )
        wide = df.join(written(rarest, "rarest"), id_col, "left")
        stratum = F.to_json(F.array(F.coalesce(F.col("_rarest").cast("string"), F.lit(""))))
        return _balanced(wide, id_col, stratum, test_size, seed).drop("_rarest")
    return _balanced(df, id_col, stratum, test_size, seed)


def _balanced(
    df: DataFrame, id_col: str, stratum: F.Column, test_size: float, seed: int
) -> DataFrame:
    counts = histogram(df, id_col, seed, stratum)
    strata = counts.groupBy("stratum").agg(F.sum("n").alias("n")).orderBy("stratum").collect()
    quotas = balanced_quotas([(json.loads(r["stratum"]), r["n"]) for r in strata], test_size)
    table = df.sparkSession.createDataFrame(
        [(r["stratum"], q) for r, q in zip(strata, quotas, strict=True)],
        "stratum string, quota long",
    )
    return _by_quota(df, id_col, seed, stratum, counts, table)


def split_summary(df: DataFrame) -> DataFrame:
    """One row: train, validation and total counts, in one pass."""
    return df.agg(
        F.count_if(F.col("split") == "train").alias("train_samples"),
        F.count_if(F.col("split") == "val").alias("val_samples"),
        F.count("*").alias("total_samples"),
    )
