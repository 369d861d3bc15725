"""Splits that follow the key of a row, not its position or partition."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.quantiles import TASK_VALUES, order_statistics

# 13 hexadecimal digits: the longest prefix that a double holds without loss.
HASH_DIGITS = 13
HASH_RANGE = 16 ** HASH_DIGITS
MAX_TIES = 10_000


def key_hash(key: str, seed: int | str) -> Column:
    """Even whole number below ``HASH_RANGE`` from the key and the seed."""
    text = F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def in_test_sample(
    df: DataFrame, key: str, ratio: float = 0.2, seed: int = 42, exact: bool = False,
    task_values: int = TASK_VALUES,
) -> Column:
    """Whether a row belongs to the test sample, from the hash of its unique key.

    By default a fixed threshold gives about ``ratio`` test rows, and a row stays on its
    side when others come or go. ``exact`` finds the threshold that gives
    ``ceil(ratio * n)`` test rows. No row moves either way.
    """
    if not 0 < ratio < 1:
        raise ValueError("ratio must be between 0 and 1")
    if exact:
        return exact_test_side(df, key, ratio, seed, task_values)
    return key_hash(key, seed) < F.lit(int(ratio * HASH_RANGE))


def train_test(
    df: DataFrame, key: str, ratio: float = 0.2, seed: int = 42, exact: bool = False,
    task_values: int = TASK_VALUES,
) -> tuple[DataFrame, DataFrame]:
    """Train and test sample as two filters of the same rows."""
    is_test = in_test_sample(df, key, ratio, seed, exact, task_values)
    return df.filter(~is_test), df.filter(is_test)


def write_sides(df: DataFrame, is_test: Column, path: str) -> None:
    """Store both samples in one pass over the rows, as partitions ``side=train`` and ``side=test``."""
    side = F.when(is_test, "test").otherwise("train")
    df.withColumn("side", side).write.mode("overwrite").partitionBy("side").parquet(path)


def read_side(spark: SparkSession, path: str, side: str) -> DataFrame:
    """One stored sample; the files of the other are not read."""
    return spark.read.parquet(path).filter(F.col("side") == side).drop("side")


def exact_test_side(
    df: DataFrame, key: str, ratio: float, seed: int, task_values: int = TASK_VALUES,
) -> Column:
    """The rows with the smallest hashes, ``ceil(ratio * n)`` of them, found by two passes over the key.

    The first counts. Hashes are even, so the last one wanted lies within a few deviations of its expected place; the
    second counts what is below and brings the few times root n hashes around it. Where they are
    too many, not distinct, or do not hold it, the hashes are searched as any exact quantile is.
    """
    hashed = df.select(F.col(key), key_hash(key, seed).alias("__hash"))
    n = hashed.count()
    wanted = math.ceil(ratio * n)
    if n == 0:
        return F.lit(False)
    # The hashes are even, so the cut lies within a few deviations of its expected place.
    centre, reach = ratio * HASH_RANGE, 6.0 * math.sqrt(ratio * (1.0 - ratio) / n) * HASH_RANGE
    h = key_hash(key, seed)
    if n * 2.0 * reach / HASH_RANGE <= task_values:
        inside = F.col("__hash").between(int(centre - reach), int(centre + reach))
        pair = F.when(inside, F.struct(F.col("__hash").alias("hash"), F.col(key).alias("key")))
        found = hashed.agg(F.count_if(F.col("__hash") < int(centre - reach)).alias("below"), F.count_if(inside).alias("inside"),
                           F.sort_array(F.collect_set(pair)).alias("near")).first()
        last = wanted - 1 - found["below"]
        if 0 <= last < len(found["near"]) == found["inside"]:
            cut, key_at_cut = found["near"][last]
            return (h < F.lit(cut)) | ((h == F.lit(cut)) & (F.col(key) <= F.lit(key_at_cut)))
    near = {("__hash", wanted - 1): (centre - reach, centre + reach)}
    cut = int(order_statistics(
        hashed.select("__hash"), {"__hash": [wanted - 1]}, {"__hash": n}, task_values,
        near)["__hash", wanted - 1])
    row = hashed.agg(F.count_if(F.col("__hash") < cut).alias("below"),
                     F.count_if(F.col("__hash") == cut).alias("tied")).first()
    take = wanted - row["below"]
    if take == row["tied"]:
        return h <= F.lit(cut)
    if row["tied"] > MAX_TIES:
        raise ValueError(f"column {key!r} is not a unique key")
    # Different keys can share a hash; the smaller keys go first.
    tied = sorted(r[key] for r in hashed.filter(F.col("__hash") == cut).select(key).collect())
    if tied[take - 1] == tied[take]:
        raise ValueError(f"column {key!r} is not a unique key")
    return (h < F.lit(cut)) | ((h == F.lit(cut)) & (F.col(key) <= F.lit(tied[take - 1])))


def add_fold(df: DataFrame, key: str, k: int = 5, col: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from the key, for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(col, F.pmod(key_hash(key, "fold"), F.lit(k)).cast("int"))


def add_contiguous_fold(df: DataFrame, key: str, k: int = 5, col: str = "fold", task_values: int = TASK_VALUES) -> DataFrame:
    """Fold number 0..k-1 of blocks of neighbouring keys, whose sizes differ by one at most; the first are the larger.

    The keys are unique whole or floating numbers. The first key of each block is found by counting, as
    exact quantiles are, so no row is sorted or moved. Nulls in the key, and keys that occur twice at an edge, are errors.
    """
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("keys")).first()
    n = counts["n"]
    if counts["keys"] < n:
        raise ValueError(f"column {key!r} has nulls")
    firsts = [fold * (n // k) + min(fold, n % k) for fold in range(1, k)]
    ranks = [rank for rank in firsts if rank < n]
    found = order_statistics(df, {key: ranks}, {key: n}, task_values) if ranks else {}
    edges = [found[key, rank] for rank in ranks]
    number = F.col(key).cast("double")
    if edges:
        below = df.agg(*[F.count_if(number < edge).alias(f"b{i}") for i, edge in enumerate(edges)]).first()
        if list(below) != ranks:
            raise ValueError(f"column {key!r} is not a unique key")
    fold = sum((F.when(number >= edge, 1).otherwise(0) for edge in edges), F.lit(0))
    return df.withColumn(col, fold.cast("int"))
