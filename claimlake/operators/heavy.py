"""Counts of heavy keys, stored with a fact set and read by the jobs that join it.

A batch of rows is counted once, when it is stored: per hash bucket of the key first, combined
before the shuffle, and per key only inside buckets that may hold a heavy one. What is stored are
the keys with at least ``least`` rows in the batch. Counts of several batches are added up, so a
key is undercounted by less than ``least`` rows for each batch; it only decides how many tasks
share the key's rows, never which rows are joined.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.operators.joins import HEAVY_ROWS, HeavyKeys, key_bucket, split_count

#: A batch lists keys from this share of a task's rows on.
LISTED_SHARE = 16


def key_counts(df: DataFrame, keys: list[str], batch: str = "0", heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(batch, keys..., n) of the keys with many rows in a stored batch. Missing keys join nothing
    and are not counted. The bucket counts, a bounded number, are computed when it is called."""
    least = max(2, heavy_rows // LISTED_SHARE)
    whole = df.dropna(subset=keys)
    loads = whole.groupBy(key_bucket(keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    inside = [r["bucket"] for r in loads.filter(F.col("n") >= least).collect()]
    counted = whole.filter(key_bucket(keys).isin(inside)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least).select(F.lit(batch).alias("batch"), *keys, "n")


def combine(counts: DataFrame) -> DataFrame:
    """Counts of all batches added up: (keys..., n)."""
    keys = [c for c in counts.columns if c not in ("batch", "n")]
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"))


def right_splits(counts: DataFrame | None, names: Mapping[str, str], heavy_rows: int = HEAVY_ROWS) -> HeavyKeys | None:
    """The keys of a right side that one task should not take, renamed by ``names``; there is at
    most one for each ``heavy_rows`` rows."""
    if counts is None:
        return None
    found = combine(counts).filter(F.col("n") > heavy_rows)
    found = found.select(*[F.col(old).alias(new) for old, new in names.items()], "n").collect()
    return HeavyKeys([(*r[:-1], 1, split_count(r["n"], heavy_rows)) for r in found]) if found else None


def split_rows(df: DataFrame, heavy: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of other keys, missing ones among them, and rows of the heavy ``key`` values."""
    few = F.broadcast(heavy.select(F.col(heavy.columns[0]).alias(key)).distinct())
    return df.join(few, key, "left_anti"), df.join(few, key, "left_semi").select(*df.columns)
