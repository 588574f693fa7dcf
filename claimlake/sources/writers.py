"""Sinks: Parquet, partitioned Parquet, CSV, JSON reports and JDBC tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame

PARTITION_COLUMNS = ("enc_year", "enc_month")


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet set and return it as read back, which cuts the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_partitioned(
    df: DataFrame, path: str, columns: Iterable[str] = PARTITION_COLUMNS
) -> DataFrame:
    """Overwrite a Parquet set with one folder per value of the columns.

    Rows are brought together by folder so that a folder gets few files. Rebalancing
    also splits a large folder over several tasks, where a plain repartitioning by
    these columns would write it in one.
    """
    columns = list(columns)
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite").partitionBy(*columns).parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, folder: str, table: str) -> str:
    """CSV set ``transformed_<table>.csv`` with a header line in every file."""
    path = f"{folder}/transformed_{table}.csv"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def dated_path(folder: str, table: str, day: date | None = None) -> str:
    return f"{folder}/{table}_{(day or date.today()):%Y%m%d}.parquet"


def write_dated(df: DataFrame, folder: str, table: str, day: date | None = None) -> str:
    path = dated_path(folder, table, day)
    write_parquet(df, path)
    return path


def profile_folder(folder: str, table: str, day: date | None = None) -> str:
    return f"{folder}/{table}_profile_{(day or date.today()):%Y%m%d}"


def write_profile(profile: Mapping[str, DataFrame], path: str) -> str:
    """Every profile result as JSON lines in its own folder of the report."""
    for name, result in profile.items():
        result.write.mode("overwrite").json(f"{path}/{name}")
    return path


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str],
    batchsize: int = 50_000,
) -> None:
    """Append to a database table in batches; every task is one transaction, so a
    failed job can leave part of its rows behind."""
    df.write.jdbc(
        url, table, mode="append", properties={**properties, "batchsize": str(batchsize)}
    )


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """A result written once to shared storage, to be read several times.

    It outlives lost executors, which kept blocks do not.
    """
    return write_parquet(df, f"{folder}/{name}")
