"""Sources: Parquet and JDBC scans, specs, profiles and declared schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timedelta
from functools import reduce
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.rows import date_range, first_rows, keep_members
from claimlake.schemas import SLICED_READS, TableSpec, spec_of

# Reader and writer options of the database connection.
JDBC_DEFAULTS = {
    "driver": "org.postgresql.Driver",
    "fetchsize": "100000",
    "batchsize": "50000",
}


def read_parquet(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None
) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def jdbc_options(credentials: Mapping[str, str], **overrides: str) -> dict[str, str]:
    """Connection properties from credentials, with the defaults for the rest."""
    login = {k: credentials[k] for k in ("user", "password")}
    return {**JDBC_DEFAULTS, **login, **overrides}


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str]
) -> DataFrame:
    """Table scan; column selection and filters are sent to the database."""
    return spark.read.jdbc(url, table, properties=dict(properties))


def _day(value: str | date | datetime) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def date_slices(start: Any, end: Any, n: int) -> list[tuple[date, date]]:
    """Up to ``n`` half-open day ranges covering [start, end) once, none empty."""
    first, last = _day(start), _day(end)
    days = (last - first).days
    if n < 1 or days < 1:
        raise ValueError("need n >= 1 slices of a range of one day or more")
    edges = [first + timedelta(days=days * i // n) for i in range(n + 1)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def slice_predicates(column: str, start: Any, end: Any, n: int) -> list[str]:
    return [
        f"{column} >= '{a}' AND {column} < '{b}'" for a, b in date_slices(start, end, n)
    ]


def read_jdbc_sliced(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
    column: str, start: Any, end: Any, n: int,
) -> DataFrame:
    """Scan of a date range with one task, and one connection, per date slice."""
    return spark.read.jdbc(
        url, table, predicates=slice_predicates(column, start, end, n),
        properties=dict(properties),
    )


def read_fact_sliced(
    spark: SparkSession, url: str, fact: str, table: str,
    properties: Mapping[str, str], start: Any, end: Any, n: int | None = None,
) -> DataFrame:
    """Sliced scan of a fact table along its configured date column."""
    column, slices = SLICED_READS[fact]
    return read_jdbc_sliced(
        spark, url, table, properties, column, start, end, n or slices
    )


def slice_number(column: Column | str, start: Any, end: Any, n: int) -> Column:
    """Ordinal of the date slice a value falls in; NULL outside the range."""
    when = F.col(column) if isinstance(column, str) else column
    slices = date_slices(start, end, n)
    first, last = slices[0][0], slices[-1][1]
    days = (last - first).days
    # Slice i starts on day floor(days * i / n): the last such i not after the day.
    day = F.datediff(when, F.lit(first)).cast("bigint")
    number = F.floor(((day + 1) * len(slices) - 1) / F.lit(days)).cast("int")
    return F.when((when >= F.lit(first)) & (when < F.lit(last)), number)


def select_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*spec.columns)


def read_table(spark: SparkSession, table: str, location: str) -> DataFrame:
    """Configured columns of ``<location>/<table>.parquet``; unknown table raises."""
    spec = spec_of(table)
    return select_spec(read_parquet(spark, f"{location}/{table}.parquet"), spec)


def apply_profile(
    df: DataFrame, spec: TableSpec, env: str, overrides: Mapping[str, Any] | None = None
) -> DataFrame:
    """Rows of one environment; ``overrides`` replace start, end, members or limit."""
    if env not in spec.profiles:
        raise ValueError(f"table {spec.name} has no profile {env!r}")
    profile = spec.profiles[env]
    use = {
        "start": profile.start, "end": profile.end, "members": profile.members,
        "limit": profile.limit, **(overrides or {}),
    }
    df = date_range(df, spec.date_column, use["start"], use["end"], closed="both")
    df = keep_members(df, use["members"])
    order = [spec.date_column, *(c for c in df.columns if c != spec.date_column)]
    return first_rows(df, use["limit"], order)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order, values that do not convert and absent
    columns NULL; ``schema_violation`` marks rows with a NULL in a required column."""
    have = set(df.columns)
    typed = df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
    required = [F.col(f.name).isNull() for f in schema if not f.nullable]
    broken = reduce(lambda x, y: x | y, required, F.lit(False))
    return typed.withColumn("schema_violation", broken)


def cache_dims(
    dims: Mapping[str, DataFrame], names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Dimensions with the named ones kept in memory and on disk.

    Release them with ``unpersist`` when the job is over.
    """
    names = set(dims if names is None else names)
    return {
        name: dim.persist(StorageLevel.MEMORY_AND_DISK) if name in names else dim
        for name, dim in dims.items()
    }


# The master tables that are worth keeping.
CACHED_DIMS = ["hospitals", "doctors", "plans", "encounter_types", "denial_codes"]
