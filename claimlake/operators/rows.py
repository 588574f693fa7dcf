"""Row selection: member lists, date ranges, present values, first rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_members(df: DataFrame, members: Mapping[str, Iterable[Any]]) -> DataFrame:
    """Rows whose columns are in the given lists; an empty list keeps all rows."""
    for column, values in members.items():
        values = list(values or ())
        if values:
            # Literals take the column's type, so that the filter reaches the scan.
            kind = df.schema[column].dataType
            df = df.filter(F.col(column).isin([F.lit(v).cast(kind) for v in values]))
    return df


def date_range(
    df: DataFrame, column: str, start: Any = None, end: Any = None, closed: str = "left"
) -> DataFrame:
    """Rows from ``start`` to ``end``: half-open, or with ``closed="both"`` closed."""
    if closed not in ("left", "both"):
        raise ValueError(f"unknown range kind {closed!r}")
    when = F.col(column)

    def bound(value: Any) -> Column:
        text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
        return F.lit(text).cast(df.schema[column].dataType)

    if start is not None:
        df = df.filter(when >= bound(start))
    if end is not None:
        df = df.filter(when <= bound(end) if closed == "both" else when < bound(end))
    return df


def keep_present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all the columns hold a value."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def first_rows(df: DataFrame, n: int | None, order_by: Iterable[str]) -> DataFrame:
    """The first ``n`` rows in a stated order; no ``n`` keeps all rows."""
    order = list(order_by)
    if n is None:
        return df
    if not order:
        raise ValueError("a limit needs an order")
    return df.orderBy(*order).limit(n)


def extract(
    df: DataFrame, date_column: str, start: Any, end: Any,
    members: Mapping[str, Iterable[Any]] | None = None,
    limit: int | None = None, order_by: Iterable[str] = (), closed: str = "both",
) -> DataFrame:
    """Parameterised extract: date range, member lists and an ordered limit."""
    df = date_range(df, date_column, start, end, closed)
    return first_rows(keep_members(df, members or {}), limit, order_by)


# Ranges that rows are numbered in, and rows that their bounds are chosen from.
RANGES, BOUND_ROWS = 200, 4000


def _range_of(order: list[str], bounds: list[tuple], low: int = 0) -> Column:
    """Number of the bounds at or below a row, found by halving."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    here = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(order)])
    bound = F.struct(*[F.lit(v).alias(f"c{i}") for i, v in enumerate(bounds[middle])])
    return F.when(here < bound, _range_of(order, bounds[:middle], low)).otherwise(
        _range_of(order, bounds[middle + 1:], low + middle + 1))


def with_row_numbers(
    df: DataFrame, order_by: Iterable[str], name: str = "row_key", ranges: int = RANGES,
) -> DataFrame:
    """Rows numbered from 0 without gaps, in the order of the columns, NULL first.

    The number of a row follows from the rows of the table alone, so a rerun or a retried task
    gives the same; rows that agree in all the columns are in any order among themselves. Rows
    are numbered within ranges, and a range starts at the count of the rows before it. The bounds
    are taken from the rows with the least hashes of the columns, found when the function is
    called; a single tuple of values is never split.
    """
    order = list(order_by)
    if not order:
        raise ValueError("row numbers need an order")
    keys = df.select(*[F.col(f"`{c}`") for c in order])
    picked = keys.dropna().orderBy(F.xxhash64(*keys.columns), *keys.columns).limit(BOUND_ROWS).collect()
    picked = sorted({tuple(r) for r in picked})
    bounds = sorted({picked[len(picked) * k // ranges] for k in range(1, ranges)}) if picked else []
    at, first = (_unused(df, c) for c in ("_range", "_first"))
    placed = df.withColumn(at, _range_of(order, bounds))
    counts = placed.groupBy(at).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(at, F.coalesce(before, F.lit(0)).alias(first))  # a row for each range
    within = Window.partitionBy(at).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order])
    numbered = placed.withColumn(name, F.row_number().over(within).cast("bigint") - 1)
    return numbered.join(F.broadcast(counts), at).withColumn(name, F.col(name) + F.col(first)).drop(at, first)


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name
