"""Type coercion: lenient forms give NULL for bad input, strict forms raise."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "coerce_integers", "coerce_numbers", "coerce_timestamps", "convert_dates",
    "day_of",
]


def _present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]


def _coerce(df: DataFrame, columns: Iterable[str], kind: T.DataType) -> DataFrame:
    """Present columns that are of another type, converted or NULL."""
    other = [c for c in _present(df, columns) if df.schema[c].dataType != kind]
    return df.withColumns({c: F.col(c).try_cast(kind) for c in other}) if other else df


def coerce_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns as double, unreadable values NULL; absent columns skipped."""
    return _coerce(df, columns, T.DoubleType())


def coerce_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns as zone-free timestamps, unreadable values NULL."""
    return _coerce(df, columns, T.TimestampNTZType())


def coerce_integers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns as int, unreadable values NULL."""
    return _coerce(df, columns, T.IntegerType())


def convert_dates(
    df: DataFrame, columns: Iterable[str], fmt: str | None = None
) -> DataFrame:
    """Listed columns as timestamps; a missing column or unreadable value is an error."""
    def read(c: str) -> Column:
        if fmt:
            return F.to_timestamp_ntz(F.col(c).cast("string"), F.lit(fmt))
        return F.col(c).cast("timestamp_ntz")

    return df.withColumns({c: read(c) for c in columns})


def day_of(text: Column | str, fmt: str = "dd/MM/yyyy") -> Column:
    """Date held as text; NULL when it does not parse."""
    text = F.col(text) if isinstance(text, str) else text
    return F.try_to_date(text, fmt)
