"""Outlier treatment with bounds taken from the whole column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.operators.quantiles import as_numbers, exact_quantiles

# Default multiple of the interquartile range.
DEFAULT_THRESHOLD = 1.5


def _one_row_map(bounds: DataFrame, *fields: str) -> Column:
    """(column_name, fields) rows, one per column, as a map from column to fields."""
    entry = F.struct(F.col("column_name"), F.struct(*fields))
    return bounds.agg(F.map_from_entries(F.collect_list(entry))).scalar()


def quartile_bounds(
    df: DataFrame, columns: Iterable[str], k: float, approximate: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """(column_name, low, high): quartiles widened by ``k`` interquartile ranges."""
    columns = list(columns)
    if approximate:
        numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        quartiles = numbers.unpivot([], columns, "column_name", "v").groupBy(
            "column_name"
        ).agg(F.percentile_approx("v", [0.25, 0.75], accuracy).alias("q")).select(
            "column_name", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")
        )
    else:
        quartiles = exact_quantiles(df, columns, {"q1": 0.25, "q3": 0.75})
    reach = F.lit(float(k)) * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        "column_name", (F.col("q1") - reach).alias("low"),
        (F.col("q3") + reach).alias("high"),
    )


def clip_outliers(
    df: DataFrame, columns: Iterable[str], k: float = DEFAULT_THRESHOLD,
    approximate: bool = False,
) -> DataFrame:
    """Values outside the widened quartiles set to the bound they cross. The quartiles are
    computed when the function is called."""
    columns = list(columns)
    bounds = _one_row_map(quartile_bounds(df, columns, k, approximate), "low", "high")

    def clipped(c: str) -> Column:
        value, b = F.col(c).cast("double"), bounds[c]
        return (
            F.when(value < b["low"], b["low"])
            .when((value > b["high"]) & ~F.isnan(value), b["high"])
            .otherwise(value)
        )

    return df.withColumns({c: clipped(c) for c in columns})


def replace_outliers(
    df: DataFrame, columns: Iterable[str], threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Values more than ``threshold`` deviations from the mean set to the mean."""
    columns = list(columns)
    numbers = as_numbers(df, columns)
    names = [f"`{c}`" for c in columns]
    moments = numbers.agg(F.map_from_entries(F.array(*[
        F.struct(F.lit(c), F.struct(F.avg(n).alias("mean"), F.stddev_samp(n).alias("std")))
        for c, n in zip(columns, names, strict=True)])).alias("stats"))
    stats = moments.scalar()

    def replaced(c: str) -> Column:
        value, s = F.col(c).cast("double"), stats[c]
        score = F.abs(F.try_divide(value - s["mean"], s["std"]))
        return F.when((score > threshold) & ~F.isnan(score), s["mean"]).otherwise(value)

    return df.withColumns({c: replaced(c) for c in columns})


def treat_outliers(
    df: DataFrame, columns: Iterable[str], method: str = "iqr",
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Outlier treatment by method name: ``iqr`` clips, ``zscore`` replaces."""
    if method == "iqr":
        return clip_outliers(df, columns, threshold)
    if method == "zscore":
        return replace_outliers(df, columns, threshold)
    raise ValueError(f"unknown outlier method {method!r}")
