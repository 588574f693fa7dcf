"""Grouped reports: center figures, denial patterns, generic aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions import exact_avg, exact_sum
from claimlake.operators.quantiles import exact_quantiles


def aggregate_by_center(matched: DataFrame) -> DataFrame:
    """Center figures over matched rows; a claim counts once per payment."""
    return matched.groupBy("center_id", "center_name").agg(
        F.count("claimid").alias("total_claims"),
        exact_sum("gross").alias("total_gross"),
        exact_sum("netclaim").alias("total_net"),
        exact_sum("received_amount").alias("total_received"),
        exact_sum("write_off_amount").alias("total_write_off"),
        F.avg("days_to_payment").alias("avg_days_to_payment"),
        F.avg(F.col("is_delayed_payment").cast("int")).alias("delayed_payment_rate"),
        exact_avg("reimbursement_rate").alias("avg_reimbursement_rate"),
    )


def center_statistics(matched: DataFrame) -> DataFrame:
    """Rounded center figures; rows without a center are left out."""
    def total(column: str) -> Column:
        return F.coalesce(exact_sum(column, 2), F.lit(0.0))

    late = F.coalesce(F.col("is_delayed_payment"), F.lit(False)).cast("int")
    return (
        matched.filter(F.col("center_id").isNotNull())
        .groupBy("center_id")
        .agg(
            F.count("claimid").alias("total_claims"),
            total("gross").alias("total_gross"),
            total("netclaim").alias("total_net"),
            total("received_amount").alias("total_received"),
            total("write_off_amount").alias("total_write_off"),
            F.round(F.avg("days_to_payment"), 2).alias("avg_days_to_payment"),
            F.round(F.avg(late), 2).alias("delayed_payment_rate"),
            F.round(exact_avg("payment_efficiency"), 2).alias("avg_payment_efficiency"),
        )
    )


def payments_per_activity(remittance: DataFrame) -> DataFrame:
    """One row per activity: amount received, last transaction, newest ordinal."""
    return remittance.groupBy("claim_id", "activity_id").agg(
        exact_sum("received_amount").alias("received_amount"),
        F.max("transaction_date").alias("transaction_date"),
        F.max("ra_seq").alias("ra_seq"),
    )


def denial_patterns(matched: DataFrame) -> DataFrame:
    """Per denial code of the payment (``ra_denial_code`` where the claim has one too): claims denied, amount denied and recovered, recovery rate;
    most frequent code first. Without denial codes there is nothing to report."""
    names = ["denial_code", "denied_claims", "denied_amount", "recovered_amount",
             "recovery_rate"]
    if not {"denial_code", "ra_denial_code"} & set(matched.columns):
        kinds = ["string", "bigint", "double", "double", "double"]
        return matched.sparkSession.createDataFrame(
            [], ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
        )

    def total(column: str) -> Column:
        return F.coalesce(exact_sum(column, 2), F.lit(0.0))

    if "ra_denial_code" in matched.columns:
        matched = matched.drop("denial_code").withColumnRenamed("ra_denial_code", "denial_code")
    return (
        matched.filter(F.col("denial_code").isNotNull())
        .groupBy("denial_code")
        .agg(
            F.count("claimid").alias("denied_claims"),
            total("netclaim").alias("denied_amount"),
            total("received_amount").alias("recovered_amount"),
        )
        .withColumn(
            "recovery_rate",
            F.round(F.try_divide("recovered_amount", "denied_amount"), 4),
        )
        .transform(rank_denials)
    )


def rank_denials(denials: DataFrame) -> DataFrame:
    """Most denied claims first, then by code."""
    return denials.orderBy(F.desc("denied_claims"), "denial_code")


def _aggregates(column: str, order_by: Iterable[str]) -> dict[str, Column]:
    c = F.col(column)
    out = {
        "sum": F.coalesce(F.sum(c), F.lit(0)),
        "mean": F.avg(c),
        "min": F.min(c),
        "max": F.max(c),
        "count": F.count(c),
        "nunique": F.count_distinct(c),
        "std": F.stddev_samp(c),
        "var": F.var_samp(c),
    }
    order = list(order_by)
    if order:
        place = F.when(c.isNotNull(), F.struct(*order))
        out["first"], out["last"] = F.min_by(c, place), F.max_by(c, place)
    return out


def aggregate(
    df: DataFrame, keys: Iterable[str], functions: Mapping[str, str | list[str]],
    order_by: Iterable[str] = (),
) -> DataFrame:
    """Grouped aggregates, one column ``<column>_<function>`` each.

    Functions: sum, mean, min, max, count, nunique, std, var, median, and first and
    last, which take the first and last present value in ``order_by`` order. Rows with
    a missing key are left out, and the sum over no values is 0.
    """
    keys = list(keys)
    order = list(order_by)
    wanted = [
        (c, f) for c, fs in functions.items() for f in ([fs] if isinstance(fs, str) else fs)
    ]
    # one condition a key: all uses of the rows then filter them at the same place, and share a scan
    kinds = dict(df.dtypes)
    present = [F.col(f"`{k}`").isNotNull() for k in keys]
    present += [~F.isnan(f"`{k}`") for k in keys if kinds[k] in ("float", "double")]
    rows = df.filter(reduce(lambda a, b: a & b, present)) if keys else df
    plain, medians = [], []
    for column, function in wanted:
        if function == "median":
            medians.append(column)
            continue
        known = _aggregates(column, order)
        if function not in known:
            hint = " without order_by" if function in ("first", "last") else ""
            raise ValueError(f"cannot compute {function!r}{hint}")
        plain.append(known[function].alias(f"{column}_{function}"))
    parts = [rows.groupBy(*keys).agg(*plain)] if plain else []
    if medians:
        # A group's median needs all its values: use the bounded-state operator.
        per_column = exact_quantiles(rows, medians, {"median": 0.5}, keys)
        parts.append(
            per_column.groupBy(*keys).agg(
                *[
                    F.max(F.when(F.col("column_name") == c, F.col("median")))
                    .alias(f"{c}_median")
                    for c in medians
                ]
            )
        )
        if not plain:
            parts.insert(0, rows.select(*keys).distinct())
    # One row per group on both sides.
    out = reduce(lambda a, b: a.join(b, keys, "left"), parts)
    return out.select(*keys, *[f"{c}_{f}" for c, f in wanted])
