"""Metric bundles, totals per claim on each row, and the final claims dataset."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions import (
    as_money, clean_activity_id, days_to_finalize, days_to_payment, exact_sum, is_delayed_payment, is_denied,
    is_full_payment, patient_share_pct, payment_efficiency, payment_ratio,
    payment_status, processing_days, reimbursement_rate, share_or_zero,
    write_off_amount,
)
from claimlake.operators.joins import HeavyKeys, salted_join
from claimlake.operators.match import match_claims


def claim_metrics(claims: DataFrame) -> DataFrame:
    """Reimbursement rate and patient share; days to finalize if both dates exist."""
    out = {
        "reimbursement_rate": reimbursement_rate(),
        "patient_share_pct": patient_share_pct(),
    }
    if {"submission_date", "bill_finalized_date"} <= set(claims.columns):
        out["days_to_finalize"] = days_to_finalize()
    return claims.withColumns(out)


def remittance_metrics(remittance: DataFrame) -> DataFrame:
    return remittance.withColumns(
        {
            "payment_ratio": payment_ratio(),
            "is_full_payment": is_full_payment(payment_ratio()),
            "is_denied": is_denied(),
        }
    )


def matched_metrics(matched: DataFrame) -> DataFrame:
    return matched.withColumns(
        {
            "payment_efficiency": payment_efficiency(),
            "days_to_payment": days_to_payment("elapsed"),
            "is_delayed_payment": is_delayed_payment(days_to_payment("elapsed")),
            "write_off_amount": write_off_amount(),
        }
    )


def center_metrics(matched: DataFrame) -> DataFrame:
    """The metrics that the center report averages; days are calendar days."""
    return matched.withColumns(
        {
            "reimbursement_rate": reimbursement_rate(),
            "patient_share_pct": patient_share_pct(),
            "days_to_payment": days_to_payment("calendar"),
            "is_delayed_payment": is_delayed_payment(days_to_payment("calendar")),
            "write_off_amount": write_off_amount(),
        }
    )


def with_group_values(
    rows: DataFrame, key: str, values: Mapping[str, Column]
) -> DataFrame:
    """Aggregates per key on each row.

    Same result as an unordered window over the key, but rows are aggregated before
    the shuffle and a heavy key can be split, where a window needs all rows of a key in
    one task. Rows without a key form one group, as they do in a window.
    """
    named = rows.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col(key)), F.lit("")))
    per_key = named.groupBy("_key").agg(*[v.alias(n) for n, v in values.items()])
    joined = salted_join(named, per_key, "_key", "left", right_unique=True)
    return joined.select(*rows.columns, *values)


def with_claim_totals(
    rows: DataFrame, key: str = "claimid", claimed: str = "netclaim",
    approved: str = "received_amount",
) -> DataFrame:
    """Claimed and approved total of the claim on each row."""
    values = {
        "total_claim_amount": exact_sum(claimed),
        "total_approved_amount": exact_sum(approved),
    }
    return with_group_values(rows, key, values)


def match_with_totals(
    claims: DataFrame, remittance: DataFrame, heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Matched rows with the claimed and the approved total of their claim on each.

    Same result as ``with_claim_totals`` over the match, in which a claim counts once for each of
    its payments, but payments are reduced to one row an activity and those to one a claim; the
    wide rows are matched once.
    """
    if "activityid" in claims.columns:
        claims = claims.withColumn("cleaned_activityid", clean_activity_id("activityid"))
    paid = remittance.groupBy(F.col("claim_id").alias("claimid"), F.col("activity_id").alias("cleaned_activityid")).agg(
        F.count(F.lit(1)).alias("payments"), F.sum(as_money("received_amount")).alias("paid"))
    slim = claims.select("claimid", "cleaned_activityid", "netclaim")
    each = salted_join(slim, paid, ["claimid", "cleaned_activityid"], "left", right_unique=True)
    times = F.coalesce(F.col("payments"), F.lit(1))
    each = each.withColumn("claimed", as_money("netclaim") * times)
    key = F.coalesce(F.concat(F.lit("="), F.col("claimid")), F.lit(""))
    totals = each.groupBy(key.alias("_key")).agg(
        F.sum("claimed").cast("double").alias("total_claim_amount"),
        F.sum("paid").cast("double").alias("total_approved_amount"))
    matched = match_claims(claims, remittance, "left", heavy)
    named = matched.withColumn("_key", key)
    return salted_join(named, totals, "_key", "left", right_unique=True).select(
        *matched.columns, "total_claim_amount", "total_approved_amount")


def with_total_paid(
    rows: DataFrame, key: str = "claim_id", paid: str = "received_amount",
) -> DataFrame:
    return with_group_values(rows, key, {"total_paid_amount": exact_sum(paid)})


def with_denial_count(
    rows: DataFrame, key: str = "claim_id"
) -> DataFrame:
    return with_group_values(rows, key, {"denial_count": F.count("denial_code")})


def remittance_per_claim(remittance: DataFrame) -> DataFrame:
    """One row per claim: amount paid and number of denials."""
    return remittance.groupBy("claim_id").agg(
        exact_sum("received_amount").alias("total_paid_amount"),
        F.count("denial_code").alias("denial_count"),
    )


def claims_with_payments(claims: DataFrame, remittance: DataFrame) -> DataFrame:
    """Claim rows with the totals of their claim and of its payments.

    Both sides are reduced to one row per claim and joined there first, so that the
    wide claim rows are shuffled once. The approved total is the paid total.
    """
    totals = claims.filter(F.col("claimid").isNotNull()).groupBy("claimid").agg(
        exact_sum("netclaim").alias("total_claim_amount")
    )
    paid = remittance_per_claim(remittance).withColumnRenamed("claim_id", "claimid")
    # One row per claim on both sides: no heavy key to split.
    per_claim = totals.join(paid, "claimid", "left").withColumns(
        {
            "total_approved_amount": F.col("total_paid_amount"),
            "rejection_rate": share_or_zero(
                F.col("total_claim_amount") - F.col("total_paid_amount"),
                "total_claim_amount",
            ),
            "payment_ratio": share_or_zero("total_paid_amount", "total_claim_amount"),
        }
    )
    joined = salted_join(claims, per_claim, "claimid", "left", right_unique=True)
    return joined.withColumn("processing_days", processing_days())


def append_open_claims(claims: DataFrame, open_claims: DataFrame) -> DataFrame:
    """Claims followed by open claims, in the columns of the claims.

    Columns an open claim lacks are NULL, its other columns are left out.
    """
    shared = open_claims.select(*[c for c in claims.columns if c in open_claims.columns])
    return claims.unionByName(shared, allowMissingColumns=True).select(*claims.columns)


def final_dataset(scored_claims: DataFrame, open_claims: DataFrame) -> DataFrame:
    """Claims with totals and payment status, and the open claims.

    ``claim_status`` becomes the payment status of a submitted claim; the status
    code it was submitted with is kept as ``submitted_status``.
    """
    scored = scored_claims.withColumns(
        {
            "submitted_status": F.col("claim_status"),
            "claim_status": payment_status("total_paid_amount", "total_claim_amount"),
        }
    )
    opened = open_claims.withColumn("doc_id", F.col("doctor_id"))
    return append_open_claims(scored, opened).withColumnRenamed("claimid", "claim_id")
