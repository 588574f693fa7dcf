"""Fact preparation: claims, remittance, open claims and what remittance implies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions import (
    clean_activity_id, coerce_numbers, consult_code, convert_dates, day_of,
    dxb_consult_code, evaluation_code, open_doctor_id, open_ordering_doc_id,
    ordering_doc_id, received_on, treating_doc_id,
)
from claimlake.functions.rules import RECEIVED_SEQ
from claimlake.schemas import TableSpec

ACTIVITY = ("claim_id", "activity_id")

# Columns every open claim carries.
OPEN_CLAIM_CONSTANTS = {
    "claim_status": "U",
    "claimstatus": "O",
    "new_claim_status": "Open",
    "org_sub_seq": 1,
    "cor_sub_seq": 1,
    "patientshare": 0,
}


def prepare_claims(claims: DataFrame) -> DataFrame:
    """Claims with parsed encounter date, cleaned activity id, code groups, doctors."""
    day = day_of("encounterstart")
    return claims.withColumns(
        {
            "encounterstart_date": day,
            "enc_year": F.year(day),
            "enc_month": F.month(day),
            "cleaned_activityid": clean_activity_id("activityid"),
            "EM": evaluation_code("activitycode"),
            "DXBConsult": dxb_consult_code("activitycode"),
            "Consult": consult_code("activitycode"),
            "doc_id": treating_doc_id(),
            "ordering_doc_id": ordering_doc_id(),
        }
    )


def with_advice_dates(remittance: DataFrame) -> DataFrame:
    """Day, year and month of the payment advice."""
    paid = F.col("transaction_date")
    return remittance.withColumns(
        {
            "ra_date": paid.cast("date").cast("timestamp_ntz"),
            "ra_year": F.year(paid),
            "ra_month": F.month(paid),
        }
    )


def with_row_received(remittance: DataFrame) -> DataFrame:
    """First, second and third received date on the rows that carry them."""
    return remittance.withColumns({name: received_on(name) for name in RECEIVED_SEQ})


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Unique row number; it is not the same from run to run."""
    return df.withColumn(name, F.monotonically_increasing_id())


def prepare_remittance(remittance: DataFrame, row_key: bool = False) -> DataFrame:
    out = with_row_received(with_advice_dates(remittance))
    return with_row_key(out) if row_key else out


def received_dates(remittance: DataFrame) -> DataFrame:
    """One row per activity: earliest first, second and third received date."""
    return remittance.groupBy(*ACTIVITY).agg(
        *[F.min(received_on(name)).alias(name) for name in RECEIVED_SEQ]
    )


def latest_denial(remittance: DataFrame) -> DataFrame:
    """One row per denied activity: the denial code of its newest advice.

    Ties go to the later transaction, then to the smaller code. The newest is kept as
    a running minimum, so each task sends on one row per activity.
    """
    newest_first = F.struct(
        F.coalesce(-F.col("ra_seq").cast("bigint"), F.lit(1 << 62)).alias("seq"),
        F.coalesce(
            F.timestamp_diff(
                "MICROSECOND", F.col("transaction_date"),
                F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
            ),
            F.lit(1 << 62),
        ).alias("age"),
        F.col("denial_code").alias("code"),
    )
    return (
        remittance.filter(F.col("denial_code").isNotNull())
        .groupBy(*ACTIVITY)
        .agg(F.min(newest_first)["code"].alias("latest_denial_code"))
    )


def prepare_open_claims(open_claims: DataFrame) -> DataFrame:
    """Open claims with encounter date parts, doctors and the fixed status columns."""
    day = day_of(F.substring("start_date", 1, 10))
    return open_claims.withColumns(
        {
            "encounter_start_date": day,
            "enc_date": day,
            "enc_year": F.year(day),
            "enc_month": F.month(day),
            "ordering_doc_id": open_ordering_doc_id(),
            "doctor_id": open_doctor_id(),
            **{c: F.lit(v) for c, v in OPEN_CLAIM_CONSTANTS.items()},
        }
    )


def coerce_facts(
    facts: Mapping[str, DataFrame], specs: Iterable[TableSpec]
) -> dict[str, DataFrame]:
    """Fact tables typed by their specs: strict date column, lenient numbers."""
    out = dict(facts)
    for spec in specs:
        if spec.name in out:
            dated = convert_dates(out[spec.name], [spec.date_column])
            out[spec.name] = coerce_numbers(dated, spec.numeric_columns)
    return out
