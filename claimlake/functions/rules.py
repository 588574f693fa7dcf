"""Derived claim columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "claim_format_label", "claim_status_label", "clean_activity_id",
    "consult_code", "dxb_consult_code", "evaluation_code", "open_doctor_id",
    "open_ordering_doc_id", "ordering_doc_id", "payment_status", "received_on",
    "treating_doc_id",
]

# Evaluation-and-management codes.
EVALUATION_CODES = [
    "99201", "99202", "99203", "99204", "99205",
    "99211", "99212", "99213", "99214", "99215",
    "99281", "99282", "99283", "99284", "99285",
]

# Regional consultation codes.
DXB_CONSULT_CODES = [
    "9", "9.01", "9.02", "10", "10.01", "10.02", "11", "11.01", "11.02",
    "61.01", "61.02", "61.03", "61.04", "61.08",
]

# Ends of the consultation code range, compared as text.
CONSULT_RANGE = ("99201", "99499")

# Charge heads for which the payee is the ordering doctor.
PAYEE_ORDERS = ["OPDOC", "ROPDOC"]

NOT_APPLICABLE = "NA"

# Payment ordinal that carries each received date.
RECEIVED_SEQ = {"first_received": 2, "second_received": 3, "third_received": 4}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_activity_id(activity: Column | str) -> Column:
    """Activity id up to its first ``-I``; without one, up to its first ``-R``."""
    c = _col(activity)
    marker = F.when(c.contains("-I"), F.lit("-I")).otherwise(F.lit("-R"))
    return F.split_part(c, marker, F.lit(1))


def _code_or_na(code: Column | str, keep) -> Column:
    trimmed = F.trim(_col(code))
    return F.when(keep(trimmed), trimmed).otherwise(F.lit(NOT_APPLICABLE))


def evaluation_code(code: Column | str) -> Column:
    return _code_or_na(code, lambda c: c.isin(EVALUATION_CODES))


def dxb_consult_code(code: Column | str) -> Column:
    return _code_or_na(code, lambda c: c.isin(DXB_CONSULT_CODES))


def consult_code(code: Column | str) -> Column:
    """Codes inside the consultation range; the comparison is lexical."""
    return _code_or_na(code, lambda c: c.between(*CONSULT_RANGE))


def treating_doc_id() -> Column:
    """Clinician, or the ordering clinician where there is none."""
    return F.coalesce("clinician", "orderingclinician")


def ordering_doc_id() -> Column:
    """Ordering clinician; where blank, the payee for outpatient doctor charges and
    otherwise the first of prescriber, payee and admitting doctor."""
    named = F.nullif(F.col("orderingclinician"), F.lit(""))
    return (
        F.when(named.isNotNull(), named)
        .when(F.col("charge_head").isin(PAYEE_ORDERS), F.col("payee_doctor_id"))
        .otherwise(open_ordering_doc_id())
    )


def open_ordering_doc_id() -> Column:
    return F.coalesce("prescribing_dr_id", "payee_doctor_id", "admitting_dr_id")


def open_doctor_id() -> Column:
    return F.coalesce("payee_doctor_id", "prescribing_dr_id", "admitting_dr_id")


def received_on(name: str) -> Column:
    """Transaction date on the row whose payment ordinal carries ``name``."""
    return F.when(F.col("ra_seq") == RECEIVED_SEQ[name], F.col("transaction_date"))


def claim_format_label(fmt: Column | str) -> Column:
    return F.when(_col(fmt) == "XML", F.lit("TPA")).otherwise(F.lit("CORPORATE"))


def claim_status_label(rules: str = "full") -> Column:
    """Readable status from the status code, submission number and payment ordinal.

    ``rules="basic"`` knows no resubmitted or closed claims.
    """
    if rules not in ("full", "basic"):
        raise ValueError(f"unknown status rules {rules!r}")
    status, submission = F.col("claim_status"), F.col("org_sub_seq")
    advice = F.coalesce("ra_seq", F.lit(0))
    first = (status == "S") & (submission == 1)
    label = (
        F.when(status == "N", "Pending Reconciliation")
        .when(first & (advice == 0), "Submitted")
        .when(first & (advice >= 1), "Denied")
    )
    if rules == "full":
        label = label.when((status == "S") & (submission > 1), "Resubmitted").when(
            status == "C", "Closed"
        )
    return label.otherwise("Unknown")


def payment_status(paid: Column | str, claimed: Column | str) -> Column:
    paid, claimed = _col(paid), _col(claimed)
    return (
        F.when(paid.isNull(), "Pending")
        .when(paid == 0, "Denied")
        .when(paid < claimed, "Partially Paid")
        .otherwise("Fully Paid")
    )
