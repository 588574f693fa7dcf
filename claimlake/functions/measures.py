"""Scalar claim and payment measures, and exact money aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_money", "days_between", "days_to_finalize", "days_to_payment", "exact_avg",
    "exact_sum", "is_delayed_payment", "is_denied", "is_full_payment",
    "patient_share_pct", "payment_efficiency", "payment_ratio",
    "processing_days", "ratio", "reimbursement_rate", "share_or_zero",
    "write_off_amount",
]

# Share of the claim that counts as paid in full; days until late.
FULL_PAYMENT_RATIO = 0.99
LATE_AFTER_DAYS = 30

# Money to a hundredth of a cent: net amounts are products of price and discount. Amounts below
# 10^24 fit; NaN is no amount and counts as missing.
MONEY = "decimal(28,4)"

_MICROS_PER_DAY = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(part: Column | str, whole: Column | str, places: int = 4) -> Column:
    """Rounded quotient; NULL for a zero divisor."""
    return F.round(F.try_divide(_col(part), _col(whole)), places)


def reimbursement_rate() -> Column:
    return ratio("netclaim", "gross")


def patient_share_pct() -> Column:
    return ratio("patientshare", "gross")


def payment_ratio() -> Column:
    return ratio("received_amount", "insurance_claim_amt")


def payment_efficiency() -> Column:
    return ratio("received_amount", "netclaim")


def is_full_payment(paid_share: Column | str = "payment_ratio") -> Column:
    return F.coalesce(_col(paid_share) >= FULL_PAYMENT_RATIO, F.lit(False))


def is_denied() -> Column:
    return F.col("denial_code").isNotNull()


def days_between(
    later: Column | str, earlier: Column | str, unit: str = "calendar"
) -> Column:
    """Whole calendar days, or elapsed days rounded to whole ones, as double."""
    if unit == "calendar":
        return F.datediff(_col(later), _col(earlier)).cast("double")
    if unit == "elapsed":
        micros = F.timestamp_diff("MICROSECOND", _col(earlier), _col(later))
        return F.round(micros / F.lit(_MICROS_PER_DAY), 0)
    raise ValueError(f"unknown day unit {unit!r}")


def days_to_finalize() -> Column:
    return days_between("bill_finalized_date", "submission_date", "elapsed")


def days_to_payment(unit: str = "elapsed") -> Column:
    return days_between("transaction_date", "bill_finalized_date", unit)


def is_delayed_payment(
    days: Column | str = "days_to_payment", threshold: int = LATE_AFTER_DAYS
) -> Column:
    """Late payment flag; an unknown delay is not late."""
    return F.coalesce(_col(days) > threshold, F.lit(False))


def as_money(amount: Column | str) -> Column:
    return _col(amount).cast(MONEY)


def write_off_amount() -> Column:
    """Claimed less received, to the cent; decimal, so that half cents round up."""
    gap = as_money("netclaim") - as_money("received_amount")
    return F.round(gap, 2).cast("double")


def processing_days() -> Column:
    return F.datediff("submission_date", "encounterstart_date")


def share_or_zero(part: Column | str, whole: Column | str) -> Column:
    """Unrounded quotient where the whole is positive, else 0."""
    part, whole = _col(part), _col(whole)
    return F.when(whole > 0, F.try_divide(part, whole)).otherwise(F.lit(0.0))


def exact_sum(amount: Column | str, places: int | None = None) -> Column:
    """Sum in decimal, so that the total does not depend on row order."""
    total = F.sum(as_money(amount))
    return (total if places is None else F.round(total, places)).cast("double")


def exact_avg(amount: Column | str) -> Column:
    """Mean from a decimal sum, NULL for no values."""
    return F.try_divide(exact_sum(amount), F.count(_col(amount)))
