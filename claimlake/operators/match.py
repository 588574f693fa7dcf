"""Joins of facts to facts and of facts to masters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions import clean_activity_id
from claimlake.operators.facts import ACTIVITY, latest_denial, received_dates
from claimlake.operators.heavy import right_splits
from claimlake.operators.joins import (
    BROADCAST_BYTES, HEAVY_ROWS, TOGETHER_ROWS, HeavyKeys, attach, attach_role, check_dimensions, salted_join,
    table_bytes,
)
from claimlake.operators.masters import (
    Tables, denial_codes, doctors_with_departments, encounter_types,
    hospitals_with_clusters, insurers, licensed_doctor_dimension, plans_with_categories,
)

# Dimension column -> output column, per role.
HOSPITAL_LABELS = {"center_name": "center_name", "cluster_name": "cluster_name"}
INSURER_LABELS = {"insurance_co_name": "insurance_co_name"}
PLAN_LABELS = {"plan_name": "plan_name", "category_name": "category_name"}
DOCTOR_LABELS = {"doctor_name": "doctor_name", "dept_name": "doctor_dept"}
ORDERING_LABELS = {
    "doctor_name": "ordering_doctor_name", "dept_name": "ordering_doctor_dept",
}
ENCOUNTER_LABELS = {"encounter_type_desc": "encounter_type_desc"}
DENIAL_LABELS = {
    "denial_description": "denial_description",
    "denial_responsibility": "denial_responsibility",
}

# A role: (dimension, its key, the fact's key, labels).
HOSPITAL = ("hospital", "center_id", "center_id", HOSPITAL_LABELS)
INSURER = ("insurer", "insurance_co_id", "insurance_co_id", INSURER_LABELS)
PLAN = ("plan", "plan_id", "plan_id", PLAN_LABELS)
ENCOUNTER = ("encounter", "encountertype", "encountertype", ENCOUNTER_LABELS)


def treating_role(key: str) -> tuple:
    return ("doctor", "doctor_id", key, DOCTOR_LABELS)


def ordering_role(key: str) -> tuple:
    return ("doctor", "doctor_id", key, ORDERING_LABELS)


def denial_role(key: str) -> tuple:
    return ("denial", "latest_denial_code", key, DENIAL_LABELS)


_BUILD = {
    "hospital": hospitals_with_clusters,
    "insurer": insurers,
    "plan": plans_with_categories,
    "doctor": doctors_with_departments,
    "licensed_doctor": licensed_doctor_dimension,
    "encounter": encounter_types,
    "denial": denial_codes,
}


@dataclass(frozen=True)
class Dimensions:
    """Dimensions with checked sizes in bytes and unique keys."""

    frames: dict[str, DataFrame]
    sizes: dict[str, int]

    def attach(
        self, facts: DataFrame, roles: Iterable[tuple], within: str | None = None, slim: DataFrame | None = None,
    ) -> DataFrame:
        """Attach the labels of every role; the fact row count does not change."""
        for name, dim_key, fact_key, labels in roles:
            facts = attach_role(
                facts, self.frames[name], dim_key, fact_key, labels, self.sizes[name],
                within=within, slim=slim,
            )
        return facts

    def all_broadcast(self, roles: Iterable[tuple]) -> bool:
        return all(self.sizes[name] <= BROADCAST_BYTES for name, *_ in roles)


def checked_dimensions(
    tables: Tables, roles: Iterable[tuple], licensed: bool = False
) -> Dimensions:
    """Build the dimensions that the roles name, and check them in one job."""
    keys = {name: key for name, key, _, _ in roles}
    frames = {
        name: _BUILD["licensed_doctor" if licensed and name == "doctor" else name](tables)
        for name in keys
    }
    return Dimensions(frames, check_dimensions(frames, keys))


def enrich(facts: DataFrame, tables: Tables, roles: Iterable[tuple]) -> DataFrame:
    roles = list(roles)
    return checked_dimensions(tables, roles).attach(facts, roles)


CLAIM_ROLES = [HOSPITAL, INSURER, PLAN, treating_role("doc_id"),
               ordering_role("ordering_doc_id"), ENCOUNTER]
OPEN_CLAIM_ROLES = [HOSPITAL, INSURER, PLAN, treating_role("doctor_id"),
                    ordering_role("ordering_doc_id")]


def claim_dimensions(tables: Tables) -> Dimensions:
    """The dimensions of claims, which serve open claims too."""
    return checked_dimensions(tables, CLAIM_ROLES, licensed=True)


def written_dimensions(read: Callable[[str], DataFrame]) -> Dimensions:
    """The dimensions of claims from the master sets that a run has written."""
    doctors = read("doctors")
    same = [c for c in doctors.columns if c != "doctor_license_number"]
    one_licence = doctors.groupBy(*same).agg(F.min("doctor_license_number").alias("doctor_license_number"))
    frames = {"hospital": read("hospitals"), "insurer": read("insurance"), "plan": read("plans"),
              "doctor": one_licence, "encounter": read("encounter_types")}
    keys = {name: key for name, key, _, _ in CLAIM_ROLES}
    return Dimensions(frames, check_dimensions(frames, keys))


def _few_rows(facts: DataFrame, key: str) -> bool:
    """Whether few enough facts share a key to compare each with all of them."""
    return facts.filter(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > TOGETHER_ROWS).isEmpty()


def enrich_claims(
    claims: DataFrame, tables: Tables, dims: Dimensions | None = None,
    slim: DataFrame | None = None,
) -> DataFrame:
    """Prepared claims with hospital, insurer, plan, both doctors, encounter type.

    With ``slim``, the same claims before anything was joined to them, the claims lie together by
    ``claimid``, and are not sent to masters too large to broadcast; one job checks before that
    no claim has too many rows for it.
    """
    dims = dims or claim_dimensions(tables)
    if slim is None or dims.all_broadcast(CLAIM_ROLES) or not _few_rows(slim, "claimid"):
        return dims.attach(claims, CLAIM_ROLES)
    known = F.col("claimid").isNotNull()
    labelled = dims.attach(claims.filter(known), CLAIM_ROLES, "claimid", slim)
    return labelled.unionByName(dims.attach(claims.filter(~known), CLAIM_ROLES))


def enrich_remittance(remittance: DataFrame, tables: Tables) -> DataFrame:
    return enrich(remittance, tables, [denial_role("denial_code")])


def enrich_open_claims(
    open_claims: DataFrame, tables: Tables, dims: Dimensions | None = None
) -> DataFrame:
    return (dims or claim_dimensions(tables)).attach(open_claims, OPEN_CLAIM_ROLES)


def with_doctor_roles(
    claims: DataFrame, tables: Tables, treating: str = "clinician",
    ordering: str = "orderingclinician",
) -> DataFrame:
    """One doctor dimension attached twice: as treating and as ordering doctor."""
    return enrich(claims, tables, [treating_role(treating), ordering_role(ordering)])


# Columns of payments that name the activity, and the columns of claims that they are matched to.
MATCHED_ON = {"claim_id": "claimid", "activity_id": "cleaned_activityid"}


def payment_splits(tables: Tables) -> HeavyKeys | None:
    """Activities of the remittance that one task should not take, by the counts that a stored
    source keeps of them; None where a source keeps none."""
    counts = getattr(tables, "payment_counts", None)
    if counts is None:
        return None
    return right_splits(counts(), MATCHED_ON, getattr(tables, "heavy_rows", HEAVY_ROWS))


def match_claims(
    claims: DataFrame, remittance: DataFrame, how: str = "left", heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Claims with their payments, on claim and cleaned activity id.

    The cleaned id is derived wherever the activity id is there, also if the claims declare a
    column for it. Remittance columns that a claim has too are prefixed ``ra_``. ``heavy``
    names activities with more payments than one task should get (``payment_splits``); they may
    have been counted before the remittance was filtered.
    """
    if "activityid" in claims.columns:
        claims = claims.withColumn("cleaned_activityid", clean_activity_id("activityid"))
    taken = set(claims.columns)
    paid = remittance.select(
        *[
            F.col(c).alias(MATCHED_ON.get(c, f"ra_{c}" if c in taken else c))
            for c in remittance.columns
        ]
    )
    return salted_join(claims, paid, ["claimid", "cleaned_activityid"], how, heavy=heavy)


def with_latest_denial(claims: DataFrame, remittance: DataFrame) -> DataFrame:
    """Claims with the newest denial code of the same claim and activity id."""
    denied = latest_denial(remittance).select(
        F.col("claim_id").alias("claimid"), F.col("activity_id").alias("activityid"),
        "latest_denial_code",
    )
    return salted_join(
        claims, denied, ["claimid", "activityid"], "left", right_unique=True,
    )


def claims_with_labels(
    claims: DataFrame, remittance: DataFrame, tables: Tables
) -> DataFrame:
    """Claims with hospital, cluster, plan, both doctors, encounter type, and the
    newest denial with its description."""
    roles = [HOSPITAL, PLAN, treating_role("doctor_id"), ordering_role("ordering_doc_id"),
             ENCOUNTER, denial_role("latest_denial_code")]
    return enrich(with_latest_denial(claims, remittance), tables, roles)


def with_received_dates(rows: DataFrame, remittance: DataFrame) -> DataFrame:
    """Payment rows with the received dates of their activity over all remittance."""
    return salted_join(
        rows, received_dates(remittance), ACTIVITY, "left", right_unique=True,
    )


def remittance_with_labels(
    rows: DataFrame, remittance: DataFrame, tables: Tables
) -> DataFrame:
    """Payment rows with received dates and denial description."""
    return enrich_remittance(with_received_dates(rows, remittance), tables)


def matched_labels(matched: DataFrame, tables: Tables) -> DataFrame:
    """Matched rows with hospital, plan, doctor, encounter type and denial labels."""
    roles = [HOSPITAL, PLAN, ("doctor", "doctor_id", "doctor_id",
             {"doctor_name": "doctor_name", "dept_name": "dept_name"}),
             ENCOUNTER, denial_role("denial_code")]
    return enrich(matched, tables, roles)


def join_masters(
    fact: DataFrame, masters: Mapping[str, DataFrame],
    mapping: Mapping[str, str | list[str]], null_safe: bool = False,
) -> DataFrame:
    """Left-join the mapped masters in turn; masters that are absent are skipped.

    A master column whose name is taken gets the suffix ``_<master>``. A repeated
    master key repeats the fact row. ``null_safe`` lets missing keys match each other.
    """
    used = {name: masters[name] for name in mapping if name in masters}
    sizes = table_bytes(used)
    for name, master in used.items():
        keys = [mapping[name]] if isinstance(mapping[name], str) else list(mapping[name])
        taken = set(fact.columns)
        side = master.select(
            *[
                F.col(c).alias(f"{c}_{name}" if c in taken and c not in keys else c)
                for c in master.columns
            ]
        )
        order = [*fact.columns, *(c for c in side.columns if c not in keys)]
        fact = attach(fact, side, keys, sizes[name], null_safe=null_safe).select(*order)
    return fact
