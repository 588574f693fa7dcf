"""Master (dimension) tables, each projected to a fixed column list.

Masters are joined to masters without hints: Spark broadcasts a side below its own size
threshold and otherwise shuffles both, splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions import claim_format_label
from claimlake.operators.joins import salted_join
from claimlake.schemas import MISSING_LABELS

Tables = Mapping[str, DataFrame]


def hospital_keys(hospitals: DataFrame) -> DataFrame:
    """Hospitals with a trimmed key and an upper-case name key, without center 0."""
    return hospitals.select(
        F.trim("center_id").alias("center_id"),
        "center_name",
        "hospital_center_service_reg_no",
        "health_authority",
        F.upper("center_name").alias("center_name_key"),
    ).filter(F.col("center_id") != "0")


def hospitals_with_clusters(tables: Tables) -> DataFrame:
    clusters = tables["clusters"].select(
        F.trim("center_id").alias("center_id"), "cluster_id", "cluster_name",
        F.upper("cluster_name").alias("cluster_sa"),
    )
    return hospital_keys(tables["hospitals"]).join(clusters, "center_id", "left")


def plans_with_categories(tables: Tables) -> DataFrame:
    plans = tables["plans"].select(
        "plan_id", "category_id", "plan_name", "rateplan_rule_id"
    )
    networks = tables["categories"].select("category_id", "category_name")
    return plans.join(networks, "category_id", "left")


def _departments(tables: Tables) -> DataFrame:
    return tables["departments"].select("dept_id", "dept_name")


def licensed_doctors(tables: Tables) -> DataFrame:
    """Doctors that have a licence record, with their department."""
    licences = tables["licences"].select("doctor_id", "doctor_license_number")
    doctors = tables["doctors"].select(
        "doctor_id", "doctor_name", "specialization", "dept_id"
    ).join(licences, "doctor_id")
    return doctors.join(_departments(tables), "dept_id", "left")


def licensed_doctor_dimension(tables: Tables) -> DataFrame:
    """One row for each licensed doctor: of several licences the least number stands."""
    licences = tables["licences"].groupBy("doctor_id").agg(
        F.min("doctor_license_number").alias("doctor_license_number")
    )
    return licensed_doctors({"doctors": tables["doctors"], "departments": tables["departments"], "licences": licences})


def doctors_with_departments(tables: Tables) -> DataFrame:
    return tables["doctors"].join(_departments(tables), "dept_id", "left")


def insurers(tables: Tables) -> DataFrame:
    return tables["insurers"]


def organizations(tables: Tables) -> DataFrame:
    return tables["organizations"].select("org_id", "org_name")


def encounter_types(tables: Tables) -> DataFrame:
    return tables["encounter_types"].select(
        F.col("id").alias("encountertype"), "encounter_type_desc"
    )


def tpa_formats(tables: Tables) -> DataFrame:
    return tables["tpa"].withColumn(
        "claim_format_desc", claim_format_label("claim_format")
    )


def denial_codes(tables: Tables) -> DataFrame:
    return tables["denial_codes"].select(
        F.col("denial_code").alias("latest_denial_code"),
        F.col("code_description").alias("denial_description"),
        F.col("responsibility").alias("denial_responsibility"),
    )


def unlicensed_referrals(tables: Tables) -> DataFrame:
    """Referrals whose clinician is named and holds no known licence.

    As with NOT IN over a list without NULLs, an unnamed clinician never passes
    unless the list is empty, and is dropped.
    """
    named = tables["referrals"].filter(F.col("clinician_id").isNotNull())
    known = tables["licences"].select(
        F.col("doctor_license_number").alias("clinician_id")
    )
    return salted_join(named, known, "clinician_id", "left_anti")


def _placed_doctors(tables: Tables) -> DataFrame:
    """Doctors that have both a licence record and a known department."""
    held = tables["doctors"].select("doctor_id", "doctor_name", "dept_id").join(
        tables["licences"].select("doctor_id", "doctor_license_number"), "doctor_id"
    )
    return held.join(_departments(tables), "dept_id")


def doctor_names(tables: Tables) -> DataFrame:
    """Greatest name per licence and department, and per unlicensed referral."""
    by_licence = (
        _placed_doctors(tables).groupBy("doctor_license_number", "dept_name")
        .agg(F.max("doctor_name").alias("doctor_name"))
    )
    by_referral = (
        unlicensed_referrals(tables)
        .groupBy(F.col("clinician_id").alias("doctor_license_number"))
        .agg(F.max("name").alias("doctor_name"))
        .withColumn("dept_name", F.lit(""))
    )
    return by_licence.unionByName(by_referral)


def doctor_sources(tables: Tables) -> DataFrame:
    """Names by licence, by referral and by doctor id, without repeats."""
    by_id = _placed_doctors(tables).select(
        F.col("doctor_id").alias("doctor_license_number"), "doctor_name", "dept_name"
    )
    return doctor_names(tables).unionByName(by_id).distinct()


def ordering_doctors(tables: Tables) -> DataFrame:
    """Ordering doctors with the greatest department name per name."""
    return doctor_sources(tables).groupBy("doctor_license_number", "doctor_name").agg(
        F.max("dept_name").alias("dept_name")
    )


def fill_missing_labels(
    df: DataFrame, labels: Mapping[str, str] = MISSING_LABELS
) -> DataFrame:
    """Missing dimension labels written out; columns that are absent are skipped."""
    present = {c: v for c, v in labels.items() if c in df.columns}
    return df.fillna(present) if present else df


# Every master set a full run materialises.
MASTER_SETS: dict[str, Callable[[Tables], DataFrame]] = {
    "hospitals": hospitals_with_clusters,
    "insurance": insurers,
    "plans": plans_with_categories,
    "organizations": organizations,
    "encounter_types": encounter_types,
    "tpa": tpa_formats,
    "denial_codes": denial_codes,
    "doctors": licensed_doctors,
    "ordering_doctors": ordering_doctors,
}


def _hospital_record(tables: Tables) -> DataFrame:
    return hospitals_with_clusters(tables).select(
        "center_id", "center_name", "cluster_name", "cluster_sa"
    )


def _plan_record(tables: Tables) -> DataFrame:
    return plans_with_categories(tables).select(
        "plan_id", "category_id", "plan_name", "rateplan_rule_id", "category_name"
    )


def _doctor_record(tables: Tables) -> DataFrame:
    return doctors_with_departments(tables).select(
        "doctor_id", "doctor_name", "dept_id", "dept_name"
    )


def _denial_record(tables: Tables) -> DataFrame:
    return denial_codes(tables).withColumnRenamed("latest_denial_code", "denial_code")


MASTER_RECORDS: dict[str, Callable[[Tables], DataFrame]] = {
    "hospital": _hospital_record,
    "plan": _plan_record,
    "doctor": _doctor_record,
    "denial": _denial_record,
    "encounter": encounter_types,
}


def master_records(tables: Tables, master_type: str) -> DataFrame:
    """One master table by type name, in the shape of its record model."""
    if master_type not in MASTER_RECORDS:
        raise ValueError(f"unknown master type {master_type!r}")
    return MASTER_RECORDS[master_type](tables)
