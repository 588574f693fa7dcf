"""Declared tables: column types, required columns, extract specs and profiles."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import types as T

# The declared column lists, in table order.
CLAIMS_DDL = """
receiverid string, transactiondate string, recordcount string, dispositionflag string,
claimid string not null, idpayer string, memberid string, payerid string,
providerid string, emiratesidnumber string, gross double, patientshare double,
netclaim double, encountertype string, patientid string, encounterstart string,
encounterend string, encounterstarttype string, encounterendtype string,
activityid string, activitystart string, activitytype string, activitycode string,
activityquantity double, activitynet double, orderingclinician string,
clinician string, visit_id string, patient_type string, org_id string,
plan_id string, center_id string, charge_id string, is_primary string,
submission_batch_id string, submission_date timestamp_ntz,
created_date timestamp_ntz, is_resubmission string, insurance_category_id string,
registration_date timestamp_ntz, discharge_date timestamp_ntz,
insurance_co_id string, tpa_id string, bill_open_date timestamp_ntz,
bill_finalized_date timestamp_ntz, is_correction string, primary_icd string,
bill_no string, charge_group string, charge_head string,
act_description_id string, act_quantity string, service_sub_group_id string,
act_description string, op_type string, claim_status string, closure_type string,
chargenet string, chargerecd string, charge_claim_status string,
charge_closure_type string, payee_doctor_id string, prescribing_dr_id string,
admitting_dr_id string, org_sub_seq int, cor_sub_seq int,
is_claim_corrected string, category string, sub_id int,
modified_date timestamp_ntz, claimstatus string, priority int,
audit_control_number string, denial_acceptance_remarks string,
rejection_reason_category_id int, denial_acceptance_date timestamp_ntz,
denial_code string, denial_acceptance_amount double, prior_auth_id string,
is_reconciliation string, encounter_start_date timestamp_ntz,
encounter_end_date timestamp_ntz, update_flag string,
denial_accepted_user string, senderid string, cleaned_activityid string
"""

REMITTANCE_DDL = """
remittance_id int, received_date timestamp_ntz, claim_id string not null,
denial_code string, xml_payment_reference string, received_amount double,
clinician_id string, act_description string, act_quantity double,
activity_id string, activitystart timestamp_ntz, act_rate_plan_item_code string,
code_type string, charge_id string, insurance_claim_amt double,
rej_accepted_amt double, file_name string, reference_no string, org_id int,
customer_number string, transaction_date timestamp_ntz, mod_time timestamp_ntz,
ra_seq int, ra_sub_seq int, bill_no string, ra_id int,
modified_date timestamp_ntz, health_authority string, patient_id string,
first_received timestamp_ntz, second_received timestamp_ntz,
third_received timestamp_ntz
"""

# The validated record models; "not null" marks a required field.
RECORD_DDL = {
    "claim": """
claimid string not null, memberid string not null, gross double not null,
patientshare double not null, netclaim double not null,
encountertype string not null, activitynet double not null,
bill_finalized_date timestamp_ntz not null, claim_status string not null,
center_id string not null, org_sub_seq int, cor_sub_seq int,
is_claim_corrected string, category string, submission_date timestamp_ntz,
is_correction string, activityid string, activitytype string,
activitycode string, doctor_id string, ordering_doc_id string,
insurance_co_id string, plan_id string, tpa_id string, primary_icd string,
visit_id string, encounter_start_date timestamp_ntz, denial_code string,
closure_type string, priority int
""",
    "remittance": """
claim_id string not null, received_amount double not null,
activity_id string not null, transaction_date timestamp_ntz not null,
insurance_claim_amt double not null, org_id int not null, ra_seq int,
denial_code string, xml_payment_reference string, reference_no string,
bill_no string, ra_date timestamp_ntz, ra_year int, ra_month int,
first_received timestamp_ntz, second_received timestamp_ntz,
third_received timestamp_ntz
""",
    "hospital": """
center_id string not null, center_name string not null, cluster_name string,
cluster_sa string
""",
    "plan": """
plan_id string not null, category_id string, plan_name string not null,
rateplan_rule_id string, category_name string
""",
    "doctor": """
doctor_id string not null, doctor_name string not null, dept_id string,
dept_name string
""",
    "denial": """
denial_code string not null, denial_description string not null,
denial_responsibility string
""",
    "encounter": """
encountertype string not null, encounter_type_desc string not null
""",
}


def parse_ddl(ddl: str) -> T.StructType:
    """Schema from a ``name type [not null], ...`` list, without a session."""
    atoms = {
        "string": T.StringType(),
        "double": T.DoubleType(),
        "int": T.IntegerType(),
        "timestamp_ntz": T.TimestampNTZType(),
    }
    fields = []
    for item in ddl.replace("\n", " ").split(","):
        name, kind, *rest = item.split()
        fields.append(T.StructField(name, atoms[kind], nullable=not rest))
    return T.StructType(fields)


CLAIMS = parse_ddl(CLAIMS_DDL)
REMITTANCE = parse_ddl(REMITTANCE_DDL)
RECORDS = {name: parse_ddl(ddl) for name, ddl in RECORD_DDL.items()}

# Columns that identify people, for callers that leave them out of lists of common values.
SENSITIVE = frozenset(
    {"memberid", "emiratesidnumber", "patientid", "patient_id", "idpayer"}
)


@dataclass(frozen=True)
class Profile:
    """Row filter of one environment: a closed date range, member lists, a limit."""

    start: datetime | None = None
    end: datetime | None = None
    members: dict[str, list[Any]] = field(default_factory=dict)
    limit: int | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[str, ...]
    date_column: str | None = None
    numeric_columns: tuple[str, ...] = ()
    key_column: str | None = None
    profiles: dict[str, Profile] = field(default_factory=dict)


_JAN_2024 = (datetime(2024, 1, 1), datetime(2024, 1, 31))

# Configured extracts with their dev / test / prod filters.
TABLE_SPECS = {
    spec.name: spec
    for spec in (
        TableSpec(
            "f_claim_submission",
            (
                "claimid", "memberid", "gross", "patientshare", "netclaim",
                "encountertype", "activitynet", "bill_finalized_date",
                "claim_status", "center_id",
            ),
            date_column="bill_finalized_date",
            numeric_columns=("gross", "patientshare", "netclaim", "activitynet"),
            profiles={
                "dev": Profile(
                    *_JAN_2024,
                    members={
                        "center_id": [1, 2, 3],
                        "claim_status": ["Approved", "Pending"],
                    },
                    limit=1000,
                ),
                "test": Profile(),  # its members belong to the caller
                "prod": Profile(),
            },
        ),
        TableSpec(
            "f_remittance_advice",
            (
                "claim_id", "denial_code", "received_amount", "activity_id",
                "transaction_date", "insurance_claim_amt", "org_id",
            ),
            date_column="transaction_date",
            numeric_columns=("received_amount", "insurance_claim_amt"),
            profiles={
                "dev": Profile(*_JAN_2024, members={"org_id": [1, 2, 3]}, limit=1000),
                "test": Profile(members={"org_id": [1]}, limit=100),
                "prod": Profile(),
            },
        ),
        TableSpec(
            "m_hospital_center_master",
            (
                "center_id", "center_name", "center_code", "city_id", "state_id",
                "country_id",
            ),
            key_column="center_id",
        ),
        TableSpec(
            "m_cluster_master",
            ("cluster_id", "cluster_name", "center_id"),
            key_column="cluster_id",
        ),
    )
}

# Source tables by the names that jobs use, and the columns read of each master
# (none: all of them).
SOURCE_TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "claims": ("f_claim_submission", ()),
    "remittance": ("f_remittance_advice", ()),
    "open_claims": ("f_open_claims", ()),
    "hospitals": ("m_hospital_center_master",
                  ("center_id", "center_name", "hospital_center_service_reg_no", "health_authority")),
    "clusters": ("m_cluster_master", ("cluster_id", "cluster_name", "center_id")),
    "insurers": ("m_insurance_company_master", ()),
    "plans": ("m_insurance_plan_main", ("plan_id", "category_id", "plan_name", "rateplan_rule_id")),
    "categories": ("m_insurance_category_master", ("category_id", "category_name")),
    "organizations": ("m_organization_details", ("org_id", "org_name")),
    "encounter_types": ("m_encounter_type_codes", ("id", "encounter_type_desc")),
    "tpa": ("m_tpa_master", ()),
    "denial_codes": ("m_insurance_denial_codes", ("denial_code", "code_description", "responsibility")),
    "doctors": ("m_doctors", ("doctor_id", "doctor_name", "specialization", "dept_id")),
    "licences": ("m_ha_doc_license_details", ("doctor_id", "doctor_license_number")),
    "departments": ("m_department", ("dept_id", "dept_name")),
    "referrals": ("m_referral", ("clinician_id", "name")),
}

# The facts whose columns are declared, brought to them when they are read from stored sets.
DECLARED = {"claims": CLAIMS, "remittance": REMITTANCE}

# Date column and slice count of the sliced database reads.
SLICED_READS = {
    "claims": ("bill_finalized_date", 50),
    "remittance": ("transaction_date", 50),
}

# Labels written where a dimension label is missing.
MISSING_LABELS = {
    "center_name": "Unknown",
    "center_code": "Unknown",
    "cluster_name": "Unknown",
}


def spec_of(table: str) -> TableSpec:
    try:
        return TABLE_SPECS[table]
    except KeyError:
        raise ValueError(f"no table spec named {table!r}") from None
