"""Composed jobs over a dict of source tables."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions import (
    claim_status_label, clean_activity_id, coerce_integers, coerce_numbers,
    coerce_timestamps,
)
from claimlake.operators.facts import (
    coerce_facts, latest_denial, prepare_claims, prepare_open_claims,
    prepare_remittance, with_advice_dates,
)
from claimlake.operators.heavy import combine, key_counts, split_rows
from claimlake.operators.joins import HEAVY_ROWS
from claimlake.operators.masters import MASTER_SETS, Tables, fill_missing_labels
from claimlake.operators.match import (
    HOSPITAL, Dimensions, claim_dimensions, claims_with_labels, enrich, enrich_claims,
    enrich_open_claims, join_masters, match_claims, matched_labels, ordering_role,
    payment_splits, remittance_with_labels, treating_role, written_dimensions,
)
from claimlake.operators.metrics import (
    center_metrics, claims_with_payments, final_dataset,
)
from claimlake.operators.profiling import full_profile, narrow_types
from claimlake.operators.quality import keys_repeat, observe_checks, validate_records
from claimlake.operators.reports import aggregate_by_center, payments_per_activity
from claimlake.operators.rows import date_range, extract, first_rows, keep_members
from claimlake.schemas import MISSING_LABELS, RECORDS, TableSpec
from claimlake.sources.readers import apply_profile, cache_dims, select_spec
from claimlake.sources.table_sets import TableSet
from claimlake.sources.writers import dated_path, profile_folder, write_profile


# --- center report ---------------------------------------------------------------

def matched_with_status(
    claims: DataFrame, remittance: DataFrame, tables: Tables, how: str = "left"
) -> DataFrame:
    """Matched rows with hospital and doctor labels and the readable status."""
    roles = [HOSPITAL, treating_role("clinician"), ordering_role("orderingclinician")]
    matched = match_claims(claims, remittance, how, payment_splits(tables))
    return enrich(matched, tables, roles).withColumn(
        "new_claim_status", claim_status_label()
    )


def center_report(
    tables: Tables, grain: str = "payment", start: Any = None, end: Any = None,
    members: Mapping[str, Iterable[Any]] | None = None,
    paid_start: Any = None, paid_end: Any = None,
    paid_members: Mapping[str, Iterable[Any]] | None = None,
) -> DataFrame:
    """Figures per center over claims and their payments.

    A claim with several payments counts once for each; ``grain="claim"`` first adds up
    the payments of an activity. ``start`` and ``end`` bound the finalization date,
    ``paid_start`` and ``paid_end`` the transaction date of payments; ``members`` and
    ``paid_members`` keep the listed values of columns of claims and of payments.
    """
    if grain not in ("payment", "claim"):
        raise ValueError(f"unknown grain {grain!r}")
    claims = keep_members(
        date_range(tables["claims"], "bill_finalized_date", start, end), members or {}
    )
    remittance = keep_members(
        date_range(tables["remittance"], "transaction_date", paid_start, paid_end),
        paid_members or {},
    )
    heavy = None
    if grain == "claim":  # one row an activity is left
        remittance = payments_per_activity(remittance)
    else:
        heavy = payment_splits(tables)
    matched = match_claims(claims, remittance, "left", heavy)
    # The report shows no doctor and no status, so neither is attached.
    return aggregate_by_center(center_metrics(enrich(matched, tables, [HOSPITAL])))


# --- extracts --------------------------------------------------------------------

def claims_extract(
    tables: Tables, start: Any, end: Any,
    members: Mapping[str, Iterable[Any]] | None = None, limit: int | None = None,
    mode: str = "quarantine", folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Labelled claims of a closed date range: (fitting rows, quarantine).

    With a ``folder`` the extract is evaluated once, written there and both results read from it.
    Only payments of the claims in the range are looked at.
    """
    prepared = prepare_claims(tables["claims"]).withColumn("doctor_id", F.col("doc_id"))
    rows = extract(
        prepared, "bill_finalized_date", start, end, members, limit,
        ["bill_finalized_date", "claimid", "activityid"],
    )
    wanted = rows.select(F.col("claimid").alias("claim_id"), F.col("activityid").alias("activity_id")).distinct()
    paid = tables["remittance"].join(wanted, ["claim_id", "activity_id"], "left_semi")
    labelled = claims_with_labels(rows, paid, tables)
    typed = coerce_timestamps(
        coerce_numbers(labelled, ["gross", "patientshare", "netclaim", "activitynet"]),
        ["bill_finalized_date", "submission_date", "encounter_start_date"],
    )
    return validate_records(typed, RECORDS["claim"], mode, folder)


def remittance_extract(
    tables: Tables, start: Any, end: Any,
    members: Mapping[str, Iterable[Any]] | None = None, limit: int | None = None,
    mode: str = "quarantine", folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Labelled payments of a closed date range: (fitting rows, quarantine).

    Received dates look at all payments of an activity, in the range or not. With a ``folder``
    the extract is evaluated once, written there and both results read from it.
    """
    remittance = tables["remittance"]
    rows = extract(
        remittance, "transaction_date", start, end, members, limit,
        ["transaction_date", "claim_id", "activity_id", "ra_seq"],
    )
    labelled = with_advice_dates(remittance_with_labels(rows, remittance, tables))
    dates = ["transaction_date", "ra_date", "first_received", "second_received",
             "third_received"]
    typed = coerce_numbers(labelled, ["received_amount", "insurance_claim_amt"])
    typed = coerce_integers(coerce_timestamps(typed, dates), ["ra_year", "ra_month"])
    return validate_records(typed, RECORDS["remittance"], mode, folder)


def matched_extract(
    tables: Tables, start: Any, end: Any, orgs: Iterable[int] = (),
    limit: int | None = None,
) -> DataFrame:
    """Paid claims with labels and basic status. The date range is that of the
    payment, the organizations are those of the claim."""
    # The denial code reported is that of the payment, not of the claim.
    claims = keep_members(tables["claims"].drop("denial_code"), {"org_id": orgs}).withColumns(
        {
            "cleaned_activityid": clean_activity_id("activityid"),
            "doctor_id": F.coalesce("clinician", "orderingclinician"),
        }
    )
    paid = date_range(tables["remittance"], "transaction_date", start, end, "both")
    matched = matched_labels(match_claims(claims, paid, "inner", payment_splits(tables)), tables)
    out = matched.withColumns(
        {
            "new_claim_status": claim_status_label("basic"),
            "activityid": F.col("cleaned_activityid"),
        }
    ).drop("cleaned_activityid")
    return first_rows(
        out, limit, ["transaction_date", "claimid", "activityid", "ra_seq"]
    )


# --- full run --------------------------------------------------------------------

def label_facts(
    scored: DataFrame, open_claims: DataFrame, tables: Tables, dims: Dimensions, slim: DataFrame | None = None,
) -> DataFrame:
    """Scored claims and open claims with their labels, as the final dataset.

    ``slim``: the claims before their totals were joined, if they lie together by claim."""
    opened = open_claims.withColumn("encounterstart_date", F.col("encounter_start_date"))
    return final_dataset(
        enrich_claims(scored, tables, dims, slim), enrich_open_claims(opened, tables, dims)
    )


def score_facts(
    claims: DataFrame, remittance: DataFrame, open_claims: DataFrame, tables: Tables
) -> DataFrame:
    """Prepared facts as the final dataset.

    Totals are joined before labels, so that the load check and the shuffle see the
    claims as they are stored; the labels are attached to both kinds of claim after.
    """
    scored = claims_with_payments(claims, remittance)
    return label_facts(scored, open_claims, tables, claim_dimensions(tables), slim=claims)


def build_final_dataset(tables: Tables) -> DataFrame:
    """Enriched claims with totals and payment status, and the open claims."""
    return score_facts(
        prepare_claims(tables["claims"]), tables["remittance"],
        prepare_open_claims(tables["open_claims"]), tables,
    )


# Masters that several sets are built from.
SHARED_MASTERS = ("doctors", "licences", "departments")
# Fixed value: buckets of the stored facts.
FACT_BUCKETS = 200


def write_sets(
    spark: SparkSession, tables: Tables, out: str, buckets: int = FACT_BUCKETS,
    heavy_rows: int = HEAVY_ROWS,
) -> TableSet:
    """Write the four fact sets and the nine master sets of a run, all or none.

    Every source is read once. Claims and remittance are bucketed and sorted by claim, so that
    joins and totals by claim need no exchange of them. Claims that hold more than ``heavy_rows``
    rows of either lie beside the buckets, in files that many tasks share.
    """
    store = TableSet(spark, out)
    kept = cache_dims({name: tables[name] for name in SHARED_MASTERS})
    sources = ChainMap(kept, tables)
    try:
        with store.commit() as commit:
            facts = {
                "claims": ("claimid", commit.scratch(prepare_claims(sources["claims"]), "claims")),
                "remittance": ("claim_id", commit.scratch(
                    prepare_remittance(sources["remittance"], row_key=True), "remittance")),
            }
            heavy = _heavy_claims(facts.values(), heavy_rows)
            for name, (key, rows) in facts.items():
                light, rest = (rows, None) if heavy is None else split_rows(rows, heavy, key)
                commit.write_bucketed(name, light, f"fact_data/{name}.parquet", key, buckets, rest)
            denials = latest_denial(facts["remittance"][1])
            commit.write("latest_denials", denials, "fact_data/latest_denials.parquet")
            opened = prepare_open_claims(sources["open_claims"])
            commit.write("open_claims", opened, "fact_data/open_claims.parquet")
            for name, build in MASTER_SETS.items():
                commit.write(name, build(sources), f"master_data/{name}.parquet")
    finally:
        for master in kept.values():
            master.unpersist()
    return store


def _heavy_claims(facts: Iterable[tuple[str, DataFrame]], heavy_rows: int) -> DataFrame | None:
    """Ids of claims that hold more rows of a fact than one task should take."""
    counted = [
        combine(key_counts(rows, [key], heavy_rows=heavy_rows)).filter(F.col("n") > heavy_rows).select(F.col(key).alias("id"))
        for key, rows in facts
    ]
    ids = [r[0] for r in reduce(DataFrame.union, counted).distinct().collect()]  # one for each heavy_rows rows
    if not ids:
        return None
    return counted[0].sparkSession.createDataFrame([(i,) for i in ids], "id string")


def materialise(
    tables: Tables, out: str, buckets: int = FACT_BUCKETS, heavy_rows: int = HEAVY_ROWS,
) -> dict[str, DataFrame]:
    """Write the four fact sets and the nine master sets; returns them as read back."""
    store = write_sets(tables["claims"].sparkSession, tables, out, buckets, heavy_rows)
    return {name: store.read(name) for name in store.entries()}


def score_sets(store: TableSet) -> DataFrame:
    """The final dataset of the sets that a run has written, labels from its master sets.

    Claims in buckets meet their payments without an exchange of either; those beside the buckets
    are joined and added up by ordinary shuffles.
    """
    scored = claims_with_payments(store.bucketed("claims"), store.bucketed("remittance"))
    claims, remittance = store.rest("claims"), store.rest("remittance")
    if claims is not None and remittance is not None:
        scored = scored.unionByName(claims_with_payments(claims, remittance))
    return label_facts(scored, store.read("open_claims"), {}, written_dimensions(store.read))


def run_claims(
    spark: SparkSession, tables: Tables, out: str, buckets: int = FACT_BUCKETS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Full claims run: materialise, enrich, score, write by year and month.

    What follows the sources is computed from the sets just written. Readers of the table set see
    the former final dataset until the new one is complete. The session is the caller's and stays
    open.
    """
    store = write_sets(spark, tables, out, buckets, heavy_rows)
    with store.commit() as commit:
        final = commit.write_partitioned(
            "final_dataset", score_sets(store), "transformed_data/final_dataset.parquet")
    return final


# --- generic load ----------------------------------------------------------------

@dataclass(frozen=True)
class LoadPlan:
    """What a generic load reads, joins, checks and writes.

    ``environment`` names a profile of the specs: facts that declare it keep its rows only.
    ``target`` is "parquet" (``<table>_<day>.parquet``) or "csv" (``transformed_<table>.csv``,
    masters too).
    """

    facts: tuple[TableSpec, ...]
    masters: tuple[TableSpec, ...] = ()
    joins: Mapping[str, Mapping[str, str | list[str]]] = field(default_factory=dict)
    required: Mapping[str, list[str]] = field(default_factory=dict)
    keys: Mapping[str, list[str]] = field(default_factory=dict)
    strict: bool = False
    profiles: bool = False
    environment: str | None = None
    target: str = "parquet"


def transform_tables(tables: Tables, plan: LoadPlan) -> dict[str, DataFrame]:
    """Facts projected, filtered, typed, joined to filled masters, integers narrowed.

    A CSV target gets the filled masters as tables of their own besides.
    """
    facts = {s.name: select_spec(tables[s.name], s) for s in plan.facts}
    for s in plan.facts:
        if plan.environment is not None and plan.environment in s.profiles:
            facts[s.name] = apply_profile(facts[s.name], s, plan.environment)
    masters = {
        s.name: fill_missing_labels(select_spec(tables[s.name], s), MISSING_LABELS)
        for s in plan.masters
    }
    typed = coerce_facts(facts, plan.facts)
    out = {
        name: narrow_types(join_masters(df, masters, plan.joins.get(name, {})))
        for name, df in typed.items()
    }
    return out | masters if plan.target == "csv" else out


def load_if_sound(
    spark: SparkSession, tables: Mapping[str, DataFrame], out: str, plan: LoadPlan,
    day: date | None = None,
) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Write every table if all checks of all tables pass, else none.

    Returns the paths written and the checks that failed. Rows and holes are counted while a
    table is written; only a check of keys reads it again. The manifest of the table set in
    ``out`` names the new tables last and at once: until then, and if anything fails, its readers
    see the former ones, and what was written is removed.
    """
    if plan.target not in ("parquet", "csv"):
        raise ValueError(f"unknown target {plan.target!r}")
    store, failed = TableSet(spark, out), []
    with store.commit() as commit:
        staged = {}
        for name, df in tables.items():
            watched, results = observe_checks(df, plan.required.get(name, ()), plan.strict)
            if plan.target == "csv":
                staged[name] = commit.scratch(watched, name)
            else:
                staged[name] = commit.write(name, watched, dated_path("", name, day).lstrip("/"))
            found = results() | {"unique_keys": not keys_repeat(staged[name], plan.keys.get(name, ()))}
            failed += [(name, check) for check, passed in found.items() if not passed]
        if failed:
            commit.undo()
            return {}, sorted(failed)
        if plan.target == "csv":
            for name, df in staged.items():
                commit.write(name, df, f"transformed_{name}.csv", kind="csv")
        if plan.profiles:
            for name, df in staged.items():
                folder = commit.fresh(profile_folder("", name, day).lstrip("/"))
                write_profile(full_profile(df), store.location(folder))
    paths = store.paths()
    return {name: paths[name] for name in tables}, []


def run_load(
    spark: SparkSession, tables: Tables, out: str, plan: LoadPlan,
    day: date | None = None,
) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Generic load: project, filter, type, join, narrow, check, profile, write."""
    return load_if_sound(spark, transform_tables(tables, plan), out, plan, day)
