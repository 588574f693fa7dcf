"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake import functions as cf
from claimlake.operators import facts, masters, match, metrics, outliers
from claimlake.operators import profiling, quality, reports, rows
from claimlake.plans import jobs
from claimlake.schemas import CLAIMS, RECORDS, REMITTANCE, TableSpec, spec_of
from claimlake.sources import readers
from claimlake.sources.driver_tables import ClaimsTables, scan

Tables = Mapping[str, DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

ACTIVITY = ["claimid", "activityid"]
PAYMENT = ["claim_id", "activity_id", "ra_seq"]


def on_claims_tables(name: str):
    """Register a query over the claims-shaped tables."""
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(ClaimsTables(spark, sf_dir))
        return build
    return register


def on_scans(name: str):
    """Register a query over the tables as they are stored."""
    def register(build: Query):
        QUERIES[name] = build
        return build
    return register


def _claims_with(**columns):
    return lambda t: t["claims"].select(
        *ACTIVITY, *[build().alias(n) for n, build in columns.items()]
    )


def _payments_with(**columns):
    return lambda t: t["remittance"].select(
        *PAYMENT, *[build().alias(n) for n, build in columns.items()]
    )


# --- sources ---------------------------------------------------------------------

@on_claims_tables("s3_date_slices")
def _(t):
    number = readers.slice_number("bill_finalized_date", "1992-01-01", "1999-01-01", 50)
    return t["claims"].groupBy(number.alias("slice")).agg(
        F.count(F.lit(1)).alias("n")
    ).filter("slice IS NOT NULL")


@on_claims_tables("s4_spec_scan")
def _(t):
    return readers.select_spec(t["claims"], spec_of("f_claim_submission"))


@on_claims_tables("s5_profile_dev")
def _(t):
    spec = spec_of("f_claim_submission")
    return readers.apply_profile(
        readers.select_spec(t["claims"], spec), spec, "dev",
        {"start": "1995-01-01", "end": "1995-12-31", "limit": 150,
         "members": {"center_id": [1, 2, 3], "claim_status": ["C", "S"]}},
    )


@on_claims_tables("s5_profile_test")
def _(t):
    spec = spec_of("f_remittance_advice")
    return readers.apply_profile(
        readers.select_spec(t["remittance"], spec), spec, "test"
    )


@on_claims_tables("s6_extract")
def _(t):
    order = ["bill_finalized_date", *ACTIVITY]
    return rows.extract(
        t["claims"].select(*order, "center_id", "claim_status", "netclaim"),
        "bill_finalized_date", "1994-01-01", "1996-12-31",
        {"center_id": ["1", "5", "7"], "claim_status": ["C", "N"]}, 200, order,
    )


@on_claims_tables("s8_conform_claims")
def _(t):
    return readers.conform(t["claims"], CLAIMS)


@on_claims_tables("s8_conform_remittance")
def _(t):
    return readers.conform(t["remittance"], REMITTANCE)


@on_scans("s9_parquet_scan")
def _(spark, sf_dir):
    orders = readers.read_parquet(
        spark, f"{sf_dir}/orders.parquet",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"],
    )
    return orders.filter("o_orderstatus = 'F'")


# --- projections and predicates --------------------------------------------------

on_claims_tables("p1_clean_activity_id")(
    _claims_with(cleaned_activityid=lambda: cf.clean_activity_id("activityid"))
)
on_claims_tables("p2_encounter_start_date")(
    _claims_with(encounterstart_date=lambda: cf.day_of("encounterstart"))
)
on_claims_tables("p3_evaluation_code")(
    _claims_with(EM=lambda: cf.evaluation_code("activitycode"))
)
on_claims_tables("p4_dxb_consult_code")(
    _claims_with(DXBConsult=lambda: cf.dxb_consult_code("activitycode"))
)
on_claims_tables("p5_consult_code")(
    _claims_with(Consult=lambda: cf.consult_code("activitycode"))
)
on_claims_tables("p6_treating_doctor")(_claims_with(doc_id=lambda: cf.treating_doc_id()))
on_claims_tables("p7_ordering_doctor")(
    _claims_with(ordering_doc_id=lambda: cf.ordering_doc_id())
)


@on_claims_tables("p8_open_claim_doctors")
def _(t):
    return facts.prepare_open_claims(t["open_claims"]).select(
        "claimid", "ordering_doc_id", "doctor_id"
    )


@on_claims_tables("p9_open_claim_constants")
def _(t):
    return facts.prepare_open_claims(t["open_claims"]).select(
        "claimid", *facts.OPEN_CLAIM_CONSTANTS
    )


@on_claims_tables("p10_advice_dates")
def _(t):
    return facts.with_advice_dates(t["remittance"]).select(
        *PAYMENT, "ra_date", "ra_year", "ra_month"
    )


@on_claims_tables("p11_row_received")
def _(t):
    return facts.with_row_received(t["remittance"]).select(
        *PAYMENT, "first_received", "second_received", "third_received"
    )


@on_claims_tables("p12_row_key")
def _(t):
    keyed = facts.with_row_key(t["remittance"])
    return keyed.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys")
    )


@on_claims_tables("p12_stable_row_key")
def _(t):
    return rows.with_row_numbers(t["remittance"].select(*PAYMENT, "received_amount"), PAYMENT)


@on_claims_tables("p13_open_claim_dates")
def _(t):
    return facts.prepare_open_claims(t["open_claims"]).select(
        "claimid", "encounter_start_date", "enc_date", "enc_year", "enc_month"
    )


@on_claims_tables("p14_hospital_keys")
def _(t):
    return masters.hospital_keys(t["hospitals"])


on_claims_tables("p15_tpa_format")(masters.tpa_formats)
on_claims_tables("p16_organizations")(masters.organizations)
on_claims_tables("p16_encounter_types")(masters.encounter_types)
on_claims_tables("p16_denial_codes")(masters.denial_codes)
on_claims_tables("p16_insurers")(masters.insurers)


def _status(ruleset: str):
    def build(t):
        matched = match.match_claims(t["claims"], t["remittance"], "left")
        return matched.select(
            *ACTIVITY, "ra_seq", cf.claim_status_label(ruleset).alias("new_claim_status")
        )
    return build


on_claims_tables("p17_status_full")(_status("full"))
on_claims_tables("p17_status_basic")(_status("basic"))


@on_claims_tables("p18_payment_status")
def _(t):
    return metrics.claims_with_payments(_dated(t["claims"]), t["remittance"]).select(
        *ACTIVITY,
        cf.payment_status("total_paid_amount", "total_claim_amount")
        .alias("payment_status"),
    )


def _dated(claims: DataFrame) -> DataFrame:
    return claims.withColumn("encounterstart_date", cf.day_of("encounterstart"))


@on_claims_tables("p19_members")
def _(t):
    kept = rows.keep_members(
        t["claims"],
        {"center_id": ["3", "4"], "org_id": [1, 2], "claim_status": ["C", "S"],
         "claimid": []},
    )
    return kept.select(*ACTIVITY, "center_id", "org_id", "claim_status")


def _ranged(closed: str):
    def build(t):
        kept = rows.date_range(
            t["remittance"], "transaction_date", "1994-01-01", "1995-06-01", closed
        )
        return kept.select(*PAYMENT, "transaction_date")
    return build


on_claims_tables("p20_date_range_half_open")(_ranged("left"))
on_claims_tables("p20_date_range_closed")(_ranged("both"))


@on_claims_tables("p21_present")
def _(t):
    return rows.keep_present(t["remittance"], "denial_code").select(
        *PAYMENT, "denial_code"
    )


@on_claims_tables("p22_numeric_coercion")
def _(t):
    texts = t["claims"].select(*ACTIVITY, "center_id", F.col("activityid").alias("code"))
    return cf.coerce_numbers(texts, ["center_id", "code", "not_there"])


@on_claims_tables("p23_timestamp_coercion")
def _(t):
    iso = F.date_format("bill_finalized_date", "yyyy-MM-dd HH:mm:ss")
    mixed = F.when(F.col("org_id") < 2, iso).otherwise(F.col("encounterstart"))
    return cf.coerce_timestamps(
        t["claims"].select(*ACTIVITY, mixed.alias("seen_at")), ["seen_at"]
    )


@on_claims_tables("p24_strict_dates")
def _(t):
    return cf.convert_dates(
        t["claims"].select(*ACTIVITY, "encounterstart"), ["encounterstart"], "dd/MM/yyyy"
    )


@on_claims_tables("p25_missing_labels")
def _(t):
    labelled = match.enrich(t["claims"], t, [match.HOSPITAL])
    return masters.fill_missing_labels(labelled).select(
        *ACTIVITY, "center_name", "cluster_name"
    )


@on_claims_tables("p26_integer_coercion")
def _(t):
    year = F.year("transaction_date").cast("string")
    text = F.when(F.col("org_id") == 0, "n/a").otherwise(year)
    return cf.coerce_integers(
        t["remittance"].select(*PAYMENT, text.alias("ra_year")), ["ra_year"]
    )


# --- metrics ---------------------------------------------------------------------

on_claims_tables("m1_reimbursement_rate")(
    _claims_with(reimbursement_rate=lambda: cf.reimbursement_rate())
)
on_claims_tables("m2_patient_share_pct")(
    _claims_with(patient_share_pct=lambda: cf.patient_share_pct())
)
on_claims_tables("m3_days_to_finalize")(
    _claims_with(days_to_finalize=lambda: cf.days_to_finalize())
)
on_claims_tables("m4_payment_ratio")(_payments_with(payment_ratio=lambda: cf.payment_ratio()))
on_claims_tables("m5_is_full_payment")(
    _payments_with(is_full_payment=lambda: cf.is_full_payment(cf.payment_ratio()))
)
on_claims_tables("m6_is_denied")(_payments_with(is_denied=lambda: cf.is_denied()))


def _matched_with(**columns):
    def build(t):
        matched = match.match_claims(t["claims"], t["remittance"], "left")
        return matched.select(
            *ACTIVITY, "ra_seq", *[build().alias(n) for n, build in columns.items()]
        )
    return build


on_claims_tables("m7_payment_efficiency")(
    _matched_with(payment_efficiency=lambda: cf.payment_efficiency())
)
on_claims_tables("m8_days_to_payment")(
    _matched_with(elapsed=lambda: cf.days_to_payment("elapsed"),
                  calendar=lambda: cf.days_to_payment("calendar"))
)
on_claims_tables("m9_is_delayed_payment")(
    _matched_with(late=lambda: cf.is_delayed_payment(cf.days_to_payment("calendar")),
                  very_late=lambda: cf.is_delayed_payment(cf.days_to_payment("calendar"), 365))
)
on_claims_tables("m10_write_off_amount")(
    _matched_with(write_off_amount=lambda: cf.write_off_amount())
)


def _scored(*columns: str):
    def build(t):
        scored = metrics.claims_with_payments(_dated(t["claims"]), t["remittance"])
        return scored.select(*ACTIVITY, *columns)
    return build


on_claims_tables("m11_rejection_rate")(_scored("rejection_rate"))
on_claims_tables("m12_processing_days")(_scored("processing_days"))
on_claims_tables("m13_claim_payment_ratio")(_scored("payment_ratio"))


# --- joins -----------------------------------------------------------------------

on_claims_tables("j1_hospitals_clusters")(masters.hospitals_with_clusters)
on_claims_tables("j2_plans_categories")(masters.plans_with_categories)
on_claims_tables("j3_licensed_doctors")(masters.licensed_doctors)
on_claims_tables("j4_doctors_departments")(masters.doctors_with_departments)


@on_claims_tables("j5_claims_labels")
def _(t):
    prepared = facts.prepare_claims(t["claims"]).withColumn("doctor_id", F.col("doc_id"))
    return match.claims_with_labels(prepared, t["remittance"], t).select(
        *ACTIVITY, "center_name", "cluster_name", "plan_name", "category_name",
        "doctor_name", "doctor_dept", "ordering_doctor_name", "ordering_doctor_dept",
        "encounter_type_desc", "latest_denial_code", "denial_description",
        "denial_responsibility",
    )


@on_claims_tables("j6_remittance_labels")
def _(t):
    paid = t["remittance"]
    return match.remittance_with_labels(paid, paid, t).select(
        *PAYMENT, "first_received", "second_received", "third_received",
        "denial_description", "denial_responsibility",
    )


def _match(how: str):
    def build(t):
        return match.match_claims(t["claims"], t["remittance"], how).select(
            *ACTIVITY, "cleaned_activityid", "netclaim", "ra_seq", "received_amount",
            "transaction_date", "org_id", "ra_org_id",
        )
    return build


on_claims_tables("j7_match_left")(_match("left"))
on_claims_tables("j7_match_inner")(_match("inner"))


@on_claims_tables("j7_match_conformed")
def _(t):
    """The match over claims brought to their declared columns first."""
    rows = match.match_claims(readers.conform(t["claims"], CLAIMS), t["remittance"])
    return rows.select(*ACTIVITY, "cleaned_activityid", "netclaim", "ra_seq", "received_amount",
                       "transaction_date")


@on_claims_tables("j8_doctor_roles")
def _(t):
    return match.with_doctor_roles(t["claims"], t).select(
        *ACTIVITY, "doctor_name", "doctor_dept", "ordering_doctor_name",
        "ordering_doctor_dept",
    )


ENRICHED = ["center_name", "cluster_name", "insurance_co_name", "plan_name",
            "category_name", "doctor_name", "doctor_dept", "ordering_doctor_name",
            "ordering_doctor_dept"]


@on_claims_tables("j9_enrich_claims")
def _(t):
    return match.enrich_claims(facts.prepare_claims(t["claims"]), t).select(
        *ACTIVITY, *ENRICHED, "encounter_type_desc"
    )


@on_claims_tables("j10_enrich_remittance")
def _(t):
    return match.enrich_remittance(t["remittance"], t).select(
        *PAYMENT, "denial_code", "denial_description", "denial_responsibility"
    )


@on_claims_tables("j11_enrich_open_claims")
def _(t):
    opened = facts.prepare_open_claims(t["open_claims"])
    return match.enrich_open_claims(opened, t).select("claimid", *ENRICHED)


on_claims_tables("j12_claim_payments")(
    _scored("total_claim_amount", "total_approved_amount", "total_paid_amount",
            "denial_count")
)


@on_claims_tables("j13_join_masters")
def _(t):
    names = {"m_org": t["organizations"], "m_insurer": t["insurers"],
             "m_plan": t["plans"].withColumn("netclaim", F.lit(1.0))}
    mapping = {"m_org": "org_id", "m_insurer": ["insurance_co_id"], "m_plan": "plan_id",
               "m_absent": "tpa_id"}
    facts_ = t["claims"].select(*ACTIVITY, "org_id", "insurance_co_id", "plan_id", "netclaim")
    return match.join_masters(facts_, names, mapping)


@on_claims_tables("j13_join_masters_null_safe")
def _(t):
    clinicians = t["claims"].select(*ACTIVITY, F.col("clinician").alias("doctor_id"))
    some = F.when(F.col("doctor_id") != "S1", F.col("doctor_id"))
    named = t["doctors"].select(some.alias("doctor_id"), "doctor_name")
    return match.join_masters(clinicians, {"m": named}, {"m": "doctor_id"}, null_safe=True)


on_claims_tables("j14_unlicensed_referrals")(masters.unlicensed_referrals)


# --- aggregations ----------------------------------------------------------------

def _center_rows(t):
    return metrics.matched_metrics(match.match_claims(t["claims"], t["remittance"], "left"))


on_claims_tables("a1_center_kpis")(jobs.center_report)
on_claims_tables("a2_center_statistics")(lambda t: reports.center_statistics(_center_rows(t)))


def _denials(t):
    # Only payments with a code are reported: the rest is not shuffled.
    denied = rows.keep_present(t["remittance"], "denial_code")
    return reports.denial_patterns(match.match_claims(t["claims"], denied, "inner"))


on_claims_tables("a3_denial_patterns")(_denials)
on_claims_tables("a4_received_dates")(lambda t: facts.received_dates(t["remittance"]))
on_claims_tables("a5_ordering_doctors")(masters.ordering_doctors)


@on_claims_tables("a6_aggregate")
def _(t):
    spread = reports.aggregate(
        t["claims"], ["center_id", "claim_status"],
        {"gross": ["sum", "mean", "min", "max", "std", "var", "median"],
         "clinician": ["count", "nunique"], "activitycode": ["first", "last"]},
        order_by=["bill_finalized_date", "claimid", "activityid"],
    )
    rounded = {f"gross_{f}": _settled(f"gross_{f}") for f in ("sum", "mean", "std", "median")}
    rounded["gross_var"] = _settled("gross_var", 2)
    return spread.withColumns(rounded)


def _settled(column: str, places: int = 4):
    """Rounded after the noise of a double sum is cut off."""
    return F.round(F.col(column).cast("decimal(28,8)"), places).cast("double")


on_claims_tables("a7_doctor_names")(masters.doctor_names)
on_claims_tables("a8_remittance_per_claim")(
    lambda t: metrics.remittance_per_claim(t["remittance"])
)


# --- windows ---------------------------------------------------------------------

on_claims_tables("w1_latest_denial")(lambda t: facts.latest_denial(t["remittance"]))


@on_claims_tables("w2_claim_totals")
def _(t):
    totals = metrics.match_with_totals(t["claims"], t["remittance"])
    return totals.select(*ACTIVITY, "ra_seq", "netclaim", "received_amount",
                         "total_claim_amount", "total_approved_amount")


@on_claims_tables("w2_claim_totals_of_rows")
def _(t):
    return metrics.with_claim_totals(
        t["remittance"].select(*PAYMENT, F.col("insurance_claim_amt"), "received_amount"),
        key="claim_id", claimed="insurance_claim_amt",
    )


@on_claims_tables("w3_total_paid")
def _(t):
    paid = t["remittance"].select(*PAYMENT, "received_amount")
    return metrics.with_total_paid(paid)


@on_claims_tables("w4_denial_count")
def _(t):
    paid = t["remittance"].select(*PAYMENT, "denial_code")
    return metrics.with_denial_count(paid)


# --- sorts, limits, sets ---------------------------------------------------------

@on_claims_tables("l1_ranked_denials")
def _(t):
    counts = t["remittance"].filter("denial_code IS NOT NULL").groupBy("denial_code").agg(
        F.count(F.lit(1)).alias("denied_claims")
    )
    return reports.rank_denials(counts)


@on_claims_tables("l2_first_rows")
def _(t):
    columns = t["claims"].select(*ACTIVITY, "bill_finalized_date", "gross")
    return rows.first_rows(columns, 100, ["bill_finalized_date", *ACTIVITY])


@on_scans("l3_most_common")
def _(spark, sf_dir):
    return profiling.most_common(scan(spark, sf_dir, "part"))


on_claims_tables("u1_doctor_sources")(masters.doctor_sources)


@on_claims_tables("u2_append_open_claims")
def _(t):
    claims = t["claims"].select(*ACTIVITY, "center_id", "plan_id", "gross", "claim_status")
    return metrics.append_open_claims(claims, facts.prepare_open_claims(t["open_claims"]))


# --- quality ---------------------------------------------------------------------

@on_claims_tables("q1_check_schema")
def _(t):
    return quality.check_schema(
        t["claims"],
        ["claimid", "clinician", "orderingclinician", "org_sub_seq", "gross", "visit_id",
         "payee_doctor_id"],
        nullable=["payee_doctor_id"],
    )


@on_claims_tables("q2_type_report")
def _(t):
    return quality.type_report(t["claims"], {
        "claimid": "string", "gross": "double", "org_sub_seq": "int", "activitycode": "int",
        "center_id": "int", "visit_id": "string", "clinician": "double",
    })


def _checked(t):
    return quality.check_tables(
        {"claims": t["claims"], "remittance": t["remittance"], "doctors": t["doctors"]},
        required={"claims": ["claimid", "gross"], "remittance": ["claim_id", "denial_code"],
                  "doctors": ["doctor_id", "licence"]},
        keys={"claims": ["claimid", "activityid"], "remittance": ["claim_id", "activity_id"]},
    )


on_claims_tables("q3_check_tables")(_checked)
on_claims_tables("q4_load_gate")(lambda t: quality.load_gate(_checked(t)))


@on_claims_tables("q6_written_table")
def _(t):
    spec = spec_of("f_claim_submission")
    columns = [*spec.columns, "audit_control_number"]
    return quality.check_written(readers.select_spec(t["claims"], spec), spec.name, columns)


def _flawed(t):
    return t["claims"].select(
        "claimid", "activityid", F.when(F.col("clinician").isNotNull(), F.col("memberid"))
        .alias("memberid"),
        F.when(F.col("org_id") == 4, "n/a").otherwise(F.col("gross").cast("string"))
        .alias("gross"),
        "patientshare", "netclaim", "encountertype", "activitynet", "bill_finalized_date",
        "claim_status", "center_id", F.col("activitycode").alias("org_sub_seq"),
    )


@on_claims_tables("q5_quarantine")
def _(t):
    _, bad = quality.validate_records(_flawed(t), RECORDS["claim"])
    return bad.select(*ACTIVITY, F.concat_ws("; ", "reasons").alias("reasons"))


@on_claims_tables("q5_valid_records")
def _(t):
    flawed = _flawed(t).withColumn("org_sub_seq", F.lit(None).cast("string"))
    good, _ = quality.validate_records(flawed, RECORDS["claim"])
    return good.select(*ACTIVITY, "memberid", "gross", "netclaim", "center_id")


# --- profiles --------------------------------------------------------------------

@on_scans("q7_table_profile")
def _(spark, sf_dir):
    return profiling.table_profile(scan(spark, sf_dir, "lineitem"))


@on_scans("q7_table_profile_repeats")
def _(spark, sf_dir):
    pairs = scan(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return profiling.table_profile(pairs)


@on_scans("q8_column_profile")
def _(spark, sf_dir):
    profile = profiling.column_profile(scan(spark, sf_dir, "lineitem"))
    return profile.withColumns(
        {c: F.round(c, 6) for c in ("null_percentage", "distinct_percentage")}
    )


@on_claims_tables("q8_column_profile_nulls")
def _(t):
    some = t["claims"].select("clinician", "org_sub_seq", "gross", "payee_doctor_id")
    return profiling.column_profile(some).withColumns(
        {c: F.round(c, 6) for c in ("null_percentage", "distinct_percentage")}
    )


@on_scans("q9_numeric_profile")
def _(spark, sf_dir):
    profile = profiling.numeric_profile(scan(spark, sf_dir, "lineitem"))
    return profile.withColumns(
        {c: F.round(c, 4) for c in profile.columns if c != "column_name"}
    )


@on_scans("q10_string_profile")
def _(spark, sf_dir):
    profile = profiling.string_profile(scan(spark, sf_dir, "orders"))
    return profile.withColumn("avg_length", F.round("avg_length", 6))


@on_scans("q11_correlations")
def _(spark, sf_dir):
    pairs = profiling.correlations(scan(spark, sf_dir, "lineitem"))
    return pairs.withColumn("correlation", F.round("correlation", 6))


@on_scans("q12_narrowing_advice")
def _(spark, sf_dir):
    return profiling.narrowing_advice(scan(spark, sf_dir, "orders"))


@on_scans("t1_narrow_types")
def _(spark, sf_dir):
    return profiling.narrow_types(scan(spark, sf_dir, "lineitem"))


def _outlier_input(t):
    return t["claims"].select(*ACTIVITY, "gross", "netclaim", "patientshare")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


@on_claims_tables("t2_iqr_clip")
def _(t):
    clipped = outliers.clip_outliers(_outlier_input(t), ["gross", "patientshare"], 0.5)
    return _rounded(clipped, "gross", "patientshare")


@on_claims_tables("t3_zscore_replace")
def _(t):
    replaced = outliers.replace_outliers(_outlier_input(t), ["gross", "netclaim"], 1.5)
    return _rounded(replaced, "gross", "netclaim")


@on_scans("b15_full_profile")
def _(spark, sf_dir):
    profile = profiling.profile_rows(profiling.full_profile(scan(spark, sf_dir, "orders")))
    return profile.withColumn("number", F.round("number", 4))


# --- composed jobs ---------------------------------------------------------------

@on_claims_tables("b1_prepare_claims")
def _(t):
    return facts.prepare_claims(t["claims"])


@on_claims_tables("b2_prepare_remittance")
def _(t):
    return facts.prepare_remittance(t["remittance"])


@on_claims_tables("b3_prepare_open_claims")
def _(t):
    return facts.prepare_open_claims(t["open_claims"])


on_claims_tables("b5_final_dataset")(jobs.build_final_dataset)

HOSPITALS = TableSpec("m_hospital_center_master", ("center_id", "center_name"), key_column="center_id")
CODES = TableSpec("m_insurance_denial_codes", ("denial_code", "code_description"), key_column="denial_code")


def _transformed(t, fact: str, rows_of: str, master: TableSpec, master_rows: DataFrame) -> DataFrame:
    spec = spec_of(fact)
    plan = jobs.LoadPlan(facts=(spec,), masters=(master,), joins={fact: {master.name: master.key_column}})
    return jobs.transform_tables({fact: t[rows_of], master.name: master_rows}, plan)[fact]


@on_claims_tables("b7_transformed")
def _(t):
    return _transformed(t, "f_claim_submission", "claims", HOSPITALS, masters.hospital_keys(t["hospitals"]))


@on_claims_tables("b7_transformed_remittance")
def _(t):
    return _transformed(t, "f_remittance_advice", "remittance", CODES, t["denial_codes"])


on_claims_tables("b8_center_report_claim_grain")(
    lambda t: jobs.center_report(t, grain="claim")
)


@on_claims_tables("b8_center_report_filtered")
def _(t):
    return jobs.center_report(
        t, start="1993-01-01", end="1997-12-31", members={"org_id": [1, 2]},
        paid_start="1994-01-01", paid_end="1996-12-31", paid_members={"org_id": [0, 1, 3]},
    )


@on_claims_tables("b8_matched_with_status")
def _(t):
    return jobs.matched_with_status(t["claims"], t["remittance"], t).select(
        *ACTIVITY, "ra_seq", "center_name", "doctor_name", "ordering_doctor_name",
        "new_claim_status",
    )


for _kind in masters.MASTER_RECORDS:
    on_claims_tables(f"b9_master_{_kind}")(
        lambda t, kind=_kind: masters.master_records(t, kind)
    )


@on_claims_tables("b10_claims_extract")
def _(t):
    good, _ = jobs.claims_extract(
        t, "1993-01-01", "1996-12-31", {"center_id": [str(i) for i in range(12)]}
    )
    return good.select(
        *ACTIVITY, "gross", "patientshare", "netclaim", "bill_finalized_date",
        "claim_status", "center_id", "doctor_id", "ordering_doc_id", "center_name",
        "plan_name", "doctor_name", "ordering_doctor_name", "encounter_type_desc",
        "latest_denial_code", "denial_description",
    )


@on_claims_tables("b11_remittance_extract")
def _(t):
    good, _ = jobs.remittance_extract(
        t, "1993-01-01", "1997-12-31", {"org_id": [0, 1, 3]}
    )
    return good


@on_claims_tables("b12_matched_extract")
def _(t):
    return jobs.matched_extract(t, "1993-01-01", "1997-12-31", [1, 2]).select(
        *ACTIVITY, "netclaim", "claim_status", "org_id", "received_amount",
        "insurance_claim_amt", "transaction_date", "denial_code", "reference_no",
        "ra_seq", "center_name", "cluster_name", "plan_name", "category_name",
        "doctor_name", "dept_name", "encounter_type_desc", "denial_description",
        "denial_responsibility", "new_claim_status",
    )


@on_claims_tables("b13_coerce_facts")
def _(t):
    spec = spec_of("f_claim_submission")
    as_text = readers.select_spec(t["claims"], spec).select(
        *[F.col(c).cast("string").alias(c) if c in (*spec.numeric_columns, spec.date_column)
          else F.col(c) for c in spec.columns]
    )
    flawed = as_text.withColumn(
        "gross", F.when(F.col("center_id") == "7", "n/a").otherwise(F.col("gross"))
    )
    return facts.coerce_facts({spec.name: flawed}, [spec])[spec.name]


@on_claims_tables("b14_outliers_iqr")
def _(t):
    treated = outliers.treat_outliers(_outlier_input(t), ["gross", "netclaim"], "iqr", 0.75)
    return _rounded(treated, "gross", "netclaim")


@on_claims_tables("b14_outliers_zscore")
def _(t):
    treated = outliers.treat_outliers(_outlier_input(t), ["patientshare"], "zscore", 2.0)
    return _rounded(treated, "patientshare")


@on_claims_tables("b16_claim_metrics")
def _(t):
    return metrics.claim_metrics(t["claims"]).select(
        *ACTIVITY, "reimbursement_rate", "patient_share_pct", "days_to_finalize"
    )


@on_claims_tables("b16_remittance_metrics")
def _(t):
    return metrics.remittance_metrics(t["remittance"]).select(
        *PAYMENT, "payment_ratio", "is_full_payment", "is_denied"
    )


@on_claims_tables("b16_matched_metrics")
def _(t):
    return _center_rows(t).select(
        *ACTIVITY, "ra_seq", "payment_efficiency", "days_to_payment",
        "is_delayed_payment", "write_off_amount",
    )


@on_claims_tables("b16_center_metrics")
def _(t):
    matched = match.match_claims(t["claims"], t["remittance"], "left")
    return metrics.center_metrics(matched).select(
        *ACTIVITY, "ra_seq", "reimbursement_rate", "patient_share_pct",
        "days_to_payment", "is_delayed_payment", "write_off_amount",
    )
