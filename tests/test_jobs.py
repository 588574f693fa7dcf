"""Sinks, full runs and the plans behind them."""

from __future__ import annotations

import contextlib
import io
from datetime import date

import pytest
from pyspark.sql import functions as F

from claimlake.operators import facts, masters, match, metrics
from claimlake.plans import jobs
from claimlake.plans.catalog import QUERIES
from claimlake.plans.oracle import ORACLE
from claimlake.schemas import TABLE_SPECS, TableSpec
from claimlake.sources import readers, writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_sinks_read_back(spark, sample_fact_data, tmp_path):
    back = writers.write_parquet(sample_fact_data, f"{tmp_path}/a.parquet")
    assert back.count() == 3 and back.schema.names == sample_fact_data.schema.names
    path = writers.write_csv(sample_fact_data, str(tmp_path), "facts")
    assert path.endswith("transformed_facts.csv")
    assert spark.read.option("header", True).csv(path).count() == 3
    assert writers.dated_path("out", "t", date(2024, 3, 9)) == "out/t_20240309.parquet"


def test_full_run_writes_all_sets_and_prunes_months(spark, tables, tmp_path):
    final = jobs.run_claims(spark, tables, str(tmp_path))
    written = {p.name.split(".")[0] for d in ("fact_data", "master_data") for p in (tmp_path / d).iterdir()}
    assert written == {"claims", "remittance", "latest_denials", "open_claims", *masters.MASTER_SETS}
    assert final.count() == tables["claims"].count() + tables["open_claims"].count()
    months = final.filter("enc_year = 1995 AND enc_month = 3")
    assert "PartitionFilters: [isnotnull(enc_year" in plan(months)
    direct = jobs.build_final_dataset(tables)
    total = F.sum(F.col("total_paid_amount").cast("decimal(20,4)"))
    assert final.agg(total).first() == direct.agg(total).first()


def load_plan(**changes):
    claims = TABLE_SPECS["f_claim_submission"]
    hospitals = TableSpec("m_hospital_center_master", ("center_id", "center_name"), key_column="center_id")
    return jobs.LoadPlan(
        facts=(claims,), masters=(hospitals,),
        joins={claims.name: {hospitals.name: "center_id"}},
        required={claims.name: ["claimid", "center_name"]}, **changes,
    )


def load_tables(tables):
    return {"f_claim_submission": tables["claims"],
            "m_hospital_center_master": masters.hospital_keys(tables["hospitals"])}


def test_load_writes_only_if_all_checks_pass(spark, tables, tmp_path):
    sources, day = load_tables(tables), date(2024, 1, 2)
    paths, failed = jobs.run_load(spark, sources, str(tmp_path), load_plan(), day)
    assert paths == {} and failed == [("f_claim_submission", "no_nulls")]  # center 0 has no name
    assert list(tmp_path.iterdir()) == []
    known = {**sources, "f_claim_submission": tables["claims"].filter("center_id not in ('0', '99')")}
    paths, failed = jobs.run_load(spark, known, str(tmp_path), load_plan(profiles=True), day)
    assert not failed and list(paths.values()) == [f"{tmp_path}/f_claim_submission_20240102.parquet"]
    loaded = readers.read_parquet(spark, paths["f_claim_submission"])
    assert loaded.count() == known["f_claim_submission"].count()
    report = tmp_path / "f_claim_submission_profile_20240102"
    assert {"table", "columns", "numeric", "strings", "correlations"} <= {p.name for p in report.iterdir()}


def test_filters_and_columns_reach_the_scan(spark, tables, tmp_path):
    writers.write_parquet(tables["claims"], f"{tmp_path}/claims.parquet")
    stored = readers.read_parquet(spark, f"{tmp_path}/claims.parquet")
    report = jobs.center_report({**tables, "claims": stored}, start="1995-01-01",
                                members={"center_id": [1, 2]})
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        report.explain("formatted")
    scans = [b for b in out.getvalue().split("\n\n") if "claims.parquet" in b and "ReadSchema" in b]
    wide = next(b for b in scans if "gross" in b)
    assert "GreaterThanOrEqual(bill_finalized_date" in wide and "In(center_id, [1,2])" in wide
    assert "memberid" not in wide and "encounterstart" not in wide


def test_dimensions_are_broadcast_and_nothing_is_crossed(spark, tables):
    text = plan(jobs.center_report(tables)) + plan(jobs.build_final_dataset(tables))
    assert "BroadcastHashJoin [center_id" in text
    for bad in ("NestedLoop", "CartesianProduct", "Python", "BatchEval"):
        assert bad not in text


def test_newest_denial_is_combined_before_the_shuffle(spark, tables):
    assert "partial_min" in plan(facts.latest_denial(tables["remittance"]))


def test_common_values_are_limited_before_the_shuffle(spark, tables):
    from claimlake.operators.profiling import _ranked_values, value_counts

    counts = value_counts(tables["doctors"], ["doctor_name"])
    assert "WindowGroupLimit" in plan(_ranked_values(counts, 5))


def test_claims_are_shuffled_once_for_totals(spark, tables, tmp_path):
    claims = writers.write_parquet(facts.prepare_claims(tables["claims"]), f"{tmp_path}/c.parquet")
    paid = writers.write_parquet(tables["remittance"], f"{tmp_path}/r.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(metrics.claims_with_payments(claims, paid))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in text
    # Claims once wide and once reduced, remittance once reduced.
    assert text.count("Exchange hashpartitioning") == 3


def test_cached_dimensions(spark, tables):
    dims = {"hospitals": masters.hospitals_with_clusters(tables), "tpa": masters.tpa_formats(tables)}
    kept = readers.cache_dims(dims, readers.CACHED_DIMS)
    assert kept["hospitals"].storageLevel.useMemory and kept["hospitals"].storageLevel.useDisk
    assert not kept["tpa"].storageLevel.useMemory
    kept["hospitals"].unpersist()


def test_match_prefixes_shared_columns(spark, tables):
    matched = match.match_claims(tables["claims"], tables["remittance"])
    assert "ra_org_id" in matched.columns and len(set(matched.columns)) == len(matched.columns)


@pytest.mark.parametrize("how,rows", [("left", None), ("inner", None)])
def test_matching_loses_no_payment_of_a_known_activity(spark, tables, how, rows):
    matched = match.match_claims(tables["claims"], tables["remittance"], how)
    paid = matched.filter("ra_seq IS NOT NULL").count()
    assert paid == tables["remittance"].count()


def test_a_doctor_with_two_licences_repeats_no_claim(spark, tables):
    from claimlake.operators import match

    more = tables["licences"].unionByName(
        tables["licences"].withColumn("doctor_license_number", F.lit("Z")))
    doubled = {**dict(tables), "licences": more}
    claims = match.enrich_claims(facts.prepare_claims(tables["claims"]), doubled)
    assert claims.count() == tables["claims"].count()


# --- wide rows stay where they are -------------------------------------------------

def sent(df, column):
    """Exchanges of the plan that send a column of this name."""
    explained = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [part for part in explained.split("\n\n") if ") Exchange\n" in part and f"{column}#" in part]


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture()
def large_masters(no_broadcast, monkeypatch):
    check = match.check_dimensions
    monkeypatch.setattr(match, "check_dimensions", lambda dims, keys: {
        n: 1 << 40 if n in ("plan", "insurer") else size for n, size in check(dims, keys).items()})


def test_totals_do_not_send_the_wide_claims(spark, tables, no_broadcast):
    assert not sent(jobs.build_final_dataset(tables), "memberid")


def test_labels_of_large_masters_do_not_send_the_wide_claims(spark, tables, large_masters, monkeypatch):
    final = jobs.build_final_dataset(tables)
    both = sent(final, "memberid")
    assert len(both) == 2  # for both masters, those of claims without an id
    same = sorted(map(str, final.collect()))
    monkeypatch.setattr(match, "TOGETHER_ROWS", 2)  # as if claims had too many rows for it
    plainly = jobs.build_final_dataset(tables)
    assert plainly.columns == final.columns
    assert sorted(map(str, plainly.collect())) == same
    monkeypatch.undo()
    assert sorted(map(str, jobs.build_final_dataset(tables).collect())) == same


def test_claims_without_ids_keep_the_labels_of_large_masters(spark, tables, large_masters, monkeypatch):
    claims = tables["claims"].withColumns({
        "claimid": F.when(F.col("org_id") != 1, F.col("claimid")),
        "plan_id": F.when(F.col("org_id") != 2, F.col("plan_id"))})
    odd = {**dict(tables), "claims": claims}
    got = jobs.build_final_dataset(odd)
    rows = sorted(map(str, got.collect()))
    assert got.filter("claim_id is null and plan_name is not null").count() > 0
    monkeypatch.undo()
    assert rows == sorted(map(str, jobs.build_final_dataset(odd).collect()))
