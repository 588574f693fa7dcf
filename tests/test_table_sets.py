"""Table sets, stored sources, heavy keys in jobs, and runs over co-located facts."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from claimlake.operators import heavy, joins, match, metrics, quality
from claimlake.plans import jobs
from claimlake.schemas import RECORDS, TABLE_SPECS, TableSpec
from claimlake.sources.stored import StoredTables, store_tables
from claimlake.sources.table_sets import TableSet, exists


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plans_since(spark, n=0):
    """Physical plans of the SQL executions from the n-th on."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    found = store.executionsList()
    return [found.apply(i).physicalPlanDescription() for i in range(n, found.size())]


def scans(plans, part):
    """How many scans of a path that contains ``part`` ran."""
    return sum("Location" in line and part in line for text in plans for line in text.split("\n"))


def rows_of(df, columns=None):
    columns = sorted(columns or df.columns)
    return sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    return store_tables(spark, tables, str(tmp_path_factory.mktemp("sources")))


# --- table sets ------------------------------------------------------------------------

def three_facts(spark, note, broken=False):
    good = spark.range(20).select(F.col("id"), F.lit(note).alias("note"))
    bad = good.withColumn("note", F.raise_error(F.lit("lost"))) if broken else good
    return {"a": good, "b": good.limit(5), "c": bad}


def listing(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith("."))


@pytest.mark.parametrize("target", ["parquet", "csv"])
def test_a_load_that_fails_leaves_the_former_state(spark, tmp_path, target):
    load, day = jobs.LoadPlan(facts=(), target=target), date(2024, 3, 9)
    paths, failed = jobs.load_if_sound(spark, three_facts(spark, "first"), str(tmp_path), load, day)
    assert not failed and set(paths) == {"a", "b", "c"}
    before = listing(tmp_path)
    with pytest.raises(Exception, match="lost"):
        jobs.load_if_sound(spark, three_facts(spark, "second", broken=True), str(tmp_path), load, day)
    store = TableSet(spark, str(tmp_path))
    assert listing(tmp_path) == before and store.paths() == paths
    assert {r.note for n in "abc" for r in store.read(n).collect()} == {"first"}
    empty = {**three_facts(spark, "third"), "c": spark.range(0).withColumn("note", F.lit("x"))}
    assert jobs.load_if_sound(spark, empty, str(tmp_path), load, day) == ({}, [("c", "has_data")])
    assert listing(tmp_path) == before
    again, _ = jobs.load_if_sound(spark, three_facts(spark, "fourth"), str(tmp_path), load, day)
    assert {r.note for n in "abc" for r in store.read(n).collect()} == {"fourth"}
    assert store.paths() == again and len(listing(tmp_path)) == len(before)  # the former folders are gone
    ending = "csv" if target == "csv" else "parquet"
    assert all(p.endswith(ending) for p in again.values())


def test_a_load_reads_a_staged_table_once_for_its_checks(spark, tmp_path):
    spark.range(50).selectExpr("id as k", "id % 3 as v").write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    load = jobs.LoadPlan(facts=(), required={"t": ["k"]}, keys={"t": ["k"]}, strict=True)
    n = len(plans_since(spark))
    paths, failed = jobs.load_if_sound(spark, {"t": source}, f"{tmp_path}/out", load, date(2024, 1, 1))
    assert not failed and paths["t"].endswith("t_20240101.parquet")
    ran = plans_since(spark, n)
    assert scans(ran, f"{tmp_path}/source") == 1 and scans(ran, "out/t_20240101") == 1


def test_observed_checks_agree_with_counted_ones(spark):
    frames = {
        "sound": spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"),
        "holes": spark.createDataFrame([(1, None), (None, "y"), (1, "z")], "k int, v string"),
        "empty": spark.createDataFrame([], "k int, v string"),
    }
    for name, df in frames.items():
        for required, strict in ((["k"], False), (["k", "gone"], False), ([], True)):
            watched, results = quality.observe_checks(df, required, strict)
            watched.write.format("noop").mode("overwrite").save()
            want = {r.check_name: r.passed for r in quality.check_table(df, name, required, ["k"], strict).collect()}
            assert results() | {"unique_keys": not quality.keys_repeat(df, ["k"])} == want


def test_csv_loads_masters_and_an_environment(spark, tables, tmp_path):
    claims, remittance = TABLE_SPECS["f_claim_submission"], TABLE_SPECS["f_remittance_advice"]
    hospitals = TableSpec("m_hospital_center_master", ("center_id", "center_name"), key_column="center_id")
    load = jobs.LoadPlan(facts=(claims, remittance), masters=(hospitals,), joins={claims.name: {hospitals.name: "center_id"}},
                         environment="test", target="csv")
    sources = {claims.name: tables["claims"], remittance.name: tables["remittance"],
               hospitals.name: tables["hospitals"].withColumn("center_id", F.trim("center_id"))}
    paths, failed = jobs.run_load(spark, sources, str(tmp_path), load)
    assert not failed
    for spec in (claims, remittance, hospitals):
        assert paths[spec.name] == f"{tmp_path}/transformed_{spec.name}.csv" and exists(spark, paths[spec.name])
    back = spark.read.option("header", True).csv(paths[remittance.name])
    assert 0 < back.count() <= 100 and {r.org_id for r in back.select("org_id").distinct().collect()} == {"1"}
    assert spark.read.option("header", True).csv(paths[claims.name]).count() == tables["claims"].count()


# --- stored sources and the run --------------------------------------------------------

def test_stored_sources_have_their_columns(spark, tables, stored):
    assert set(stored) == set(tables) and len(stored) == 16
    assert stored["plans"].columns == ["plan_id", "category_id", "plan_name", "rateplan_rule_id"]
    assert stored["claims"].schema["org_id"].dataType.simpleString() == "string" and "senderid" in stored["claims"].columns
    assert stored["remittance"].count() == tables["remittance"].count()


SHARED = ["claim_id", "center_id", "netclaim", "encounterstart_date", "EM", "Consult", "center_name", "cluster_name", "plan_name",
          "category_name", "insurance_co_name", "doctor_name", "doctor_dept", "ordering_doctor_name", "encounter_type_desc",
          "total_claim_amount", "total_paid_amount", "denial_count", "rejection_rate", "payment_ratio", "claim_status",
          "submitted_status", "processing_days"]


@pytest.mark.parametrize("heavy_rows", [1_000_000, 5])
def test_the_run_from_stored_sets_equals_the_final_dataset(spark, tables, stored, tmp_path, heavy_rows):
    out, n = str(tmp_path / "out"), len(plans_since(spark))
    final = jobs.run_claims(spark, stored, out, buckets=4, heavy_rows=heavy_rows)
    ran = plans_since(spark, n)
    assert rows_of(final, SHARED) == rows_of(jobs.build_final_dataset(tables), SHARED)
    store = TableSet(spark, out)
    assert (store.rest("claims") is not None) == (heavy_rows == 5)
    if heavy_rows == 5:
        assert store.rest("claims").count() > 0 and store.bucketed("claims").count() > 0
    assert store.read("claims").count() == tables["claims"].count()
    for table, _ in (stored._names[k] for k in stored if k not in jobs.SHARED_MASTERS):
        assert sum(f"{stored.folder}/{table}.parquet" in text for text in ran) == 1, table
    assert not list((tmp_path / "out").glob("staged-*"))


def test_a_run_that_fails_shows_nothing_new(spark, stored, tmp_path):
    out = str(tmp_path)
    jobs.run_claims(spark, stored, out, buckets=2)
    store = TableSet(spark, out)
    before, files = store.entries(), sorted(p for p in tmp_path.rglob("*.parquet") if p.is_dir())
    broken = {**stored, "tpa": stored["tpa"].withColumn("claim_format", F.raise_error(F.lit("lost")).cast("string"))}
    with pytest.raises(Exception, match="lost"):
        jobs.run_claims(spark, broken, out, buckets=2)
    assert store.entries() == before and sorted(p for p in tmp_path.rglob("*.parquet") if p.is_dir()) == files
    assert store.read("final_dataset").count() > 0


def test_co_located_facts_are_not_exchanged(spark, stored, tmp_path):
    store = jobs.write_sets(spark, stored, str(tmp_path), buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        scored = metrics.claims_with_payments(store.bucketed("claims"), store.bucketed("remittance"))
        text = plan(scored)
        assert "Exchange" not in text and "Bucketed: true" in text and text.count("SortMergeJoin") == 2
        plain = metrics.claims_with_payments(store.read("claims"), store.read("remittance"))
        assert "Exchange" in plan(plain)
        totals = ["claimid", "activityid", "total_claim_amount", "total_paid_amount", "denial_count"]
        assert rows_of(scored, totals) == rows_of(plain, totals)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- heavy keys ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def hot(spark, tables, tmp_path_factory):
    """Sources in which one activity holds a third of all payments."""
    claims, paid = tables["claims"], tables["remittance"]
    first = paid.orderBy("claim_id", "activity_id", "ra_seq").limit(1)
    more = first.crossJoin(spark.range(paid.count() // 2).withColumnRenamed("id", "k")).withColumn(
        "ra_seq", (F.col("k") + 100).cast("int")).select(*paid.columns)
    everything = {**tables, "remittance": paid.unionByName(more), "claims": claims}
    folder = str(tmp_path_factory.mktemp("hot"))
    return everything, store_tables(spark, everything, folder, heavy_rows=100), tuple(first.select("claim_id", "activity_id").first())


def test_counts_of_heavy_keys_are_exact_and_add_up(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id")).alias("k"))
    one = heavy.key_counts(df, ["k"], "one", heavy_rows=160)
    two = heavy.key_counts(df, ["k"], "two", heavy_rows=160)
    assert [tuple(r) for r in one.collect()] == [("one", 7, 335)]
    assert [tuple(r) for r in heavy.combine(one.unionByName(two)).collect()] == [(7, 670)]
    found = heavy.right_splits(one.unionByName(two), {"k": "key"}, heavy_rows=160)
    assert found.rows == [(7, 1, 5)]
    assert heavy.right_splits(None, {"k": "key"}) is None and heavy.right_splits(one, {"k": "key"}, 10**6) is None


def test_a_hot_activity_is_dealt_over_tasks_in_jobs(spark, hot):
    plain, stored, (claim, activity) = hot
    splits = match.payment_splits(stored)
    assert len(splits.rows) == 1 and splits.rows[0][:2] == (claim, activity) and splits.rows[0][-1] > 10
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for how in ("left", "inner"):
            matched = match.match_claims(stored["claims"], stored["remittance"], how, splits)
            loads = matched.filter((F.col("claimid") == claim) & (F.col("cleaned_activityid") == activity)).groupBy(
                F.spark_partition_id().alias("p")).count().collect()
            n = sum(r["count"] for r in loads)
            assert n > stored["remittance"].count() / 4
            assert len(loads) >= 8 and max(r["count"] for r in loads) < n / 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_jobs_split_hot_activities_by_themselves(spark, hot):
    plain, stored, _ = hot
    report, extract = jobs.center_report(stored), jobs.matched_extract(stored, "1992-01-01", "1999-12-31")
    assert "_salt_left" in plan(report) and "_salt_left" in plan(extract)
    for got, want in ((report, jobs.center_report(plain)), (jobs.center_report(stored, grain="claim"), jobs.center_report(plain, grain="claim"))):
        assert rows_of(got) == rows_of(want)
    assert extract.count() == jobs.matched_extract(plain, "1992-01-01", "1999-12-31").count()
    # the hot payments are filtered away after they were counted: no claim is lost
    early = {"paid_start": "1900-01-01", "paid_end": "1900-01-02"}
    assert rows_of(jobs.center_report(stored, **early)) == rows_of(jobs.center_report(plain, **early))


def test_a_left_join_keeps_rows_whose_heavy_key_is_gone(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(2, i) for i in range(40)], "k int, w int")
    keys = joins.HeavyKeys([(1, 1, 4), (2, 1, 3)])
    got = joins.salted_join(left, right, "k", "left", heavy=keys)
    assert rows_of(got) == rows_of(left.join(right, "k", "left"))


# --- one evaluation of both outputs ----------------------------------------------------

def test_fitting_rows_and_quarantine_come_from_one_evaluation(spark, tables, tmp_path):
    flawed = tables["claims"].withColumn("gross", F.when(F.col("org_id") == 1, None).otherwise(F.col("gross"))).withColumn("_fits", F.lit(1))
    flawed.write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    n = len(plans_since(spark))
    good, bad = quality.validate_records(source, RECORDS["claim"], folder=f"{tmp_path}/judged")
    counts = good.count(), bad.count()
    ran = plans_since(spark, n)
    assert scans(ran, f"{tmp_path}/source") == 1
    lazy = quality.validate_records(source, RECORDS["claim"])
    assert counts == tuple(df.count() for df in lazy) and min(counts) > 0
    assert rows_of(good) == rows_of(lazy[0]) and good.columns == lazy[0].columns
    assert rows_of(bad) == rows_of(lazy[1]) and bad.columns == lazy[1].columns
    with pytest.raises(ValueError, match="rows do not fit"):
        quality.validate_records(source, RECORDS["claim"], "fail", f"{tmp_path}/again")


def test_extracts_are_written_once(spark, tables, tmp_path):
    for job, name in ((jobs.claims_extract, "c"), (jobs.remittance_extract, "r")):
        good, bad = job(tables, "1993-01-01", "1997-12-31", folder=f"{tmp_path}/{name}")
        lazy = job(tables, "1993-01-01", "1997-12-31")
        assert rows_of(good) == rows_of(lazy[0]) and rows_of(bad) == rows_of(lazy[1])


# --- keys of different types -----------------------------------------------------------

def test_keys_are_compared_exactly(spark):
    big = 9007199254740992
    left = spark.createDataFrame([(big,), (big + 1,), (None,)], "k bigint")
    right = spark.createDataFrame([(big, "even"), (big + 1, "odd"), (None, "none")], "k bigint, label string").withColumn(
        "k", F.col("k").cast("decimal(20,0)"))
    want = [(big, "even"), (big + 1, "odd")]
    for how in (joins.plain_join(left, right, ["k"], "left"), match.join_masters(left, {"m": right}, {"m": "k"})):
        assert sorted((r.k, r.label) for r in how.collect() if r.k) == want
    nulls = joins.plain_join(left, right, ["k"], "left", null_safe=True)
    assert {(r.k, r.label) for r in nulls.collect()} == {*want, (None, "none")}
    wide = spark.createDataFrame([("1.5", "x"), ("3", "y"), (None, "none")], "k string, label string").withColumn(
        "k", F.col("k").cast("decimal(38,30)"))
    small = spark.createDataFrame([(3,), (big,), (None,)], "k bigint")
    got = joins.plain_join(small, wide, ["k"], "left", null_safe=True)
    assert {(r.k, r.label) for r in got.collect()} == {(3, "y"), (big, None), (None, "none")}
    kinds = {("int", "bigint"): "bigint", ("int", "decimal(5,2)"): "decimal(12,2)", ("decimal(5,2)", "decimal(10,0)"): "decimal(12,2)",
             ("float", "int"): "double", ("double", "decimal(5,2)"): "double", ("string", "int"): "string", ("date", "date"): "date"}
    for (a, b), kind in kinds.items():
        one, two = (spark.createDataFrame([], f"k {t}") for t in (a, b))
        assert joins.key_kind(one, two, "k", "k") == kind
