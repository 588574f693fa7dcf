"""Literal cases for the decisions that an order table never shows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from claimlake import functions as cf
from claimlake.operators import facts, masters, match, metrics, outliers, profiling
from claimlake.operators import quality, reports, rows
from claimlake.schemas import RECORDS, TABLE_SPECS, spec_of
from claimlake.sources import readers


def values(spark, sql, names):
    return spark.sql(f"select * from values {sql} as t({names})")


def column(df, *names):
    return [tuple(r) if len(names) > 1 else r[0] for r in df.select(*names).collect()]


def test_suffix_i_is_cut_before_r_at_its_first_place(spark):
    df = values(spark, "(1,'7.1-R2-I1'),(2,'7.1-R2'),(3,'-I1'),(4,'7'),(5,null),(6,'a-Ib-Ic')", "i, a")
    got = column(df.orderBy("i").withColumn("o", cf.clean_activity_id("a")), "o")
    assert got == ["7.1-R2", "7.1", "", "7", None, "a"]


def test_code_groups(spark):
    df = values(spark, "(1,' 99285 '),(2,'9922'),(3,'61.08'),(4,'9'),(5,null),(6,'99499')", "i, c")
    out = df.orderBy("i").select(
        cf.evaluation_code("c"), cf.dxb_consult_code("c"), cf.consult_code("c")
    )
    assert [tuple(r) for r in out.collect()] == [
        ("99285", "NA", "99285"), ("NA", "NA", "9922"), ("NA", "61.08", "NA"),
        ("NA", "9", "NA"), ("NA", "NA", "NA"), ("NA", "NA", "99499"),
    ]


def test_doctor_fallbacks_differ_on_the_empty_string(spark):
    df = values(spark, """(1,'c','','OPDOC',null,'p','a'),(2,null,'','LAB','y',null,'a'),
        (3,null,'o','OPDOC','y','p','a'),(4,null,null,null,null,null,'a')""",
        "i, clinician, orderingclinician, charge_head, payee_doctor_id, prescribing_dr_id, admitting_dr_id")
    out = df.orderBy("i").withColumns({"d": cf.treating_doc_id(), "o": cf.ordering_doc_id()})
    assert column(out, "d", "o") == [("c", None), ("", "y"), ("o", "o"), (None, "a")]


def test_dates_that_do_not_parse(spark):
    df = values(spark, "(1,'31/12/2023'),(2,'n/a'),(3,'30/02/2023'),(4,null)", "i, d")
    assert column(df.orderBy("i").withColumn("o", cf.day_of("d")), "o") == [
        date(2023, 12, 31), None, None, None]
    with pytest.raises(Exception):
        cf.convert_dates(df, ["d"], "dd/MM/yyyy").collect()


def test_zero_divisors_and_missing_delays(spark):
    df = values(spark, "(0D, 5D, 0D, null, null)", "gross, netclaim, insurance_claim_amt, received_amount, d")
    row = df.select(
        cf.reimbursement_rate(), cf.payment_ratio(), cf.is_full_payment(cf.payment_ratio()),
        cf.is_delayed_payment("d"), cf.share_or_zero("netclaim", "gross"),
    ).first()
    assert tuple(row) == (None, None, False, False, 0.0)


def test_elapsed_and_calendar_days_differ(spark):
    df = values(spark, "(timestamp_ntz'2024-01-02 01:00:00', timestamp_ntz'2024-01-01 23:00:00')", "a, b")
    assert tuple(df.select(cf.days_between("a", "b"), cf.days_between("a", "b", "elapsed")).first()) == (1.0, 0.0)


def test_half_cents_round_up(spark):
    df = values(spark, "(37081.645D, 0D)", "netclaim, received_amount")
    assert df.select(cf.write_off_amount()).first()[0] == 37081.65


def test_unknown_status_inputs(spark):
    df = values(spark, "(1,'S',null,1),(2,'X',1,1),(3,'S',1,null),(4,'S',2,0),(5,'C',null,null)",
                "i, claim_status, org_sub_seq, ra_seq").orderBy("i")
    assert column(df.withColumn("o", cf.claim_status_label()), "o") == [
        "Unknown", "Unknown", "Submitted", "Resubmitted", "Closed"]
    assert column(df.withColumn("o", cf.claim_status_label("basic")), "o")[3:] == ["Unknown", "Unknown"]
    with pytest.raises(ValueError):
        cf.claim_status_label("more")


def test_latest_denial_ties(spark):
    df = values(spark, """('C','1',2,timestamp_ntz'2024-01-01','D2'),('C','1',2,timestamp_ntz'2024-01-02','D9'),
        ('C','1',2,timestamp_ntz'2024-01-02','D8'),('C','1',3,timestamp_ntz'2024-01-03',null),
        ('C','2',null,timestamp_ntz'2024-01-09','D1'),('C','2',1,timestamp_ntz'2024-01-01','D3')""",
        "claim_id, activity_id, ra_seq, transaction_date, denial_code")
    got = {r.activity_id: r.latest_denial_code for r in facts.latest_denial(df).collect()}
    assert got == {"1": "D8", "2": "D3"}


def test_date_ranges_and_limits(spark):
    df = values(spark, "(timestamp_ntz'2024-01-01'),(timestamp_ntz'2024-01-31')", "d")
    assert rows.date_range(df, "d", "2024-01-01", "2024-01-31").count() == 1
    assert rows.date_range(df, "d", datetime(2024, 1, 1), datetime(2024, 1, 31), "both").count() == 2
    assert rows.keep_members(df, {"d": []}).count() == 2
    with pytest.raises(ValueError):
        rows.first_rows(df, 5, [])


def test_date_slices_cover_the_range_once():
    slices = readers.date_slices("2024-01-01", "2024-01-11", 50)
    assert len(slices) == 10 and all(a < b for a, b in slices)
    assert [a for a, _ in slices[1:]] == [b for _, b in slices[:-1]]
    assert slices[0][0] == date(2024, 1, 1) and slices[-1][1] == date(2024, 1, 11)
    assert readers.slice_predicates("d", "2024-01-01", "2024-01-03", 2) == [
        "d >= '2024-01-01' AND d < '2024-01-02'", "d >= '2024-01-02' AND d < '2024-01-03'"]


class _FakeReader:
    """Stands for a session: records what a JDBC read is asked for."""

    def __init__(self):
        self.read, self.calls = self, []

    def jdbc(self, url, table, **kwargs):
        self.calls.append((url, table, kwargs))


def test_jdbc_reads_ask_for_slices_and_options():
    fake, props = _FakeReader(), readers.jdbc_options({"user": "u", "password": "p"})
    assert props["fetchsize"] == "100000" and props["batchsize"] == "50000"
    readers.read_jdbc(fake, "url", "t", props)
    readers.read_fact_sliced(fake, "url", "claims", "t", props, "2024-01-01", "2024-12-31")
    assert "predicates" not in fake.calls[0][2]
    predicates = fake.calls[1][2]["predicates"]
    assert len(predicates) == 50 and predicates[0].startswith("bill_finalized_date >= '2024-01-01'")


def test_unknown_names_raise(spark, tables):
    for call in (lambda: spec_of("nope"), lambda: masters.master_records(tables, "nope"),
                 lambda: readers.apply_profile(spark.range(1), spec_of("f_claim_submission"), "nope"),
                 lambda: outliers.treat_outliers(spark.range(1), ["id"], "nope"),
                 lambda: reports.aggregate(spark.range(1), ["id"], {"id": "nope"}),
                 lambda: reports.aggregate(spark.range(1), ["id"], {"id": "first"})):
        with pytest.raises(ValueError):
            call()


def test_aggregate_drops_missing_keys_and_sums_nothing_to_zero(spark):
    df = values(spark, "('a',1D),('a',null),('b',null),(null,5D)", "k, x")
    out = reports.aggregate(df, ["k"], {"x": ["sum", "median", "count"]}).orderBy("k")
    assert column(out, "k", "x_sum", "x_median", "x_count") == [("a", 1.0, 1.0, 1), ("b", 0.0, None, 0)]
    only = reports.aggregate(df, ["k"], {"x": "median"}).orderBy("k")
    assert column(only, "k", "x_median") == [("a", 1.0), ("b", None)]


def test_denial_patterns_without_codes_is_empty(spark):
    assert reports.denial_patterns(spark.range(3)).count() == 0


def test_totals_per_group_equal_a_window(spark):
    df = values(spark, "('a',1,1D),('a',2,2D),('b',3,null),(null,4,7D),(null,5,1D)", "claim_id, i, received_amount")
    got = metrics.with_total_paid(df).orderBy("i")
    assert column(got, "i", "total_paid_amount") == [(1, 3.0), (2, 3.0), (3, None), (4, 8.0), (5, 8.0)]


def test_final_dataset_keeps_every_claim_once(spark, tables):
    from claimlake.plans.jobs import build_final_dataset, center_report

    final = build_final_dataset(tables)
    assert len(set(final.columns)) == len(final.columns)
    assert final.count() == tables["claims"].count() + tables["open_claims"].count()
    assert final.filter("submitted_status IS NULL AND claim_status <> 'U'").count() == 0
    by_claim = center_report(tables, grain="claim").agg(F.sum("total_claims")).first()[0]
    assert by_claim == tables["claims"].count()


def test_null_keys_join_only_when_asked(spark):
    left = values(spark, "('a',1),(null,2)", "k, v")
    right = values(spark, "('a',7),(null,8)", "k, v")
    plain = match.join_masters(left, {"m": right}, {"m": "k", "absent": "k"}).orderBy("v")
    safe = match.join_masters(left, {"m": right}, {"m": ["k"]}, null_safe=True).orderBy("v")
    assert column(plain, "v", "v_m") == [(1, 7), (2, None)]
    assert column(safe, "v", "v_m") == [(1, 7), (2, 8)]


def test_outliers_keep_nulls_and_constant_columns(spark):
    df = values(spark, "(1,1D,5D),(2,2D,5D),(3,3D,5D),(4,100D,5D),(5,null,5D)", "i, x, same").orderBy("i")
    clipped = column(outliers.clip_outliers(df, ["x", "same"]), "x", "same")
    # Quartiles of 1, 2, 3, 100 are 1.75 and 27.25.
    assert clipped == [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (27.25 + 1.5 * 25.5, 5.0), (None, 5.0)]
    replaced = column(outliers.replace_outliers(df, ["x", "same"], 1.4), "x", "same")
    assert replaced == [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (26.5, 5.0), (None, 5.0)]


def test_narrowing_keeps_values_at_the_bounds(spark):
    df = spark.createDataFrame([(127, -128, 32768, None), (0, 0, 0, None)],
                               "a bigint, b bigint, c bigint, d bigint")
    out = profiling.narrow_types(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["tinyint", "tinyint", "int", "bigint"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_only_excluded_columns_have_no_common_values(spark, sample_fact_data):
    def names(**options):
        found = profiling.most_common(sample_fact_data, **options)
        return {r[0] for r in found.select("column_name").collect()}

    assert {"memberid", "encountertype"} <= names()
    left = names(exclude=["MemberID"])
    assert "memberid" not in left and "encountertype" in left


def test_profile_of_small_fixture(spark, sample_fact_data):
    profile = profiling.full_profile(sample_fact_data)
    assert tuple(profile["table"].first()) == (3, 9, 0)
    numeric = {r.column_name: r for r in profile["numeric"].collect()}
    assert numeric["gross"].median == 2000.0 and numeric["gross"].skewness == pytest.approx(0.0)
    assert numeric["gross"].kurtosis is None


def test_records_are_split_with_reasons(spark, sample_fact_data):
    flawed = sample_fact_data.withColumn("activitynet", F.when(F.col("center_id") != 2, "1.5").otherwise("x"))
    flawed = flawed.withColumn("memberid", F.when(F.col("center_id") != 3, F.col("memberid")))
    good, bad = quality.validate_records(flawed, RECORDS["claim"])
    assert column(good, "claimid", "center_id", "activitynet") == [("C1", "1", 1.5)]
    assert {r.claimid: r.reasons for r in bad.collect()} == {
        "C2": ["activitynet: not double"], "C3": ["memberid: missing"]}
    with pytest.raises(ValueError, match="2 rows"):
        quality.validate_records(flawed, RECORDS["claim"], mode="fail")


def test_facts_and_masters_of_the_small_fixtures(spark, sample_fact_data, sample_master_data):
    spec = TABLE_SPECS["f_claim_submission"]
    typed = facts.coerce_facts({spec.name: sample_fact_data}, [spec])[spec.name]
    kinds = dict(typed.dtypes)
    assert kinds["bill_finalized_date"] == "timestamp_ntz" and kinds["gross"] == "double"
    gaps = sample_master_data.withColumn("center_code", F.when(F.col("center_id") > 1, F.col("center_code")))
    filled = masters.fill_missing_labels(gaps)
    assert filled.filter("center_name is null or center_code is null").count() == 0
    assert quality.check_types(typed, {"gross": "double", "center_id": "int", "no": "int"}) == {
        "center_id": "bigint", "no": "missing column"}
    assert quality.schema_is_sound(sample_fact_data, ["claimid", "gross"])
    assert not quality.schema_is_sound(sample_fact_data, ["claimid", "visit_id"])


def test_checks_pass_without_keys_and_fail_on_repeats(spark):
    df = values(spark, "('a',1),('a',null)", "k, v")
    failed = quality.failed_checks(quality.check_tables({"t": df}, {"t": ["k"]}, {"t": ["k"]}))
    assert failed == [("t", "unique_keys")]
    assert quality.failed_checks(quality.check_tables({"t": df}, strict=True)) == [("t", "no_nulls")]
    assert quality.failed_checks(quality.check_tables({"t": df.limit(0)})) == [("t", "has_data")]


def test_instants_of_a_repeated_hour_are_two_values(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        two = spark.sql("select timestamp_seconds(1729992600 + 3600 * id) as t from range(2)")
        assert profiling.column_profile(two).first()["distinct_count"] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_quantiles_of_a_column_shuffle_no_values(spark):
    from claimlake.operators import quantiles

    df = spark.range(1000).select((F.col("id") / 7).alias("v"))
    # the second pass sends on the values inside the bracket only
    big = spark.range(100_000).select((F.col("id") / 7).alias("v"), F.lit(0).alias("w"))
    ranks = quantiles.bracket_ranks(big, ["v"], {"m": 0.5})
    inside = quantiles._inside(big, ["v"], [(0, *ranks["ends0"])])
    assert 1 < inside.count() < 100_000 * 10 / quantiles.ACCURACY
    plan = quantiles._located_quantiles(df, ["v"], {"m": 0.5}, [])._jdf.queryExecution().optimizedPlan().toString()
    first = [line for line in plan.splitlines() if "Aggregate [column_name" in line]
    assert first and all("d1" in line or "name" in line for line in first)
