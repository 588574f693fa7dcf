"""Claims-shaped views over the order tables (region ... lineitem).

Each view stands for one table of a claims warehouse. All are lazy and read whole tables. Keys
without a master row are planted in the tables that refer to it. Doctors of all roles are
suppliers; a role's key may lie past the last of them. The amounts use decimal arithmetic so that
results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _tag(letter: str, n: Column) -> Column:
    return F.concat(F.lit(letter), n.cast("string"))


def _day_text(ts: str) -> Column:
    return F.date_format(F.col(ts), "dd/MM/yyyy")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kept = F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    lines = (
        scan(spark, sf_dir, "lineitem")
        .withColumn("claimid", _tag("C", F.col("l_orderkey")))
        # all rows of a claim are sent to one partition while they are narrow: what adds up or
        # joins by claim later does not send the wide rows
        .repartition("claimid")
        .groupBy("claimid", "l_linenumber")
        .agg(
            F.min("l_orderkey").alias("l_orderkey"),
            F.min("l_suppkey").alias("s"),
            F.min("l_partkey").alias("p"),
            F.min("l_shipdate").alias("ship"),
            F.sum(price).alias("g"),
            F.sum(price * kept).alias("n"),
        )
    )
    orders = scan(spark, sf_dir, "orders").withColumn("claimid", _tag("C", F.col("o_orderkey")))
    o, line, s, p = (F.col(c) for c in ("l_orderkey", "l_linenumber", "s", "p"))
    net = F.col("n").cast("double")
    suffix = F.when(line % 3 == 1, "-I1").when(line % 3 == 2, "-R2").otherwise("")
    codes = {0: "99213", 1: " 99285 ", 2: "9.01", 3: "61.08", 4: "99499", 5: "9922"}
    code = F.lit("80050")
    for residue, text in codes.items():
        code = F.when(p % 7 == residue, text).otherwise(code)
    return lines.join(orders, "claimid").select(
        "claimid",
        _tag("M", F.col("o_custkey")).alias("memberid"),
        F.when(o % 101 == 0, 0.0).otherwise(F.col("g").cast("double")).alias("gross"),
        (F.col("g") - F.col("n")).cast("double").alias("patientshare"),
        net.alias("netclaim"),
        net.alias("activitynet"),
        F.when(o % 89 == 0, "9").otherwise(F.substring("o_orderpriority", 1, 1)).alias("encountertype"),
        F.col("o_orderdate").alias("bill_finalized_date"),
        F.col("ship").alias("submission_date"),
        F.when(o % 50 == 0, "X").when(F.col("o_orderstatus") == "F", "C")
        .when(F.col("o_orderstatus") == "O", "S").otherwise("N").alias("claim_status"),
        F.when(o % 97 == 0, "99").otherwise((s % 25).cast("string")).alias("center_id"),
        F.concat(o.cast("string"), F.lit("."), line.cast("string"), suffix)
        .alias("activityid"),
        code.alias("activitycode"),
        F.when(o % 17 != 0, 1 + o % 2).cast("int").alias("org_sub_seq"),
        F.when(s % 10 != 0, _tag("S", s)).alias("clinician"),
        F.when(s % 7 == 0, "").when(s % 11 != 0, _tag("S", s + 1))
        .alias("orderingclinician"),
        F.when(line == 1, "OPDOC").when(line == 2, "ROPDOC").otherwise("LAB")
        .alias("charge_head"),
        F.when(s % 3 != 0, _tag("S", s + 2)).alias("payee_doctor_id"),
        F.when(s % 4 != 0, _tag("S", s + 3)).alias("prescribing_dr_id"),
        _tag("S", s + 4).alias("admitting_dr_id"),
        _day_text("o_orderdate").alias("encounterstart"),
        F.when(p % 30 == 0, "P-").otherwise(_tag("P", p)).alias("plan_id"),
        F.when(F.col("o_custkey") % 20 == 0, "I-")
        .otherwise(_tag("I", F.col("o_custkey"))).alias("insurance_co_id"),
        _tag("T", F.col("o_custkey") % 4).alias("tpa_id"),
        (F.col("o_custkey") % 5).cast("int").alias("org_id"),
        # the code that the claim itself carries, which differs from its payment's
        F.when(o % 3 == 0, _tag("E", line)).alias("denial_code"),
    )


def number_payments(lines: DataFrame) -> DataFrame:
    """Payment ordinal ``ra_seq`` within the activity, an order line."""
    order = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"
    )
    return lines.withColumn("ra_seq", F.row_number().over(order))


def remittance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scan(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") != "N")
    lines = number_payments(lines)
    o, p = F.col("l_orderkey"), F.col("l_partkey")
    tenths = F.col("l_extendedprice").cast("decimal(12,2)") * (10 - p % 3).cast(
        "decimal(3,0)"
    )
    denied = F.col("l_returnflag") == "R"
    return lines.select(
        _tag("C", o).alias("claim_id"),
        F.concat_ws(".", o.cast("string"), F.col("l_linenumber").cast("string"))
        .alias("activity_id"),
        "ra_seq",
        F.col("l_shipdate").alias("transaction_date"),
        F.when(denied & (p % 11 == 0), "D-")
        .when(denied, _tag("D", F.col("l_suppkey"))).alias("denial_code"),
        (F.when(denied, 0.0).otherwise(tenths.cast("double")) / 10)
        .alias("received_amount"),
        F.when(p % 50 == 0, 0.0).otherwise(F.col("l_extendedprice"))
        .alias("insurance_claim_amt"),
        (F.col("l_suppkey") % 5).cast("int").alias("org_id"),
        _tag("R", p).alias("reference_no"),
    )


def open_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_lines = scan(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey")
    ).distinct()
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    doctor = F.floor(c / 15)  # there are fifteen customers to a supplier
    return scan(spark, sf_dir, "orders").join(with_lines, "o_orderkey", "left_anti").select(
        _tag("C", o).alias("claimid"),
        F.when(o % 10 == 0, "n/a")
        .otherwise(F.concat(_day_text("o_orderdate"), F.lit(" 10:00"))).alias("start_date"),
        (c % 25).cast("string").alias("center_id"),
        F.when(c % 30 == 0, "P-").otherwise(_tag("P", c)).alias("plan_id"),
        F.when(c % 20 == 0, "I-").otherwise(_tag("I", c)).alias("insurance_co_id"),
        F.when(c % 3 != 0, _tag("S", doctor)).alias("payee_doctor_id"),
        F.when(c % 4 != 0, _tag("S", doctor + 1)).alias("prescribing_dr_id"),
        _tag("S", doctor + 2).alias("admitting_dr_id"),
        F.col("o_totalprice").alias("gross"),
    )


def hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return scan(spark, sf_dir, "nation").select(
        F.concat(F.lit(" "), n.cast("string"), F.lit(" ")).alias("center_id"),
        F.col("n_name").alias("center_name"),
        _tag("H", n).alias("hospital_center_service_reg_no"),
        _tag("HA", F.col("n_regionkey")).alias("health_authority"),
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (scan(spark, sf_dir, t) for t in ("nation", "region"))
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _tag("K", F.col("r_regionkey")).alias("cluster_id"),
            F.col("r_name").alias("cluster_name"),
            F.concat(F.when(F.col("n_nationkey") % 6 == 5, "x").otherwise(""),
                     F.col("n_nationkey").cast("string"), F.lit(" ")).alias("center_id"),
        )
    )


def insurers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "customer").select(
        _tag("I", F.col("c_custkey")).alias("insurance_co_id"),
        F.col("c_name").alias("insurance_co_name"),
    )


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    return scan(spark, sf_dir, "part").select(
        _tag("P", p).alias("plan_id"),
        F.when(p % 40 < 7, "G-").otherwise(_tag("G", p % 8)).alias("category_id"),
        F.col("p_name").alias("plan_name"),
        _tag("RR", F.col("p_size")).alias("rateplan_rule_id"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        scan(spark, sf_dir, "part")
        .groupBy(_tag("G", F.col("p_partkey") % 8).alias("category_id"))
        .agg(F.min("p_type").alias("category_name"))
    )


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("org_id"), F.col("r_name").alias("org_name")
    )


def encounter_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("id"),
        F.substring("o_orderpriority", 3, 20).alias("encounter_type_desc"),
    ).distinct()


def tpa(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("r_regionkey")
    return scan(spark, sf_dir, "region").select(
        _tag("T", r).alias("tpa_id"),
        F.when(r % 2 == 0, "XML").otherwise("XLS").alias("claim_format"),
    )


def denial_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return scan(spark, sf_dir, "supplier").select(
        _tag("D", s).alias("denial_code"),
        _tag("reason ", s).alias("code_description"),
        F.when(s % 3 == 0, "payer").when(s % 3 == 1, "provider").alias("responsibility"),
    )


def doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return scan(spark, sf_dir, "supplier").select(
        _tag("S", s).alias("doctor_id"),
        F.col("s_name").alias("doctor_name"),
        _tag("spec", s % 4).alias("specialization"),
        F.when(s % 24 == 0, "N-").otherwise(_tag("N", F.col("s_nationkey"))).alias("dept_id"),
    )


def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return scan(spark, sf_dir, "supplier").select(
        F.when(s % 5 == 0, _tag("S-", s)).otherwise(_tag("S", s)).alias("doctor_id"),
        F.when(s % 13 != 0, _tag("L", s)).alias("doctor_license_number"),
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "nation").select(
        _tag("N", F.col("n_nationkey")).alias("dept_id"),
        F.concat(F.lit("dept "), F.col("n_name")).alias("dept_name"),
    )


def referrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return scan(spark, sf_dir, "customer").select(
        F.when(c % 9 != 0, _tag("L", c)).alias("clinician_id"),
        F.col("c_name").alias("name"),
    )


VIEWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        claims, remittance, open_claims, hospitals, clusters, insurers, plans,
        categories, organizations, encounter_types, tpa, denial_codes, doctors,
        licences, departments, referrals,
    )
}


class ClaimsTables(Mapping):
    """The views by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._source = (spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = VIEWS[name](*self._source)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)
