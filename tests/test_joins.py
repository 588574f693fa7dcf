"""Split joins and quantiles agree with the plain ones on skewed data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimlake.operators import joins
from claimlake.operators.joins import attach, check_dimensions, heavy_keys, salted_join
from claimlake.operators.quantiles import exact_quantiles


def _sides(spark):
    # A third of the rows of each side share one key; keys and copies go missing too.
    def key(n, heavy):
        return F.when(n % 3 == 0, F.lit(heavy)).when(n % 17 == 0, None).otherwise(
            (n % 50).cast("string")
        )

    n = F.col("id")
    left = spark.range(0, 600, 1, 5).select(
        key(n, "L").alias("k"), (n % 7).alias("a"), F.lit(1).alias("copy")
    )
    right = spark.range(0, 90, 1, 3).select(
        F.when(n % 3 == 0, "R").otherwise((n % 40).cast("string")).alias("k"),
        (n % 5).alias("b"),
    )
    # Both heavy keys occur on both sides, in few rows on the other one.
    left = left.union(spark.sql("select 'R', 100L, 1 union all select 'R', 101L, 1"))
    right = right.union(spark.sql("select 'L', 200L union all select 'L', 201L"))
    return left, right


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("unique", [False, True])
def test_split_join_equals_plain_join(spark, how, unique):
    left, right = _sides(spark)
    if unique:
        right = right.groupBy("k").agg(F.max("b").alias("b"))
    plain = left.join(right, "k", how)
    heavy = heavy_keys(left, None if unique else right, ["k"], heavy_rows=5)
    split = salted_join(left, right, "k", how, right_unique=unique, heavy=heavy)
    assert "_salt_left" in split._jdf.queryExecution().toString()
    assert split.columns == plain.columns
    assert _rows(split) == _rows(plain)


def test_key_heavy_on_both_sides(spark):
    left = spark.range(60).select(F.lit("x").alias("k"), "id")
    right = spark.range(40).select(F.lit("x").alias("k"), F.col("id").alias("r"))
    for how in ("inner", "left"):
        out = salted_join(left, right, "k", how, heavy=heavy_keys(left, right, ["k"], heavy_rows=5))
        assert out.count() == 2400
        assert out.distinct().count() == 2400


def test_left_key_missing_on_the_right_is_kept_once(spark):
    left = spark.sql("select * from values ('x',1),('y',2),('z',3) as t(k,a)")
    right = spark.range(50).select(F.lit("x").alias("k"), F.col("id").alias("b"))
    out = salted_join(left, right, "k", "left", heavy=heavy_keys(left, right, ["k"], heavy_rows=5))
    assert out.filter("k = 'x'").count() == 50
    assert out.filter("k <> 'x' and b is null").count() == 2


def test_composite_keys(spark):
    left, right = _sides(spark)
    left, right = left.withColumn("j", F.col("a") % 2), right.withColumn("j", F.col("b") % 2)
    plain = left.join(right, ["k", "j"], "left")
    heavy = heavy_keys(left, right, ["k", "j"], heavy_rows=5)
    split = salted_join(left, right, ["k", "j"], "left", heavy=heavy)
    assert _rows(split) == _rows(plain)


def test_heavy_keys_are_found_exactly(spark):
    left, right = _sides(spark)
    found = heavy_keys(left, right, ["k"], heavy_rows=25)
    assert {r[0]: (r[1] > 1, r[2] > 1) for r in found.rows} == {
        "L": (True, False), "R": (False, True)
    }
    assert not heavy_keys(left, right, ["k"], heavy_rows=10_000)


def test_no_heavy_key_gives_an_ordinary_join(spark):
    left, right = _sides(spark)
    plan = salted_join(left, right, "k")._jdf.queryExecution().toString()
    assert "_salt_left" not in plan and "explode" not in plan


def test_all_planned_splits_are_used_on_a_clustered_key(spark):
    left = spark.range(4000, numPartitions=1).select(F.lit("x").alias("k"), F.lit("y").alias("same"), "id")
    right = spark.sql("select 'x' k, 1 b")
    heavy = heavy_keys(left, None, ["k"], heavy_rows=100)
    assert heavy.rows == [("x", 40, 1)]
    split = joins._salted(left, ["k"], spark.createDataFrame(heavy.rows, "k string, _left_splits int, _right_splits int"),
                          "_left_splits", "_right_splits", "_salt_left", "_salt_right", copy=False)
    assert split.select("_salt_left").distinct().count() == 40
    assert salted_join(left, right, "k", "left", right_unique=True, heavy=heavy).count() == 4000


@pytest.mark.parametrize("fact, dim, pairs", [
    ("int", "string", 2), ("string", "int", 2), ("int", "bigint", 2), ("bigint", "int", 2), ("double", "int", 2),
    ("string", "string", 2), ("decimal(9,2)", "double", 2)])
@pytest.mark.parametrize("null_safe", [False, True])
def test_key_types_meet_by_one_rule_on_both_sides_of_the_bound(spark, fact, dim, pairs, null_safe):
    left = spark.sql(f"select cast(k as {fact}) k, a from values (1,'p'),(2,'q'),(9,'r'),(null,'s') t(k,a)")
    right = spark.sql(f"select cast(k as {dim}) k, b from values (1,'x'),(2,'y'),(null,'z') t(k,b)")
    small, big = (attach(left, right, "k", 100, broadcast_bytes=n, null_safe=null_safe) for n in (1000, 10))
    assert small.columns == big.columns == ["k", "a", "b"]
    assert small.schema["k"].dataType == left.schema["k"].dataType
    assert _rows(small) == _rows(big)
    assert small.filter("b is not null").count() == pairs + null_safe and small.count() == 4


def test_adaptive_execution_splits_a_skewed_side(spark):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("a"))
        out = salted_join(left, spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("b")), "k", "left", right_unique=True)
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        assert len(rows) == 200_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dimension_above_the_size_bound_is_not_broadcast(spark):
    left, right = _sides(spark)
    dim = right.groupBy("k").agg(F.max("b").alias("b"))
    size = check_dimensions({"d": dim}, {"d": "k"})["d"]
    small = attach(left, dim, "k", size)
    big = attach(left, dim, "k", size, broadcast_bytes=size - 1)
    assert "rightHint=(strategy=broadcast)" in small._jdf.queryExecution().toString()
    assert "strategy=broadcast" not in big._jdf.queryExecution().toString()
    assert _rows(small) == _rows(big)


def test_repeated_dimension_key_is_an_error(spark):
    dim = spark.sql("select * from values ('a'),('a'),('b') as t(k)")
    with pytest.raises(ValueError, match="d"):
        check_dimensions({"d": dim}, {"d": "k"})


VALUES = [0.0, -0.0, 1.5, -1.5, 3.25, 3.25, 3.25, 1e-12, 1e300, -7e8, 2.0, 4.0, 8.0,
          0.1, 0.2, 0.30000000000000004, 0.3, float("nan"), None, 123456.78, 123456.79]


@pytest.mark.parametrize("n", [1, 2, 3, 7, len(VALUES)])
def test_exact_quantiles_equal_the_builtin(spark, n):
    df = spark.createDataFrame([(v,) for v in VALUES[-n:]], "v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = exact_quantiles(df, ["v"], probs).collect()
    want = df.filter("not isnan(v)").agg(
        F.percentile("v", [0.0, 0.25, 0.5, 0.9, 1.0])
    ).first()[0]
    assert got[0]["column_name"] == "v"
    assert [got[0][p] for p in probs] == pytest.approx(want, rel=1e-12)


def test_exact_quantiles_per_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 11).cast("string"))
        .alias("g"),
        (F.xxhash64("id") % 1000 / 7.0).alias("x"), (F.col("id") % 5).alias("y"),
    )
    got = {
        (r.g, r.column_name): r.m for r in exact_quantiles(df, ["x", "y"], {"m": 0.5}, ["g"]).collect()
    }
    for r in df.groupBy("g").agg(F.median("x").alias("x"), F.median("y").alias("y")).collect():
        assert got[(r.g, "x")] == pytest.approx(r.x, rel=1e-12)
        assert got[(r.g, "y")] == pytest.approx(r.y, rel=1e-12)
