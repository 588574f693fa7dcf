"""Quantiles, distinct counts, common values and row numbers against plain Python."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from claimlake.operators import profiling, quantiles, rows


def interpolated(values, p):
    values = sorted(values)
    place = (len(values) - 1) * p
    low = int(place)
    high = min(low + (place > low), len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


def columns_of_numbers():
    rng = random.Random(3)
    n = 30_000
    return {
        "flat": [float(i) for i in range(n)],
        "ties": [float(i % 3) for i in range(n)],
        "one": [7.0] * n,
        "log": [10.0 ** rng.uniform(-12, 12) * rng.choice([-1, 1]) for _ in range(n)],
        "holes": [None if i % 2 else float("nan") if i % 10 == 0 else i / 7 for i in range(n)],
        "few": [None] * (n - 3) + [1.0, 5.0, 2.0],
        "none": [None] * n,
    }


@pytest.fixture(scope="module")
def numbers(spark):
    data = columns_of_numbers()
    schema = ", ".join(f"`{c}` double" for c in data)
    return spark.createDataFrame(list(zip(*data.values())), schema).repartition(6), data


WANTED = {"p0": 0.0, "p1": 0.001, "q1": 0.25, "half": 0.5, "q3": 0.75, "p9": 0.9999, "p100": 1.0}


def test_bracketed_quantiles_are_exact(numbers):
    df, data = numbers
    got = {r["column_name"]: r for r in quantiles.exact_quantiles(df, list(data), WANTED).collect()}
    assert set(got) == set(data) - {"none"}
    for c in got:
        real = [v for v in data[c] if v is not None and v == v]
        for name, p in WANTED.items():
            assert got[c][name] == pytest.approx(interpolated(real, p), rel=1e-12)


def test_a_bracket_that_misses_is_noticed(numbers, monkeypatch):
    df, data = numbers
    ranks = quantiles.bracket_ranks(df, ["flat"], {"m": 0.5})
    wrong = {"n0": ranks["n0"], "ends0": [0.0, 10.0]}
    assert quantiles.ranked_values(df, ["flat"], {"m": 0.5}, wrong) is None
    honest = quantiles.bracket_ranks
    monkeypatch.setattr(quantiles, "bracket_ranks", lambda *a, **k: {**honest(*a, **k).asDict(), "ends0": [0.0, 10.0]})
    assert quantiles.exact_quantiles(df, ["flat"], {"m": 0.5}).first()["m"] == statistics.median(data["flat"])


def test_numeric_profile_in_two_passes(numbers):
    df, data = numbers
    got = {r["column_name"]: r for r in profiling.numeric_profile(df).collect()}
    assert set(got) == set(data)
    for c, r in got.items():
        real = [v for v in data[c] if v is not None and v == v]
        if not real:
            assert r["mean"] is None and r["median"] is None
            continue
        assert r["median"] == pytest.approx(statistics.median(real)) and (r["min"], r["max"]) == (min(real), max(real))
        assert r["mean"] == pytest.approx(statistics.fmean(real)) and r["std"] == pytest.approx(statistics.stdev(real))


def test_distinct_counts_of_all_kinds(spark):
    long = "x" * 40
    df = spark.createDataFrame(
        [(1, 1.5, "a", long, True, b"q"), (2, -0.0, "a", long + "y", None, b"q"), (2, 0.0, None, long, True, None),
         (None, float("nan"), "", long, False, b"")],
        "i int, d double, s string, l string, b boolean, x binary",
    ).withColumns({"day": F.date_add(F.lit("2024-01-01").cast("date"), F.coalesce(F.col("i"), F.lit(5))),
                   "at": F.timestamp_seconds(F.col("d") * 10), "m": F.col("i").cast("decimal(12,2)") / 3,
                   "w": F.col("i").cast("decimal(30,4)"), "u": F.lit("2024-01-01 10:00").cast("timestamp_ntz"),
                   "list": F.array("i", "i")})
    got = {r["column_name"]: (r["null_count"], r["distinct_count"]) for r in profiling.column_profile(df.drop("at")).collect()}
    assert got == {"i": (1, 2), "d": (1, 2), "s": (1, 2), "l": (0, 2), "b": (1, 2), "x": (1, 2), "day": (0, 3),
                   "m": (1, 2), "w": (1, 2), "u": (0, 1), "list": (0, 3)}


def test_numbers_are_not_shuffled_as_text(spark):
    text = profiling.column_profile(spark.range(10).withColumn("v", F.rand()))._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in text


def test_long_texts_are_digested(spark):
    rng = random.Random(5)
    rows_ = [("".join(rng.choice("ab") for _ in range(rng.choice([3, 15, 16, 17, 40]))),) for _ in range(3000)]
    df = spark.createDataFrame(rows_, "s string")
    assert profiling.column_profile(df).first()["distinct_count"] == len(set(rows_))


@pytest.mark.parametrize("buckets,first", [(1 << 14, 64), (16, 2), (4, 8)])
def test_common_values_of_flat_and_skewed_columns(spark, monkeypatch, buckets, first):
    monkeypatch.setattr(profiling, "VALUE_BUCKETS", buckets)
    monkeypatch.setattr(profiling, "FIRST_BUCKETS", first)
    rng = random.Random(6)
    data = {
        "skewed": [f"v{min(int(rng.paretovariate(0.7)), 5000)}" for _ in range(6000)],
        "flat": [f"u{i}" for i in range(6000)],
        "pairs": [f"p{i // 2}" for i in range(6000)],
        "few": [rng.choice(["x", "y", None]) for _ in range(6000)],
        "none": [None] * 6000,
    }
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} string" for c in data))
    got = {}
    for r in profiling.most_common(df, n=4).collect():
        got.setdefault(r["column_name"], []).append((r["place"], r["value"], r["n"]))
    for c, values in data.items():
        counts = {}
        for v in values:
            if v is not None:
                counts[v] = counts.get(v, 0) + 1
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4]
        assert sorted(got.get(c, [])) == [(k + 1, v, n) for k, (v, n) in enumerate(best)]


@pytest.mark.parametrize("ranges", [1, 7, 200])
def test_row_numbers_are_gapless_and_stable(spark, ranges):
    rng = random.Random(7)
    data = [(rng.choice(["a", "b", None]), rng.randrange(40), i, 1) for i in range(800)] + [("a", None, 900, 1)]
    df = spark.createDataFrame(data, "k string, v int, w int, _range int")
    want = {r[2]: n for n, r in enumerate(sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])))}
    for parts in (1, 5):
        got = rows.with_row_numbers(df.repartition(parts), ["k", "v", "w"], "key", ranges)
        assert got.columns == ["k", "v", "w", "_range", "key"]
        assert {r["w"]: r["key"] for r in got.collect()} == want
    assert rows.with_row_numbers(df.limit(0), ["k"]).collect() == []
    with pytest.raises(ValueError, match="order"):
        rows.with_row_numbers(df, [])


def test_all_profile_results_as_rows(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, 3.0, "x")], "a int, b double, c string")
    out = profiling.profile_rows(profiling.full_profile(df))
    assert out.columns == ["section", "subject", "measure", "number", "text"]
    found = {(r.section, r.subject, r.measure): r.number if r.text is None else r.text for r in out.collect()}
    assert found["table", "", "rows"] == 2 and found["numeric", "b", "median"] == 2.5
    assert found["strings", "c|1", "value"] == "x" and found["correlations", "a|b", "correlation"] == pytest.approx(1)


def test_values_of_groups_are_counted_once(spark):
    from claimlake.plans.catalog import QUERIES

    found = QUERIES["a6_aggregate"](spark, "/root/testdata/sf0.001")
    found.collect()
    ran = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ran.count("partial_count(1)") == 1


def test_a_group_without_a_key_has_quantiles(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 4.0), ("a", 2.0), ("a", None)], "k string, x double")
    got = quantiles.exact_quantiles(rows, ["x"], {"half": 0.5}, ["k"])
    assert {tuple(r) for r in got.collect()} == {(None, "x", 2.5), ("a", "x", 2.0)}
