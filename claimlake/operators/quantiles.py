"""Exact quantiles without holding all values of a column or group in one task.

The built-in exact percentile keeps a map of every distinct value in one buffer. Here

* over whole columns, a mergeable sketch brackets every wanted rank from both sides in a first
  pass, and a second pass counts the values below and, one by one, inside the bracket. The error
  of the sketch is bounded, so the ranks lie inside; that is checked by the exact counts, and a
  column whose bracket missed takes the way of the groups.
* per group, the wanted ranks are located in three steps: by the leading digits of the value, by
  the following digits among the values that share them, and by value among the few that are
  left. A step hands at most two rows per quantile to the next, which are broadcast. Values are
  counted once per group; the first two steps read that one shuffle, the third what the second
  left.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from claimlake.operators.joins import salted_join

# Binary digits after the leading one that the first and second pass look at.
FIRST_BITS, SECOND_BITS = 16, 18
_LARGEST = 1.7976931348623157e308
# The sketch errs by at most one rank in so many; a bracket reaches twice as far on either side.
ACCURACY = 10_000


def _digits(v: Column) -> tuple[Column, Column]:
    """Two integers that order values as the values themselves do, ties aside."""
    size = F.least(F.abs(v), F.lit(_LARGEST))
    exponent = F.when(size == 0, -1023).otherwise(
        F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    ).cast("int")
    scaled = size / F.pow(F.lit(2.0), F.greatest(exponent, F.lit(-1022))) * (
        1 << FIRST_BITS
    )
    lead = F.floor(scaled)
    sign = F.when(v < 0, -1).otherwise(1)
    stride = 1 << (FIRST_BITS + 3)  # room for an exponent that is one off
    first = sign * ((exponent + 1100).cast("bigint") * stride + lead)
    second = sign * F.floor((scaled - lead) * (1 << SECOND_BITS))
    first = F.when(size == 0, F.lit(0)).otherwise(first)
    # Never NULL, which spares NULL filters that would tell the passes' scans apart.
    return tuple(F.coalesce(d.cast("bigint"), F.lit(0)) for d in (first, second))


def _wanted(probabilities: Mapping[str, float], total: Column) -> Column:
    """The two neighbouring ranks of every quantile, with the weight of the upper."""
    wanted = []
    for name, p in probabilities.items():
        place = (total - 1) * F.lit(float(p))
        weight = place - F.floor(place)
        for end, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            wanted.append(
                F.struct(
                    F.lit(name).alias("name"), F.lit(end).alias("end"),
                    weight.alias("weight"), rank.cast("bigint").alias("rank"),
                )
            )
    return F.array(*wanted)


def _locate(rows: DataFrame, group: list[str], digit: str, first: Column | None) -> DataFrame:
    """Digit that holds each wanted rank of the group; ranks become ranks within it."""
    measures = [F.sum("n").alias("n")]
    if first is None:
        measures.append(F.any_value("wanted").alias("wanted"))
    counts = rows.groupBy(*group, digit).agg(*measures)
    whole = Window.partitionBy(*group)
    if first is not None:
        counts = counts.withColumn("total", F.sum("n").over(whole)).withColumn("wanted", first)
    upto = F.sum("n").over(
        whole.orderBy(digit).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = F.filter(
        "wanted",
        lambda w: (w["rank"] >= F.col("upto") - F.col("n")) & (w["rank"] < F.col("upto")),
    )
    shifted = F.transform(
        inside, lambda w: w.withField("rank", w["rank"] - (F.col("upto") - F.col("n")))
    )
    return (
        counts.withColumn("upto", upto)
        .withColumn("wanted", shifted)
        .filter(F.size("wanted") > 0)
        .select(*group, digit, "wanted")
    )


def as_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The columns as doubles, NaN as NULL."""
    nothing = F.lit(None).cast("double")
    return df.select(*[F.nanvl(F.col(c).cast("double"), nothing).alias(c) for c in columns])


def bracket_ranks(
    numbers: DataFrame, columns: list[str], probabilities: Mapping[str, float],
    measures: Mapping[str, Callable[[str], Column]] | None = None,
) -> Row:
    """First pass, run when called: one row with the count of each column (``n<i>``), the ends of
    its brackets (``ends<i>``, two for each probability), and ``measures`` (``<name><i>``)."""
    reach = 2 / ACCURACY
    places = [q for p in probabilities.values() for q in (max(0.0, p - reach), min(1.0, p + reach))]
    found = []
    for i, c in enumerate(columns):
        found.append(F.count(F.col(f"`{c}`")).alias(f"n{i}"))
        found.append(F.percentile_approx(F.col(f"`{c}`"), places, ACCURACY).alias(f"ends{i}"))
        for name, measure in (measures or {}).items():
            found.append(measure(f"`{c}`").alias(f"{name}{i}"))
    return numbers.agg(*found).first()


def _inside(numbers: DataFrame, columns: list[str], brackets: list[tuple[int, float, float]]) -> DataFrame:
    """(bracket, v, n): how often each value inside a bracket occurs, and how many lie below (v
    NULL). Values are combined before the shuffle; those above are not sent at all."""
    cells = []
    for b, (i, low, high) in enumerate(brackets):
        value = F.col(f"`{columns[i]}`")
        held = F.when(value >= low, value)
        cells.append(F.when(value <= high, F.struct(F.lit(b).alias("bracket"), held.alias("v"))))
    each = numbers.select(F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c"))
    return each.groupBy("c.bracket", "c.v").agg(F.count(F.lit(1)).alias("n"))


def ranked_values(
    numbers: DataFrame, columns: list[str], probabilities: Mapping[str, float], ranks: Row,
) -> dict[str, dict[str, float]] | None:
    """Second pass, run when called: the quantiles of each column that has values, or None if a
    bracket missed its ranks. At most two rows a column and quantile reach the driver."""
    brackets, wanted = [], []
    for i in range(len(columns)):
        n = ranks[f"n{i}"]
        for k, p in enumerate(probabilities.values() if n else ()):
            place = (n - 1) * float(p)
            brackets.append((i, *ranks[f"ends{i}"][2 * k:2 * k + 2]))
            wanted.append((place - math.floor(place), math.floor(place), math.ceil(place)))
    if not brackets:
        return {}
    order = Window.partitionBy("bracket").orderBy(F.col("v").asc_nulls_first())
    spec = F.array(*[F.array(F.lit(low).cast("bigint"), F.lit(high).cast("bigint")) for _, low, high in wanted])
    upto = _inside(numbers, columns, brackets).withColumn("upto", F.sum("n").over(order)).withColumn(
        "ends", F.element_at(spec, F.col("bracket") + 1))
    hit = [(F.col("ends")[e] < F.col("upto")) & (F.col("ends")[e] >= F.col("upto") - F.col("n")) for e in (0, 1)]
    found = upto.filter(F.col("v").isNotNull() & (hit[0] | hit[1])).select(
        "bracket", "v", hit[0].alias("lo"), hit[1].alias("hi")).collect()
    lows, highs = ({r["bracket"]: r["v"] for r in found if r[end]} for end in ("lo", "hi"))
    if len(lows) < len(brackets) or len(highs) < len(brackets):
        return None
    out: dict[str, dict[str, float]] = {}
    for b, ((i, _, _), (weight, _, _)) in enumerate(zip(brackets, wanted, strict=True)):
        name = list(probabilities)[b % len(probabilities)]
        lo, hi = lows[b], highs[b]
        out.setdefault(columns[i], {})[name] = lo if lo == hi else lo + (hi - lo) * weight
    return out


def exact_quantiles(
    df: DataFrame, columns: Iterable[str], probabilities: Mapping[str, float],
    keys: Iterable[str] = (),
) -> DataFrame:
    """Interpolated quantiles of numeric columns, per group of ``keys`` if given.

    One row per group and column that has values: the keys, ``column_name`` and one
    column per entry of ``probabilities``. NULL and NaN are not values. Without keys the two
    passes over ``df`` run when the function is called.
    """
    keys, columns = list(keys), list(columns)
    if keys:
        return _located_quantiles(df, columns, probabilities, keys)
    numbers = as_numbers(df, columns)
    found = ranked_values(numbers, columns, probabilities, bracket_ranks(numbers, columns, probabilities))
    if found is None:
        return _located_quantiles(df, columns, probabilities, [])
    fields = ", ".join(f"`{n}` double" for n in probabilities)
    rows = [(c, *(values[n] for n in probabilities)) for c, values in found.items()]
    return df.sparkSession.createDataFrame(rows, f"column_name string, {fields}")


def _located_quantiles(
    df: DataFrame, columns: list[str], probabilities: Mapping[str, float], keys: list[str],
) -> DataFrame:
    """Quantiles located by digits."""
    # One key that is never NULL, as NULL filters on keys would tell the steps' scans apart.
    whole = [F.struct(*keys).alias("_group")] if keys else []
    names = {c: f"_value_{i}" for i, c in enumerate(columns)}
    numbers = df.select(*whole, *[F.col(c).cast("double").alias(n) for c, n in names.items()])
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(n).alias("v")) for c, n in names.items()])
    each = ["_group"] if keys else []
    long = numbers.select(*each, F.inline(values)).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    if keys:
        counts = long.groupBy("_group", "column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = long.withColumn("n", F.lit(1).cast("bigint"))
    first, second = _digits(F.col("v"))
    long = counts.withColumns({"d1": first, "d2": second})

    def narrow(rows: DataFrame, places: DataFrame, on: list[str]) -> DataFrame:
        if keys:
            return salted_join(rows, places, on, "inner", right_unique=True)
        # At most two rows per column and quantile.
        return rows.join(F.broadcast(places), on)

    group = [*each, "column_name"]
    at_first = _locate(long, group, "d1", _wanted(probabilities, F.col("total")))
    near = narrow(long, at_first, [*group, "d1"])
    at_second = _locate(near, [*group, "d1"], "d2", None)
    nearest = narrow(near.drop("wanted"), at_second, [*group, "d1", "d2"])
    found = _locate(nearest, [*group, "d1", "d2"], "v", None).select(
        *group, "v", F.inline("wanted")
    )

    def end_of(name: str, end: str) -> Column:
        return F.max(F.when((F.col("name") == name) & (F.col("end") == end), F.col("v")))

    def value(name: str) -> Column:
        lo, hi = end_of(name, "lo"), end_of(name, "hi")
        weight = F.max(F.when(F.col("name") == name, F.col("weight")))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * weight)

    found = found.groupBy(*group).agg(*[value(n).alias(n) for n in probabilities])
    return found.select(*[F.col("_group")[k].alias(k) for k in keys], "column_name", *probabilities)
