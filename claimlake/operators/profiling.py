"""Column and table profiles, in long format, without pulling rows to the driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.quantiles import as_numbers, bracket_ranks, exact_quantiles, ranked_values

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)

# Common values listed; distinct share below which a string repeats.
MOST_COMMON = 5
LOW_CARDINALITY = 0.5

INTEGER_LADDER = [
    ("tinyint", -(1 << 7), (1 << 7) - 1, 1),
    ("smallint", -(1 << 15), (1 << 15) - 1, 2),
    ("int", -(1 << 31), (1 << 31) - 1, 4),
    ("bigint", -(1 << 63), (1 << 63) - 1, 8),
]


def columns_of(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, *INTEGERS, *FLOATS, T.DecimalType)


def string_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.StringType)


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and duplicate rows (repeats after the first) of a table."""
    # Hashes are counted; whole rows are compared only where a hash repeats.
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    counts = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    again = hashed.join(counts.filter("n > 1").select("_hash"), "_hash", "left_semi")
    again = again.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("repeats"))
    rows = counts.agg(F.sum("n").alias("rows"), F.lit(0).cast("bigint").alias("repeats"))
    repeats = again.agg(F.lit(0).cast("bigint").alias("rows"), F.sum("repeats").alias("repeats"))
    return rows.unionByName(repeats).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum("repeats"), F.lit(0)).alias("duplicate_rows"),
    )


def _as_text(df: DataFrame, columns: Iterable[str], instants: bool = False) -> DataFrame:
    """Listed columns as (column_name, value) rows of text; 0.0 and -0.0 are one.

    With ``instants`` a timestamp is its microseconds: as local text, two instants of the
    hour that clocks repeat would be one.
    """
    def text(c: str) -> Column:
        value = F.col(c)
        if instants and isinstance(df.schema[c].dataType, T.TimestampType):
            value = F.unix_micros(c)
        if isinstance(df.schema[c].dataType, FLOATS):
            value = F.when(~F.isnan(c), value + F.lit(0.0).cast(df.schema[c].dataType))
        return value.cast("string").alias(c)

    columns = list(columns)
    return df.select(*[text(c) for c in columns]).unpivot(
        [], columns, "column_name", "value"
    )


def value_counts(
    df: DataFrame, columns: Iterable[str], instants: bool = False
) -> DataFrame:
    """How often each value of each column occurs, NULL included."""
    return (
        _as_text(df, columns, instants).groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


# Texts up to this many bytes are counted as they are, longer ones by a 128-bit digest.
PLAIN_BYTES = 15


def _cell(df: DataFrame, i: int, column: str) -> Column:
    """A value as (column number, whole number, double, bytes), one of the last three set.

    Equal values, and only those, have equal cells: numbers, dates and times in eight bytes, other
    values as text, of which a long one is digested (a digest is longer than any plain text). NaN
    counts as missing, and 0.0 and -0.0 are one.
    """
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType
    whole, real, other = (F.lit(None).cast(t) for t in ("bigint", "double", "binary"))
    if isinstance(kind, (*INTEGERS, T.BooleanType)):
        whole = value.cast("bigint")
    elif isinstance(kind, T.DateType):
        whole = F.unix_date(value).cast("bigint")
    elif isinstance(kind, T.TimestampType):
        whole = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        whole = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), value)
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        whole = (value * F.lit(10 ** kind.scale)).cast("bigint")
    elif isinstance(kind, FLOATS):
        real = F.when(~F.isnan(value), value.cast("double") + F.lit(0.0))
    else:
        text = value.cast("string").cast("binary")
        other = F.when(F.octet_length(text) <= PLAIN_BYTES, text).otherwise(F.unhex(F.md5(text)))
    return F.struct(F.lit(i).alias("i"), whole.alias("whole"), real.alias("real"), other.alias("other"))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, NULL count and share, distinct count and share of every column.

    The exact distinct counts come from one shuffle of the values, each sent on once
    per task: numbers as such, long texts as digests. ``approximate`` counts them in fixed
    space instead.
    """
    kinds = F.create_map(
        *[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())]
    )
    if approximate:
        counts = _as_text(df, df.columns, instants=True).groupBy("column_name").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("value").isNull()).alias("null_count"),
            F.approx_count_distinct("value").alias("distinct_count"),
        )
    else:
        cells = df.select(F.explode(F.array(*[_cell(df, i, c) for i, c in enumerate(df.columns)])).alias("c"))
        values = cells.groupBy("c.i", "c.whole", "c.real", "c.other").agg(F.count(F.lit(1)).alias("n"))
        missing = F.col("whole").isNull() & F.col("real").isNull() & F.col("other").isNull()
        names = F.array(*[F.lit(c) for c in df.columns])
        counts = values.groupBy("i").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_count"),
            F.count_if(~missing).alias("distinct_count"),
        ).withColumn("column_name", F.element_at(names, F.col("i") + 1))
    return counts.select(
        "column_name",
        kinds[F.col("column_name")].alias("type"),
        "null_count",
        _percent(F.col("null_count"), F.col("rows")).alias("null_percentage"),
        "distinct_count",
        _percent(F.col("distinct_count"), F.col("rows")).alias("distinct_percentage"),
    )


def _corrected(n: Column, skew: Column, kurt: Column) -> tuple[Column, Column]:
    """Sample skewness and excess kurtosis from the population figures."""
    n = n.cast("double")
    g1 = F.when(n > 2, skew * F.sqrt(n * (n - 1)) / (n - 2))
    g2 = F.when(
        n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * kurt + 6)
    )
    return g1, g2


_MOMENTS = {
    "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "g1": F.skewness, "g2": F.kurtosis,
}


def numeric_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Mean, deviation, range, median, skewness and kurtosis per numeric column.

    The moments and the brackets of the medians come from one pass over ``df``, the medians from
    a second; both run when the function is called.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    wanted, numbers = {"median": 0.5}, as_numbers(df, columns)
    found = bracket_ranks(numbers, columns, wanted, {name: f for name, f in _MOMENTS.items()})
    medians = ranked_values(numbers, columns, wanted, found)
    if medians is None:
        medians = {r["column_name"]: {"median": r["median"]} for r in exact_quantiles(df, columns, wanted).collect()}
    rows = [(c, found[f"n{i}"], *(found[f"{m}{i}"] for m in _MOMENTS), medians.get(c, {}).get("median"))
            for i, c in enumerate(columns)]
    fields = ", ".join(f"{m} double" for m in _MOMENTS)
    moments = df.sparkSession.createDataFrame(rows, f"column_name string, n bigint, {fields}, median double")
    skewness, kurtosis = _corrected(F.col("n"), F.col("g1"), F.col("g2"))
    return moments.select(
        "column_name", "mean", "std", "min", "max", "median",
        skewness.alias("skewness"), kurtosis.alias("kurtosis"),
    )


# Hash buckets that the values of a column are counted in, and those looked into first.
VALUE_BUCKETS, FIRST_BUCKETS = 1 << 14, 64


def _ranked_values(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most common values per column, ties in value order. Only ``n`` rows per column
    leave each task: the planner limits the groups before the shuffle."""
    place = F.row_number().over(
        Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    )
    return (
        counts.filter(F.col("value").isNotNull())
        .withColumn("place", place)
        .filter(F.col("place") <= n)
        .select("column_name", "place", "value", "n")
    )


def _heavy_buckets(text: DataFrame) -> tuple[dict[str, list[int]], dict[str, int]]:
    """Per column the fullest hash buckets of its values, and the most rows of any other bucket,
    which no value outside the fullest ones can exceed. At most ``FIRST_BUCKETS`` + 1 rows a
    column reach the driver."""
    loads = text.groupBy("column_name", "bucket").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), "bucket"))
    found = loads.withColumn("place", place).filter(F.col("place") <= FIRST_BUCKETS + 1).collect()
    inside: dict[str, list[int]] = {}
    rest: dict[str, int] = {}
    for r in found:
        if r["place"] <= FIRST_BUCKETS:
            inside.setdefault(r["column_name"], []).append(r["bucket"])
        else:
            rest[r["column_name"]] = r["n"]
    return inside, rest


def most_common(
    df: DataFrame, columns: Iterable[str] | None = None, n: int = MOST_COMMON,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """The ``n`` most common values per column, ties in value order.

    Columns in ``exclude`` are left out, whatever their case. The values are counted by hash bucket
    first and one by one in the fullest buckets only; both passes run when the function is called.
    Where the n-th best of those does not exceed every other bucket, as in a flat column, all
    values of the column are counted.
    """
    wanted = string_columns(df) if columns is None else list(columns)
    left_out = {c.lower() for c in exclude}
    wanted = [c for c in wanted if c.lower() not in left_out]
    schema = "column_name string, place int, value string, n bigint"
    if not wanted:
        return df.sparkSession.createDataFrame([], schema)
    text = _as_text(df, wanted).filter(F.col("value").isNotNull()).withColumn(
        "bucket", F.pmod(F.xxhash64("value"), F.lit(VALUE_BUCKETS)).cast("int"))
    inside, rest = _heavy_buckets(text)
    if not inside:
        return df.sparkSession.createDataFrame([], schema)
    full = reduce(lambda x, y: x | y, [
        (F.col("column_name") == c) & F.col("bucket").isin(buckets) for c, buckets in inside.items()])
    counts = text.filter(full).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best: dict[str, list[tuple]] = {}
    for r in _ranked_values(counts, n).collect():  # at most n rows a column
        best.setdefault(r["column_name"], []).append(tuple(r))
    decided = [c for c in inside if c not in rest or (len(best[c]) == n and min(r[3] for r in best[c]) > rest[c])]
    out = df.sparkSession.createDataFrame([r for c in decided for r in best[c]], schema)
    open_ = [c for c in wanted if c in inside and c not in decided]
    if open_:
        out = out.unionByName(_ranked_values(value_counts(df, open_), n))
    return out


def string_lengths(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Mean length per string column."""
    columns = string_columns(df) if columns is None else list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, avg_length double")
    means = df.agg(*[F.avg(F.length(F.col(c).cast("string"))).alias(f"m{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("avg_length"))
             for i, c in enumerate(columns)]
    return means.select(F.inline(F.array(*cells)))


def string_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Most common values and mean length per string column."""
    common = most_common(df, columns)
    lengths = string_lengths(df, columns)
    # One row per column on the left, at most a handful on the right.
    return lengths.join(common, "column_name", "left").select(
        "column_name", "avg_length", "place", "value", "n"
    )


def correlations(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Correlation of every pair of numeric columns over rows where both are present."""
    columns = numeric_columns(df) if columns is None else list(columns)
    numbers = df.select(
        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c)
          for c in columns]
    )
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    sums = numbers.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(
            F.lit(x).alias("column_a"), F.lit(y).alias("column_b"),
            F.col(f"r{i}").alias("correlation"),
        )
        for i, (a, b) in enumerate(pairs)
        for x, y in ({(a, b), (b, a)})
    ]
    return sums.select(F.inline(F.array(*cells)))


def narrowing_advice(df: DataFrame) -> DataFrame:
    """Range, suggested type and share of space saved, for columns that can shrink.

    Integers take the smallest signed type that holds their range, doubles could be
    floats, and strings with under half distinct values suit dictionary encoding.
    """
    ints, floats = columns_of(df, *INTEGERS), columns_of(df, T.DoubleType)
    parts = []
    if ints or floats:
        ends = [F.struct(F.lit(c).alias("column_name"), F.min(f"`{c}`").cast("double").alias("low"),
                         F.max(f"`{c}`").cast("double").alias("high"), _advice(df, c).alias("advice"))
                for c in ints + floats]
        ranges = df.agg(F.array(*ends).alias("ends")).select(F.inline("ends"))
        parts.append(ranges.filter("low IS NOT NULL").select("column_name", "low", "high", "advice.*"))
    strings = string_columns(df)
    if strings:
        repeats = column_profile(df.select(*strings)).filter(
            F.col("distinct_percentage") < LOW_CARDINALITY * 100
        )
        nothing = F.lit(None).cast("double")
        parts.append(
            repeats.select(
                "column_name", nothing.alias("low"), nothing.alias("high"),
                F.lit("dictionary").alias("suggested_type"),
                nothing.alias("saved_percentage"),
            )
        )
    if not parts:
        raise ValueError("no integer, double or string columns")
    return reduce(DataFrame.unionByName, parts)


def _advice(df: DataFrame, column: str) -> Column:
    """Suggested type and share saved: the smallest type that holds the range, or a float."""
    if column not in columns_of(df, *INTEGERS):
        return F.struct(F.lit("float").alias("suggested_type"), F.lit(50.0).alias("saved_percentage"))
    kind, bytes_ = F.lit("bigint"), F.lit(8)
    for name, low, high, size in reversed(INTEGER_LADDER):
        fits = (F.min(f"`{column}`") >= F.lit(low)) & (F.max(f"`{column}`") <= F.lit(high))
        kind = F.when(fits, F.lit(name)).otherwise(kind)
        bytes_ = F.when(fits, F.lit(size)).otherwise(bytes_)
    saved = (1 - bytes_ / F.lit(_width(df, column))) * 100
    return F.struct(kind.alias("suggested_type"), F.greatest(saved, F.lit(0.0)).cast("double").alias("saved_percentage"))


def _width(df: DataFrame, column: str) -> int:
    return {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}[
        df.schema[column].dataType.simpleString()
    ]


def narrow_types(df: DataFrame, floats: bool = False) -> DataFrame:
    """Integer columns in the smallest signed type that holds their range.

    ``floats`` also turns doubles to floats, which loses cents on large amounts. The
    ranges, one row, are computed when the function is called.
    """
    ints = columns_of(df, *INTEGERS)
    casts = {c: F.col(c).cast("float") for c in columns_of(df, T.DoubleType)} if floats else {}
    if ints:
        found = df.agg(
            *[F.min(c).alias(f"low_{i}") for i, c in enumerate(ints)],
            *[F.max(c).alias(f"high_{i}") for i, c in enumerate(ints)],
        ).first()
        for i, c in enumerate(ints):
            low, high = found[f"low_{i}"], found[f"high_{i}"]
            if low is None:
                continue
            kind = next(k for k, a, b, _ in INTEGER_LADDER if a <= low and high <= b)
            casts[c] = F.col(c).cast(kind)
    return df.withColumns(casts) if casts else df


def full_profile(df: DataFrame) -> dict[str, DataFrame]:
    """All profile results of a table, by name."""
    out = {"table": table_profile(df), "columns": column_profile(df),
           "narrowing": narrowing_advice(df)}
    numbers = numeric_columns(df)
    if numbers:
        out["numeric"] = numeric_profile(df, numbers)
    if len(numbers) > 1:
        out["correlations"] = correlations(df, numbers)
    if string_columns(df):
        out["strings"] = string_profile(df)
    return out


def profile_rows(profile: Mapping[str, DataFrame]) -> DataFrame:
    """All results of a profile as one table: (section, subject, measure, number, text).

    The subject is the column, the two columns or the column and place that a row is about.
    """
    about, parts = ("column_name", "column_a", "column_b", "place"), []
    for section, result in profile.items():
        keys = [F.col(c).cast("string") for c in about if c in result.columns]
        cells = []
        for f in result.schema:
            if f.name in about:
                continue
            text = isinstance(f.dataType, T.StringType)
            cells.append(F.struct(
                F.lit(f.name).alias("measure"),
                (F.lit(None) if text else F.col(f.name)).cast("double").alias("number"),
                (F.col(f.name) if text else F.lit(None)).cast("string").alias("text")))
        parts.append(result.select(
            F.lit(section).alias("section"), F.concat_ws("|", *keys).alias("subject"), F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)
