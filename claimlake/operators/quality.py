"""Data-quality checks, record validation with quarantine, and the load gate."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_schema(
    df: DataFrame, expected: Iterable[str], nullable: Iterable[str] = ()
) -> DataFrame:
    """Problems found: (column_name, problem, null_count), empty for a sound table.

    A missing column is reported without reading data; NULLs in the columns that may
    not hold any are counted in one pass.
    """
    expected, nullable = list(expected), set(nullable)
    missing = [c for c in expected if c not in df.columns]
    required = [c for c in expected if c in df.columns and c not in nullable]
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit("missing column").alias("problem"),
            F.lit(None).cast("bigint").alias("null_count"),
        )
        for c in missing
    ] + [
        F.struct(
            F.lit(c).alias("column_name"), F.lit("null values").alias("problem"),
            F.col(f"n{i}").alias("null_count"),
        )
        for i, c in enumerate(required)
    ]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(required)],
    )
    kind = "array<struct<column_name:string,problem:string,null_count:bigint>>"
    found = F.array(*cells).cast(kind)
    return counts.select(F.inline(found)).filter(
        "null_count IS NULL OR null_count > 0"
    )


def schema_is_sound(
    df: DataFrame, expected: Iterable[str], nullable: Iterable[str] = ()
) -> bool:
    return check_schema(df, expected, nullable).isEmpty()


def check_types(df: DataFrame, expected: Mapping[str, str | T.DataType]) -> dict[str, str]:
    """Columns that are absent or of another type, with the type found."""
    wrong = {}
    for column, want in expected.items():
        if column not in df.columns:
            wrong[column] = "missing column"
            continue
        kind = df.schema[column].dataType
        names = {kind.simpleString(), kind.typeName()}
        if not (kind == want if isinstance(want, T.DataType) else want in names):
            wrong[column] = kind.simpleString()
    return wrong


CHECKS = ("has_data", "no_nulls", "expected_columns", "unique_keys")


def check_table(
    df: DataFrame, table: str, required: Iterable[str] = (), keys: Iterable[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Four checks as rows (table_name, check_name, passed).

    NULLs are looked for in the required columns, with ``strict`` in all. Without keys
    the uniqueness check passes; missing keys are no group and repeat nothing.
    """
    required, keys = list(required), list(keys)
    present = [c for c in required if c in df.columns]
    looked_at = df.columns if strict else present
    holes = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in looked_at], F.lit(False))
    one_pass = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(holes).alias("with_nulls")
    )
    results = {
        "has_data": F.col("rows") > 0,
        "no_nulls": F.col("with_nulls") == 0,
        "expected_columns": F.lit(len(present) == len(required)),
    }
    if not keys:
        results["unique_keys"] = F.lit(True)
    cells = [
        F.struct(F.lit(name).alias("check_name"), passed.alias("passed"))
        for name, passed in results.items()
    ]
    out = one_pass.select(F.lit(table).alias("table_name"), F.inline(F.array(*cells)))
    if keys:
        repeats = (
            df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("repeated"))
        )
        unique = repeats.select(
            F.lit(table).alias("table_name"), F.lit("unique_keys").alias("check_name"),
            (F.col("repeated") == 0).alias("passed"),
        )
        out = out.unionByName(unique)
    return out


def observe_checks(
    df: DataFrame, required: Iterable[str] = (), strict: bool = False,
) -> tuple[DataFrame, Callable[[], dict[str, bool]]]:
    """``df`` watched while it is written, and what its first three checks say after that.

    As ``check_table`` without keys, but the rows and holes are counted by the write itself.
    """
    required = list(required)
    present = [c for c in required if c in df.columns]
    looked_at = df.columns if strict else present
    holes = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in looked_at], F.lit(False))
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(holes).alias("with_nulls"))

    def results() -> dict[str, bool]:
        counts = seen.get
        return {"has_data": counts["rows"] > 0, "no_nulls": counts["with_nulls"] == 0,
                "expected_columns": len(present) == len(required)}

    return watched, results


def keys_repeat(df: DataFrame, keys: Iterable[str]) -> bool:
    """Whether some key occurs twice; missing keys are no group and repeat nothing."""
    keys = list(keys)
    if not keys:
        return False
    groups = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return not groups.filter("n > 1").isEmpty()


def check_written(df: DataFrame, table: str, required: Iterable[str]) -> DataFrame:
    """A written table holds rows and every required column: (table_name, check_name, passed)."""
    rows = df.agg((F.count(F.lit(1)) > 0).alias("filled"))
    cells = [F.struct(F.lit("has_data").alias("check_name"), F.col("filled").alias("passed"))]
    cells += [F.struct(F.lit(f"column {c}").alias("check_name"), F.lit(c in df.columns).alias("passed")) for c in required]
    return rows.select(F.lit(table).alias("table_name"), F.inline(F.array(*cells)))


def type_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """(column_name, expected, found, matches, unread): the type of each expected column, and how
    many of its values do not convert to the expected type (absent columns: NULL)."""
    wrong = check_types(df, expected)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(f"_unread_{i}")
        for i, (c, kind) in enumerate(expected.items()) if c in kinds])
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(kind).alias("expected"),
            F.lit(kinds.get(c)).cast("string").alias("found"), F.lit(c not in wrong).alias("matches"),
            (F.col(f"_unread_{i}") if c in kinds else F.lit(None).cast("bigint")).alias("unread"))
        for i, (c, kind) in enumerate(expected.items())
    ]
    return counts.select(F.inline(F.array(*cells)))


def load_gate(checks: DataFrame) -> DataFrame:
    """(tables, failed, load): a load goes ahead only if every check of every table passes."""
    return checks.agg(
        F.count_distinct("table_name").alias("tables"), F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.every("passed"), F.lit(False)).alias("load"))


def check_tables(
    tables: Mapping[str, DataFrame], required: Mapping[str, list[str]] | None = None,
    keys: Mapping[str, list[str]] | None = None, strict: bool = False,
) -> DataFrame:
    """The checks of several tables in one result."""
    required, keys = required or {}, keys or {}
    return reduce(
        DataFrame.unionByName,
        [
            check_table(df, name, required.get(name, ()), keys.get(name, ()), strict)
            for name, df in tables.items()
        ],
    )


def failed_checks(checks: DataFrame) -> list[tuple[str, str]]:
    """Failed (table, check) pairs: at most four per table."""
    rows = checks.filter("NOT passed").select("table_name", "check_name").collect()
    return sorted((r[0], r[1]) for r in rows)


def violations(df: DataFrame, schema: T.StructType) -> Column:
    """Why a row does not fit a record model: an array, empty for a fitting row.

    Only what can fail is looked at: a value already of the model's type converts, and
    an optional one may be absent.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    reasons = []
    for f in schema:
        if f.name not in kinds:
            if not f.nullable:
                reasons.append(F.lit(f"{f.name}: missing"))
            continue
        value = F.col(f.name)
        missing = F.when(value.isNull(), f"{f.name}: missing")
        if kinds[f.name] != f.dataType:
            unread = value.try_cast(f.dataType).isNull()
            wrong = f"{f.name}: not {f.dataType.simpleString()}"
            reasons.append(
                F.when(value.isNotNull() & unread, wrong) if f.nullable
                else missing.when(unread, wrong)
            )
        elif not f.nullable:
            reasons.append(missing)
    joined = F.concat_ws("\n", *reasons) if reasons else F.lit("")
    nothing = F.array().cast("array<string>")
    return F.when(joined == "", nothing).otherwise(F.split(joined, "\n"))


def validate_records(
    df: DataFrame, schema: T.StructType, mode: str = "quarantine", folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split rows into those that fit a record model, typed by it, and the rest.

    The rest carry their ``reasons``. Columns outside the model are kept. With
    ``mode="fail"`` any misfit is an error, which counts them first. With a ``folder`` the judged
    rows are written there once, partitioned by the verdict, and either result reads its own
    partition; without one, each result evaluates ``df`` when it is read.
    """
    if mode not in ("quarantine", "fail"):
        raise ValueError(f"unknown mode {mode!r}")
    judged = df.withColumn("reasons", violations(df, schema))
    if folder is None:
        bad, good = judged.filter(F.size("reasons") > 0), judged.filter(F.size("reasons") == 0)
    else:
        verdict = "_fits"
        while verdict in df.columns:
            verdict += "_"
        judged = judged.withColumn(verdict, F.size("reasons") == 0)
        judged.write.partitionBy(verdict).parquet(folder)
        stored = df.sparkSession.read.schema(judged.schema).parquet(folder)
        bad, good = (stored.filter(F.col(verdict) == v).drop(verdict) for v in (False, True))
    if mode == "fail":
        n = bad.count()
        if n:
            raise ValueError(f"{n} rows do not fit the record model")
    typed = {
        f.name: F.col(f.name).try_cast(f.dataType)
        for f in schema
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    }
    good = good.drop("reasons")
    return (good.withColumns(typed) if typed else good), bad


def staging_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    path = path or spark.sparkContext.getCheckpointDir()
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return path
