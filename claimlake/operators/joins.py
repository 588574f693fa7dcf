"""Equi-joins that hold when one key carries a large share of the rows.

* ``attach`` broadcasts a dimension whose bytes were checked to be small, and joins a larger
  one like a fact. Keys are compared by one rule on either way (``key_kind``).
* ``salted_join`` is a plain join, which adaptive execution splits where one side is skewed and
  may be split: either side of an inner join, the left one of a left or anti join. Where the
  right side of a left join is heavy, count its keys once on the stored tables with
  ``heavy_keys`` and pass them: their rows are then dealt over as many tasks as they need.

No input is counted or evaluated before a join unless the caller asks for it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NumericType, ShortType, StringType,
)

BUCKETS = 1 << 14
# Rows of one key that one task takes.
HEAVY_ROWS = 1_000_000
# Facts that may share a value of ``within`` (``attach_role``): each is compared with the pairs of all.
TOGETHER_ROWS = 1_000
# Dimensions up to this many bytes are broadcast.
BROADCAST_BYTES = 64 << 20

_LEFT, _RIGHT = "_left_splits", "_right_splits"
_A, _B, _HIT = "_salt_left", "_salt_right", "_right_row"
# Bucket number of rows whose key has a missing part: they join nothing.
_NO_KEY = -1


@dataclass(frozen=True)
class HeavyKeys:
    """Keys to split, as (key parts..., left splits, right splits), at most one for each
    ``HEAVY_ROWS`` rows of a side, and the splits of left rows without a key."""

    rows: list[tuple]
    no_key_splits: int = 1

    def __bool__(self) -> bool:
        return bool(self.rows) or self.no_key_splits > 1


def _complete(keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])


def key_bucket(keys: list[str]) -> Column:
    hashed = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    return F.when(_complete(keys), hashed).otherwise(_NO_KEY).cast("int")


def split_count(n: int, limit: int) -> int:
    return -(-n // limit)


def heavy_keys(
    left: DataFrame, right: DataFrame | None, keys: list[str],
    heavy_rows: int = HEAVY_ROWS,
) -> HeavyKeys:
    """Keys that hold more rows of a side than one task should get.

    Rows are counted per hash bucket of the key first, at most ``BUCKETS`` + 1 counts a side and
    combined before they are shuffled, and per key only inside buckets above ``heavy_rows``.
    Both inputs are read for it, so call it on stored tables and keep what it returns.
    """
    sides = {0: left} if right is None else {0: left, 1: right}
    no_key, merged = 1, {}
    for side, df in sides.items():
        loads = df.groupBy(key_bucket(keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        found = loads.filter(F.col("n") > heavy_rows).collect()
        if side == 0:
            no_key = max([split_count(r["n"], heavy_rows) for r in found if r["bucket"] == _NO_KEY], default=1)
        inside = [r["bucket"] for r in found if r["bucket"] != _NO_KEY]
        if not inside:
            continue
        counted = df.filter(key_bucket(keys).isin(inside)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        for row in counted.filter(F.col("_n") > heavy_rows).collect():
            *key, n = row
            merged.setdefault(tuple(key), [1, 1])[side] = split_count(n, heavy_rows)
    return HeavyKeys([(*k, l, r) for k, (l, r) in merged.items()], no_key)


_WHOLE_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def key_kind(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> str:
    """The type that two keys are compared in, which holds the values of both exactly.

    Their own if it is one, bigint for whole numbers, a decimal with the digits of both where one
    is a decimal and the other no float, double with a float on one side, and text for all else:
    '01' does not match 1. Where a decimal cannot hold the digits of both (over 38), values that
    do not fit match nothing.
    """
    a, b = left.schema[left_key].dataType, right.schema[right_key].dataType
    if a == b:
        return a.simpleString()
    whole, floats = tuple(_WHOLE_DIGITS), (FloatType, DoubleType)
    if isinstance(a, whole) and isinstance(b, whole):
        return "bigint"
    if not (isinstance(a, NumericType) and isinstance(b, NumericType)):
        return "string"
    if isinstance(a, floats) or isinstance(b, floats):
        return "double"
    digits, scales = zip(*((t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (_WHOLE_DIGITS[type(t)], 0)
                           for t in (a, b)), strict=True)
    return f"decimal({min(38, max(digits) + max(scales))},{max(scales)})"


def _alike(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame | None:
    """The right side with keys of the left side's types, or None if only a common type serves."""
    for k in keys:
        kind = key_kind(left, right, k, k)
        if kind != left.schema[k].dataType.simpleString():
            return None
        right = right.withColumn(k, F.col(k).try_cast(kind))
    return right


def plain_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool = False) -> DataFrame:
    """Join on same-named keys of any types; the left side's keys stay. ``null_safe``: missing
    keys match each other."""
    same = None if null_safe else _alike(left, right, keys)
    if same is not None:
        return left.join(same, keys, how)
    kinds = {k: key_kind(left, right, k, k) for k in keys}
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    other = right.withColumns({names[k]: F.col(k).try_cast(kinds[k]) for k in keys}).drop(*keys)
    on = [left[k].try_cast(kinds[k]) == other[names[k]] for k in keys]
    if null_safe:  # a key that its decimal type cannot hold is not a missing one
        tight = [k for k in keys if kinds[k].startswith("decimal")]
        gaps = {f"_gap_{names[k]}": right[k].isNull() for k in tight}
        other = right.withColumns({names[k]: F.col(k).try_cast(kinds[k]) for k in keys} | gaps).drop(*keys)
        on = [left[k].try_cast(kinds[k]).eqNullSafe(other[names[k]]) for k in keys]
        on += [left[k].isNull() == other[f"_gap_{names[k]}"] for k in tight]
        return left.join(other, reduce(lambda x, y: x & y, on), how).drop(*names.values(), *gaps)
    return left.join(other, reduce(lambda x, y: x & y, on), how).drop(*names.values())


def _salted(
    df: DataFrame, keys: list[str], heavy: DataFrame, own: str, other: str,
    own_salt: str, other_salt: str, copy: bool, no_key_splits: int = 1,
) -> DataFrame:
    """Add the side's own salt, and one copy per split of the opposite side.

    The salt depends on all columns of the row and the input partition: not on row order, so
    that a retried task puts every row where it was before. Only exact copies of one input
    partition stay together.
    """
    columns = df.columns
    df = df.join(F.broadcast(heavy), keys, "left")
    n = F.coalesce(F.col(own), F.lit(1))
    if no_key_splits > 1:
        n = F.when(_complete(keys), n).otherwise(no_key_splits)
    deal = F.pmod(F.xxhash64(F.spark_partition_id(), *columns), n)
    df = df.withColumn(own_salt, F.when(n > 1, deal).otherwise(0).cast("int"))
    copies = F.lit(0)
    if copy:
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
    return df.withColumn(other_salt, copies).select(*columns, other, own_salt, other_salt)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Iterable[str],
    how: str = "left",
    right_unique: bool = False,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Exact inner, left or left-anti equi-join on same-named keys.

    Without ``heavy`` keys it is a plain join. Rows of a heavy left key are dealt over its
    splits and the matching right rows copied to each; for a heavy right key the other way
    round. ``right_unique`` says that a key occurs once on the right, which leaves left rows
    uncopied. Filter the inputs beforehand: filters do not move below a salt. The keys may have
    been counted before the filters: for a left join, those that the right side still holds are
    looked up in it, so that no left row is lost.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if how == "left_anti":
        right, right_unique = right.select(*keys).distinct(), True
    if not heavy:
        return plain_join(left, right, keys, how)
    alike = _alike(left, right, keys)
    if alike is None:
        raise TypeError("heavy keys need keys of one type")
    right = alike

    right = right.dropna(subset=keys)
    key_types = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in keys)
    splits = left.sparkSession.createDataFrame(
        heavy.rows, f"{key_types}, {_LEFT} int, {_RIGHT} int"
    )
    if how == "left" and not right_unique:
        present = right.join(F.broadcast(splits.select(*keys)), keys, "left_semi").select(*keys).distinct()
        splits = splits.join(F.broadcast(present.withColumn(_HIT, F.lit(True))), keys, "left").withColumn(
            _RIGHT, F.when(F.col(_HIT), F.col(_RIGHT)).otherwise(1)).drop(_HIT)
    no_key = 1 if how == "inner" else heavy.no_key_splits
    l = _salted(left, keys, splits, _LEFT, _RIGHT, _A, _B,
                copy=not right_unique, no_key_splits=no_key)
    r = _salted(right, keys, splits, _RIGHT, _LEFT, _B, _A, copy=True)
    r = r.drop(_LEFT)
    on_salt = [*keys, _A, _B]
    if how != "left" or right_unique:
        joined = l.drop(_RIGHT).join(r, on_salt, how)
    else:
        # A copied left row misses the splits that got no right row. A key that is
        # copied for does occur on the right, so the row matched in another split
        # and the miss goes.
        copied = F.coalesce(F.col(_RIGHT), F.lit(1)) > 1
        joined = l.join(r.withColumn(_HIT, F.lit(True)), on_salt, "left").filter(
            F.col(_HIT).isNotNull() | ~copied
        )
    order = [*keys, *(c for c in left.columns if c not in keys)]
    if how != "left_anti":
        order += [c for c in right.columns if c not in keys]
    return joined.select(*order)


def _stored_bytes(df: DataFrame) -> Column:
    """Bytes of a row: its texts, and eight for each other column."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, StringType)]
    return reduce(lambda x, y: x + y, texts, F.lit(8 * (len(df.columns) + 1)))


def check_dimensions(
    dims: Mapping[str, DataFrame], keys: Mapping[str, str]
) -> dict[str, int]:
    """Bytes of each dimension, in one job; a repeated key is an error.

    A repeated key would multiply fact rows, and with them every total.
    """
    counts = [
        dim.groupBy(keys[name]).agg(F.count(F.lit(1)).alias("n"), F.sum(_stored_bytes(dim)).alias("bytes")).agg(
            F.lit(name).alias("name"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.max(F.when(F.col(keys[name]).isNotNull(), F.col("n"))).alias("most"),
        )
        for name, dim in dims.items()
    ]
    found = reduce(DataFrame.union, counts).collect()  # one row per dimension
    repeated = [r["name"] for r in found if (r["most"] or 0) > 1]
    if repeated:
        raise ValueError(f"repeated keys in dimensions: {sorted(repeated)}")
    return {r["name"]: r["bytes"] for r in found}


def table_bytes(dims: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes of each table, in one job."""
    if not dims:
        return {}
    counts = [
        dim.agg(F.lit(name).alias("name"), F.coalesce(F.sum(_stored_bytes(dim)), F.lit(0)).alias("bytes"))
        for name, dim in dims.items()
    ]
    found = reduce(DataFrame.union, counts).collect()  # one row per table
    return {r["name"]: r["bytes"] for r in found}


def attach(
    facts: DataFrame, dim: DataFrame, on: str | list[str], size: int,
    broadcast_bytes: int = BROADCAST_BYTES, null_safe: bool = False,
) -> DataFrame:
    """Left join to a dimension that was checked to have ``size`` bytes."""
    keys = [on] if isinstance(on, str) else list(on)
    if size <= broadcast_bytes:
        dim = F.broadcast(dim)
    return plain_join(facts, dim, keys, "left", null_safe)


def attach_role(
    facts: DataFrame, dim: DataFrame, dim_key: str, fact_key: str,
    labels: Mapping[str, str], size: int, broadcast_bytes: int = BROADCAST_BYTES,
    *, within: str | None = None, slim: DataFrame | None = None,
) -> DataFrame:
    """Attach ``labels`` (dimension column -> output column) through ``fact_key``.

    ``within`` names a column that no fact lacks, by which the facts lie together and which few of
    them share: to a dimension too large to broadcast only its pairs with the key are sent, and
    back with the labels, so that the wide rows stay where they are. The pairs are those of
    ``slim``, the same facts before anything was joined to them.
    """
    view = dim.select(
        F.col(dim_key).alias(fact_key),
        *[F.col(c).alias(out) for c, out in labels.items()],
    ).dropna(subset=[fact_key])
    if within is None or size <= broadcast_bytes:
        return attach(facts, view, fact_key, size, broadcast_bytes)
    pairs = (facts if slim is None else slim).select(within, fact_key).dropna().distinct()
    found = plain_join(pairs, view, [fact_key], "inner").repartition(within)
    found = found.withColumnsRenamed({within: "_within", fact_key: "_key"})
    # equal as two bounds: as a second join key, it would send the facts by both
    same = (F.col(within) == F.col("_within")) & F.col(fact_key).between(F.col("_key"), F.col("_key"))
    order = [fact_key, *(c for c in facts.columns if c != fact_key), *labels.values()]
    return facts.join(found, same, "left").select(*order)
