"""Helpers of the corpus operators: shared staging, safe joins and byte slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one vector operation works on, and that one block of rows holds.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named in ``spark.checkpoint.dir``.

    Only where a local session names none, as in tests, a local folder is used: executors on other
    machines would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"file://{tempfile.gettempdir()}/claimlake-shared"
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Cuts the lineage: a lost executor costs a read of the files, not of what came before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, drop: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``df`` with its columns renamed by place, so that they meet no name an operator adds; the
    new name of each column; and what selects them back. Columns named in ``drop`` go."""
    kept = [c for c in df.columns if c.lower() not in drop]
    names = {c: f"c{i}" for i, c in enumerate(kept)}
    inner = df.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    return inner, names, [F.col(n).alias(c) for c, n in names.items()]


def attach_small(df: DataFrame, small: DataFrame, key: str, max_rows: int = 100_000) -> DataFrame:
    """Left join on ``key``, nulls matching nulls; ``small`` (staged, one row a key) is broadcast
    after its rows were counted, and joined by a shuffle beyond ``max_rows``. The rows are the
    same either way."""
    tagged = small.withColumnRenamed(key, "_small_key")
    if small.count() <= max_rows:
        tagged = F.broadcast(tagged)
    return df.join(tagged, df[key].eqNullSafe(F.col("_small_key")), "left").drop("_small_key")


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unit(seed: int, *columns: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the values only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary Arrow column end to end, and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]] if len(offsets) else flat, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer row stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(n, max(low + 1, high))
        yield low, high
        low = high
