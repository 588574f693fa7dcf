"""Exact Lloyd clustering with the dimensions cut into shards.

Vectors are packed once into blocks of rows, and every block into cells, one for each shard of
dimensions. The cells are a table bucketed by (shard, block), so no round moves them. A round is
one Spark job: every cell meets only its shard's slice of the centroids and yields exact partial
distances; these are added by block of rows, and the argmin gives the labels; the labels go back
to the cells, and every shard adds up and divides its own components. No centroid passes
through the driver, and distances and sums are whole numbers, so reruns agree to the last bit.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm.common import shared_dir, stage

#: Rows of a block, dimensions of a shard, and bytes of the cells that one task reads.
BLOCK_ROWS, SHARD_DIMS, TASK_BYTES = 4096, 16, 16 << 20
#: Bytes of all centroids up to which the slices are broadcast; beyond, they are sent to the cells.
BROADCAST_BYTES = 16 << 20
#: Scaled components beyond this have squared distances that may leave 64 bits.
MOST = 1 << 27


def scaled(vector: Column, dims: int, factor: int = 1024) -> Column:
    """floor(factor * x) of each component as long; null for vectors that are not kept."""
    x = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * factor))
    fits = F.forall(whole, lambda c: F.abs(c) <= MOST)
    loud = F.raise_error(F.lit(f"a scaled component is beyond {MOST}: its squared distance may not fit in 64 bits"))
    kept = vector.isNotNull() & (F.size(vector) == dims) & ~bad
    return F.when(kept, F.when(fits, whole).otherwise(loud.cast("array<long>")))


def _packing(dims: int, shard_dims: int):
    """Cells of each block of rows: for every shard the components end to end."""

    def run(batches):
        at = 0
        for batch in batches:
            for low in range(0, len(batch), BLOCK_ROWS):
                rows = batch.slice(low, BLOCK_ROWS)
                x = rows.column("q").flatten().to_numpy().reshape(-1, dims)
                block = (TaskContext.get().partitionId() << 32) + at
                at += 1
                starts = range(0, dims, shard_dims)
                n = len(starts)
                ids = [rows.column("id").to_pylist(), *[None] * (n - 1)]
                yield pa.record_batch({
                    "block": pa.array([block] * n, pa.int64()), "shard": pa.array(range(n), pa.int32()),
                    "ids": pa.array(ids, pa.list_(pa.int64())),
                    "cells": pa.array([x[:, s:s + shard_dims].astype("<i4").tobytes() for s in starts], pa.binary())})

    return run


def _grid(cells: bytes, shard: int, dims: int, shard_dims: int) -> np.ndarray:
    return np.frombuffer(cells, "<i4").reshape(-1, min(shard_dims, dims - shard * shard_dims)).astype(np.int64)


def _partial(dims: int, shard_dims: int):
    """Exact partial distances of a cell's rows to its shard's slice of every centroid."""

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                x = _grid(batch.column("cells")[i].as_py(), batch.column("shard")[i].as_py(), dims, shard_dims)
                slices = batch.column("slice")[i].values.to_numpy().reshape(-1, x.shape[1])
                part = np.empty((len(x), len(slices)), np.int64)
                for c in range(len(slices)):
                    gap = x - slices[c]
                    part[:, c] = (gap * gap).sum(axis=1)
                yield pa.record_batch({"block": batch.column("block").slice(i, 1), "k": pa.array([len(slices)], pa.int32()),
                                       "part": pa.array([part.tobytes()], pa.binary())})

    return run


def _argmin(table: pa.Table) -> pa.Table:
    """Add the partial distances of one block; the nearest centroid of each row, ties to the smaller."""
    total = sum(np.frombuffer(p.as_py(), np.int64) for p in table.column("part"))
    total = total.reshape(-1, table.column("k")[0].as_py())
    label = total.argmin(axis=1)
    return pa.table({"block": table.column("block")[:1],
                     "labels": pa.array([label.astype("<i4").tobytes()], pa.binary()),
                     "distances": pa.array([total[np.arange(len(total)), label].tobytes()], pa.binary())})


def _sums(dims: int, shard_dims: int):
    """Counts and sums of each cluster over all cells of the task, one row for each component."""

    def run(batches):
        sums: dict[int, dict[int, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                x = _grid(row["cells"], row["shard"], dims, shard_dims)
                label = np.frombuffer(row["labels"], "<i4")
                order = np.argsort(label, kind="stable")
                names, first = np.unique(label[order], return_index=True)
                counts = np.diff(np.append(first, len(label)))
                part = np.concatenate([np.add.reduceat(x[order], first, axis=0), counts[:, None]], axis=1)
                held = sums.setdefault(row["shard"], {})
                for name, values in zip(names.tolist(), part, strict=True):
                    held[name] = held[name] + values if name in held else values
        for shard, held in sums.items():
            for name, values in held.items():
                n = len(values) - 1
                yield pa.record_batch({
                    "shard": pa.array([shard] * n, pa.int32()), "cluster": pa.array([name] * n, pa.int32()),
                    "dim": pa.array(range(n), pa.int32()), "total": pa.array(values[:-1]),
                    "n": pa.array([int(values[-1])] * n, pa.int64())})

    return run


def _unpack(batches):
    """A row for each vector of a labelled block."""
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.record_batch({
                "id": pa.array(row["ids"], pa.int64()), "cluster": pa.array(np.frombuffer(row["labels"], "<i4"), pa.int32()),
                "distance": pa.array(np.frombuffer(row["distances"], np.int64))})


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, factor: int = 1024, seed: int = 3,
            id_col: str = "vec_id", vector_col: str = "embedding", shard_dims: int = SHARD_DIMS) -> DataFrame:
    """Clusters of ``vectors`` after ``rounds`` of Lloyd's algorithm in whole numbers.

    Vectors with exactly ``dims`` components, none null or non-finite, are kept, as
    floor(factor * x). Centroids start as the k kept vectors with the smallest hexadecimal
    sha256 of ``seed:id``, in that order; equal hashes (repeated ids) go by the components, and
    rows without an id come last. Each round assigns every vector to the nearest centroid (ties:
    smaller number) and replaces each non-empty centroid by floor(sum / count); empty ones stay.
    Then vectors are assigned once more. With fewer than k vectors there are fewer centroids.

    Returns a row for each kept row, repeats included: ``id_col``, cluster, distance, the sums of
    distances over the cluster and over all, and the sha256 of the final centroid's components.
    Other columns are ignored; an empty table gives no rows. A scaled component beyond 2^27 is
    an error, as distances must fit in 64 bits.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), dims, factor).alias("q")).where("q is not null")
    n_rows = kept.count()
    shards = -(-dims // shard_dims)
    tasks = max(1, -(-n_rows * dims * 4 // TASK_BYTES))
    name, path = f"cells_{uuid.uuid4().hex}", f"{shared_dir(spark)}/cells-{uuid.uuid4().hex}"
    cells = kept.mapInArrow(_packing(dims, shard_dims), "block long, shard int, ids array<long>, cells binary")
    cells = cells.repartition(tasks * shards, "shard", "block")
    cells.write.bucketBy(tasks * shards, "shard", "block").option("path", path).format("parquet").saveAsTable(name)
    cells = spark.table(name)
    grid = cells.select("block", "shard", "cells")

    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    start = kept.select(first.alias("h"), "q").orderBy(F.col("h").asc_nulls_last(), "q").limit(k)
    start = start.withColumn("cluster", F.row_number().over(Window.orderBy(F.col("h").asc_nulls_last(), "q")) - 1)
    parted = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.slice("q", s * shard_dims + 1, F.lit(shard_dims)))
    centroids = stage(start.select("cluster", F.posexplode(parted).alias("shard", "part")), "centroids")

    def labelled(centroids: DataFrame) -> DataFrame:
        """Labels and distances of every block of rows."""
        slices = centroids.groupBy("shard").agg(F.flatten(F.transform(
            F.sort_array(F.collect_list(F.struct("cluster", "part"))), lambda c: c["part"])).alias("slice"))
        if k * dims * 8 <= BROADCAST_BYTES:
            near = grid.join(F.broadcast(slices), "shard")
        else:
            copies = slices.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
            parted = grid.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(tasks)).cast("int"))
            near = parted.join(copies.hint("shuffle_hash"), ["shard", "part"])
        near = near.select("block", "shard", "cells", "slice")
        partial = near.mapInArrow(_partial(dims, shard_dims), "block long, k int, part binary")
        return partial.groupBy("block").applyInArrow(_argmin, "block long, labels binary, distances binary")

    for _ in range(rounds):
        labels = labelled(centroids).select(F.col("block").alias("of"), "labels")
        cell = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("to")
        sent = labels.select("of", cell, "labels")
        back = grid.join(sent.hint("shuffle_hash"), (F.col("shard") == F.col("to")) & (F.col("block") == F.col("of")))
        sums = back.select("shard", "cells", "labels").mapInArrow(
            _sums(dims, shard_dims), "shard int, cluster int, dim int, total long, n long")
        sums = sums.groupBy("shard", "cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        mean = F.expr("(total - pmod(total, n)) div n")
        means = sums.withColumn("mean", mean).groupBy("shard", "cluster").agg(F.transform(
            F.sort_array(F.collect_list(F.struct("dim", "mean"))), lambda d: d["mean"]).alias("mean"))
        moved = centroids.join(means, ["shard", "cluster"], "left")
        centroids = stage(moved.select("cluster", "shard", F.coalesce("mean", "part").alias("part")), "centroids")

    ids = cells.where("shard = 0").select(F.col("block").alias("of"), "ids")
    final = labelled(centroids)
    rows = stage(final.join(ids, F.col("block") == F.col("of")).select("ids", "labels", "distances").mapInArrow(
        _unpack, "id long, cluster int, distance long"), "labels")
    spark.sql(f"drop table {name}")

    text = F.array_join(F.transform(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("shard", "part"))), lambda s: s["part"])),
                                    lambda x: x.cast("string")), ",")
    named = centroids.groupBy("cluster").agg(F.sha2(text.cast("binary"), 256).alias("centroid_sha256"))
    each = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    each = each.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    each = each.join(named, "cluster")
    if k * 200 <= BROADCAST_BYTES:  # a row of at most 200 bytes for each centroid
        each = F.broadcast(each)
    return rows.join(each, "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

