"""Exact top-k search by the three-phase uniform threshold.

The dimensions of the vectors are cut into lists; a score is the sum of a row's entries in the
lists. Phase 1 takes the best entries of every list in a share of the blocks of rows, resolves
them, and so finds a score that each query's k best rows reach at least. Phase 2 sends that
cutoff with the block of queries: a row that reaches it has an entry of at least the cutoff over
the number of lists in some list, and its entries so far and its length in the lists to come
reach it. List by list, rows and pairs that do not are left out, and phase 3 multiplies out the
remaining lists of the remaining pairs only. Blocks of rows meet blocks of queries in tasks of
bounded size. Equal vectors are one row with its least ids, so ties cost nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm.common import stage

ROWS, QUERIES, LISTS = 4096, 1024, 8
#: One block in how many gives the first cutoff; the share of pairs from which on they are resolved
#: one by one, and pairs multiplied at once.
SEED_SHARE, FEW, PAIRS = 16, 0.2, 1 << 16


def quantised(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component as long; null for vectors that take no part."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(as_double, lambda x: F.floor(x * factor)))


def _pack(table: pa.Table) -> pa.Table:
    """One row for a block: its vectors end to end, their width, and what names them."""
    vectors = table.column("q").combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    cells = np.zeros((len(sizes), width), np.int64)
    cells[np.arange(width) < sizes[:, None]] = flat
    peak = int(np.abs(cells).max(initial=0))
    kind = "<i2" if peak < 1 << 15 else "<i4" if peak < 1 << 31 else "<i8"
    names = table.column("ids").combine_chunks()
    return pa.table({
        "block": table.column("block")[:1], "width": pa.array([width], pa.int32()), "kind": [kind],
        "cells": pa.array([cells.astype(kind).tobytes()], pa.binary()),
        "ids": pa.array([names.to_pylist()], pa.list_(pa.list_(pa.int64())))})


_PACKED = "block long, width int, kind string, cells binary, ids array<array<long>>"


def _cells(table: pa.Table, tag: str) -> np.ndarray:
    width = table.column(f"{tag}width")[0].as_py()
    flat = np.frombuffer(table.column(f"{tag}cells")[0].as_py(), table.column(f"{tag}kind")[0].as_py())
    return flat.reshape(-1, width) if width else np.zeros((len(table.column(f"{tag}ids")[0]), 0))


def _list_scores(rows: np.ndarray, queries: np.ndarray, lists: int) -> list[np.ndarray]:
    """Queries by rows: the entries of each list, exact as 64-bit integers."""
    width = min(rows.shape[1], queries.shape[1])
    peak = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, width)
    kind = np.float32 if peak < 2**24 else np.float64 if peak < 2**53 else np.int64
    out = []
    for part in np.array_split(np.arange(width), lists):
        out.append((queries[:, part].astype(kind) @ rows[:, part].astype(kind).T).astype(np.int64))
    return out


def _local_lists(most: int, lists: int):
    """Phase 1: the best entries of each list of a block, resolved."""

    def run(table: pa.Table) -> pa.Table:
        entries = _list_scores(_cells(table, ""), _cells(table, "q_"), lists)
        total, n = sum(entries), entries[0].shape[1]
        keep = min(most, n)
        best = [np.argpartition(-e, keep - 1, axis=1)[:, :keep] for e in entries]
        seen = np.concatenate(best, axis=1)
        scores = np.take_along_axis(total, seen, axis=1)
        order = np.argsort(-scores, axis=1, kind="stable")
        return _result(table, *_distinct(np.take_along_axis(seen, order, 1), np.take_along_axis(scores, order, 1), keep))

    return run


def _distinct(seen: np.ndarray, scores: np.ndarray, keep: int):
    """The first ``keep`` different rows of each query."""
    query, row, score = [], [], []
    for q in range(len(seen)):
        _, first = np.unique(seen[q], return_index=True)
        for j in np.sort(first)[:keep]:
            query.append(q)
            row.append(seen[q, j])
            score.append(scores[q, j])
    return np.array(query, np.int64), np.array(row, np.int64), np.array(score, np.int64)


def _norms(rows: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """Length of each row in each list."""
    return np.stack([np.sqrt((rows[:, p].astype(float) ** 2).sum(axis=1)) for p in parts], axis=1)


def resolve(rows: np.ndarray, queries: np.ndarray, cut: np.ndarray, lists: int):
    """Queries and rows whose score reaches the query's cutoff, the scores, and how many entries
    (a pair in a list) were multiplied out.

    A row that is too short in all lists for every query is not multiplied. The others are taken
    list by list: after each, a pair goes if its entries so far and the lengths in the lists to
    come cannot reach the cutoff, or if no entry reaches the uniform threshold (the cutoff over
    the number of lists) and none to come can. Once few pairs are left, only those are resolved.
    """
    width = min(rows.shape[1], queries.shape[1])
    parts = [p for p in np.array_split(np.arange(width), lists) if len(p)] or [np.arange(0)]
    x_norm, y_norm = _norms(rows, parts), _norms(queries, parts)
    reach = (x_norm @ y_norm.max(axis=0, initial=0.0)) * (1 + 1e-9) + 1
    live = np.flatnonzero(reach >= cut.min(initial=0))
    x, x_norm, spent = rows[live], x_norm[live], 0
    share = np.floor_divide(cut, len(parts))[:, None]
    score = np.zeros((len(queries), len(live)), np.int64)
    able, above, j = np.ones(score.shape, bool), np.zeros(score.shape, bool), 0

    def to_come(j: int) -> np.ndarray:
        """Most that the lists from j on can add (Cauchy-Schwarz)."""
        tails = (np.sqrt((n[:, j:] ** 2).sum(axis=1)) for n in (y_norm, x_norm))
        y_tail, x_tail = tails
        return (y_tail[:, None] * x_tail) * (1 + 1e-9) + (1 if j < len(parts) else 0)

    while j < len(parts) and able.size and able.mean() > FEW:
        part = parts[j]
        peak = float(np.abs(x[:, part]).max(initial=0)) * float(np.abs(queries[:, part]).max(initial=0)) * len(part)
        kind = np.float32 if peak < 2**24 else np.float64 if peak < 2**53 else np.int64
        entry = (queries[:, part].astype(kind) @ x[:, part].astype(kind).T).astype(np.int64)
        spent += entry.size
        score += entry
        above |= entry >= share
        j += 1
        able = score + to_come(j) >= cut[:, None]
        later = np.zeros(able.shape, bool)
        for k in range(j, len(parts)):
            later |= (y_norm[:, k, None] * x_norm[:, k]) * (1 + 1e-9) + 1 >= share
        able &= above | later
    query, row = np.nonzero(able)
    total = score[query, row]
    for part in parts[j:]:
        for low in range(0, len(query), PAIRS):
            at = slice(low, low + PAIRS)
            total[at] += (queries[query[at]][:, part].astype(np.int64) * x[row[at]][:, part]).sum(axis=1)
        spent += len(query)
    good = total >= cut[query]
    return query[good], live[row[good]], total[good], spent


def _resolved(lists: int):
    """Phases 2 and 3: rows that can reach the cutoff, resolved."""

    def run(table: pa.Table) -> pa.Table:
        rows, queries = _cells(table, ""), _cells(table, "q_")
        cut = np.full(len(queries), np.iinfo(np.int64).min // 8)
        for c in table.column("cuts")[0].as_py() or []:
            if c["cut"] is not None:
                cut[c["place"]] = c["cut"]
        return _result(table, *resolve(rows, queries, cut, lists)[:3])

    return run


def _result(table: pa.Table, query: np.ndarray, row: np.ndarray, score: np.ndarray) -> pa.Table:
    x, y = _cells(table, ""), _cells(table, "q_")
    width = max(x.shape[1], y.shape[1])
    x, y = (np.pad(c, ((0, 0), (0, width - c.shape[1]))) for c in (x, y))
    names = table.column("ids").combine_chunks().flatten()
    owners = table.column("q_ids").combine_chunks().flatten().flatten()
    return pa.table({
        "q_block": pa.array(np.full(len(query), table.column("q_block")[0].as_py()), pa.int64()),
        "place": pa.array(query, pa.int64()), "query_id": owners.take(pa.array(query)),
        "ids": names.take(pa.array(row)), "own": (x[row] == y[query]).all(axis=1), "score": pa.array(score, pa.int64())})


_FOUND = "q_block long, place long, query_id long, ids array<long>, own boolean, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, its own left out, ties to the smaller id."""
    own = F.array_position("ids", F.col("query_id"))
    same = F.when(F.col("own") & (own > 0), F.concat(
        F.slice("ids", F.lit(1), own.cast("int") - 1), F.slice("ids", own.cast("int") + 1, F.size("ids")))).otherwise(F.col("ids"))
    each = found.select("q_block", "place", "query_id", "score", F.explode(same).alias("vec_id"))
    order = Window.partitionBy("q_block", "place").orderBy(F.col("score").desc(), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          lists: int = LISTS, rows: int = ROWS, block_queries: int = QUERIES) -> DataFrame:
    """The k highest scores of each query: query_id, rank, ``id_col``, score (integer inner product).

    ``queries`` is a condition on ``vectors``; every other row is a candidate of each query.
    Fewer than k candidates are all returned. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part. Vectors of different lengths meet as if
    the shorter one went on with zeros. Repeats of a query's id and vector are candidates of
    each other, and one query. Other columns are ignored. An empty table gives no rows. Scores
    must fit in 64 bits.
    """
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("q"),
                           F.coalesce(queries, F.lit(False)).alias("asks")).where("q is not null and id is not null")
    least = Window.partitionBy("q").orderBy("id")
    classes = valid.select("q", "id").withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    classes = stage(classes.groupBy("q").agg(F.sort_array(F.collect_list("id")).alias("ids")), "classes")
    asked = stage(valid.where("asks").select("q", F.array("id").alias("ids")).distinct(), "queries")
    n_rows, n_asked = classes.count(), asked.count()
    if not n_asked:
        return vectors.sparkSession.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")

    def packed(df: DataFrame, n: int, most: int) -> DataFrame:
        block = F.pmod(F.xxhash64("q", "ids"), F.lit(max(1, -(-n // most)))).alias("block")
        return stage(df.select(block, "q", "ids").groupBy("block").applyInArrow(_pack, _PACKED), "blocks")

    sides, asking = packed(classes, n_rows, rows), packed(asked, n_asked, block_queries)
    asking = asking.select(*(F.col(c).alias(f"q_{c}") for c in asking.columns))
    every = F.sequence(F.lit(0).cast("long"), F.lit(max(1, -(-n_asked // block_queries)) - 1).cast("long"))
    dealt = sides.withColumn("at", F.explode(every))

    seeds = dealt.where(F.col("block") % SEED_SHARE == 0)
    found = seeds.join(asking, F.col("at") == F.col("q_block")).groupBy("block", "q_block").applyInArrow(
        _local_lists(k + 1, lists), _FOUND)
    cut = _ranked(found, k).groupBy("q_block", "place").agg(
        F.when(F.count("*") == k, F.min("score")).alias("cut"))
    cuts = cut.groupBy("q_block").agg(F.collect_list(F.struct("place", "cut")).alias("cuts"))
    cuts = stage(cuts.withColumnRenamed("q_block", "cut_block"), "cutoffs")
    asking = asking.join(cuts, F.col("q_block") == F.col("cut_block"), "left").drop("cut_block")
    resolved = dealt.join(asking, dealt.at == asking.q_block).groupBy("block", "q_block").applyInArrow(
        _resolved(lists), _FOUND)
    return _ranked(resolved, k).select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
