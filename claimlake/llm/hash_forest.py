"""Approximate nearest neighbours by a forest of sorted hash strings.

Every tree draws its own hyperplanes; the sides of a vector are its hash string in the tree, most
significant bit first. A tree is the sorted array of the strings, cut at prefixes into leaves of
bounded rows that tasks hold with the vectors. A query descends to its longest prefix match in
each tree and counts the strings below every shorter prefix. All trees then ascend together: the
query stops at the longest prefix length at which they hold enough candidates between them, and
all rows below that prefix, in any tree, are scored on the original vectors.

Inner products become angles by one more component that brings all rows to the length of the
longest one; it is zero for queries. How many candidates are enough is measured: a bounded
sample of queries is searched by brute force over all rows, and the count is taken at which
``recall`` of their true neighbours is reached. The rule is the same at every size.

Equal vectors are one entry with its least ids, so copies cost nothing. Leaves that stay large
at the deepest cut are dealt, rows and queries, over as many tasks as they need.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm.common import stage

TREES, BITS, LEAF_BYTES, SAMPLE = 16, 48, 8 << 20, 200
_SLICE = 2048


def planes(width: int, trees: int, bits: int, seed: int = 11) -> np.ndarray:
    """Normals of all trees side by side, orthogonal as far as the width allows."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(-(-trees * bits // width)):
        out.append(np.linalg.qr(rng.standard_normal((width, width)))[0])
    return np.concatenate(out, axis=1)[:, :trees * bits]


def strings(x: np.ndarray, last: np.ndarray, normals: np.ndarray, trees: int) -> np.ndarray:
    """Rows by trees: the hash strings as whole numbers."""
    sides = (x @ normals[:-1] + last[:, None] * normals[-1]) > 0
    sides = sides.reshape(len(x), trees, sides.shape[1] // trees)
    weights = np.left_shift(np.int64(1), np.arange(sides.shape[2] - 1, -1, -1, dtype=np.int64))
    return (sides * weights).sum(axis=2)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column as rows, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    cells = np.zeros((len(sizes), width))
    cells[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return cells


def _lift(x: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows over the greatest length, and the component that fills them up to length one."""
    x = x / longest
    return x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))


def _keys_of(x: np.ndarray, longest: float, normals: np.ndarray, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of the rows as entries and as queries."""
    unit, last = _lift(x, longest)
    return strings(unit, last, normals, trees), strings(unit, np.zeros(len(x)), normals, trees)


def products(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, added component by component, so that equal vectors score equally."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * query[d]
    return total


def best(x: np.ndarray, query: np.ndarray, least: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the ``most`` best rows, ties to the smaller of ``least``."""
    rough = x @ query
    if len(rough) > most:
        cut = np.partition(rough, len(rough) - most)[len(rough) - most]
        slack = 1e-9 * (np.abs(query).sum() * np.abs(x).max(initial=0.0))
        at = np.flatnonzero(rough >= cut - slack)
    else:
        at = np.arange(len(rough))
    score = products(x[at], query)
    order = np.lexsort((least[at], -score))[:most]
    return at[order], score[order]


def _hashing(width: int, longest: float, trees: int, bits: int, with_vectors: bool):
    """Entries of every tree; with the vectors, or only their strings and those of the queries."""

    def run(batches):
        normals = planes(width + 1, trees, bits)
        for batch in batches:
            for low in range(0, len(batch), _SLICE):
                rows = pa.Table.from_batches([batch.slice(low, _SLICE)])
                entry, query = _keys_of(_matrix(rows.column("v"), width), longest, normals, trees)
                n = len(entry)
                take = np.repeat(np.arange(n), trees)
                out = {"tree": pa.array(np.tile(np.arange(trees, dtype=np.int32), n)), "key": pa.array(entry.ravel()),
                       "uid": rows.column("uid").combine_chunks().take(pa.array(take))}
                if with_vectors:
                    out |= {c: rows.column(c).combine_chunks().take(pa.array(take)) for c in ("v", "ids")}
                else:
                    asks = rows.column("asks").to_numpy()[take]
                    out["query_key"] = pa.array(query.ravel(), mask=~asks)
                yield from pa.table(out).to_batches()

    return run


def _below(keys: np.ndarray, wanted: np.ndarray, level: int | np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Range of the sorted keys that share the first ``level`` bits with each wanted key."""
    shift = np.asarray(bits - level, np.int64)
    low = (wanted >> shift) << shift
    return np.searchsorted(keys, low), np.searchsorted(keys, low + (np.int64(1) << shift))


def _descend(bits: int):
    """Strings below every prefix of each query in its leaf, the counts of the nodes above included."""

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        key = table.column("key").to_numpy()
        entries, wanted = np.sort(key[~asks]), key[asks]
        level = table.column("level")[0].as_py()
        counts = np.zeros((len(wanted), bits + 1), np.int64)
        for x in range(level, bits + 1):
            low, high = _below(entries, wanted, x, bits)
            counts[:, x] = high - low
        if table.column("eb")[0].as_py() == 0:
            counts[:, :level] = np.array(table.column("path")[0].as_py()[:level], np.int64)
        flat = pa.array(counts.ravel())
        offsets = pa.array(np.arange(len(wanted) + 1, dtype=np.int32) * (bits + 1))
        return pa.table({"uid": table.column("uid").combine_chunks().filter(pa.array(asks)),
                         "counts": pa.ListArray.from_arrays(offsets, flat)})

    return run


def _score(width: int, bits: int, most: int):
    """Best rows of a leaf for each query that stops above it or in it."""

    def run(entries: pa.Table, asking: pa.Table) -> pa.Table:
        out_q, out_u, out_s, at = [], [], [], []
        if len(entries) and len(asking):
            key = entries.column("key").to_numpy()
            order = np.argsort(key, kind="stable")
            key, x = key[order], _matrix(entries.column("v"), width)[order]
            uid = entries.column("uid").to_numpy()[order]
            names = entries.column("ids").combine_chunks()
            least = names.flatten().to_numpy()[names.offsets.to_numpy()[:-1]][order]
            wanted = _matrix(asking.column("v"), width)
            low, high = _below(key, asking.column("key").to_numpy(), asking.column("stop").to_numpy(), bits)
            owner = asking.column("uid").to_numpy()
            for i in range(len(owner)):
                place, score = best(x[low[i]:high[i]], wanted[i], least[low[i]:high[i]], most)
                place += low[i]
                out_q.append(np.full(len(place), owner[i]))
                out_u.append(uid[place])
                out_s.append(score)
                at.append(order[place])
        if not out_q:
            return pa.table({"quid": pa.array([], pa.int64()), "uid": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64()), "ids": pa.array([], pa.list_(pa.int64()))})
        return pa.table({"quid": np.concatenate(out_q), "uid": np.concatenate(out_u), "score": np.concatenate(out_s),
                         "ids": names.take(pa.array(np.concatenate(at)))})

    return run


def _truth(asked: np.ndarray, owner: np.ndarray, width: int, most: int):
    """Brute force for the sample: the best rows of each batch, with their vectors."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            names = batch.column("ids")
            least = names.flatten().to_numpy()[names.offsets.to_numpy()[:-1] - names.offsets[0].as_py()]
            for i in range(len(owner)):
                place, score = best(x, asked[i], least, most)
                yield pa.record_batch({
                    "quid": pa.array(np.full(len(place), owner[i])), "uid": batch.column("uid").take(pa.array(place)),
                    "score": pa.array(score), "v": batch.column("v").take(pa.array(place))})

    return run


def candidates_for(recall: float, totals: dict[int, np.ndarray], near: list[tuple[int, np.ndarray]],
                   asked: dict[int, np.ndarray], bits: int) -> int:
    """Least number of candidates at which ``recall`` of the near rows would have been found.

    ``near`` holds the query and the strings of each of its true neighbours. A neighbour that
    shares n bits in some tree is found as soon as the prefix of n + 1 bits holds too few.
    """
    needed = []
    for quid, found in near:
        differ = np.bitwise_xor(found, asked[quid])
        shared = bits - max(0, int(differ.min()).bit_length())
        needed.append(1 if shared >= bits else int(totals[quid][shared + 1]) + 1)
    if not needed:
        return 1
    return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])


def _prefix(key: Column, level: Column, bits: int) -> Column:
    return F.call_function("shiftright", key, (F.lit(bits) - level).cast("int"))


def _cut(keys: DataFrame, depth: int, bits: int, leaf_rows: int) -> DataFrame:
    """Leaf of every prefix of ``depth`` bits in use: tree, top, level, rows, asking and counts above.

    A leaf is the shortest prefix that holds at most ``leaf_rows`` rows, ``depth`` bits at most.
    """
    top = F.call_function("shiftright", F.col("key"), F.lit(bits - depth)).alias("top")
    rows = keys.select("tree", "key", F.lit(1).alias("row"), F.lit(0).alias("ask")).unionAll(
        keys.where("query_key is not null").select("tree", F.col("query_key").alias("key"), F.lit(0), F.lit(1)))
    tops = stage(rows.select("tree", top, "row", "ask").groupBy("tree", "top").agg(
        F.sum("row").alias("rows"), F.sum("ask").alias("asking")), "tops")
    levels = tops.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth)))).withColumn(
        "prefix", F.call_function("shiftright", F.col("top"), (F.lit(depth) - F.col("level")).cast("int")))
    nodes = levels.groupBy("tree", "level", "prefix").agg(F.sum("rows").alias("rows"), F.sum("asking").alias("asking"))
    path = levels.select("tree", "level", "prefix", "top").join(nodes, ["tree", "level", "prefix"]).groupBy("tree", "top").agg(
        F.sort_array(F.collect_list(F.struct("level", "rows", "asking"))).alias("path"))
    fits = F.filter("path", lambda n: (n["rows"] <= leaf_rows) | (n["level"] == depth))[0]
    return stage(path.withColumn("leaf", fits).select(
        "tree", "top", F.col("leaf.level").alias("level"), F.col("leaf.rows").alias("rows"),
        F.col("leaf.asking").alias("asking"), F.col("path.rows").alias("path"),
        F.call_function("shiftright", F.col("top"), (F.lit(depth) - F.col("leaf.level")).cast("int")).alias("leaf")), "leaves")


def _blocks(rows: Column, most: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / most)).cast("int")


def _dealt(uid: Column, blocks: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), uid), blocks.cast("long")).cast("int")


def _every(blocks: Column) -> Column:
    return F.sequence(F.lit(0), blocks - 1)


_COUNTS = "uid long, counts array<long>"
_FOUND = "quid long, uid long, score double, ids array<long>"


def nearest(vectors: DataFrame, queries: Column, k: int = 20, recall: float = 0.95, id_col: str = "vec_id",
            vector_col: str = "embedding", trees: int = TREES, bits: int = BITS, leaf_bytes: int = LEAF_BYTES,
            sample: int = SAMPLE) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, ``id_col``, score.

    Nearness is the inner product in double precision; equal scores go to the smaller id.
    ``queries`` is a condition on ``vectors``, and every other row is a candidate. Fewer than k
    candidates are all returned. Vectors that are null, empty, zero or hold null or non-finite
    components, and rows without an id, take no part. Vectors of different lengths meet as if
    the shorter one went on with zeros. Repeats of a query's id and vector are candidates of each
    other, and one query. Other columns are ignored; an empty table gives no rows.

    ``sample`` queries, those of least hash, set the number of candidates for ``recall``; the
    driver holds them and their true neighbours. All rows are indexed in all trees.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("asks"),
                           F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = valid.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))

    least = Window.partitionBy("v").orderBy("id")
    kept = valid.select("v", "id").withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    classes = kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = stage(valid.where("asks").select("v", "id").distinct(), "asked")
    asking = asked.select("v").distinct().withColumn("asks", F.lit(True))
    classes = classes.join(asking, "v", "left").select(
        F.monotonically_increasing_id().alias("uid"), "v", "ids", F.coalesce("asks", F.lit(False)).alias("asks"))
    classes = stage(classes, "classes")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    width, longest, n, n_asking = classes.agg(
        F.max(F.size("v")), F.max(length), F.count("*"), F.count_if("asks")).first()
    if not n_asking:
        return empty
    leaf_rows = max(1, leaf_bytes // (8 * width))

    keys = stage(classes.select("uid", "v", "asks").mapInArrow(
        _hashing(width, longest, trees, bits, False), "tree int, key long, uid long, query_key long"), "keys")
    depth = min(bits, max(0, int(np.ceil(np.log2(n / leaf_rows)))) + 4)
    leaves = _cut(keys, depth, bits, leaf_rows)

    def placed(df: DataFrame) -> DataFrame:
        top = F.call_function("shiftright", F.col("key"), F.lit(bits - depth))
        return df.withColumn("top", top).join(leaves, ["tree", "top"])

    # descend: rows and queries of a leaf, dealt over its blocks
    nodes = ["tree", "level", "leaf", "eb", "qb"]
    eb, qb = _blocks(F.col("rows"), leaf_rows), _blocks(F.col("asking"), leaf_rows)
    entries = placed(keys.select("tree", "key", "uid")).select(
        "tree", "level", "leaf", _dealt(F.col("uid"), eb, 1).alias("eb"), F.explode(_every(qb)).alias("qb"),
        "key", "uid", F.lit(False).alias("asks"), F.lit(None).cast("array<long>").alias("path"))
    wanted = placed(keys.where("query_key is not null").select("tree", F.col("query_key").alias("key"), "uid")).select(
        "tree", "level", "leaf", F.explode(_every(eb)).alias("eb"), _dealt(F.col("uid"), qb, 2).alias("qb"),
        "key", "uid", F.lit(True).alias("asks"), "path")
    counted = entries.unionAll(wanted).groupBy(*nodes).applyInArrow(_with_path(_descend(bits)), _COUNTS)
    totals = stage(counted.groupBy("uid").agg(
        F.array(*(F.sum(F.col("counts")[x]) for x in range(bits + 1))).alias("totals")), "totals")

    enough = _calibrate(classes, totals, k, recall, width, longest, trees, bits, sample)

    # ascend together: the longest prefix that holds enough rows in all trees
    level = F.size(F.filter("totals", lambda c: c >= enough)) - 1
    stops = stage(totals.select("uid", F.greatest(F.lit(0), level).alias("stop")), "stops")
    leaf_at = leaves.select("tree", "level", "leaf", "rows").distinct()
    above = leaf_at.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("level")))).withColumn(
        "node", F.call_function("shiftright", F.col("leaf"), (F.col("level") - F.col("at")).cast("int")))
    asks = placed(keys.where("query_key is not null").select("tree", F.col("query_key").alias("key"), "uid")).join(
        stops, "uid").withColumn("at", F.least("stop", "level")).select(
        "tree", "key", "uid", "stop", "at", _prefix(F.col("key"), F.col("at"), bits).alias("node"))
    visits = stage(asks.join(above, ["tree", "at", "node"]).select(
        "tree", "level", "leaf", "rows", "key", "uid", "stop"), "visits")
    loads = stage(visits.groupBy("tree", "level", "leaf").agg(F.count("*").alias("visits")), "loads")
    qb = _blocks(F.col("visits"), leaf_rows)
    held = placed(classes.select("uid", "v", "ids", "asks").mapInArrow(
        _hashing(width, longest, trees, bits, True), "tree int, key long, uid long, v array<double>, ids array<long>"))
    held = held.join(loads, ["tree", "level", "leaf"]).select(
        "tree", "level", "leaf", _dealt(F.col("uid"), eb, 1).alias("eb"), F.explode(_every(qb)).alias("qb"),
        "key", "uid", "v", "ids")
    seeking = visits.join(loads, ["tree", "level", "leaf"]).join(classes.select("uid", "v"), "uid").select(
        "tree", "level", "leaf", F.explode(_every(eb)).alias("eb"), _dealt(F.col("uid"), qb, 2).alias("qb"),
        "key", "uid", "stop", "v")
    found = held.groupBy(*nodes).cogroup(seeking.groupBy(*nodes)).applyInArrow(_score(width, bits, k + 1), _FOUND)

    # the best rows of all trees, each once
    once = found.groupBy("quid", "uid").agg(F.first("score").alias("score"), F.first("ids").alias("ids"))
    order = Window.partitionBy("quid").orderBy(F.col("score").desc(), F.col("ids")[0])
    top = once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    rows = F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(
        (-F.col("score")).alias("far"), i.alias("id"), (F.col("uid") == F.col("quid")).alias("own")))))
    ranked = stage(top.groupBy("quid").agg(F.slice(F.sort_array(rows), 1, k + 1).alias("near")), "ranked")
    numbered = asked.join(classes.where("asks").select("v", F.col("uid").alias("quid")), "v").select("id", "quid")
    mine = F.array_position(F.transform("near", lambda r: r["own"] & (r["id"] == F.col("id"))), True).cast("int")
    others = F.when(mine > 0, F.concat(F.slice("near", F.lit(1), mine - 1), F.slice("near", mine + 1, F.lit(k + 1))))
    out = numbered.join(ranked, "quid").select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(F.coalesce(others, F.col("near")), 1, k)).alias("place", "row"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), F.col("row.id").alias(id_col),
                      (-F.col("row.far")).alias("score"))


def _with_path(run):
    """Bring a row that carries the counts above to the front of its group."""

    def first(table: pa.Table) -> pa.Table:
        known = table.column("path").is_valid().to_numpy(zero_copy_only=False)
        if not known.any():
            return pa.table({"uid": pa.array([], pa.int64()), "counts": pa.array([], pa.list_(pa.int64()))})
        return run(table.take(pa.array(np.argsort(~known, kind="stable"))))

    return first


def _calibrate(classes: DataFrame, totals: DataFrame, k: int, recall: float, width: int, longest: float,
               trees: int, bits: int, sample: int) -> int:
    """Candidates that ``recall`` needs, from true neighbours of a bounded sample of queries."""
    picked = classes.where("asks").orderBy(F.xxhash64("uid"), "uid").limit(sample).select("uid", "v").collect()
    owner = np.array([r.uid for r in picked], np.int64)
    asked = np.zeros((len(picked), width))
    for i, r in enumerate(picked):
        asked[i, :len(r.v)] = r.v
    order = Window.partitionBy("quid").orderBy(F.col("score").desc(), "uid")
    near = classes.select("uid", "v", "ids").mapInArrow(
        _truth(asked, owner, width, k + 1), "quid long, uid long, score double, v array<double>")
    near = near.withColumn("n", F.row_number().over(order)).where((F.col("n") <= k + 1) & (F.col("uid") != F.col("quid"))).collect()
    counts = totals.where(F.col("uid").isin(owner.tolist())).collect()
    normals = planes(width + 1, trees, bits)
    found = np.zeros((len(near), width))
    for i, r in enumerate(near):
        found[i, :len(r.v)] = r.v
    entry = _keys_of(found, longest, normals, trees)[0]
    query = _keys_of(asked, longest, normals, trees)[1]
    return candidates_for(recall, {r.uid: np.array(r.totals) for r in counts},
                          [(r.quid, entry[i]) for i, r in enumerate(near)],
                          {int(owner[i]): query[i] for i in range(len(owner))}, bits)
