"""Near-duplicate documents: hash minima, bands, verification and components.

Many universal hash minima of each text's shingles are cut into bands; texts that share a band
are candidates; their signatures are compared, then their full shingle sets; the components of
the confirmed links follow by alternating large-star and small-star.

* Equal texts are one node from the start, so a group of copies costs one row.
* Within a band's bucket every text is compared with the bucket's least node, and components
  are formed. Only buckets in which texts of more than one component remain are looked at
  again: texts outside the least node's component against the others, in blocks of bounded size
  dealt over tasks. Signatures and sets are compared there in place, and only confirmed links
  leave a task, one for each text and component. No bucket is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm import shingles as S
from claimlake.llm.common import stage, text_bytes
from claimlake.llm.components import connected_components

#: A pair is verified in full if this much less than the threshold of its minima agree
#: (over four standard errors of 128 minima).
MARGIN = 0.18
#: Texts of one block of a bucket.
BLOCK = 256


def _sign(bands: int, rows: int, seed: int):
    a, b = S.hash_family(bands * rows, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = text_bytes(batch.column("_bytes"))
            n = batch.num_rows
            sizes, signed = np.zeros(n, np.int64), [None] * n
            for low, high, hashes, begins in S.row_shingles(flat, offsets):
                full = np.flatnonzero(np.diff(begins) > 0)
                if not len(full):
                    continue
                for i in full:
                    sizes[low + i] = len(np.unique(hashes[begins[i]:begins[i + 1]]))
                edges = np.append(begins[:-1][full], len(hashes))
                least = (S.minima(hashes, edges, a, b) >> np.uint64(32)).astype("<u4")
                for i, row in zip(full, least, strict=True):
                    signed[low + i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_id", "_digest")), pa.array(sizes),
                 pa.array(signed, pa.binary())], ["_id", "_digest", "n_shingles", "signature"])

    return run


def _bands(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, _ = text_bytes(batch.column("signature"))
            cells = flat.view("<u4").reshape(-1, bands, rows).astype(np.uint64)
            keys = np.zeros(cells.shape[:2], np.uint64) + np.arange(bands, dtype=np.uint64)
            for r in range(rows):
                keys = S.mix(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, r])
            node = np.repeat(batch.column("node").to_numpy(), bands)
            band = np.tile(np.arange(bands, dtype=np.int32), len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(band), pa.array(node)],
                ["bucket", "band", "node"])

    return run


def _agree(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs of which at least this share of minima agrees."""
    for batch in batches:
        x, y = (text_bytes(batch.column(c))[0].view("<u4").reshape(batch.num_rows, -1)
                for c in ("sig_a", "sig_b"))
        keep = (x == y).mean(axis=1) >= least if batch.num_rows else np.zeros(0, bool)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _set_of(flat: np.ndarray) -> np.ndarray:
    return np.unique(S.shingles(*S.words(flat, np.array([0, len(flat)])))[0])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _across(bands: int, percent: int):
    """Links across components between two blocks of a bucket (or within one), confirmed on full
    sets: one for each text of the first block and component it is linked with."""
    least = percent / 100 - MARGIN

    def run(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("node", "component", "side", "band")}
        sig = text_bytes(table.column("signature"))[0].view("<u4").reshape(len(table), -1)
        flat, offsets = text_bytes(table.column("bytes"))
        sets: dict[int, np.ndarray] = {}

        def full(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = _set_of(flat[offsets[i]:offsets[i + 1]])
            return sets[i]

        own = table.column("kind")[0].as_py() == 0
        left = np.flatnonzero(col["side"] == 0)
        right = left if own else np.flatnonzero(col["side"] == 1)
        out_a, out_b = [], []
        for i in left:
            other = right[col["component"][right] != col["component"][i]]
            if own:
                other = other[col["node"][other] > col["node"][i]]
            same = sig[other] == sig[i]
            share = same.mean(axis=1)
            # a pair meets in each band in which it agrees; it is looked at in the first of them
            first = same.reshape(len(other), bands, -1).all(axis=2).argmax(axis=1) if len(other) else share
            good = (share >= least) & (first == col["band"][i])
            done = set()
            for j in other[good][np.argsort(-share[good], kind="stable")]:
                c = int(col["component"][j])
                if c not in done and _similar(full(int(i)), full(int(j)), percent):
                    done.add(c)
                    out_a.append(col["node"][i])
                    out_b.append(col["node"][j])
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def _confirm(percent: int):
    """Pairs whose full sets share at least ``percent`` of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None  # pairs come ordered by a
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            a = batch.column("a").to_pylist()
            x, x_at = text_bytes(batch.column("text_a"))
            y, y_at = text_bytes(batch.column("text_b"))
            for i in range(batch.num_rows):
                if a[i] != last:
                    held, last = _set_of(x[x_at[i]:x_at[i + 1]]), a[i]
                keep[i] = _similar(held, _set_of(y[y_at[i]:y_at[i + 1]]), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each wanted node: (node, bytes)."""
    wanted = nodes.select("node", "least_id", "digest").join(wanted, "node")
    found = docs.join(
        wanted, F.col("_id").eqNullSafe(F.col("least_id")) & (F.col("_digest") == F.col("digest")))
    return found.dropDuplicates(["node"]).select("node", F.col("_bytes").alias("bytes"))


def _star_links(docs: DataFrame, nodes: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of the texts of each bucket with its least node."""
    pairs = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    sig = nodes.select("node", "signature")
    pairs = (
        pairs.join(sig.toDF("b", "sig_b"), "b").join(sig.toDF("a", "sig_a"), "a")
        .select("a", "b", "sig_a", "sig_b")
        .mapInArrow(lambda it, least=percent / 100 - MARGIN: _agree(it, least), "a long, b long"))
    pairs = stage(pairs, "pairs")
    texts = _texts(docs, nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    full = (
        pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
        .select("a", "b", "text_a", "text_b").sortWithinPartitions("a"))
    return stage(full.mapInArrow(_confirm(percent), "a long, b long"), "links")


def _other_links(docs: DataFrame, nodes: DataFrame, members: DataFrame, component: DataFrame,
                 bands: int, percent: int) -> DataFrame:
    """Confirmed links across components within buckets, beside those of the least nodes."""
    rows = members.join(component, "node")
    beside = F.when(F.col("node") != F.col("pivot"), F.col("component"))
    mixed = rows.groupBy("bucket").agg(
        F.min(beside).alias("x"), F.max(beside).alias("y"),
        F.max(F.when(F.col("node") == F.col("pivot"), F.col("component"))).alias("main")).where("x < y")
    rows = rows.where("node <> pivot").join(mixed.select("bucket", "main"), "bucket")
    rows = rows.join(nodes.select("node", "n_shingles"), "node")
    # sets that are linked differ in size by less than one class of this ratio: s meets s and s + 1
    rows = stage(rows.select(
        "bucket", "band", "node", "component", (F.col("component") == F.col("main")).alias("in_main"),
        F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent) + 1e-9).alias("s")), "mixed")
    blocks = rows.groupBy("bucket", "s").agg(
        F.ceil(F.sum((~F.col("in_main")).cast("int")) / BLOCK).alias("rest"),
        F.ceil(F.sum(F.col("in_main").cast("int")) / BLOCK).alias("main"))
    shape = lambda d, tag: blocks.select(F.col("bucket").alias(f"b{tag}"), (F.col("s") + d).alias(f"s{tag}"),
                                         F.struct("rest", "main").alias(tag))
    zero = F.struct(F.lit(0).cast("long").alias("rest"), F.lit(0).cast("long").alias("main"))
    plan = shape(0, "own")
    for d, tag in ((-1, "up"), (1, "down")):
        plan = plan.join(shape(d, tag), (F.col("bown") == F.col(f"b{tag}")) & (F.col("sown") == F.col(f"s{tag}")), "left")
    plan = plan.select("bown", "sown", "own", F.coalesce("up", zero).alias("up"), F.coalesce("down", zero).alias("down"))
    rows = rows.join(plan, (F.col("bucket") == F.col("bown")) & (F.col("s") == F.col("sown")))
    none = F.array().cast("array<struct<lo:bigint,i:bigint,j:bigint,kind:int,side:int>>")

    def cell(lo, x, y, kind, side):
        return F.struct(lo.cast("long").alias("lo"), x.cast("long").alias("i"), y.cast("long").alias("j"),
                        kind.cast("int").alias("kind"), F.lit(side).cast("int").alias("side"))

    def upto(n, f):
        return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), f)).otherwise(none)

    # kinds tell block pairs apart: 0 within a block, 1 and 2 within a size class, 3 to 5 across two
    s, own, up, down = (F.col(c) for c in ("s", "own", "up", "down"))
    i = F.pmod(F.xxhash64("node"), F.when(F.col("in_main"), own["main"]).otherwise(own["rest"]))
    rest = F.concat(
        F.array(cell(s, i, i, F.lit(0), 0)),
        F.filter(upto(own["rest"], lambda k: cell(s, F.least(i, k), F.greatest(i, k), F.lit(1), 0)), lambda c: c["i"] < c["j"]),
        upto(own["main"], lambda k: cell(s, i, k, F.lit(2), 0)),
        upto(up["rest"], lambda k: cell(s, i, k, F.lit(3), 0)),
        upto(up["main"], lambda k: cell(s, i, k, F.lit(4), 0)),
        upto(down["rest"], lambda k: cell(s - 1, k, i, F.lit(3), 1)),
        upto(down["main"], lambda k: cell(s - 1, k, i, F.lit(5), 1)))
    main = F.concat(
        upto(own["rest"], lambda k: cell(s, k, i, F.lit(2), 1)),
        upto(down["rest"], lambda k: cell(s - 1, k, i, F.lit(4), 1)),
        upto(up["rest"], lambda k: cell(s, i, k, F.lit(5), 0)))
    dealt = rows.select("bucket", "band", "node", "component", i.alias("block"),
                        F.explode(F.when(F.col("in_main"), main).otherwise(rest)).alias("c"))
    dealt = dealt.select("bucket", "band", "node", "component", "c.lo", "c.i", "c.j", "c.kind",
                         F.when(F.col("c.kind") == 1, (F.col("block") == F.col("c.j")).cast("int"))
                         .otherwise(F.col("c.side")).alias("side"))
    texts = _texts(docs, nodes, rows.select("node").distinct()).join(nodes.select("node", "signature"), "node")
    dealt = dealt.join(texts, "node")
    return stage(dealt.groupBy("bucket", "lo", "i", "j", "kind").applyInArrow(
        _across(bands, percent), "a long, b long"), "across")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 75, bands: int = 32, rows: int = 4, seed: int = 1) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id, kept.

    Documents are linked if their sets of five-word shingles share at least ``percent`` of
    their union. component_id is the least id reachable over links, kept whether that is the
    row's own. A link of exactly 75 % is missed by all 32 bands of 4 minima with a probability
    of 5e-6, and less the closer the texts are.

    Null or blank texts have an empty set and stay alone. Rows that repeat an id and its text
    are copies of each other and get one result; ids that are null are reachable but never
    least, and are kept only if no row of their component has an id. Other columns are ignored,
    whatever their names. No rows give no rows.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_bytes"))
    source = source.withColumn("_digest", F.coalesce(F.md5("_bytes"), F.lit("")))
    id_type = source.schema["_id"].dataType.simpleString()
    signed = stage(source.mapInArrow(
        _sign(bands, rows, seed),
        f"_id {id_type}, _digest string, n_shingles long, signature binary"), "signed")
    nodes = stage(
        signed.where("n_shingles > 0").groupBy(F.col("_digest").alias("digest"))
        .agg(F.min("_id").alias("least_id"), F.first("n_shingles").alias("n_shingles"),
             F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    banded = nodes.select("node", "signature").mapInArrow(_bands(bands, rows), "bucket long, band int, node long")
    shared = banded.groupBy("bucket").agg(
        F.min("node").alias("pivot"), F.count("*").alias("c")).where("c > 1").drop("c")
    members = stage(banded.join(shared, "bucket"), "members")

    links = _star_links(source, nodes, members, percent)
    known = stage(connected_components(links), "components")
    component = nodes.select("node").join(known, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
    more = _other_links(source, nodes, members, component, bands, percent)
    if not more.isEmpty():
        known = stage(connected_components(links.unionByName(more)), "components")

    label = stage(nodes.select("node", "digest", "least_id").join(known, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "labels")
    least = label.groupBy("component").agg(F.min("least_id").alias("component_id"))
    label = label.join(least, "component").select("digest", "component_id")
    own = F.col("n_shingles") > 0
    return signed.join(label, signed._digest == label.digest, "left").select(
        F.col("_id").alias(id_col), "n_shingles",
        F.when(own, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
        F.when(own, F.col("_id").eqNullSafe(F.col("component_id"))).otherwise(True).alias("kept"))
