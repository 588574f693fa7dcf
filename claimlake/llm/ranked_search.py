"""Exact ranked lexical search by buckets of vector lengths.

A document is a vector of integer impacts, one for each term that some item asks for; an item
is a vector of ones. Impact vectors are ordered by length and cut into buckets. For an item whose
50th best score so far is t, a bucket is skipped if the length of the item times the greatest
length in the bucket is below t (Cauchy-Schwarz), and so is the rest of a bucket from the first
vector on that is too short. Inside, the item's terms come in groups, heaviest first: the impacts
at these coordinates are added up from the bucket's term lists, and what is missing is bounded by
Cauchy-Schwarz over the other coordinates. Only vectors that may still reach t after the last
bound are scored in full. Scores are exact, in 64-bit integers.

The first t comes from a share of the documents, chosen by hash; it is a score that so many rows
do reach, so nothing is lost. Tasks then take ranges of lengths and raise t on their own. Items
are taken in blocks of bounded terms, each a stated query set that meets all documents.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm.common import stage, text_bytes

#: Documents of a bucket, terms of an item that are added up between bounds, distinct terms of a
#: block of items, one document in how many sets the first threshold, and bytes counted at once.
BUCKET, FOCUS, BLOCK_TERMS, SEED_SHARE, PIECE = 2048, 6, 200_000, 16, 1 << 22

# Digits, letters and all bytes beyond ASCII stay; A-Z become a-z; all else parts terms.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(raw: bytes):
    """The terms of a text in runs of bounded bytes; a run ends between two terms."""
    folded = raw.translate(_FOLD)
    low = 0
    while low < len(folded):
        high = low + PIECE
        if high < len(folded):
            cut = folded.find(b" ", high)
            high = len(folded) if cut < 0 else cut
        yield folded[low:high].split()
        low = high


def _raw(column: pa.Array):
    flat, offsets = text_bytes(column)
    for i in range(len(offsets) - 1):
        yield flat[offsets[i]:offsets[i + 1]].tobytes()


def _distinct_terms(batches):
    """Distinct terms of every item."""
    for batch in batches:
        found = [sorted({t for run in _terms(raw) for t in run}) for raw in _raw(batch.column("text"))]
        yield pa.record_batch({"item": batch.column("item"), "item_id": batch.column("item_id"),
                               "terms": pa.array(found, pa.list_(pa.binary()))})


def _counting(places: dict[bytes, int]):
    """Terms of every document, and how often each that an item asks for occurs."""

    def run(batches):
        for batch in batches:
            total, terms, often = [], [], []
            for raw in _raw(batch.column("text")):
                n, counts = 0, Counter()
                for part in _terms(raw):
                    n += len(part)
                    counts.update(map(places.get, part))
                counts.pop(None, None)
                total.append(n)
                terms.append(list(counts))
                often.append(list(counts.values()))
            yield pa.record_batch({
                "uid": batch.column("uid"), "id": batch.column("id"), "n": pa.array(total, pa.int64()),
                "terms": pa.array(terms, pa.list_(pa.int32())), "often": pa.array(often, pa.list_(pa.int64()))})

    return run


def impacts(often: np.ndarray, weight: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """The score that a term adds, from its occurrences and weight and the document's terms."""
    m = 50 + (50 * n * documents) // length
    return weight * ((1_000_000_000 * often) // (1000 * often + 20 * m))


def _measuring(weights: np.ndarray, documents: int, length: int):
    """Impact vectors and their lengths."""

    def run(batches):
        for batch in batches:
            terms, often = batch.column("terms"), batch.column("often")
            sizes = np.diff(terms.offsets.to_numpy())
            flat = terms.flatten().to_numpy()
            n = np.repeat(batch.column("n").to_numpy(), sizes)
            value = impacts(often.flatten().to_numpy(), weights[flat], n, documents, length)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            squares = np.bincount(owner, weights=value.astype(np.float64) ** 2, minlength=len(sizes))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.record_batch({
                "uid": batch.column("uid"), "id": batch.column("id"), "length": pa.array(np.sqrt(squares)),
                "terms": pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())),
                "impacts": pa.ListArray.from_arrays(offsets, pa.array(value, pa.int64()))})

    return run


class Best:
    """The best scores of each item so far, and the score that a new row has to reach."""

    def __init__(self, floors: np.ndarray, most: int):
        self.floors, self.most = floors.astype(np.int64), most
        empty = np.zeros(0, np.int64)
        self.rows = [(empty, empty, np.zeros(0, bool)) for _ in floors]
        self.pruned = self.bounded = self.rescored = 0

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        s, i, u = (np.concatenate(p) for p in zip(self.rows[item], (score, ids, unnamed), strict=True))
        order = np.lexsort((i, u, -s))[:self.most]
        self.rows[item] = s[order], i[order], u[order]
        if len(order) == self.most:
            self.floors[item] = max(self.floors[item], s[order[-1]])


def search_bucket(best: Best, items: list[np.ndarray], ids: np.ndarray, unnamed: np.ndarray, lengths: np.ndarray,
                  owner: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
    """Bring the rows of one bucket, longest first, to all items.

    ``owner``, ``terms`` and ``values`` are the entries of the vectors; the terms of an item are
    in the order of their weights, heaviest first.
    """
    order = np.argsort(terms, kind="stable")
    names, first = np.unique(terms[order], return_index=True)
    ends = np.append(first[1:], len(order))
    lists = {int(t): order[a:b] for t, a, b in zip(names, first, ends, strict=True)}
    n, squares = len(lengths), lengths ** 2
    for item, asked in enumerate(items):
        floor = max(1, int(best.floors[item]))
        reach = np.sqrt(len(asked)) * lengths * (1 + 1e-9)
        if reach[0] < floor:
            best.pruned += n
            continue
        live = int(np.searchsorted(-reach, -floor, side="right"))
        best.pruned += n - live
        score, rest, able = np.zeros(n, np.int64), squares.copy(), np.arange(n) < live
        for done in range(0, len(asked), FOCUS):
            left = max(0, len(asked) - done - FOCUS)
            whole = int(able.sum())
            for t in asked[done:done + FOCUS].tolist():
                if t in lists:
                    at = lists[t]
                    score[owner[at]] += values[at]
                    rest[owner[at]] -= values[at].astype(np.float64) ** 2
            missing = np.sqrt(left * np.maximum(rest, 0.0) + 1e-9 * left * squares) * (1 + 1e-9)
            able &= score + missing >= floor
            if not able.any():
                break
        best.rescored += whole if not left else 0
        best.bounded += live - (whole if not left else 0)
        found = np.flatnonzero(able)
        if len(found):
            best.add(item, score[found], ids[found], unnamed[found])


def _searching(items: list[np.ndarray], names: list[int], floors: np.ndarray, most: int):
    """The best rows of a task for each item, bucket by bucket in the order of lengths."""

    def run(batches):
        best = Best(floors, most)
        for batch in batches:
            for low in range(0, len(batch), BUCKET):
                rows = batch.slice(low, BUCKET)
                sizes = np.diff(rows.column("terms").offsets.to_numpy())
                missing = rows.column("id").is_null().to_numpy(zero_copy_only=False)
                search_bucket(best, items, rows.column("id").fill_null(0).to_numpy(), missing, rows.column("length").to_numpy(),
                              np.repeat(np.arange(len(sizes)), sizes), rows.column("terms").flatten().to_numpy(),
                              rows.column("impacts").flatten().to_numpy())
        for item, (score, ids, unnamed) in enumerate(best.rows):
            if len(score):
                yield pa.record_batch({"item": pa.array([names[item]] * len(score), pa.int64()),
                                       "doc": pa.array(ids, pa.int64(), mask=unnamed), "score": pa.array(score)})

    return run


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def ranked_search(docs: DataFrame, items: DataFrame, most: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``most`` best documents of each item: ``item_col``, rank, ``id_col``, score.

    Terms are runs of ASCII digits and letters (A-Z lower-cased) and all other characters beyond
    ASCII, over whole texts. A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), N the
    documents with a term and df those with this one. With tf occurrences in a document of n
    terms, and L terms in all, it adds weight * ((10^9 tf) div (1000 tf + 20 m)), m being
    50 + (50 n N) div L. An item's terms count once. Scores above 0 are returned, equal ones by
    ascending id, rows without an id last.

    Null and empty texts hold no term: such documents are in no result and such items have none.
    Every row is a document or an item of its own, repeats included. Other columns are ignored;
    an empty table on either side gives no rows. Ids of documents are whole numbers.
    """
    spark, kind = docs.sparkSession, items.schema[item_col].dataType.simpleString()
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"),
                            F.col(item_text).cast("binary").alias("text"))
    asked = stage(stage(numbered, "items").mapInArrow(
        _distinct_terms, f"item long, item_id {kind}, terms array<binary>"), "item-terms")
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms)
    out = spark.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` long, score long")
    plain = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
                        F.col(text_col).cast("binary").alias("text"))
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        found = _search_block(plain, block, most)
        names = block.select("item", F.col("item_id").alias(item_col))
        out = out.unionAll(found.join(names, "item").select(item_col, "rank", F.col("doc").alias(id_col), "score"))
    return out


def _search_block(docs: DataFrame, block: DataFrame, most: int) -> DataFrame:
    """Best documents of the items of one block: item, rank, doc, score. The block is collected:
    its terms are bounded."""
    spark = docs.sparkSession
    rows = sorted((r.item, [bytes(t) for t in r.terms]) for r in block.select("item", "terms").collect())
    places: dict[bytes, int] = {}
    for _, terms in rows:
        for t in terms:
            places.setdefault(t, len(places))
    vectors = "uid long, id long, n long, terms array<int>, often array<long>"
    counted = stage(docs.mapInArrow(_counting(places), vectors), "counted")
    documents, length = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents or not places:
        return spark.createDataFrame([], "item long, rank int, doc long, score long")
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1)))
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = np.zeros(len(places), np.int64)
    for r in held.select("term", weight.alias("w")).collect():  # a row for each term of the block
        weights[r.term] = r.w
    names, asked = [i for i, _ in rows], []
    for _, terms in rows:
        at = np.array([places[t] for t in terms], np.int64)
        asked.append(at[np.argsort(-weights[at], kind="stable")])
    spread = F.xxhash64(F.lit(5), "uid")

    def searched(part: DataFrame, floors: np.ndarray) -> DataFrame:
        measured = part.where(F.size("terms") > 0).mapInArrow(
            _measuring(weights, documents, length), "uid long, id long, length double, terms array<int>, impacts array<long>")
        by_length = measured.where("length > 0").repartitionByRange(F.col("length").desc(), spread)
        by_length = by_length.sortWithinPartitions(F.col("length").desc())
        return _ranked(by_length.mapInArrow(_searching(asked, names, floors, most), "item long, doc long, score long"), most)

    floors, place = np.zeros(len(rows), np.int64), {i: at for at, i in enumerate(names)}
    seeds = searched(counted.where(F.pmod(spread, F.lit(SEED_SHARE)) == 0), floors)
    for r in seeds.where(F.col("rank") == most).select("item", "score").collect():  # at most a row an item
        floors[place[r.item]] = r.score
    return stage(searched(counted, floors), "found").select("item", "rank", "doc", "score")
