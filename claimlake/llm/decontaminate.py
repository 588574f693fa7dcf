"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by the size of their shingle sets, [2^p, 2^(p+1)). For partition p a
document is cut into windows of 2^p shingles, and each window is reduced to K universal hash
minima. An item of q shingles of which a share t lies in the document, in one place or
scattered, agrees with some window in one hash with a probability of at least the sum over
windows of |item & window| / |item | window|, which is at least t q / (q + 2^p) >= t / 2. So
a document that holds three quarters of an item shares no minimum with it with a probability
below 0.625^K, 4e-7 for K = 32 and 2e-13 for K = 64. (Signatures of whole documents would need
thousands of minima: the share of a short item in a long union is that small.) Documents that
share a minimum are verified by exact containment of the item's shingles in their full set.

Test items are broadcast in blocks of bounded rows and bytes, one pass over the documents for
each block; documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm import shingles as S
from claimlake.llm.common import text_bytes

#: Bytes of item text in one broadcast block.
BLOCK_BYTES = 8 << 20


class _Items:
    """Shingle sets and minima of a block of test items, by size partition."""

    def __init__(self, ids: list, texts: list[bytes], hashes: int, seed: int):
        self.ids, self.sets = ids, []
        for text in texts:
            flat = np.frombuffer(text, np.uint8)
            found, _ = S.shingles(*S.words(flat, np.array([0, len(flat)])))
            self.sets.append(np.unique(found))
        self.a, self.b = S.hash_family(hashes, seed)
        members = defaultdict(list)
        for i, found in enumerate(self.sets):
            if len(found):
                members[int(len(found)).bit_length() - 1].append(i)
        self.parts = {}
        for p, own in sorted(members.items()):
            begins = np.concatenate([[0], np.cumsum([len(self.sets[i]) for i in own])])
            least = S.minima(np.concatenate([self.sets[i] for i in own]), begins, self.a, self.b)
            # a table of low bits, some sixty-four times the items, spares most of the searches
            low = np.uint64((1 << (64 * len(own)).bit_length()) - 1)
            tables = []
            for j in range(hashes):
                order = np.argsort(least[:, j], kind="stable")
                some = np.zeros(int(low) + 1, bool)
                some[least[:, j] & low] = True
                tables.append((some, least[order, j], np.array(own)[order]))
            self.parts[p] = low, tables

    def candidates(self, hashes: np.ndarray, begins: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) pairs that share a minimum in some window."""
        out: set[tuple[int, int]] = set()
        counts = np.diff(begins)
        for p, (bits, tables) in self.parts.items():
            per_row = -(-counts // (1 << p))
            row = np.repeat(np.arange(len(counts)), per_row)
            k = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
            cuts = begins[row] + (k << p)
            if not len(cuts):
                continue
            work = np.empty(len(hashes), np.uint64)
            for j, (some, values, items) in enumerate(tables):
                np.multiply(hashes, self.a[j], out=work)
                work += self.b[j]
                least = np.minimum.reduceat(work, cuts)
                hit = np.flatnonzero(some[least & bits])
                low = np.searchsorted(values, least[hit], "left")
                high = np.searchsorted(values, least[hit], "right")
                for w, x, y in zip(hit[high > low], low[high > low], high[high > low], strict=True):
                    out.update((int(row[w]), int(i)) for i in items[x:y])
        return out


def _leaks(items: _Items, column: pa.Array, percent: int) -> Iterator[tuple[int, int, int]]:
    """(row, item, shared shingles) of the texts that hold an item, checked on full sets."""
    flat, offsets = text_bytes(column)
    for low, _, hashes, begins in S.row_shingles(flat, offsets):
        held, last = None, -1
        for r, i in sorted(items.candidates(hashes, begins)):
            if r != last:
                held, last = np.unique(hashes[begins[r]:begins[r + 1]]), r
            n = len(np.intersect1d(held, items.sets[i], assume_unique=True))
            if 100 * n >= percent * len(items.sets[i]):
                yield low + r, i, n


def _search(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _Items(*shared.value)
        for batch in batches:
            found = np.array(list(_leaks(items, batch.column("_bytes"), percent)), np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(found[:, 0])), pa.array([items.ids[i] for i in found[:, 1]], pa.int64()),
                 pa.array(found[:, 2]), pa.array([len(items.sets[i]) for i in found[:, 1]], pa.int64())],
                ["_id", "_item", "n_shared", "n_item"])

    return run


def _holds(shared, percent: int):
    """Whether a text holds an item of the block."""
    built: list[_Items] = []

    @F.arrow_udf("boolean")
    def holds(column: pa.Array) -> pa.Array:
        if not built:
            built.append(_Items(*shared.value))
        out = np.zeros(len(column), bool)
        out[[row for row, _, _ in _leaks(built[0], column, percent)]] = True
        return pa.array(out)

    return holds


def _item_blocks(items: DataFrame, item_col: str, item_text_col: str, block_bytes: int,
                 hashes: int, seed: int) -> Iterator:
    """Broadcast blocks of items, of ``block_bytes`` of text each; one item may be larger."""
    wanted = items.select(F.col(item_col).cast("long").alias("_item"),
                          F.coalesce(F.col(item_text_col).cast("binary"), F.lit(b"")).alias("_bytes"))
    ids, texts, held = [], [], 0
    send = items.sparkSession.sparkContext.broadcast
    for row in wanted.toLocalIterator():
        if held + len(row["_bytes"]) > block_bytes and ids:
            yield send((ids, texts, hashes, seed))
            ids, texts, held = [], [], 0
        ids.append(row["_item"])
        texts.append(bytes(row["_bytes"]))
        held += len(row["_bytes"]) + 64
    if ids:
        yield send((ids, texts, hashes, seed))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", percent: int = 75,
               hashes: int = 64, seed: int = 11, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents that hold test items: ``id_col``, ``item_col``, n_shared, n_item, containment.

    One row for each document and item of which at least ``percent`` of the distinct five-word
    shingles occur in the document. An item of fewer than five words is one shingle, all its
    words, and is found in documents of just those words.

    Null and blank texts hold nothing and are found nowhere. Repeated document rows give
    repeated results; items with equal ids are told apart and each reported. Null ids are
    reported as null; item ids are whole numbers. Other columns are ignored. An empty table on
    either side gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_bytes"))
    kind = source.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _item long, n_shared long, n_item long"
    out = spark.createDataFrame([], schema)
    for shared in _item_blocks(items, item_col, item_text_col, block_bytes, hashes, seed):
        out = out.unionByName(source.mapInArrow(_search(shared, percent), schema))
    return out.select(
        F.col("_id").alias(id_col), F.col("_item").alias(item_col), "n_shared", "n_item",
        (F.col("n_shared") / F.col("n_item")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", percent: int = 75, hashes: int = 64, seed: int = 11,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents of ``docs`` that hold none of the test items, with all their columns.

    Every row is judged by its own text, whatever its id: of rows that share an id, or have none,
    those that hold an item go and the others stay. No column is added, so none can clash.
    """
    text = F.col(text_col).cast("binary")
    for shared in _item_blocks(items, item_col, item_text_col, block_bytes, hashes, seed):
        docs = docs.where(~_holds(shared, percent)(text))
    return docs
