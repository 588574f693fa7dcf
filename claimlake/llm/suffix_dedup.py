"""Removal of repeated byte strings across documents, by merged Burrows-Wheeler transforms.

Every byte covered by a string of L bytes that also starts earlier is removed. Documents are
shards of one text collection too large for one suffix order, so they are brought together by
anchors: of each L bytes the K bytes with the least hash (the leftmost of equals). Equal
strings have equal anchors, so each anchor with what surrounds it is a collection of its own.

* A stretch is an anchor with the run of positions it stands for. Equal stretches are one
  class; all but the earliest of a class are removed. That is decided first within a batch of
  documents, so that a common stretch leaves a batch once, and then over all of them.
* Where an anchor has several classes, one stretch of each is fetched, and the transforms of
  shards of such stretches are merged by iterative interleave refinement (``bwt``). Its
  repeated intervals are the strings that occur in more than one class. Parts of stretches that
  differ from all others in the bytes that their strings have in common are cut off before.
* Anchors whose stretches exceed what one merge takes are split before: by ranges of distance to
  the anchor and the bytes that the strings of a range share, equal parts reduced to the
  earliest, and what is still too large by half the range, down to single strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm import shingles as S
from claimlake.llm.bwt import repeated
from claimlake.llm.common import attach_small, slices, stage, text_bytes

#: Bytes of an anchor, and bytes of the stretches that one merge takes.
ANCHOR, MERGE_BYTES = 32, 1 << 19
_LOW = np.uint64((1 << 24) - 1)


def _stretches(flat: np.ndarray, offsets: np.ndarray, length: int):
    """(row, start, positions, anchor, class, offset of the anchor) of the stretches of some rows."""
    n = len(flat)
    starts = n - length + 1
    nothing = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
    if starts <= 0:
        return nothing
    sums = S.prefix_hash(flat)
    _, down = S.powers(n)
    grams = n - ANCHOR + 1
    key = S.mix((sums[ANCHOR:] - sums[:grams]) * down[:grams])
    window = length - ANCHOR + 1
    best = (key & ~_LOW) | np.arange(grams, dtype=np.uint64)
    have = 1
    while have < window:  # least over ever wider windows; the position decides between equals
        step = min(have, window - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    anchor = (best & _LOW).astype(np.int64)[:starts]
    row = np.searchsorted(offsets, np.arange(starts), "right") - 1
    valid = np.arange(starts) + length <= offsets[row + 1]
    at = np.flatnonzero(valid)
    if not len(at):
        return nothing
    new = np.append(True, (np.diff(at) != 1) | (anchor[at][1:] != anchor[at][:-1]) | (row[at][1:] != row[at][:-1]))
    first = at[new]
    count = np.diff(np.append(np.flatnonzero(new), len(at)))
    a = anchor[first]
    end = first + count + length - 1
    body = (sums[end] - sums[first]) * down[first]
    same = S.mix(body ^ S.mix((count.astype(np.uint64) << np.uint64(32)) | (a - first).astype(np.uint64)))
    owner = row[first]
    return owner, first - offsets[owner], count, key[a], same, a - first


def _merged(start: np.ndarray, end: np.ndarray, row: np.ndarray):
    """Union of spans within rows: (row, start, end), spans that touch joined."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    base = row.astype(np.int64) << 40
    reach = np.maximum.accumulate(base + end) if len(row) else base
    new = np.append(True, base[1:] + start[1:] > reach[:-1]) if len(row) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    last = reach[np.append(at[1:], len(row)) - 1] - base[at] if len(row) else base
    return row[at], start[at], last


_ROWS = ["key", "same", "rid", "start", "count"]
_SCHEMA = "key long, same long, rid long, start long, count long"
_PARTS = "kind int, key long, rid long, start long, end long"


def _long_text(part: np.ndarray, length: int, most: int = 1 << 22):
    """Stretches of one long text, in windows that overlap so that no position is lost."""
    out = []
    for low in range(0, max(1, len(part) - length + 1), most):
        piece = part[low:low + most + length - 1]
        row, start, *rest = _stretches(piece, np.array([0, len(piece)]), length)
        out.append((row, start + low, *rest))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _scan(length: int):
    """Stretches of documents; those that repeat within a batch become spans (same = 0, count < 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = text_bytes(batch.column("_bytes"))
            rid = batch.column("rid").to_numpy()
            found = []
            for low, high in slices(offsets):
                part = flat[offsets[low]:offsets[high]]
                if high == low + 1 and len(part) > 1 << 22:
                    row, *rest = _long_text(part, length)
                else:
                    row, *rest = _stretches(part, offsets[low:high + 1] - offsets[low], length)
                found.append((row + low, *rest))
            if not found:
                continue
            row, start, count, key, same, _ = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.lexsort((start, rid[row], same, key))
            row, start, count, key, same = (c[order] for c in (row, start, count, key, same))
            again = np.append(False, (key[1:] == key[:-1]) & (same[1:] == same[:-1])) if len(key) else np.zeros(0, bool)
            r, s, e = _merged(start[again], start[again] + count[again] + length - 1, row[again])
            first = ~again
            spans = S.mix(rid[r].astype(np.uint64) ^ s.astype(np.uint64))  # anywhere
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (
                np.concatenate([key[first], spans]).view(np.int64),
                np.concatenate([same[first].view(np.int64), np.zeros(len(s), np.int64)]),
                np.concatenate([rid[row[first]], rid[r]]), np.concatenate([start[first], s]),
                np.concatenate([count[first], s - e]))], _ROWS)

    return run


def _classes(length: int):
    """Over stretches ordered by anchor, class and place: spans of all but the first of a class
    (kind 0), and the first of each class of anchors with several classes (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_before = same_before = None
        waiting, several = None, False  # the only class so far of the last anchor; whether it has more
        for batch in batches:
            key, same, rid, start, count = (batch.column(c).to_numpy() for c in _ROWS)
            out = [(np.zeros(int((count < 0).sum()), np.int64), key[count < 0], rid[count < 0], start[count < 0],
                    start[count < 0] - count[count < 0])]
            real = count > 0
            key, same, rid, start, count = (c[real] for c in (key, same, rid, start, count))
            if len(key):
                end = start + count + length - 1
                new_key = np.append(key_before is None or key[0] != key_before, key[1:] != key[:-1])
                new = new_key | np.append(same_before is None or same[0] != same_before, same[1:] != same[:-1])
                old = ~new
                out.append((np.zeros(int(old.sum()), np.int64), key[old], rid[old], start[old], end[old]))
                group = np.cumsum(new_key)  # 0 goes on with the last anchor of the batch before
                classes = np.bincount(group[new], minlength=group[-1] + 1)
                held = waiting is not None
                total = classes.copy()
                total[0] += 2 if several else int(held)
                pick = new & (total[group] > 1)
                if held and classes[0]:
                    out.append(tuple(np.array([x]) for x in waiting))
                    waiting, several = None, True
                out.append((np.ones(int(pick.sum()), np.int64), key[pick], rid[pick], start[pick], end[pick]))
                last = group[-1]
                if last:
                    several, waiting = bool(total[last] > 1), None
                    if total[last] == 1:
                        i = np.flatnonzero(new & (group == last))[0]
                        waiting = (1, key[i], rid[i], start[i], end[i])
                else:
                    several = several or bool(total[0] > 1)
                key_before, same_before = key[-1], same[-1]
            kind, *rest = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind.astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in rest)],
                ["kind", "key", "rid", "start", "end"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted stretches of each document."""
    for batch in batches:
        flat, offsets = text_bytes(batch.column("_bytes"))
        wanted = batch.column("wanted")
        each = wanted.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
        start, end = (each.field(c).to_numpy() for c in ("start", "end"))
        texts = [flat[offsets[r] + s:offsets[r] + e].tobytes() for r, s, e in zip(row, start, end, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [each.field("key"), pa.array(batch.column("rid").to_numpy()[row]), pa.array(start), pa.array(texts, pa.binary())],
            ["key", "rid", "start", "bytes"])


def _ranges(flat: np.ndarray, offsets: np.ndarray, length: int, wide: int):
    """(text, first and last position, mark, hash) of the parts of stretches by ranges of ``wide``
    distances to the anchor.

    All strings of a range share the bytes in their midst; the mark stands for the anchor, the
    range and these bytes, so equal strings have equal marks. The hash stands for the whole part.
    """
    out = []
    for low, high in slices(offsets):
        part, at = flat[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        row, start, count, key, _, anchor = _stretches(part, at, length)
        sums = S.prefix_hash(part)
        _, down = S.powers(len(part))
        begin = at[row] + start
        for q in range((length - ANCHOR) // wide + 1):
            # positions with q * wide <= distance < (q + 1) * wide
            a = np.maximum(0, anchor - (q + 1) * wide + 1)
            b = np.minimum(count - 1, anchor - q * wide)
            some = np.flatnonzero(a <= b)
            s = begin[some] + anchor[some] - q * wide
            e = begin[some] + anchor[some] - (q + 1) * wide + 1 + length
            mark = S.mix((sums[e] - sums[s]) * down[s] + S.mix(key[some] + np.uint64(q)))
            s, e = begin[some] + a[some], begin[some] + b[some] + length
            body = (sums[e] - sums[s]) * down[s]
            same = S.mix(body ^ S.mix(((b - a)[some].astype(np.uint64) << np.uint64(32)) | (anchor - a)[some].astype(np.uint64)))
            out.append((row[some] + low, start[some] + a[some], start[some] + b[some], mark, same))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _promising(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(text, offset, bytes) of the parts of stretches that may hold a string of another one.

    A range of which no other stretch has the bytes that its strings share cannot hold a
    repeated string, and is cut off.
    """
    flat, offsets = text_bytes(texts)
    own, first, upto, mark, _ = _ranges(flat, offsets, length, max(1, (length - ANCHOR) // 4))
    _, which, many = np.unique(mark, return_inverse=True, return_counts=True)
    keep = many[which] > 1 if len(mark) else np.zeros(0, bool)
    row, start, end = _merged(first[keep], upto[keep] + 1, own[keep])
    return row, start, [flat[offsets[r] + s:offsets[r] + e + length - 1].tobytes() for r, s, e in zip(row, start, end, strict=True)]


_PIECES = "mark long, same long, rid long, start long, end long, bytes binary"


def _pieces(length: int, wide: int):
    """Parts of stretches by ranges; those that repeat within a batch come without their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = text_bytes(batch.column("bytes"))
            own, first, upto, mark, same = _ranges(flat, offsets, length, wide)
            rid = batch.column("rid").to_numpy()[own]
            start = batch.column("start").to_numpy()[own] + first
            end = start + upto - first + length
            order = np.lexsort((start, rid, same, mark))
            own, first, mark, same, rid, start, end = (c[order] for c in (own, first, mark, same, rid, start, end))
            again = np.append(False, (mark[1:] == mark[:-1]) & (same[1:] == same[:-1])) if len(mark) else np.zeros(0, bool)
            at = offsets[own] + first
            texts = [None if g else flat[x:x + n].tobytes() for g, x, n in zip(again, at, end - start, strict=True)]
            mark = np.where(again, S.mix(rid.astype(np.uint64) ^ start.astype(np.uint64)), mark)  # anywhere
            same = np.where(again, np.uint64(0), same)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c) for c in (mark.view(np.int64), same.view(np.int64), rid, start, end)),
                 pa.array(texts, pa.binary())], ["mark", "same", "rid", "start", "end", "bytes"])

    return run


def _split(texts: DataFrame, length: int, merge_bytes: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Split the stretches of anchors too large for one merge: (spans, parts to merge).

    Spans (rid, start, end) are parts equal to an earlier one. Of the others, those of one mark
    can share strings with each other only; marks of at most ``merge_bytes`` go to the merge and
    larger ones are cut into ranges of half as many distances. A range of one distance is one
    string, and of equal ones only the earliest is left.
    """
    spans, parts = [], []
    wide = 1 << (max(1, (length - ANCHOR) // 4).bit_length() - 1)
    earlier = Window.partitionBy("mark", "same").orderBy("rid", "start")
    while True:
        pieces = texts.select("rid", "start", "bytes").mapInArrow(_pieces(length, wide), _PIECES)
        later = F.col("bytes").isNull() | (F.row_number().over(earlier) > 1)
        pieces = stage(pieces.withColumn("later", later), "pieces")
        spans.append(pieces.where("later").select("rid", "start", "end"))
        if wide == 1:
            return spans, parts
        first = pieces.where("not later").select("mark", "rid", "start", "bytes")
        large = stage(first.groupBy("mark").agg(F.sum(F.octet_length("bytes")).alias("large"))
                      .where(F.col("large") > merge_bytes), "large")
        first = attach_small(first, large, "mark")
        parts.append(first.where("large is null").select(F.col("mark").alias("key"), "rid", "start", "bytes"))
        if large.isEmpty():
            return spans, parts
        texts = first.where("large is not null")
        wide //= 2


def _intervals(length: int):
    """Spans of the strings of a bucket of stretches that also start in an earlier one."""

    def run(table: pa.Table) -> pa.Table:
        row, cut, texts = _promising(table.column("bytes").combine_chunks(), length)
        rid, start = table.column("rid").to_numpy()[row], table.column("start").to_numpy()[row] + cut
        interval, string, offset = repeated(texts, length, 2)
        place = start[string] + offset
        order = np.lexsort((place, rid[string], interval))
        interval, string, place = interval[order], string[order], place[order]
        later = np.append(False, interval[1:] == interval[:-1]) if len(interval) else np.zeros(0, bool)
        owner, row = np.unique(rid[string[later]], return_inverse=True)
        r, s, e = _merged(place[later], place[later] + length, row)
        return pa.table({"rid": pa.array(owner[r], pa.int64()), "start": pa.array(s, pa.int64()), "end": pa.array(e, pa.int64())})

    return run


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, rid, _bytes): rid orders documents by id, and rows of one id by text; null ids last."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_bytes"))
    whole = rows.schema["_id"].dataType.typeName() in ("long", "integer", "short", "byte")
    if whole and rows.groupBy("_id").count().where("_id is null or count > 1").isEmpty():
        return rows.withColumn("rid", F.col("_id").cast("long"))
    # ids that are missing, repeated or no numbers: number the rows in their order, once
    return stage(rows.orderBy(F.col("_id").asc_nulls_last(), "_bytes").withColumn(
        "rid", F.monotonically_increasing_id()), "numbered")


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   merge_bytes: int = MERGE_BYTES) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, removed (array of start, end), kept (binary).

    ``removed`` are the maximal runs of bytes covered by a string of ``length`` bytes that also
    starts earlier: in a document with a smaller id, or further up in the same one. Strings are
    judged on the input and never cross documents. ``kept`` is what is left.

    Null and empty texts have no bytes. Ids that are null come last; rows that repeat an id are
    ordered by their text, and of rows that repeat both all but one are later copies. Other
    columns are ignored. No rows give no rows.
    """
    rows = _numbered(docs, id_col, text_col)
    found = rows.select("rid", "_bytes").mapInArrow(_scan(length), _SCHEMA)
    parts = stage(
        found.repartition("key").sortWithinPartitions("key", "same", "rid", "start")
        .mapInArrow(_classes(length), _PARTS), "stretches")

    wanted = parts.where("kind = 1")
    large = stage(wanted.groupBy("key").agg(F.sum(F.col("end") - F.col("start")).alias("large"))
                  .where(F.col("large") > merge_bytes), "large")

    def cut(stretches: DataFrame) -> DataFrame:
        per_row = stretches.groupBy("rid").agg(F.collect_list(F.struct("key", "start", "end")).alias("wanted"))
        return rows.select("rid", "_bytes").join(per_row, "rid").mapInArrow(
            _cut, "key long, rid long, start long, bytes binary")

    spans = [parts.where("kind = 0").select("rid", "start", "end")]
    texts = cut(wanted)
    if large.isEmpty():
        size = wanted.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    else:
        # the documents are shuffled once for the stretches of all anchors, large or not
        both = attach_small(stage(texts, "cut"), large, "key")
        texts = both.where("large is null").drop("large")
        size = texts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
        more, split = _split(both.where("large is not null"), length, merge_bytes)
        spans += more
        for part in split:
            size += part.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
            texts = texts.unionByName(part)
    buckets = max(1, -(-size // merge_bytes))
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")
    across = texts.select(bucket, "rid", "start", "bytes").groupBy("bucket").applyInArrow(
        _intervals(length), "rid long, start long, end long")

    spans = reduce(DataFrame.unionByName, [*spans, stage(across, "intervals")])
    spans = spans.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))

    @F.arrow_udf("array<struct<start:bigint,end:bigint>>")
    def joined(column: pa.Array) -> pa.Array:
        sizes = np.nan_to_num(np.array(column.value_lengths().to_pylist(), float)).astype(int)
        each = column.flatten()
        row, s, e = _merged(each.field("start").to_numpy(), each.field("end").to_numpy(), np.repeat(np.arange(len(sizes)), sizes))
        runs = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(runs), pa.StructArray.from_arrays([pa.array(s), pa.array(e)], ["start", "end"]))

    @F.arrow_udf("binary")
    def kept(texts: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for text, gone in zip(texts, removed, strict=True):
            body, at, left = text.as_py(), 0, []
            for span in gone.as_py() or []:
                left.append(body[at:span["start"]])
                at = span["end"]
            out.append(b"".join([*left, body[at:]]))
        return pa.array(out, pa.binary())

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    out = rows.join(spans, "rid", "left").withColumn("removed", joined(F.coalesce("spans", none)))
    return out.select(F.col("_id").alias(id_col), F.octet_length("_bytes").cast("long").alias("n_bytes"), "removed",
                      kept("_bytes", "removed").alias("kept"))
