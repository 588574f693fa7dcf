"""Sharding by a two-pass external shuffle.

Pass 1 scatters records uniformly into buckets that fit in memory, by seeded hashes: a hash of
the id gives the shard, so that with one more shard records only move into the new one, and a
hash of the record gives the bucket within it. Pass 2 shuffles each bucket: its places are
permuted by Fisher-Yates (Spark's ``shuffle``), and the buckets of a shard follow one another.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm.common import set_aside, stage

#: Bytes of text that a bucket holds.
BUCKET_BYTES = 16 << 20
#: Buckets whose permutations one task draws.
TASK_BUCKETS = 64
#: Bytes that a record counts besides its text.
RECORD_BYTES = 64


def record_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard whose hash with the key is highest: one more shard only takes rows into itself."""
    draws = [F.xxhash64(F.lit(seed), F.lit(s), key) for s in range(shards)]
    highest = F.greatest(*draws) if shards > 1 else draws[0]
    return F.coalesce(*(F.when(d == highest, F.lit(s)) for s, d in enumerate(draws))).cast("int")


def deal(docs: DataFrame, added: tuple[str, str, str], shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
         bucket_bytes: int = BUCKET_BYTES, seed: int = 23) -> DataFrame:
    """``docs`` with its shard, slot and grown shard in columns named by ``added``.

    As ``shuffle_shards``, for callers that name the added columns themselves.
    """
    docs, name, back = set_aside(docs)
    text, key = F.col(name[text_col]), F.col(name[id_col])
    # bytes of each shard; buckets are sized to hold bucket_bytes each
    volume = docs.groupBy(shard_of(key, shards, seed).alias("shard")).agg(
        F.sum(record_size(text) + RECORD_BYTES).alias("bytes"))
    most = volume.agg(F.max("bytes")).first()[0] or 1
    per_shard = max(1, -(-most // bucket_bytes))
    record = F.xxhash64(F.lit(seed + 1), key, text)
    shard = shard_of(key, shards, seed)
    bucket = F.pmod(record, F.lit(per_shard))
    places = ["shard", "bucket"]

    counts = docs.groupBy(shard.alias("shard"), bucket.alias("bucket")).agg(F.count("*").alias("n"))
    in_shard = Window.partitionBy("shard").orderBy("bucket")
    counts = stage(counts.withColumn("first", F.sum("n").over(in_shard) - F.col("n")), "buckets")
    # Fisher-Yates: one permutation of the places of each bucket. The generator is seeded by
    # partition and the buckets of a partition are taken in order; the partitions follow from the
    # number of buckets alone, so a rerun draws the same under any setting.
    tasks = -(-shards * per_shard // TASK_BUCKETS)
    drawn = counts.repartition(tasks, *places).sortWithinPartitions(*places).select(
        F.col("shard").alias("s"), F.col("bucket").alias("b"), "first",
        F.shuffle(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), F.lit(seed + 2)).alias("order"))

    plain = [c for c, t in docs.dtypes if not t.startswith(("map", "variant", "array", "struct")) and c not in (name[id_col], name[text_col])]
    by = Window.partitionBy(*places).orderBy("record", key.asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in plain))
    ranked = docs.withColumns({
        "shard": shard, "bucket": bucket, "record": record, "grown_shard": shard_of(key, shards + 1, seed)})
    ranked = ranked.withColumn("place", F.row_number().over(by))
    # never broadcast: the permutations have a place for every record
    out = ranked.join(drawn.hint("merge"), (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
    slot = F.col("first") + F.element_at("order", F.col("place"))
    return out.select(*back, F.col("shard").alias(added[0]), slot.alias(added[1]), F.col("grown_shard").alias(added[2]))


def shuffle_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = BUCKET_BYTES, seed: int = 23) -> DataFrame:
    """``docs`` with _shard (0 to ``shards`` - 1), _slot (gapless from 0 in it) and _grown_shard
    (the shard if there were one more).

    Shards depend on the id and the number of shards alone. The order within a shard is a
    random permutation that depends on the seed and the records; the same records give the same
    order, whatever the session's settings. Rows that repeat in full are interchangeable and meet
    in one bucket, which spills to disk while it is ranked. Null ids share a shard and spread over
    its buckets by their text; null texts count no bytes. All columns are kept, whatever their
    names; those of the three names above are replaced. No rows give no rows.
    """
    added = ("_shard", "_slot", "_grown_shard")
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in added))
    return deal(kept, added, shards, id_col, text_col, bucket_bytes, seed)


def in_slot_order(shuffled: DataFrame, shard: str = "_shard", slot: str = "_slot") -> DataFrame:
    """The rows as range partitions of (shard, slot), each in that order: files written from it
    hold consecutive slots, and read in turn they give the order of the shuffle."""
    return shuffled.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write what ``shuffle_shards`` returns as a folder for each shard. A file holds consecutive
    slots in their order, and the files of a shard follow one another by name."""
    in_slot_order(shuffled).write.partitionBy("_shard").parquet(path)
