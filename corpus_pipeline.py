"""The corpus pipeline: quality, near duplicates, decontamination, mixing, shards.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns
the columns of ``documents``; the last adds the shard and the place in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm.common import set_aside, stage
from claimlake.llm.decontaminate import decontaminate
from claimlake.llm.mixing import mix_sources
from claimlake.llm.near_dedup import near_duplicates
from claimlake.llm.quality import fit_quality, quality_score
from claimlake.llm.sharding import deal, in_slot_order


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score at least 0.5).

    Every row is judged by its own text, whatever its id; null and empty texts are scored too.
    No column is added.
    """
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality_score(model, F.col("text")) >= 0.5)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one document of each group of near duplicates, one with the least id.

    Rows whose id is missing or repeated are judged by themselves: all rows then get a staged
    number, which decides between rows of one id. A row without an id is kept only if no row of
    its group has one. Null and blank texts are in no group and all stay. Columns of any names
    are kept.
    """
    rows, name, back = set_aside(docs)
    key = F.col(name["doc_id"])
    if docs.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        rows = rows.withColumn("key", key)
    else:
        number = F.struct(key.isNull().alias("missing"), key.alias("id"), F.monotonically_increasing_id().alias("at"))
        rows = stage(rows.withColumn("key", number), "numbered")
    gone = near_duplicates(rows, id_col="key", text_col=name["text"]).where("not kept").select(F.col("key").alias("gone"))
    gone = stage(gone, "gone")
    return rows.join(gone, F.col("key") == F.col("gone"), "left_anti").select(*back)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, judged row by row. No column is added."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources repeats them; those it leaves out go.

    Columns of any names are kept.
    """
    rows, name, back = set_aside(docs)
    mixed = mix_sources(rows, name["doc_id"], name["text"], name["source"]).where("_copies > 0")
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return mixed.withColumn("again", again).select(*back)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in shuffled shards: all their columns, shard and slot, in the order of these.

    Written as they come, the files hold consecutive slots. Where documents have a column of
    either name, the added one gets an underscore after it.
    """
    names, taken = [], {c.lower() for c in docs.columns}
    for name in ("shard", "slot", "grown"):
        while name in taken:
            name += "_"
        names.append(name)
    return in_slot_order(deal(docs, tuple(names)).drop(names[2]), *names[:2])


STAGES = [("quality", quality), ("near_dedup", deduplicate), ("decontaminate", leaks), ("mix", mix),
          ("shard", shard)]

#: Learned scores and random draws have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
