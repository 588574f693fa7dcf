"""Mixing sources to target weights by Pareto order sampling.

Sources share the words of all documents by weight. A document's expected copies are its
source's target over its source's words: the whole part is allotted for certain, and the words
that remain are drawn by Pareto order sampling. Each document has an inclusion probability p,
larger for longer documents, and a random number u; documents are ranked by the odds of u
divided by the odds of p, and the first ones that fill the remaining words are taken. That is
an unequal-probability sample of fixed size, the size being words.

No source is gathered anywhere: the place in the ranking at which the words are filled is found
from sums over ever narrower ranges of the ranking, aggregated before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlake.llm.common import WORD, attach_small, set_aside, stage, unit

#: Ranges that one pass of sums splits a range of the ranking into, and passes.
_SPLITS, _PASSES = 1024, 4


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Target words of each source, from one row (source, source_size) a source.

    Sources by code point, null last, weigh ``weights`` in turn. A target stops at ``most``
    times its source's words, and the excess is shared by the others by weight until none is
    above. One row a source passes through one task here, and nothing larger.
    """
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    t = sizes.withColumn("k", F.row_number().over(order)).withColumn(
        "weight", F.element_at(cycle, ((F.col("k") - 1) % n + 1).cast("int")))
    t = t.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    # by cap over weight: those at their cap come first, and each leaves the rest to the others
    t = t.withColumn("total", F.sum("source_size").over(everything))
    fill = everything.orderBy((F.col("cap") / F.col("weight")), "k")
    t = t.withColumn("before", F.coalesce(
        F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    t = t.withColumn("rest", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
    t = t.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    t = t.withColumn("open", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
    return t.select(
        "source", "source_size",
        F.when(F.col("full") | F.col("open").isNull(), F.col("cap"))
        .otherwise(F.col("open") * F.col("weight")).alias("target"))


def _level(size: Column) -> Column:
    """The power of two at or below a size."""
    return F.when(size > 0, F.floor(F.log2(size.cast("double")) + 1e-9)).otherwise(0).cast("int")


def _rank(size: Column, rate: Column, u: Column, power: float) -> Column:
    """Place in [0, 1) in the Pareto ranking: q / (1 + q) for q = odds of u / odds of p."""
    p = rate * F.pow(F.lit(2.0), power * _level(size))
    q = F.try_divide(u * (1 - p), (1 - u) * p)
    place = F.least(F.coalesce(q / (1 + q), F.lit(1.0)), F.lit(1.0 - 2.0**-52))
    return F.when(size == 0, F.lit(None)).when(p >= 1, F.lit(0.0)).otherwise(place)


def _rates(slim: DataFrame, targets: DataFrame, power: float) -> DataFrame:
    """Per source: certain copies, words to draw, and the rate r of p = min(1, r 2^(power level)).

    Rates solve sum(p size) = words to draw, filling the largest sizes to p = 1 first.
    """
    t = targets.withColumn("copies", F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.col("source_size") + 1e-12), F.floor(F.col("target")))).otherwise(0))
    t = t.withColumn("draw", F.greatest(F.lit(0.0), F.col("target") - F.col("copies") * F.col("source_size")))
    by = slim.groupBy("source", _level(F.col("size")).alias("level")).agg(F.sum("size").alias("words"))
    by = by.where("words > 0").withColumn("w", F.pow(F.lit(2.0), power * F.col("level")))
    by = by.join(t.select(F.col("source").alias("s"), "draw"), F.col("source").eqNullSafe(F.col("s")))
    down = Window.partitionBy("source").orderBy(F.col("level").desc())
    by = by.withColumn("before", F.coalesce(
        F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    by = by.withColumn("rest", F.sum(F.col("words") * F.col("w")).over(
        down.rowsBetween(0, Window.unboundedFollowing)))
    by = by.withColumn("r", (F.col("draw") - F.col("before")) / F.col("rest"))
    rate = by.where(F.col("r") * F.col("w") <= 1).groupBy("source").agg(F.max("r").alias("rate"))
    return t.join(rate.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "copies", "draw", F.coalesce("rate", F.lit(1.0)).alias("rate"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (5, 2, 1), most: float = 3.0, size_power: float = 0.5,
                seed: int = 17) -> DataFrame:
    """``docs`` with _size (words), _source_size, _target (of its source), _copies and _taken.

    _copies is how often the mix repeats the document, at most ``most`` times; _taken is
    _copies * _size. The words taken of a source come to its target up to half a document.
    Longer documents are likelier drawn, by the size level to the power ``size_power`` (0: all
    alike). Draws depend on the seed, the id and the text alone, so reruns agree.

    Null, empty and blank texts have no words and get the certain copies. A null source is a
    source, the last one. Rows that repeat an id and its text draw the same number and are in
    or out together; null ids draw by their text. All other columns are kept, whatever their
    names; those of the five names above are replaced. No rows give no rows.
    """
    added = ("_size", "_source_size", "_target", "_copies", "_taken")
    size = n_words(F.col(text_col).cast("string"))
    u = unit(seed, F.col(id_col), F.col(text_col))
    slim = stage(docs.select(F.col(source_col).alias("source"), size.alias("size"), u.alias("u")), "sizes")
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = stage(_rates(slim, source_targets(totals, weights, most), size_power), "rates")
    ranked = attach_small(slim, rates.select("source", "draw", "rate"), "source")
    ranked = ranked.where("draw > 0 and size > 0").withColumn(
        "z", _rank(F.col("size"), F.col("rate"), F.col("u"), size_power)).select("source", "size", "z")

    # narrow, pass by pass, the range of the ranking in which a source's words are filled
    found = rates.where("draw > 0").select("source", F.lit(0.0).alias("low"), F.lit(1.0).alias("width"),
                                           F.col("draw").alias("left"))
    for _ in range(_PASSES):
        inside = attach_small(ranked, found, "source").where(
            (F.col("z") >= F.col("low")) & (F.col("z") < F.col("low") + F.col("width")))
        cell = F.floor((F.col("z") - F.col("low")) / F.col("width") * _SPLITS)
        sums = inside.groupBy("source", "low", "width", "left", cell.alias("cell")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("cell")
        sums = sums.withColumn("upto", F.sum("words").over(run))
        at = sums.where(F.col("upto") >= F.col("left")).groupBy("source", "low", "width", "left").agg(
            F.min_by(F.struct("cell", "words", "upto"), "cell").alias("c"))
        found = stage(at.select(
            "source", (F.col("low") + F.col("c.cell") * F.col("width") / _SPLITS).alias("low"),
            (F.col("width") / _SPLITS).alias("width"),
            (F.col("left") - (F.col("c.upto") - F.col("c.words"))).alias("left")), "cut")
    # equal places left in the last range: take those that come nearest to the target
    inside = attach_small(ranked, found, "source").where(
        (F.col("z") >= F.col("low")) & (F.col("z") < F.col("low") + F.col("width")))
    ties = inside.groupBy("source", "left", "low", "z").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("z")
    ties = ties.withColumn("off", F.abs(F.sum("words").over(run) - F.col("left"))).groupBy("source", "left", "low").agg(
        F.min("off").alias("off"), F.min_by("z", "off").alias("z"))
    cuts = ties.select("source", F.when(F.col("left") <= F.col("off"), -1.0).otherwise(F.col("z")).alias("z"),
                       "low")
    cuts = stage(rates.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("_key"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        F.col("copies").alias("_certain"), F.col("draw").alias("_draw"), F.col("rate").alias("_rate"),
        F.coalesce("z", F.lit(2.0)).alias("_cut"), F.coalesce("low", F.lit(2.0)).alias("_below")), "cuts")

    rows, name, back = set_aside(docs, added)
    text = F.col(name[text_col])
    rows = rows.withColumns({"_size": n_words(text.cast("string")), "_u": unit(seed, F.col(name[id_col]), text),
                             "_key": F.col(name[source_col])})
    out = attach_small(rows, cuts, "_key")
    z = _rank(F.col("_size"), F.col("_rate"), F.col("_u"), size_power)
    extra = F.coalesce((F.col("_draw") > 0) & ((z < F.col("_below")) | (z <= F.col("_cut"))), F.lit(False))
    copies = (F.col("_certain") + extra.cast("long")).cast("long")
    return out.withColumn("_copies", copies).select(
        *back, "_size", "_source_size", "_target", "_copies", (F.col("_copies") * F.col("_size")).alias("_taken"))
