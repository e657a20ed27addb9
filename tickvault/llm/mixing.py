"""Operator 1: mixing sources to target weights (DataFrame operations only).

Efraimidis-Spirakis sampling without replacement: a document of quality weight
w gets the key ``-ln(u) / w`` with u drawn from a hash of its id, so reruns
agree, and the smallest keys are taken first.  Each source has a token budget:
whole epochs come first, then a fractional pass takes the documents of smallest
key until their prefix sum reaches the rest (the crossing document goes where
the budget is nearest).

Scale: a source may hold a third of all rows, so its prefix sum has two levels.
Keys are cut, in order, into about sqrt(n) ranges per source; each range is
summed on its own, and only the range totals are scanned per source.

Edge cases: a null source is a source of its own, after all others; a null or
non-positive quality counts as 1; a null or negative size as 0; a null id draws
one fixed u; repeated rows are documents of their own; a source without words
gets the target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickvault.llm.common import written

WEIGHTS = (5.0, 2.0, 1.0)


def sampling_key(doc_id: Column, quality: Column) -> Column:
    draw = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 13), 16, 10).cast("long")
    u = (draw + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.when(quality > 0, quality).otherwise(F.lit(1.0)).cast("double")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, cap: float = 3.0) -> DataFrame:
    """Adds ``target`` to (src, source_size), one row per source.

    Sources in order of ``src`` weigh ``weights``, repeating.  They share
    ``share`` of all sizes; a target stops at ``cap`` times its source's size
    and the excess is reshared by weight.  In order of cap / weight, a source
    is at its cap exactly when its part of what earlier ones left reaches it."""
    every, before = Window.orderBy("_ratio", "src"), Window.orderBy("_ratio", "src").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    nth = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("_weight", weight)
         .withColumn("_cap", F.col("source_size") * F.lit(cap))
         .withColumn("_ratio", F.col("_cap") / F.col("_weight")))
    left = F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    rest = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    s = s.withColumn("_level", left / rest).withColumn("_nth", F.row_number().over(every))
    free = F.col("_cap") > F.col("_level") * F.col("_weight")
    level = F.max(F.when(free, F.col("_level"))).over(whole)
    return s.select("src", "source_size", "source_docs", F.when(free, level * F.col("_weight")).otherwise(F.col("_cap")).alias("target"))


def mix_sources(docs: DataFrame, doc_id: Column, source: Column, size: Column, quality: Column,
                weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, cap: float = 3.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs
    (whole passes of its source), picked (is it in the fractional pass) and
    taken (words the mix takes)."""
    # "s..." sorts before "t": a null source comes last, and is a plain join key
    src = F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source))
    d = written(docs.select(doc_id.alias("doc_id"), source.alias("source"), src.alias("src"),
                            F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("size"),
                            sampling_key(doc_id, quality).alias("_key")), "mix")
    sizes = d.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    targets = written(source_targets(sizes, weights, share, cap), "mix-targets")
    d = d.join(targets, "src")
    ranges = F.ceil(F.sqrt("source_docs"))
    d = d.withColumn("_range", F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * ranges))
    totals = d.groupBy("src", "_range").agg(F.sum("size").alias("_total"))
    earlier = Window.partitionBy("src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("src", "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("src", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_upto", F.sum("size").over(within)).join(totals, ["src", "_range"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    middle = F.col("_before") + F.col("_upto") - F.col("size") / 2
    d = d.withColumn("epochs", epochs)
    d = d.withColumn("picked", (F.col("size") > 0) & (middle <= F.col("target") - F.col("epochs") * F.col("source_size")))
    return d.select("doc_id", "source", "size", "source_size", "target", "epochs", "picked",
                    (F.col("size") * (F.col("epochs") + F.col("picked").cast("long"))).cast("long").alias("taken"))
