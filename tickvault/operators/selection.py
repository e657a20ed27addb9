"""Exact medians of groups of any size (C15, C28, C32, B8 on ticks).

Spark's ``median`` gathers all distinct values of a group in one task.  Here the
middle is bracketed first by an approximate quantile of fixed size, whose error
is bounded, so the bracket surely holds it.  Values inside the bracket are counted
by (group, value), combined map-side and dealt over all tasks; of values below it
only their number is kept.  The counted values are cut into ``BINS`` equal parts
of the bracket: a running sum over at most that many rows per group says in
which part each middle rank lies, and only these parts are ranked value by
value.

The brackets (one row per group) are joined to the rows: broadcast when their
size allows, else a join whose hot groups AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: An approximate quantile is off by at most one in so many ranks; parts of a bracket.
ACCURACY, BINS = 10000, 4096


def exact_median(df: DataFrame, keys: Sequence[str], value: F.Column, name: str) -> DataFrame:
    """One row per group of ``keys``: the median of ``value`` (the mean of the
    two middle values of an even number) as ``name``.  Null values do not
    count; a group of nulls only has no row.  Null is a key like any other."""
    one = list(keys) or ["_all"]
    rows = df.select(*(F.col(k) for k in keys), *([] if keys else [F.lit(0).alias("_all")]), value.cast("double").alias("_v")).where("_v is not null")
    near = 2.0 / ACCURACY
    ends = rows.groupBy(*one).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", [0.5 - near, 0.5 + near], ACCURACY).alias("_q"))
    ends = ends.select(F.struct(*one).alias("_g"), "_n", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))
    rows = rows.select(F.struct(*one).alias("_g"), "_v").alias("r")
    if keys:
        rows = rows.join(ends.alias("e"), F.col("r._g").eqNullSafe(F.col("e._g")))
    else:
        rows = rows.select("*", *(ends.select(c).scalar().alias(c) for c in ("_n", "_lo", "_hi"))).alias("r")
    share = F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))  # null if the ends are equal
    part = F.floor(F.least(F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * BINS).cast("int")
    part = F.when(F.col("_v") < F.col("_lo"), F.lit(-1)).otherwise(part)
    held = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))  # all values below the bracket are one
    counts = rows.where(F.col("_v") <= F.col("_hi")).groupBy(F.col("r._g").alias("_g"), "_n", part.alias("_part"), held.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("_g", "_n", "_part").agg(F.sum("_c").alias("_c"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_c").over(before("_g").orderBy("_part")), F.lit(0)))
    first, second = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)  # ranks from 0
    upto = F.col("_before") + F.col("_c")
    holds = lambda rank: (F.col("_before") <= rank) & (rank < upto)
    parts = parts.where(holds(first) | holds(second)).select(F.col("_g").alias("_pg"), F.col("_part").alias("_pp"), F.col("_before").alias("_start"))
    near = counts.join(parts, F.col("_g").eqNullSafe(F.col("_pg")) & (F.col("_part") == F.col("_pp")))
    near = near.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_c").over(before("_g", "_part").orderBy("_v")), F.lit(0)))
    middle = near.groupBy("_g").agg(F.max(F.when(holds(first), F.col("_v"))).alias("_a"), F.max(F.when(holds(second), F.col("_v"))).alias("_b"))
    return middle.select(*(F.col(f"_g.{k}").alias(k) for k in keys), ((F.col("_a") + F.col("_b")) / 2).alias(name))


def with_medians(per: DataFrame, keys: Sequence[str], *medians: DataFrame) -> DataFrame:
    """per (one row per group of keys) with the columns of such medians."""
    for m in medians:
        new = [c for c in m.columns if c not in keys]
        if not keys:
            per = per.select("*", *(m.select(c).scalar().alias(c) for c in new))
            continue
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"m.{k}"))
        per = per.alias("p").join(m.alias("m"), same, "left").select("p.*", *(F.col(f"m.{c}") for c in new))
    return per
