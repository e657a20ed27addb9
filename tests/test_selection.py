"""Exact medians selected in parts, against Spark's own median."""

import random
import re

from pyspark.sql import functions as F

from tickvault.operators import selection
from tickvault.operators.selection import exact_median, with_medians


def test_medians(spark):
    rng = random.Random(1)
    rows = [("hot", rng.choice([rng.random() * 1e6, float(rng.randrange(5))])) for _ in range(60001)]
    rows += [(None, float(rng.randrange(3))) for _ in range(400)] + [("one", 2.5), ("two", 1.0), ("two", 4.0), ("none", None), ("same", 7.0), ("same", 7.0), ("same", 7.0)]
    rows += [("neg", x) for x in (-1e300, -1.0, 0.0, 1e300)]
    d = spark.createDataFrame(rows, "k string, v double").repartition(7).cache()
    want = {r.k: r.m for r in d.groupBy("k").agg(F.median("v").alias("m")).collect()}
    per = with_medians(d.select("k").distinct(), ["k"], exact_median(d, ["k"], F.col("v"), "m"))
    assert {r.k: r.m for r in per.collect()} == want
    assert exact_median(d, [], F.col("v"), "m").first().m == d.agg(F.median("v")).first()[0]
    assert exact_median(d.where("false"), ["k"], F.col("v"), "m").count() == 0
    assert with_medians(d.agg(F.count("v").alias("n")), [], exact_median(d.where("false"), [], F.col("v"), "m")).first().m is None


def test_no_task_holds_a_hot_group(spark):
    """What is dealt by group alone is one row a part; values are dealt by group and value."""
    d = spark.range(200000).select(F.concat(F.lit("hot"), F.substring(F.col("id").cast("string"), 1, 0)).alias("k"), (F.col("id") * 7919 % 200003).cast("double").alias("v"))
    m = exact_median(d, ["k"], F.col("v"), "m")
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_g#\d+, _n#\d+L?, _groupingexpression#\d+, _groupingexpression#", plan) and "median(" not in plan
    assert m.first().m == d.agg(F.median("v")).first()[0]
    assert selection.BINS <= 1 << 16
