"""Registered query of operator 7 (no SQL: tested against plain search)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.licence import scan


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"), ["doc_id"])
    starts = F.col("phrases.start")
    base = F.array_distinct("phrases.label")
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("spans.label"))), ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.col("best")).alias("score"))


QUERIES = {"op7_licence_scan": op7_licence_scan}
ORACLES: dict[str, str] = {}
