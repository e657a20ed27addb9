"""Corpus pipeline: five stages, each written and read again before the next.

A stage takes (spark, docs, sf_dir) and returns the columns of documents; the
last returns the mix.  docs may have more columns, which are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import fingerprint, table, written
from tickvault.llm.contamination import cut_spans, find_contamination
from tickvault.llm.jaccard import jaccard_components
from tickvault.llm.language import accepted
from tickvault.llm.mixing import mix_sources
from tickvault.llm.q_mixing import with_quality
from tickvault.llm.substring import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _worded(docs: DataFrame) -> DataFrame:
    """Documents with words left; n_chars follows the text."""
    left = docs.where(F.regexp_like(F.coalesce("text", F.lit("")), F.lit("[^ \\x09-\\x0D]")))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those unlike the rows of every
    language; a missing lang is the language found."""
    found = accepted(docs, F.col("text"), F.col("lang"), COLUMNS)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of smallest id (and print)."""
    found = jaccard_components(docs, F.col("doc_id"), F.col("text"))
    stay = written(found.where("kept").select(F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("doc_id").isNull().alias("_none"), F.col("print").alias("_print")).distinct(), "stay")
    keyed = docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("_id"), F.col("doc_id").isNull().alias("_none"), fingerprint(F.col("text")).alias("_print"))
    keys = ["_id", "_none", "_print"]
    return keyed.join(stay, keys).dropDuplicates(keys).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated windows; documents without words left go."""
    return _worded(remove_repeats(docs, F.col("doc_id"), F.col("text"), ["doc_id", "lang", "source", "n_chars"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages; documents without words left go."""
    tests = table(spark, sf_dir, "benchmark")
    plain = docs.select(*COLUMNS)
    found = find_contamination(plain, F.col("text"), COLUMNS, tests, F.col("item_id"), F.col("text"))
    return _worded(cut_spans(found.select(*COLUMNS, "spans")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix and how many words of each it takes."""
    rated = with_quality(spark, docs, sf_dir)
    mixed = mix_sources(rated, F.col("doc_id"), F.col("source"), F.col("size"), F.col("quality"))
    copies = (F.col("epochs") + F.col("picked").cast("long")).alias("copies")
    return mixed.where("taken > 0").select("doc_id", "source", "size", "source_size", "target", copies, "taken")


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates), ("substring dedup", substring_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing)]

#: Language ID has no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
