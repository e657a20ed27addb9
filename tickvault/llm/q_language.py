"""Registered query of operator 10 (no SQL: held-out accuracy is tested)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.language import fit, identify


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text divisible by 5; a null id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def prototypes(docs: DataFrame):
    return fit(docs.where(~held_out(F.col("doc_id"))), F.col("text"), F.col("lang"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, F.col("text"), prototypes(docs), ["doc_id", "held_out"])


QUERIES = {"op10_language_id": op10_language_id}
ORACLES: dict[str, str] = {}
