"""Registered query of operator 9 (no SQL: held-out accuracy is tested)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import pack_texts, table, unpack_texts, written
from tickvault.llm.q_language import held_out
from tickvault.llm.toxicity import fit, score


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    # a merge join at every size: labels grow with documents, so they are not broadcast
    labelled = pack_texts(docs.where("not held_out and doc_id is not null").select("doc_id", "text"), "text").join(labels.hint("merge"), "doc_id")
    training = unpack_texts(written(labelled.select("toxic", "packed"), "toxic"), "text")
    model = fit(training, F.col("text"), F.col("toxic"))
    return score(docs, F.col("text"), model, ["doc_id", "held_out"])


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES: dict[str, str] = {}
