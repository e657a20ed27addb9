"""Registered query of operator 5 (no SQL: tested against a plain model)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import pack_texts, table, unpack_texts, written
from tickvault.llm.quality import classify, cross_perplexity, fold_of, gram_counts


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted text: documents labelled of good quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    # a merge join at every size: labels grow with documents, so they are not broadcast
    texts = docs.where("text is not null").select("doc_id", fold_of(F.col("text")).alias("fold"), "text")
    trusted = written(pack_texts(texts, "text").join(good.hint("merge"), "doc_id").select("fold", "packed"), "trusted")
    counts = [written(gram_counts(unpack_texts(trusted.where(F.col("fold") == fold).select("packed"), "text")), f"grams{fold}") for fold in (0, 1)]
    scored = written(cross_perplexity(docs, F.col("text"), ["doc_id", "lang"], counts), "scored")
    marked = scored.join(good.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    return classify(marked, F.col("lang"), F.col("trusted")).select("doc_id", "lang", "n_symbols", "trusted", "perplexity", "threshold", "kept")


QUERIES = {"op5_quality": op5_quality}
ORACLES: dict[str, str] = {}
