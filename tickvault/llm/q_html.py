"""Registered query of operator 8 (no SQL: tested on written pages)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.html_text import extract, learn_costs


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages, F.col("html"), ["page_id", "url"], learn_costs(pages, F.col("html")))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op8_html_extraction": op8_html_extraction}
ORACLES: dict[str, str] = {}
