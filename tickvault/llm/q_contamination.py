"""Registered query of operator 4 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.contamination import find_contamination


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tests = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = find_contamination(docs, F.col("text"), ["doc_id"], tests, F.col("item_id"), F.col("text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


SQL = """
WITH abc AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents, abc),
i AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item,
             regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark, abc),
p AS (SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, s, s + least(len(w), 10) - 1) AS ws
      FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
k AS (SELECT DISTINCT n FROM p),
g AS (SELECT r, s, n, list_slice(w, s, s + n - 1) AS ws FROM d, k, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS t(s)),
m AS (SELECT g.r, g.s, g.n, p.item FROM g JOIN p ON g.n = p.n AND g.ws = p.ws),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN it USING (r)"""

QUERIES = {"op4_decontamination": op4_decontamination}
ORACLES = {"op4_decontamination": SQL}
