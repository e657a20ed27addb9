"""Registered query of operator 6 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.embedding import near_duplicates


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("embedding"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.9 ELSE false END),
c AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT c.x, l.y FROM c JOIN l ON c.y = l.x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT m.x AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, m.component_id, m.x = m.component_id AS kept
FROM (SELECT x, min(y) AS component_id FROM c GROUP BY x) m LEFT JOIN n ON n.x = m.x"""

QUERIES = {"op6_embedding_dedup": op6_embedding_dedup}
ORACLES = {"op6_embedding_dedup": SQL}
