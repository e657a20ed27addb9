"""Registered query of operator 3 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.jaccard import jaccard_components


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"), shingle=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS g FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n2 FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * n2 >= 85 * (nx.n + ny.n - n2)),
c AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT c.x, l.y FROM c JOIN l ON c.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM c GROUP BY x) m ON m.x = d.doc_id"""

QUERIES = {"op3_ngram_jaccard": op3_ngram_jaccard}
ORACLES = {"op3_ngram_jaccard": SQL}
