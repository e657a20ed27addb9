"""Registered query of operator 2 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table, words_sql
from tickvault.llm.substring import remove_repeats


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words_sql(F.col("text")), " "), 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT r, s, hash(list_slice(w, s, s + 34)) AS h, md5(array_to_string(list_slice(w, s, s + 34), ' ')) AS m
      FROM d, unnest(range(1, greatest(len(w) - 34, 0) + 1)) AS t(s)),
u AS (SELECT h, m FROM g GROUP BY h, m HAVING count(*) > 1),
x AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS i FROM g JOIN u USING (h, m)),
k AS (SELECT d.r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
      FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d) d ANTI JOIN x USING (r, i) GROUP BY d.r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)"""

QUERIES = {"op2_substring_dedup": op2_substring_dedup}
ORACLES = {"op2_substring_dedup": SQL}
