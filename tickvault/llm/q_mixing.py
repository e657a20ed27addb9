"""Registered query of operator 1 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.mixing import mix_sources

#: Quality weight of a document labelled good, labelled bad, not labelled.
GOOD, BAD, UNKNOWN = 2.0, 0.5, 1.0


def with_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, quality) of documents."""
    label = (table(spark, sf_dir, "labels").where("doc_id is not null").groupBy("doc_id")
             .agg(F.max("quality").alias("_label")).withColumnRenamed("doc_id", "_labelled"))
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[^ \\x09-\\x0D]+"))
    quality = F.when(F.col("_label") == 1, GOOD).when(F.col("_label") == 0, BAD).otherwise(UNKNOWN)
    d = docs.select("doc_id", "source", size.cast("long").alias("size"))
    return d.join(label, F.col("doc_id") == F.col("_labelled"), "left").select("doc_id", "source", "size", quality.alias("quality"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = with_quality(spark, table(spark, sf_dir, "documents"), sf_dir)
    mixed = mix_sources(d, F.col("doc_id"), F.col("source"), F.col("size"), F.col("quality"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
           / CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS k
  FROM documents LEFT JOIN (SELECT doc_id AS lid, max(quality) AS q FROM labels GROUP BY 1) ON lid = doc_id),
s AS (SELECT source, sum(size)::DOUBLE AS total, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
o AS (SELECT *, 3 * total AS cap,
             coalesce(sum(3 * total) OVER p, 0) AS capped, coalesce(sum(w) OVER p, 0) AS wdone
      FROM s WINDOW p AS (ORDER BY 3 * total / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, ((SELECT sum(total) FROM s) - capped) / ((SELECT sum(w) FROM s) - wdone) AS level FROM o),
t AS (SELECT source, total, CASE WHEN cap > level * w THEN w * (SELECT max(level) FROM v WHERE cap > level * w) ELSE cap END AS target FROM v),
c AS (SELECT d.doc_id, d.size, t.total, t.target,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto,
             CASE WHEN t.total > 0 THEN floor(t.target / t.total) ELSE 0 END AS epochs
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, total::BIGINT AS source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND upto - size / 2.0 <= target - epochs * total THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c"""

QUERIES = {"op1_mixing": op1_mixing}
ORACLES = {"op1_mixing": SQL}
