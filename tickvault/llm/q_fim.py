"""Registered query of operator 13 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.fim import fill_in_middle, restored


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = fill_in_middle(docs, F.col("doc_id"), F.col("text"), ["doc_id"])
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                  sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
c AS (SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS y,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                  WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, n, form, text, array_to_string(units[1:least(x, y)], '') AS prefix,
             array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS middle, array_to_string(units[greatest(x, y) + 1:], '') AS suffix FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                          ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM p),
r AS (SELECT *, regexp_split_to_array(output, '<[PSM]>') AS parts FROM o)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN parts[2] || parts[4] || parts[3] ELSE parts[3] || parts[4] || parts[2] END) AS restored_sha256
FROM r"""

QUERIES = {"op13_fill_in_middle": op13_fill_in_middle}
ORACLES = {"op13_fill_in_middle": SQL}
