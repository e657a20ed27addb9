"""Registered query of operator 11 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.common import table
from tickvault.llm.merkle import FANOUT, folded, manifest, proof_digest, row_digest

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    picked = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(picked, row_digest(*fields, F.translate("text", UPPER, LOWER)))
    found = manifest(docs, F.col("lang"), F.col("doc_id"), row_digest(*fields, F.col("text")), ["doc_id", tampered.alias("tampered")])
    again = folded(F.col("path"), F.coalesce("tampered", "leaf"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc_steps() -> list[int]:
    """What four shifts make of each low nibble (polynomial of CRC-32)."""
    out = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def _sql(levels: int = 11, top_levels: int = 4) -> str:
    """The tree of every lang, level by level (8 ** 11 leaves), and the tree of
    their roots (8 ** 4 langs); a level of one node stays as it is."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    crc = (f"list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [(ascii(c) & 15)::BIGINT, (ascii(c) >> 4)::BIGINT]))), "
           f"lambda c, x: xor({_crc_steps()}[(xor(c, x) & 15) + 1]::BIGINT, c >> 4))")
    ctes = [f"""
a0 AS (SELECT doc_id, coalesce('s' || lang, '') AS tree, sha256({head} || {field('text')}) AS d,
              CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN sha256({head} || {field(lower)}) END AS bad FROM documents),
a AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS r FROM a0),
u0 AS (SELECT tree, r AS i, d, count(*) OVER (PARTITION BY tree) AS n FROM a)"""]

    def climb(name: str, count: int) -> None:
        for k in range(count):
            ctes.append(f"""
{name}{k + 1} AS (SELECT tree, i // {FANOUT} AS i, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY {name}{k}.i)) ELSE min(d) END AS d, (n + {FANOUT - 1}) // {FANOUT} AS n
        FROM {name}{k} GROUP BY tree, i // {FANOUT}, n)""")
            run = f"PARTITION BY tree, i // {FANOUT} ORDER BY i ROWS BETWEEN"
            ctes.append(f"""
{name}p{k} AS (SELECT tree, i, n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS e FROM {name}{k})""")

    climb("u", levels)
    ctes.append(f"""
s AS (SELECT tree AS lang_tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS r FROM u{levels}),
t0 AS (SELECT '' AS tree, r AS i, subroot AS d, count(*) OVER () AS n FROM s)""")
    climb("t", top_levels)
    joins, proof, fold = "", [], "coalesce(bad, a.d)"
    ctes.append("f0 AS (SELECT doc_id, a.d AS leaf, a.r, s.r AS sr, a.tree, subroot, '' AS proof, coalesce(bad, a.d) AS folded FROM a JOIN s ON s.lang_tree = a.tree)")
    steps = [("u", k, "f.tree", "f.r") for k in range(levels)] + [("t", k, "''", "f.sr") for k in range(top_levels)]
    for j, (name, k, tree, rank) in enumerate(steps):
        ctes.append(f"""
f{j + 1} AS (SELECT doc_id, leaf, f.r, sr, f.tree, subroot, proof || p.b || p.e AS proof, CASE WHEN p.n > 1 THEN sha256(p.b || folded || p.e) ELSE folded END AS folded
       FROM f{j} f JOIN {name}p{k} p ON p.tree = {tree} AND p.i = {rank} // {FANOUT ** k})""")
    return "WITH " + ",".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM f{len(steps)}, (SELECT d AS root FROM t{top_levels})"""


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLES = {"op11_merkle_manifest": _sql()}
