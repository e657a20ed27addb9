"""Registered query of operator 12 (no SQL: tested against the tiktoken library)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.llm.bpe import IDS, decode, encode
from tickvault.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode(docs, F.col("text"), ["doc_id"], ranks, pattern)
    n, digest = (F.octet_length("ids") / IDS.itemsize).cast("long"), F.sha2("ids", 256)
    found = ids.select("doc_id", n.alias("n_tokens"), digest.alias("ids_sha256"), "ids")
    back = decode(found, F.col("ids"), ["doc_id", "n_tokens", "ids_sha256"], ranks, pattern)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op12_byte_bpe": op12_byte_bpe}
ORACLES: dict[str, str] = {}
