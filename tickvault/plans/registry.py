"""Query registry: each entry is a Spark plan over the fixtures and,
where SQL can express it, an independent DuckDB oracle text.

Doubles are rounded to 4 decimals on both sides (float sums differ in the
last digits between engines).  The Spark side rounds every double column;
the oracle side rounds the columns listed in ``rnd``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures


@dataclass
class Entry:
    name: str
    fn: Callable[[dict], DataFrame]
    oracle: str | None
    rnd: tuple[str, ...] = field(default_factory=tuple)
    ops: str = ""


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None, rnd=(), ops: str = ""):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, oracle, tuple(rnd), ops)
        return fn
    return deco


def finalize(df: DataFrame) -> DataFrame:
    """Round double columns to 4 decimals as ``round(x * 1e4) / 1e4``: the
    product and quotient are IEEE operations, so both engines agree even on
    ties, where decimal half-up rounding and binary rounding differ."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f"`{f.name}`") * 10000) / 10000).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def spark_fn(name: str) -> Callable[[SparkSession, str], DataFrame]:
    e = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..session import configure
        configure(spark)
        return finalize(e.fn(fixtures.load(spark, sf_dir)))
    run.__name__ = f"q_{name}"
    run.__doc__ = e.fn.__doc__
    return run


def oracle_text(name: str) -> str | None:
    e = REGISTRY[name]
    if e.oracle is None:
        return None
    sql = e.oracle.strip().rstrip(";")
    if e.rnd:
        repl = ", ".join(f"round({c} * 10000) / 10000 as {c}" for c in e.rnd)
        sql = f"select * replace ({repl}) from (\n{sql}\n) _r"
    return fixtures.oracle_with(sql)
