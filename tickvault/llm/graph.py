"""Connected components by alternating large and small stars (Spark joins).

Each round points neighbours at the smallest node seen, first the larger ones,
then the smaller ones; after about log(n) rounds every node points at the
smallest of its component.  Minima are written before they are joined, so both
sides of a join are plain shuffles and a node with very many links is split.
Rounds are many and edges are small rows, so the tables of a round are made and
written by as many tasks as their edges need, not by one a shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickvault.llm.common import by_tasks, written


def _minima(edges: DataFrame, n: int) -> DataFrame:
    return written(by_tasks(edges.groupBy("a").agg(F.min("b").alias("m")), n), "minima")


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the smallest node of
    its component.  Loops and repeated edges do no harm."""
    a, b = F.col("a"), F.col("b")
    now = written(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = now.unionAll(now.select(b.alias("a"), a.alias("b")))
        n = 2 * state[0]
        large = both.join(_minima(both, n), "a").where(b > a).select(b.alias("a"), F.least(a, F.col("m")).alias("b"))
        large = written(by_tasks(by_tasks(large.where(a != b), n).distinct(), n), "large")
        small = large.join(_minima(large, n), "a")
        small = small.select(F.explode(F.array(F.struct(a, F.col("m").alias("b")), F.struct(b.alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = written(by_tasks(by_tasks(small.where(a != b), n).distinct(), n), "small")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(b.alias("node"), b.alias("root")).distinct()
    return written(by_tasks(now.select(a.alias("node"), b.alias("root")).unionAll(by_tasks(roots, state[0])), 2 * state[0]), "components")
