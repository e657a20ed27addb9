"""Operator 6: near-duplicate embeddings by collision-counting projections.

There are ``tables`` one-dimensional Gaussian projections.  Rows are sorted
along each, inside cells given by the signs of a few more projections, so that
a cell holds about ``CELL`` rows at any size of input.  Two rows collide in a
table when they share its cell and each lies in the window centred on the
other's projection.  A pair with at least ``LEAST`` collisions is verified by
its cosine in double precision.  The number of tables is calibrated: a pair
right at the threshold reaches that count with probability ``RECALL`` (a nearer
pair more often), from the binomial distribution.

Pairs are never shuffled.  Every row of a cell knows its signs and projections
in all tables, so the group that sees a pair in its first common table counts
its collisions and alone counts its link; what leaves a group is, per row, its
number of links and the smallest row it is connected with there.  Cells of over
``BLOCK`` rows are cut into blocks, and every two blocks meet in a group of
their own, so a crowded cell is spread and nothing is left out.  Equal vectors
are one node with a multiplicity.

Edge cases: vectors that are null, empty or zero or hold null or non-finite
components link with nothing, nor does a vector without id; vectors of
different length are not compared; rows that share an id are one node; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import by_value, map_arrow, record, written
from tickvault.llm.graph import components

THRESHOLD, RECALL, LEAST = 0.9, 0.98, 2
CELL, BLOCK = 512, 640
#: Half a window, in standard deviations of the difference of two rows at the threshold.
REACH = 2.5


def calibrate(rows: int, threshold: float = THRESHOLD, recall: float = RECALL, least: int = LEAST) -> tuple[int, int]:
    """Signs of a cell and number of tables."""
    signs = max(3, math.ceil(math.log2(max(rows, 1) / CELL)))
    same = (1 - math.acos(threshold) / math.pi) ** signs * math.erf(REACH / math.sqrt(2))
    tables = least
    while sum(math.comb(tables, i) * same**i * (1 - same) ** (tables - i) for i in range(least)) > 1 - recall:
        tables += 1
    return signs, tables


def projections(unit: np.ndarray, signs: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell and projected value of each row in each table."""
    axes = np.random.default_rng(unit.shape[1]).standard_normal((unit.shape[1], tables * (signs + 1)))
    p = (unit @ axes).reshape(len(unit), tables, signs + 1)
    return ((p[:, :, 1:] > 0) << np.arange(signs)).sum(axis=2), p[:, :, 0]


def units(packed: list[bytes]) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    x = np.array([np.frombuffer(v[:-1], v[-1:].decode()) for v in packed], np.float64)
    return x / np.linalg.norm(x, axis=1)[:, None]


def pack(x: np.ndarray) -> bytes:
    """Single precision if that loses nothing, then the type's letter."""
    single = x.astype(np.float32)
    return single.tobytes() + b"f" if np.array_equal(single, x) else x.tobytes() + b"d"


def group_links(ids: np.ndarray, block: np.ndarray, times: np.ndarray, unit: np.ndarray, table: int, signs: int, tables: int,
                threshold: float, least: int, between: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row its links (with multiplicity) and the smallest id it is connected with here."""
    cell, value = projections(unit, signs, tables)
    half = REACH * math.sqrt(2 - 2 * threshold)
    order = np.argsort(value[:, table], kind="stable")
    stop = np.searchsorted(value[order, table], value[order, table] + half, "right")
    size = stop - np.arange(len(order)) - 1
    a = np.repeat(np.arange(len(order)), size)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size)
    a, b = order[a], order[b]
    if between:  # pairs within a block are another group's
        cross = block[a] != block[b]
        a, b = a[cross], b[cross]
    cell, found = cell.astype(np.int32), []
    for lo in range(0, len(a), 1 << 16):
        x, y = a[lo:lo + (1 << 16)], b[lo:lo + (1 << 16)]
        often = (cell[x] == cell[y]).sum(axis=1) >= least
        x, y = x[often], y[often]
        met = (cell[x] == cell[y]) & (np.abs(value[x] - value[y]) <= half)
        mine = (met.argmax(axis=1) == table) & (met.sum(axis=1) >= least)  # the pair's first table counts its link
        x, y = x[mine], y[mine]
        near = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
        found.append((x[near], y[near]))
    a, b = (np.concatenate(c) for c in zip(*found)) if found else (a, b)
    links = np.bincount(a, times[b], len(ids)) + np.bincount(b, times[a], len(ids))
    root = ids.copy()
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if np.array_equal(before, root):
            break
    return links.astype(np.int64), root


def near_duplicates(vectors: DataFrame, vec_id: Column, embedding: Column, threshold: float = THRESHOLD, recall: float = RECALL, least: int = LEAST) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept."""
    plain = vectors.select(vec_id.cast("long").alias("vec_id"), embedding.cast("array<double>").alias("embedding"))

    def packed(batches):
        schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary())])
        for batch in batches:
            out = []
            for i, e in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = None if i is None or not e.is_valid or e.values.null_count else e.values.to_numpy(zero_copy_only=False)
                size = np.linalg.norm(x) if x is not None and len(x) else 0
                out.append(pack(x) if np.isfinite(size) and size > 0 else None)
            yield record(schema, batch.column(0), out)

    rows = written(map_arrow(plain, packed, "vec_id long, vector binary"), "vectors")
    valid = rows.where("vector is not null")
    nodes = written(valid.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("times")), "distinct")
    signs, tables = calibrate(nodes.count(), threshold, recall, least)

    def place(batches):
        schema = pa.schema([("table", pa.int32()), ("cell", pa.int64()), ("length", pa.int32()), ("id", pa.int64()), ("times", pa.int64()), ("vector", pa.binary())])
        for batch in batches:
            vector, ids, times = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            size = np.array([(len(v) - 1) // np.dtype(v[-1:].decode()).itemsize for v in vector])
            for n in np.unique(size):
                mine = np.flatnonzero(size == n)
                for lo in range(0, len(mine), 4096):
                    part = mine[lo:lo + 4096]
                    cell, _ = projections(units([vector[i] for i in part]), signs, tables)
                    at = pa.array(np.tile(part, tables))
                    yield record(schema, np.repeat(np.arange(tables, dtype=np.int32), len(part)), cell.T.reshape(-1).astype(np.int64),
                                 np.full(len(at), n, np.int32), ids.take(at), times.take(at), batch.column(0).take(at))

    placed = map_arrow(nodes.select("vector", "id", "times"), place, "table int, cell long, length int, id long, times long, vector binary")
    key = ["table", "cell", "length"]
    crowd = placed.groupBy(*key).count().where(F.col("count") > BLOCK).select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    crowd = written(crowd, "crowded")
    cut = placed.join(crowd, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("x"), F.greatest(o, F.col("block")).alias("y")))
    cut = cut.withColumn("meet", F.explode(meet)).select(*key, "meet", "block", "id", "times", "vector")

    def compare(group: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
        ids, times, block = (group.column(c).to_numpy() for c in ("id", "times", "block"))
        meet = group.column("meet")[0].as_py()
        links, root = group_links(ids, block, times, units(group.column("vector").to_pylist()), group.column("table")[0].as_py(),
                                  signs, tables, threshold, least, meet["x"] != meet["y"])
        some = np.flatnonzero(links)
        return pa.Table.from_batches([record(schema, ids[some], links[some], root[some])])

    by_value()
    found = written(cut.groupBy(*key, "meet").applyInArrow(compare, "id long, links long, root long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    facts = nodes.join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    facts = written(facts.select("vector", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")), "facts")
    out = rows.join(facts, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
