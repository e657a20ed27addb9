"""Operator 11: Merkle manifest of a table by nested-interval labels (DataFrame
operations only).

Rows are the leaves of one tree per group; leaves are ranked from 0, and a node
is labelled with the interval ``lo..hi`` of leaf ranks that it covers.  While
a tree has several nodes on a level, every ``fanout`` consecutive ones become
one node of the next level, whose digest is the sha256 of theirs.  The roots of
the groups' trees are the leaves of one more tree, whose root stands for the
table.

A proof of a leaf is found from the top down.  On each level a node is joined to
the node above whose interval contains its own; the join is an equi-join on the
tree and the bucket ``lo / fanout ** level`` with the containment as its
condition.  Its siblings are what is left of the parent's interval without its
own: the members of the parent that lie before it and after it.  So a path
travels once for each parent, not once for each leaf and level.

Scale: leaves are ranked by a range partitioning on (group, order) and a running
sum over one row per range, so a group with most of all rows is spread like any
other.  No key has more than ``fanout`` rows.  The driver gets the size of the
largest tree and the number of groups.  Every level is a written table.

Edge cases: a null group is a group of its own, before all others; null order
values come first; equal order values are ordered by digest, and rows equal in
that too give the same result in any order; a tree of one leaf has it as its
root and no siblings; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickvault.llm.common import drop, written

FANOUT = 8


def row_digest(*columns: Column) -> Column:
    """sha256 (hex) of the columns' texts, each as byte count, colon, text; a
    null is one minus sign."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def proof_digest(path: Column) -> Column:
    """sha256 (hex) of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(path: Column, digest: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def _ranked(rows: DataFrame, name: str) -> DataFrame:
    """(tree, order, digest, row) with lo, hi (the rank in the tree, from 0) and
    total (leaves of the tree)."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["tree", "order", "digest", "_seen"]  # _seen: repeated rows too are dealt over ranges
    dealt = rows.withColumn("_seen", F.monotonically_increasing_id()).repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    # this id holds the range in its upper bits and the row's place in the range in the lower 33
    placed = written(dealt.select("tree", "digest", "row", F.monotonically_increasing_id().alias("_at")), name)
    ranged = placed.withColumn("_range", F.shiftright("_at", 33))
    spans = ranged.groupBy("tree", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("tree", "_range", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                         F.sum("_n").over(Window.partitionBy("tree")).alias("total"))
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    ranks = ranged.join(spans, ["tree", "_range"]).select("tree", rank.alias("lo"), rank.alias("hi"), "total", "digest", "row")
    out = written(ranks, f"{name}-ranks")
    drop(placed)
    return out


def _levels(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """Nodes of the levels from 1 on: tree, lo, hi, total, digest and members
    (intervals and digests of the level below)."""
    most = leaves.agg(F.max("total")).first()[0] or 0
    levels, below, width = [], leaves, 1
    while width < most:
        member = F.struct("lo", "hi", "digest")
        groups = below.where(F.col("total") > width).groupBy("tree", "total", F.floor(F.col("lo") / (width * fanout)).alias("bucket"))
        nodes = groups.agg(F.array_sort(F.collect_list(member)).alias("members"))
        nodes = nodes.select("tree", F.col("members")[0]["lo"].alias("lo"), F.element_at("members", -1)["hi"].alias("hi"), "total",
                             F.sha2(F.array_join(F.col("members.digest"), ""), 256).alias("digest"), "members")
        below = written(nodes, f"level{len(levels) + 1}")
        levels.append(below)
        width *= fanout
    return levels


def _roots(leaves: DataFrame, levels: list[DataFrame], fanout: int) -> DataFrame:
    """(tree, digest) of every tree's root."""
    roots = leaves.where("total = 1").select("tree", "digest")
    for k, nodes in enumerate(levels, 1):
        roots = roots.unionAll(nodes.where(F.col("total") <= fanout ** k).select("tree", "digest"))
    return roots


def _paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """leaves with what tops (tree, path, more) has for their tree; path begins
    with the leaf's own siblings."""
    more = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for k in range(len(levels), -1, -1):
        nodes = levels[k - 1] if k else leaves
        own = [F.col(f"n.{c}") for c in nodes.columns]
        here = nodes.where(F.col("total") <= fanout ** k).alias("n").join(tops.alias("p"), F.col("n.tree") == F.col("p.tree"))
        here = here.select(*own, F.col("p.path"), *(F.col(f"p.{c}") for c in more))
        if above is not None:
            width = fanout ** (k + 1)
            bucket = lambda side: F.floor(F.col(f"{side}.lo") / width)
            inside = (F.col("n.lo") >= F.col("p.lo")) & (F.col("n.hi") <= F.col("p.hi"))
            joined = nodes.where(F.col("total") > fanout ** k).alias("n").join(above.alias("p"), (F.col("n.tree") == F.col("p.tree")) & (bucket("n") == bucket("p")) & inside)
            joint = lambda keep: F.array_join(F.transform(F.filter("p.members", keep), lambda m: m["digest"]), "")
            step = F.struct(joint(lambda m: m["hi"] < F.col("n.lo")).alias("before"), joint(lambda m: m["lo"] > F.col("n.hi")).alias("after"))
            here = here.unionAll(joined.select(*own, F.concat(F.array(step), F.col("p.path")).alias("path"), *(F.col(f"p.{c}") for c in more)))
        above = here
    return above


def manifest(rows: DataFrame, group: Column, order: Column, digest: Column, keep: list[Column | str], fanout: int = FANOUT) -> DataFrame:
    """One row per row of rows: the columns keep, leaf (its digest), subroot (of
    its group's tree), root (of the table) and path (array of before and after:
    the joined digests of its siblings, level by level up to the root)."""
    tree = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), group))  # null comes first
    leaves = written(rows.select(tree.alias("tree"), order.alias("order"), digest.alias("digest"), F.struct(*keep).alias("row")), "leaves")
    placed = _ranked(leaves, "placed")
    drop(leaves)
    levels = _levels(placed, fanout)

    subroots = _roots(placed, levels, fanout).select(F.lit("").alias("tree"), F.col("tree").alias("order"), "digest", F.struct(F.col("tree").alias("of")).alias("row"))
    top = _ranked(subroots, "subroots")
    top_levels = _levels(top, fanout)
    no_path = F.expr("cast(array() as array<struct<before: string, after: string>>)")
    root = _roots(top, top_levels, fanout).select("tree", no_path.alias("path"), F.col("digest").alias("root"))
    tops = _paths(top, top_levels, root, fanout).select(F.col("row.of").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    tops = written(tops, "tops")
    return _paths(placed, levels, tops, fanout).select("row.*", F.col("digest").alias("leaf"), "subroot", "root", "path")
