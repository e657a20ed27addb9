"""Operator 3: n-gram Jaccard join by size-banded tiles and bitmap signatures.

A document is the set of its distinct word shingles (64-bit hashes).  Documents
with equal sets are one node.  Two sets that are similar enough share one of
the first ``n - ceil(threshold * n) + 1`` shingles of each in any common order,
so only these are posted; the order puts rare shingles first, by a count sketch
of fixed size.  A tile is the nodes that posted a shingle, cut by size bands so
narrow that similar sets are in one band or in neighbours.

A tile never emits all its pairs.  First every node is paired with the smallest
node of all its tiles, in its own and in the next smaller band; verified pairs
are linked into components.  Then, in tiles that still hold several components,
each node outside the tile's largest component meets the nodes of other
components, as arrays in one task, and only its nearest one by signature comes
out; after ``NEAREST_ROUNDS`` of this, with components linked in between, all
pairs of different components that pass the signatures come out.  The first
round uses signatures folded to half their bits; only tiles of nodes that had an
allowed pair then go on, with whole signatures.  A pair skipped so is
connected already, so components are exact.

Candidate pairs meet their bitmap signatures first (as many bits as shingles
or more, each set by the parity of the shingles hashed to it; unequal
bits bound the overlap from above); what passes is verified by intersecting sorted arrays.

Edge cases: null and wordless texts have the empty set and link with nothing;
texts of fewer words than a shingle are one shingle; a null id is allowed and
counts as larger than any other; repeated rows are one node.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import by_tasks, by_value, drop, fingerprint, map_arrow, record, text_chunks, written
from tickvault.llm.graph import components
from tickvault.llm.tokens import Words, grams, inside, splitmix, words_of

SHINGLE, PERCENT, SKETCH_BITS = 5, 80, 18
#: Most outsiders and members of a tile that meet in one place; larger tiles are cut.
OUTSIDERS, MEMBERS = 128, 2048
#: How often nodes meet only their nearest one before all pairs meet.
NEAREST_ROUNDS = 2
#: About as many bytes of tiles meet in one task at a time.
BAG_BYTES = 1 << 21


def shingle_sets(w: Words, k: int):
    """For each text the sorted array of its distinct shingles."""
    g, ok = grams(w.hash, k), inside(w.off, k)
    for d in range(len(w.off) - 1):
        a, b = int(w.off[d]), int(w.off[d + 1])
        if b - a >= k:
            yield np.unique(g[a:b - k + 1])
        elif b > a:
            yield grams(w.hash[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def node_of(s: np.ndarray) -> int | None:
    """64 bits of a set, as a signed number; None if it is empty."""
    if not len(s):
        return None
    x = splitmix(s + np.uint64(0x5851F42D4C957F2D))
    both = np.array([x.sum()], np.uint64) + np.uint64(len(s)) * np.array([np.bitwise_xor.reduce(splitmix(x))], np.uint64)
    return int(splitmix(both).view(np.int64)[0])


def signature(s: np.ndarray) -> bytes:
    """Parity bitmap with a power of two of bits, no fewer than shingles and 64."""
    bits = 64 << max(0, math.ceil(math.log2(max(len(s), 1) / 64)))
    at = (splitmix(s) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).tobytes()


def folded(bits: bytes) -> bytes:
    """A signature of half the bits (no fewer than 64): the halves' parity."""
    half = len(bits) // 2
    return bytes(np.frombuffer(bits[:half], np.uint8) ^ np.frombuffer(bits[half:], np.uint8)) if half >= 8 else bits


def unequal_bits(x: bytes, y: bytes) -> int:
    """A lower bound of the shingles that are in one set only."""
    a, b = np.unpackbits(np.frombuffer(x, np.uint8)), np.unpackbits(np.frombuffer(y, np.uint8))
    if len(a) < len(b):
        a, b = b, a
    return int((np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0) ^ b).sum())


def _describe(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("bits", pa.binary()), ("half", pa.binary()), ("bucket", pa.int32()), ("count", pa.int64())])

    def work(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            n, node, bits, half = [], [], [], []
            for _, _, raw, offsets in text_chunks(batch, "text"):
                for s in shingle_sets(words_of(raw, offsets, "lower"), k):
                    n.append(len(s))
                    node.append(node_of(s))
                    bits.append(signature(s) if len(s) else None)
                    half.append(folded(bits[-1]) if len(s) else None)
                    np.add.at(sketch, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            none = pa.nulls(len(n))
            yield record(schema, batch.column(0), batch.column(1), n, node, bits, half, none.cast(pa.int32()), none.cast(pa.int64()))
        some = np.flatnonzero(sketch)
        none = pa.nulls(len(some))
        yield record(schema, *[none.cast(pa.int64())] * 4, *[none.cast(pa.binary())] * 2, some.astype(np.int32), sketch[some])

    return work, "doc_id long, print long, n long, node long, bits binary, half binary, bucket int, count long"


def _post(k: int, percent: int, order: np.ndarray):
    schema = pa.schema([("h", pa.int64()), ("node", pa.int64()), ("size", pa.int32())])

    def work(batches):
        for batch in batches:
            for _, _, raw, offsets in text_chunks(batch, "text"):
                hs, nodes, sizes, counts = [], [], [], []
                for s in shingle_sets(words_of(raw, offsets, "lower"), k):
                    n = len(s)
                    if n:
                        nodes.append(node_of(s))
                        first = n - (percent * n + 99) // 100 + 1
                        seen = order[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                        if first < n:  # the rarest, then those of the smallest hash
                            s = s[np.lexsort((s, seen))[:first]]
                        hs.append(s)
                        sizes.append(n)
                        counts.append(len(s))
                if hs:
                    yield record(schema, np.concatenate(hs).view(np.int64), np.repeat(np.array(nodes, np.int64), counts), np.repeat(np.array(sizes, np.int32), counts))

    return work, "h long, node long, size int"


def _texts(k: int):
    """Texts of wanted nodes, compressed, if the row's set is the node's."""
    schema = pa.schema([("node", pa.int64()), ("packed", pa.binary())])

    def work(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            want = batch.column(0).to_pylist()
            nodes, packed = [], []
            for lo, hi, raw, offsets in text_chunks(batch, "text"):
                for d, s in enumerate(shingle_sets(words_of(raw, offsets, "lower"), k)):
                    if node_of(s) == want[lo + d]:
                        nodes.append(want[lo + d])
                        packed.append(pack.compress(raw[offsets[d]:offsets[d + 1]].tobytes()))
            yield record(schema, nodes, packed)

    return work, "node long, packed binary"


def _filter(percent: int):
    """Pairs whose signatures allow the similarity."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches):
        for batch in batches:
            a, b, na, nb, x, y = (c.to_pylist() for c in batch.columns)
            ok = [unequal_bits(p, q) * (100 + percent) <= (100 - percent) * (m + n) for m, n, p, q in zip(na, nb, x, y)]
            mask = pa.array(ok, pa.bool_())
            yield record(schema, batch.column(0).filter(mask), batch.column(1).filter(mask))

    return work, "a long, b long"


def _cross(percent: int, nearest: bool):
    """For a bag of tiles, each with outsiders (side 0) and all its nodes (side
    1): the pairs of different components that sizes and signatures allow; or,
    of each outsider, the nearest one by the share of unequal bits."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("share", pa.float64())])

    def unequal(i, j, width, bits):
        """The number of unequal bits of pairs of rows."""
        out = np.zeros(len(i), np.int64)
        least = np.minimum(width[i], width[j])
        for w in np.unique(least):
            mine = np.flatnonzero(least == w)
            rows, at = np.unique(np.concatenate([i[mine], j[mine]]), return_inverse=True)
            table = np.empty((len(rows), w // 64), np.uint64)
            for n, r in enumerate(rows):  # a wider signature is folded
                table[n] = np.bitwise_xor.reduce(np.frombuffer(bits[r], np.uint64).reshape(-1, w // 64), axis=0)
            x, y = at[:len(mine)], at[len(mine):]
            slab = max(1, (1 << 20) // (w // 64))
            for lo in range(0, len(mine), slab):
                out[mine[lo:lo + slab]] = np.bitwise_count(table[x[lo:lo + slab]] ^ table[y[lo:lo + slab]]).sum(axis=1, dtype=np.int64)
        return out

    def reduced(found):
        """Distinct pairs, or the nearest of each outsider."""
        a, b, share = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        if not nearest:
            a, b = np.maximum(a, b), np.minimum(a, b)
        order = np.lexsort((b, share, a)) if nearest else np.lexsort((b, a))
        a, b, share = a[order], b[order], share[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) if nearest else (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return a[first], b[first], share[first]

    def work(group: pa.Table) -> pa.Table:
        tile, side, minor, node, size, root = (group.column(c).to_numpy() for c in ("tile", "side", "minor", "node", "size", "root"))
        size = size.astype(np.int64)
        bits = group.column("bits").to_pylist()
        width = np.array([8 * len(b) for b in bits])
        order = np.lexsort((side, tile))
        cut = np.flatnonzero(np.concatenate([[True], tile[order][1:] != tile[order][:-1], [True]]))
        found: list[tuple[np.ndarray, ...]] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            i, j = (np.concatenate(x) for x in zip(*held))
            held.clear()
            ok = (root[i] != root[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
            if not nearest:
                ok &= ~minor[j] | (node[i] < node[j])
            i, j = i[ok], j[ok]
            odd, both = unequal(i, j, width, bits), size[i] + size[j]
            ok = odd * (100 + percent) <= (100 - percent) * both
            found.append((node[i[ok]], node[j[ok]], odd[ok] / both[ok]))
            if len(found) > 16:
                found[:] = [reduced(found)]

        waiting = 0
        for lo, hi in zip(cut[:-1], cut[1:]):
            mine = order[lo:hi]
            q = int(np.searchsorted(side[mine], 1))
            held.append((np.repeat(mine[:q], hi - lo - q), np.tile(mine[q:], q)))
            waiting += q * (hi - lo - q)
            if waiting > 1 << 18:
                flush()
                waiting = 0
        if held:
            flush()
        return pa.Table.from_batches([record(schema, *reduced(found))])

    return work, "a long, b long, share double"


def _verify(k: int, percent: int):
    """Pairs whose sets are similar enough, by intersecting sorted arrays."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches):
        unpack, cache = zstandard.ZstdDecompressor(), OrderedDict()

        def set_of(node, packed):
            if node not in cache:
                raw = np.frombuffer(unpack.decompress(packed), np.uint8)
                cache[node] = next(shingle_sets(words_of(raw, np.array([0, len(raw)]), "lower"), k))
                if len(cache) > 64:
                    cache.popitem(last=False)
            cache.move_to_end(node)
            return cache[node]

        for batch in batches:
            ok = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                p, q = set_of(a, x), set_of(b, y)
                p, q = (p, q) if len(p) <= len(q) else (q, p)
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[at] == p).sum())
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            mask = pa.array(ok, pa.bool_())
            yield record(schema, batch.column(0).filter(mask), batch.column(1).filter(mask))

    return work, "a long, b long"


def jaccard_components(docs: DataFrame, doc_id: Column, text: Column, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, print (fingerprint of the text),
    n_shingles, node (null for the empty set), component_id (smallest doc_id of
    the component) and kept (is this row the first of its component by doc_id
    and print, or its set empty?)."""
    rows = docs.select(doc_id.cast("long").alias("doc_id"), fingerprint(text).alias("print"), text.alias("text"))
    seen = written(map_arrow(rows, *_describe(shingle)), "sets")
    base = seen.where("bucket is null").select("doc_id", "print", "n", "node", "bits", "half")
    counts = seen.where("bucket is not null").groupBy("bucket").agg(F.sum("count").alias("count")).toArrow()  # 2**SKETCH_BITS rows at most
    order = np.zeros(1 << SKETCH_BITS, np.int64)
    order[counts.column(0).to_numpy()] = counts.column(1).to_numpy()

    at = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id"), F.col("print"))  # a null id comes last
    nodes = written(by_tasks(base.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("half").alias("half"), F.min(at).alias("at"), F.min("doc_id").alias("doc_id")), seen.count()), "nodes")
    posted = written(map_arrow(rows, *_post(shingle, percent, order.astype(np.int32))), "posted")
    n = posted.count()
    shared = written(by_tasks(posted.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("h"), n), "shared")
    band = F.floor(F.log("size") / F.lit(math.log(100 / percent))).cast("int")
    tiles = written(by_tasks(posted.join(shared, "h").select("h", "node", "size", band.alias("band")).distinct(), n), "tiles")
    drop(posted, shared)

    fits = F.lit(100) * F.least("size", "other_size") >= F.lit(percent) * F.greatest("size", "other_size")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """pairs (a, b) of nodes that are similar enough."""
        facts, n = nodes.select("node", "n", "bits"), pairs.count()
        p = by_tasks(pairs.join(facts.toDF("a", "na", "xa"), "a"), n).join(facts.toDF("b", "nb", "xb"), "b").select("a", "b", "na", "nb", "xa", "xb")
        likely = written(map_arrow(by_tasks(p, n), *_filter(percent)), f"{name}-likely")
        ends = by_tasks(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), 2 * n)
        wanted = written(by_tasks(ends.join(nodes.select("node", "doc_id"), "node"), 2 * n), f"{name}-wanted")
        ids = wanted.select("node", F.coalesce("doc_id", F.lit(-1)).alias("_id"))
        found = rows.select(F.coalesce("doc_id", F.lit(-1)).alias("_id"), "text").join(ids, "_id").select("node", "text")
        texts = written(map_arrow(found, *_texts(shingle)), f"{name}-texts")
        q = by_tasks(likely.join(texts.toDF("b", "y"), "b"), n).join(texts.toDF("a", "x"), "a").select("a", "b", "x", "y")
        links = written(by_tasks(map_arrow(by_tasks(q, n), *_verify(shingle, percent)).distinct(), n), f"{name}-links")
        drop(likely, wanted, texts)
        return links

    # every node meets the smallest node of all its tiles, in its own band and in the one below
    heads = tiles.groupBy("h", "band").agg(F.min(F.struct("node", "size")).alias("head")).select("h", "band", "head.node", "head.size")
    n = tiles.count()
    heads = written(by_tasks(heads, n), "heads")
    pairs = None
    for step in (0, 1):
        heads_of = heads.select("h", (F.col("band") + step).alias("band"), F.col("node").alias("other"), F.col("size").alias("other_size"))
        met = by_tasks(tiles.join(heads_of, ["h", "band"]).where(fits & (F.col("node") != F.col("other"))), n).groupBy("node").agg(F.min("other").alias("other"))
        met = by_tasks(met, n).select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"))
        pairs = met if pairs is None else pairs.unionAll(met)
    stars = written(by_tasks(pairs.distinct(), n), "stars")
    links = verified(stars, "stars")
    roots = components(links)
    drop(heads, stars)

    # tiles that still hold several components: their outsiders meet the nearest
    # node of another component, and in the last round all that signatures allow
    rest, bits = tiles, "half"
    for turn in range(NEAREST_ROUNDS + 1):
        before, (rest, bags) = rest, _mixed(rest, roots, nodes.select("node", F.col(bits).alias("bits")))
        drop(before)
        if not bags:
            break
        crossed = _crossed(rest, bags, percent, turn < NEAREST_ROUNDS)
        found = verified(crossed, "crossed")
        if not found.isEmpty():
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(found))
        # a tile without an allowed pair has none later: only tiles of nodes that had one go on, with whole signatures
        n, ends = rest.count(), crossed.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        go_on = by_tasks(by_tasks(rest.join(by_tasks(ends, n), "node", "left_semi").select("h"), n).distinct(), n)
        before, rest, bits = rest, written(by_tasks(rest.join(go_on, "h", "left_semi").select("h", "node", "size"), n), "go-on"), "bits"
        drop(before, crossed)
    drop(rest)
    return _labelled(base, nodes, roots, at)


def _mixed(tiles: DataFrame, roots: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the tiles that hold several components (those outside a tile's
    largest are minor), each with the number of parts that its tile's outsiders
    (few) and members (many) are cut into, and the number of bags that they
    fill (0: there are no such tiles).  Rows are in the order of nodes: equal signatures lie side by side, so
    the table and the shuffle made from it are small."""
    n = tiles.count()
    placed = written(by_tasks(tiles.select("h", "node", "size").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), n), "placed")
    sizes = by_tasks(placed.groupBy("h", "root").agg(F.count(F.lit(1)).alias("n")), n)
    tops = sizes.groupBy("h").agg(F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("roots"), F.sum("n").alias("m")).where("roots > 1")
    few, many = F.ceil((F.col("m") - F.col("top.n")) / OUTSIDERS), F.ceil(F.col("m") / MEMBERS)
    mixed = by_tasks(tops.select("h", F.col("top.root").alias("major"), few.cast("int").alias("few"), many.cast("int").alias("many")), n)
    rest = by_tasks(placed.join(mixed, "h"), n).withColumn("minor", F.col("root") != F.col("major"))
    rest = by_tasks(rest.join(nodes, "node"), n).select("h", "node", "size", "root", "minor", "few", "many", "bits").sortWithinPartitions("node")
    rest = written(rest, "rest")
    drop(placed)
    held = rest.agg(F.sum(F.octet_length("bits") + 64)).first()[0]
    return rest, max(512, held // BAG_BYTES) if held else 0


def _crossed(rest: DataFrame, bags: int, percent: int, nearest: bool) -> DataFrame:
    """Pairs (a, b) of _cross over all tiles; of a node the nearest if so asked."""
    sides = rest.withColumn("side", F.explode(F.when(F.col("minor"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("few")).otherwise(F.col("many")))
    across = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("many")).otherwise(F.col("few")) - 1))
    sides = sides.withColumn("own", own.cast("int")).withColumn("across", across)
    sides = sides.withColumn("tile", F.when(F.col("side") == 0, F.xxhash64("h", "own", "across")).otherwise(F.xxhash64("h", "across", "own")))
    work, schema = _cross(percent, nearest)
    n = rest.count()
    by_value()
    pairs = sides.select(F.pmod("tile", F.lit(bags)).alias("bag"), "tile", "side", "minor", "node", "size", "root", "bits").groupBy("bag").applyInArrow(work, schema)
    if nearest:
        pairs = by_tasks(pairs.groupBy("a").agg(F.min(F.struct("share", "b")).alias("best")), n).select(F.greatest("a", "best.b").alias("a"), F.least("a", "best.b").alias("b"))
    return written(by_tasks(pairs.select("a", "b").distinct(), n), "crossed")


def _labelled(base: DataFrame, nodes: DataFrame, roots: DataFrame, at: Column) -> DataFrame:
    first = nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "at")
    n = nodes.count()
    smallest = by_tasks(first.groupBy("root").agg(F.min("at").alias("first")), n)
    classes = written(by_tasks(by_tasks(first.select("node", "root"), n).join(smallest, "root").select("node", "first"), n), "classes")
    out = base.select("doc_id", "print", F.col("n").alias("n_shingles"), "node").join(classes, "node", "left")
    alone = F.col("node").isNull()
    component = F.when(F.col("first.doc_id") < (1 << 63) - 1, F.col("first.doc_id"))
    return out.select("doc_id", "print", "n_shingles", "node", F.when(alone, F.col("doc_id")).otherwise(component).alias("component_id"),
                      (alone | at.eqNullSafe(F.col("first"))).alias("kept"))
