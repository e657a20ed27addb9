"""Operator 2: exact substring removal by relative Lempel-Ziv parsing.

A phrase is ``k`` words chosen by content: the one of smallest hash in each
window (``k`` is half a window, so every window has a phrase and neighbouring
phrases touch).  The reference index holds, for every phrase that occurs more
than once, the place of one occurrence, in blocks by the phrase's hash; a
document is looked up in every block that its phrases fall into.

Parsing is greedy: a factor goes on as long as the next phrase points to the
same reference text at the same distance.  Neighbouring phrases touch, so equal
phrases make the whole factor equal to its reference.  A factor of at least a
window is a duplicate span, in the document and in its reference.  What parsing
leaves open are windows around factor boundaries: windows with a repeated
phrase that no factor covers, and those of the reference phrases themselves.
They are compared exactly, by a hash of all their words.  If two windows are
equal they share their phrase, so either a factor covers both or both are in
this comparison.

Hashes have 64 bits.  Repeated phrases of a document are posted once, hot
phrases are counted before they are joined, and spans of a much used reference
meet by their start first.  A window may repeat in its own document.

Edge cases: null and empty texts have no words; texts shorter than a window
lose nothing; a null id is allowed; rows that are equal throughout are two
documents with the same words; texts of any length are parsed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import BATCH_BYTES, fingerprint, map_arrow, pack_texts, record, text_chunks, written
from tickvault.llm.tokens import Words, grams, inside, words_of

WINDOW = 35
_PLACE = 28  # bits for a word's place among the words of a run of texts


def phrase_words(window: int) -> int:
    return (window + 1) // 2


def phrases(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of every window, place of its phrase, and the hashes of all runs
    of phrase length."""
    k = phrase_words(window)
    g = grams(w.hash, k)
    low = ((g >> np.uint64(_PLACE)) << np.uint64(_PLACE)) | np.arange(len(g), dtype=np.uint64)
    ok = inside(w.off, window)
    span, width = 1, window - k + 1
    while span * 2 <= width and len(low) > span:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span and len(low) > width - span:
        low = np.minimum(low[:span - width], low[width - span:])
    starts = np.flatnonzero(ok)
    return starts, (low[starts] & np.uint64((1 << _PLACE) - 1)).astype(np.int64), g


def _counts(window: int):
    """(h, n) of the phrases of each run of texts."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def work(batches):
        for batch in batches:
            for _, _, raw, offsets in text_chunks(batch, "text"):
                w = words_of(raw, offsets, "plain")
                _, at, g = phrases(w, window)
                h, n = np.unique(g[np.unique(at)], return_counts=True)
                yield record(schema, h.view(np.int64), n.astype(np.int64))

    return work, "h long, n long"


def _postings(window: int):
    """(h, key, pos) of the first place of each phrase of a text."""
    schema = pa.schema([("h", pa.int64()), ("key", pa.int64()), ("pos", pa.int64())])

    def work(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, _, raw, offsets in text_chunks(batch, "text"):
                w = words_of(raw, offsets, "plain")
                _, at, g = phrases(w, window)
                at = np.unique(at)
                owner = np.searchsorted(w.off, at, "right") - 1
                order = np.lexsort((at, g[at], owner))
                at, owner, h = at[order], owner[order], g[at[order]]
                first = np.ones(len(at), bool)
                first[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
                at, owner, h = at[first], owner[first], h[first]
                yield record(schema, h.view(np.int64), keys[lo + owner], at - w.off[owner])

    return work, "h long, key long, pos long"


def _parse(window: int):
    """Rows (kind, key, start, stop, h): 0 a span, 1 an open window."""
    k = phrase_words(window)
    schema = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("h", pa.int64())])

    def work(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            keys, packed, pointers = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            out: list[list[np.ndarray]] = [[], [], [], [], []]

            def add(kind, key, start, stop, h):
                for column, x in zip(out, (np.full(len(start), kind, np.int8), np.full(len(start), key, np.int64) if np.isscalar(key) else key, start, stop, h)):
                    column.append(x)

            for i, key in enumerate(keys):
                raw = np.frombuffer(unpack.decompress(packed[i]), np.uint8)
                w = words_of(raw, np.array([0, len(raw)]), "plain")
                starts, at, g = phrases(w, window)
                places, which = np.unique(at, return_inverse=True)
                mine = pointers[i].values
                ph, pk, pp = (mine.field(j).to_numpy(zero_copy_only=False) for j in range(3))
                order = np.argsort(ph)
                ph, pk, pp = ph[order], pk[order], pp[order]
                h = g[places].view(np.int64)
                slot = np.minimum(np.searchsorted(ph, h), len(ph) - 1)
                repeated = ph[slot] == h
                to, to_pos = pk[slot], pp[slot]
                pointing = repeated & ~((to == key) & (to_pos == places))  # else it is the reference itself
                goes_on = pointing[1:] & pointing[:-1] & (to[1:] == to[:-1]) & (to_pos[1:] - to_pos[:-1] == np.diff(places))
                first = np.flatnonzero(pointing & ~np.concatenate([[False], goes_on]))
                last = np.flatnonzero(pointing & ~np.concatenate([goes_on, [False]]))
                a, z = places[first], places[last] + k
                long = z - a >= window
                first, last, a, z = first[long], last[long], a[long], z[long]
                none = np.zeros(len(a), np.int64)
                add(0, key, a, z, none)
                add(0, to[first], to_pos[first], to_pos[first] + z - a, none)
                begin = np.full(len(places), np.iinfo(np.int64).max)
                end = np.full(len(places), -1)
                if len(a):
                    member = np.repeat(np.arange(len(a)), last - first + 1)
                    of = np.concatenate([np.arange(x, y + 1) for x, y in zip(first, last)])
                    begin[of], end[of] = a[member], z[member]
                open_ = repeated[which] & ~((starts >= begin[which]) & (starts + window <= end[which]))
                s = starts[open_]
                add(1, key, s, s + window, grams(w.hash, window)[s].view(np.int64))
                if sum(map(len, out[0])) > 1 << 17:
                    yield record(schema, *(np.concatenate(c) for c in out))
                    for c in out:
                        c.clear()
            yield record(schema, *(np.concatenate(c) if c else [] for c in out))

    return work, "kind byte, key long, start long, stop long, h long"


def _cut(kept: list[tuple[str, str]]):
    """Unpacks the text, cuts the spans' words, counts; a batch out is of about
    BATCH_BYTES unpacked."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def work(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            packed, spans = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            texts, count, removed, merged = [], [], [], []
            lo = size = 0
            for i, (p, mine) in enumerate(zip(packed, spans)):
                data = unpack.decompress(p) if p is not None else b""
                raw = np.frombuffer(data, np.uint8)
                out = []
                if mine:
                    for x in sorted(mine, key=lambda x: x["start"]):
                        if out and x["start"] <= out[-1]["stop"]:
                            out[-1]["stop"] = max(out[-1]["stop"], x["stop"])
                        else:
                            out.append(dict(x))
                    w = words_of(raw, np.array([0, len(raw)]), "plain")
                    parts, at = [], 0
                    for x in out:
                        parts.append(data[at:w.start[x["start"]]])
                        at = int(w.end[x["stop"] - 1])
                    text = b"".join([*parts, data[at:]])
                    count.append(len(w.hash))
                else:
                    text = data
                    count.append(len(data.split()))
                texts.append(None if p is None else text)
                removed.append(sum(x["stop"] - x["start"] for x in out))
                merged.append(out)
                size += len(data)
                if size >= BATCH_BYTES or i + 1 == len(packed):
                    yield pa.RecordBatch.from_arrays([*batch.slice(lo, i + 1 - lo).columns[:-2], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(merged, span)],
                                                     names=[*batch.schema.names[:-2], "text", "n_words", "n_removed", "spans"])
                    texts, count, removed, merged = [], [], [], []
                    lo, size = i + 1, 0

    return work, "".join(f"`{c}` {t}, " for c, t in kept) + "text string, n_words long, n_removed long, spans array<struct<start:long,stop:long>>"


def remove_repeats(docs: DataFrame, doc_id: Column, text: Column, keep: list[str], window: int = WINDOW) -> DataFrame:
    """The columns ``keep`` of docs, then text without the words of windows
    that occur anywhere else, n_words, n_removed and the spans cut."""
    key = F.xxhash64(F.coalesce(doc_id.cast("long"), F.lit(-1)), doc_id.isNull(), fingerprint(text))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c not in ("text", "n_words", "n_removed", "spans")], key.alias("__key"), text.alias("__text"))
    texts = rows.select(F.col("__key").alias("key"), F.col("__text").alias("text")).where("text is not null")

    counted = map_arrow(texts.select("text"), *_counts(window)).groupBy("h").agg(F.sum("n").alias("n"))
    repeated = written(counted.where("n > 1").select("h"), "repeated")
    postings = written(map_arrow(texts, *_postings(window)).join(repeated, "h"), "postings")
    index = written(postings.groupBy("h").agg(F.min(F.struct("key", "pos")).alias("at")).select("h", F.col("at.key").alias("to"), F.col("at.pos").alias("to_pos")), "index")
    pointers = postings.select("h", "key").join(index, "h").groupBy("key").agg(F.collect_list(F.struct("h", "to", "to_pos")).alias("pointers"))

    packed = pack_texts(texts, "text")
    parsed = written(map_arrow(packed.join(pointers, "key").select("key", "packed", "pointers"), *_parse(window)), "parsed")
    open_ = parsed.where("kind = 1")
    equal = written(open_.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "equal")
    spans = parsed.where("kind = 0").select("key", "start", "stop").unionAll(open_.join(equal, "h").select("key", "start", "stop"))
    spans = spans.groupBy("key", "start").agg(F.max("stop").alias("stop"))
    spans = written(spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")

    kept = rows.dtypes[:-1]
    whole = pack_texts(rows, "__text").join(spans.withColumnRenamed("key", "__key"), "__key", "left")
    names = [c for c, _ in kept if c != "__key"]
    return map_arrow(whole.select(*names, "packed", "spans"), *_cut([x for x in kept if x[0] != "__key"]))
