"""Operator 4: benchmark decontamination with an FM-index per training shard.

A shard is an Arrow batch of documents.  Its words become numbers of the
benchmark's vocabulary; stretches of known words that are long enough to hold a
test phrase are concatenated, each ended by a mark of its own, and indexed:
suffix array by prefix doubling, Burrows-Wheeler transform, wavelet matrix with
counts at each level, and sampled suffix positions.  All phrases are searched
backwards at once; occurrences are located by walking to the next sample, and
merged into spans.

A phrase is ``window`` consecutive words of an item; an item of fewer words, but
not none, is one phrase.  The benchmark reaches the tasks in blocks of about
``block_words`` words, one pass each, so what a task holds is bounded however
large the benchmark grows; with one block there is no shuffle at all.

Edge cases: null texts have no words; a null item id is reported as ``null``;
repeated items are searched once and reported by their ids; an empty benchmark
hits nothing; texts of any length are indexed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import fingerprint, map_arrow, text_chunks, written
from tickvault.llm.tokens import grams, words_of

WINDOW, BLOCK_WORDS, SAMPLE = 10, 1 << 20, 16


class FMIndex:
    """Index of a row of symbols: 0 marks the end of a stretch, the last included."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        n = len(symbols)
        marks = symbols == 0
        rank = np.where(marks, np.cumsum(marks) - 1, symbols.astype(np.int64) + marks.sum())  # each mark differs
        step = 1
        while True:
            _, rank = np.unique(rank, return_inverse=True)
            if rank.max(initial=0) == n - 1:
                break
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            rank = rank * np.int64(n + 1) + after
            step *= 2
        suffixes = np.empty(n, np.int64)
        suffixes[rank] = np.arange(n)
        bwt = symbols[suffixes - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])
        begins = np.zeros(n, bool)
        begins[0] = True
        begins[1:] = marks[:-1]
        self.sampled = (suffixes % SAMPLE == 0) | begins[suffixes]
        self.slot = np.cumsum(self.sampled) - 1
        self.position = suffixes[self.sampled]
        self.levels = []  # (shift, zeros before each place, zeros in all)
        row = bwt
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bit = (row >> shift) & 1
            zeros = np.concatenate([[0], np.cumsum(bit == 0)])
            self.levels.append((shift, zeros, int(zeros[-1])))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.origin = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for shift, zeros, count in self.levels:
            z = zeros[place]
            place = np.where((symbol >> shift) & 1, count + place - z, z)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often symbol stands before place in the transform."""
        return self._down(symbol, place) - self.origin[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns, one per line, all of one length."""
        lo = self.first[patterns[:, -1]].copy()
        hi = self.first[patterns[:, -1] + 1].copy()
        for j in range(patterns.shape[1] - 2, -1, -1):
            live = np.flatnonzero(lo < hi)
            c = patterns[live, j]
            lo[live] = self.first[c] + self.rank(c, lo[live])
            hi[live] = self.first[c] + self.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes of rows."""
        out = np.empty(len(rows), np.int64)
        live, at, steps = np.arange(len(rows)), rows, 0
        while len(live):
            done = self.sampled[at]
            out[live[done]] = self.position[self.slot[at[done]]] + steps
            live, at, steps = live[~done], at[~done], steps + 1
            symbol = np.zeros(len(at), np.int64)
            for _, zeros, count in self.levels:  # the symbol before, and where that suffix stands
                bit = zeros[at + 1] == zeros[at]
                at = np.where(bit, count + at - zeros[at], zeros[at])
                symbol = symbol * 2 + bit
            at = self.first[symbol] + at - self.origin[symbol]
        return out


class Phrases:
    """Distinct test phrases of a block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        raw = [t.encode() for _, t in items]
        w = words_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw]), "alnum")
        self.vocabulary, number = np.unique(w.hash, return_inverse=True)
        number = number + 1
        self.by_length = []  # (length, patterns, items of each pattern)
        size = np.diff(w.off)
        for length in sorted(set(np.minimum(size[size > 0], window).tolist())):
            whole = grams(w.hash, length)
            starts, owners = [], []
            for i in np.flatnonzero(np.minimum(size, window) == length):
                starts.append(np.arange(w.off[i], w.off[i + 1] - length + 1))
                owners.append(np.full(len(starts[-1]), i))
            starts, owners = np.concatenate(starts), np.concatenate(owners)
            _, first, which = np.unique(whole[starts], return_index=True, return_inverse=True)
            order = np.argsort(which, kind="stable")
            groups = np.split(owners[order], np.cumsum(np.bincount(which))[:-1])
            self.by_length.append((length, number[starts[first][:, None] + np.arange(length)], groups))
        self.ids = [i for i, _ in items]
        self.shortest = min((n for n, *_ in self.by_length), default=0)


def shard_hits(w, phrases: Phrases) -> tuple[np.ndarray, set[tuple[int, int]]]:
    """Which words are hit, and (text, item) pairs, by an index of these texts."""
    n = len(w.hash)
    hit = np.zeros(n + 1, np.int64)
    pairs: set[tuple[int, int]] = set()
    if not n or not phrases.shortest:
        return hit[:n] > 0, pairs
    at = np.minimum(np.searchsorted(phrases.vocabulary, w.hash), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[at] == w.hash
    owner = w.owner()
    joined = known[1:] & known[:-1] & (owner[1:] == owner[:-1])
    begin = np.flatnonzero(known & ~np.concatenate([[False], joined]))
    end = np.flatnonzero(known & ~np.concatenate([joined, [False]])) + 1
    enough = end - begin >= phrases.shortest
    begin, end = begin[enough], end[enough]
    if not len(begin):
        return hit[:n] > 0, pairs
    size = end - begin + 1  # one more for the mark
    where = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    symbols = np.append(at, 0)[where] + 1
    symbols[np.cumsum(size) - 1] = 0
    index = FMIndex(symbols, len(phrases.vocabulary) + 1)
    for length, patterns, groups in phrases.by_length:
        lo, hi = index.search(patterns)
        found = np.flatnonzero(lo < hi)
        if not len(found):
            continue
        count = (hi - lo)[found]
        which = np.repeat(found, count)
        rows = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        place = where[index.locate(rows)]
        np.add.at(hit, place, 1)
        np.add.at(hit, place + length, -1)
        for text, p in set(zip(owner[place].tolist(), which.tolist())):
            pairs.update((text, int(i)) for i in groups[p])
    return np.cumsum(hit)[:n] > 0, pairs


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
RESULT = "n_words long, spans array<struct<start:long,stop:long>>, items array<string>"


def mask_spans(mask: np.ndarray, off: np.ndarray) -> list[list[dict]]:
    """Runs of true words of each text, words counted from the text's start."""
    padded = np.concatenate([[False], mask, [False]])
    cut = np.zeros(len(padded) + 1, bool)
    cut[off[1:-1] + 1] = True
    begin = np.flatnonzero(padded[1:-1] & (~padded[:-2] | cut[1:len(padded) - 1]))
    end = np.flatnonzero(padded[1:-1] & (~padded[2:] | cut[2:len(padded)])) + 1
    out: list[list[dict]] = [[] for _ in range(len(off) - 1)]
    for d, a, b in zip((np.searchsorted(off, begin, "right") - 1).tolist(), begin.tolist(), end.tolist()):
        out[d].append({"start": a - int(off[d]), "stop": b - int(off[d])})
    return out


def block_hits(rows: DataFrame, phrases: Phrases) -> DataFrame:
    """rows end with __text; the other columns, then n_words, spans and items."""

    def work(batches):
        for batch in batches:
            count, spans, items = np.zeros(batch.num_rows, np.int64), [], [set() for _ in range(batch.num_rows)]
            for lo, hi, raw, offsets in text_chunks(batch, "__text", 8 << 20):
                w = words_of(raw, offsets, "alnum")
                mask, pairs = shard_hits(w, phrases)
                count[lo:hi] = np.diff(w.off)
                spans += mask_spans(mask, w.off)
                for d, i in pairs:
                    items[lo + d].add(phrases.ids[i])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count), pa.array(spans, SPANS), pa.array([sorted(s) for s in items], pa.list_(pa.string()))],
                                             names=[*batch.schema.names[:-1], "n_words", "spans", "items"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return map_arrow(rows, work, kept + RESULT)


#: A word before A-Z are lower-cased.
ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def find_contamination(docs: DataFrame, text: Column, keep: list[str], benchmark: DataFrame, item_id: Column, item_text: Column,
                       window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns ``keep`` of docs, then n_words; spans, the hit words as
    (start, stop); items, the ids of items with an occurring phrase, sorted."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c not in ("n_words", "spans", "items")], text.alias("__text"))
    tests = benchmark.select(F.coalesce(item_id.cast("string"), F.lit("null")).alias("id"), F.coalesce(item_text, F.lit("")).alias("text"))
    size = F.regexp_count("text", F.lit(ANY_CASE))
    blocks = max(1, -(-int(tests.select(F.sum(size)).first()[0] or 0) // block_words))
    cut = tests.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))

    def hits(block: int, of: DataFrame) -> DataFrame:
        return block_hits(of, Phrases([(r["id"], r["text"]) for r in cut.where(F.col("block") == block).select("id", "text").collect()], window))

    if blocks == 1:
        return hits(0, rows)
    # each pass tells only what it hits; passes meet by the columns kept and the text's fingerprint
    keys = rows.columns[:-1] + ["__print"]
    marked = rows.select(*rows.columns[:-1], fingerprint(F.col("__text")).alias("__print"), "__text")
    parts = [hits(b, marked) for b in range(blocks)]
    some = parts[0].where("size(spans) > 0")
    for p in parts[1:]:
        some = some.unionAll(p.where("size(spans) > 0"))
    met = written(some.groupBy(*keys).agg(F.flatten(F.collect_set("spans")).alias("__spans"), F.flatten(F.collect_set("items")).alias("__items")), "contaminated")
    left = marked.withColumn("__words", F.regexp_count(F.coalesce("__text", F.lit("")), F.lit(ANY_CASE)).cast("long")).drop("__text")
    same = [left[k].eqNullSafe(met[k]) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    both = left.join(met, condition, "left").select(*[left[k] for k in keys[:-1]], left["__words"].alias("n_words"),
                                                    F.coalesce("__spans", F.array().cast("array<struct<start:long,stop:long>>")).alias("__spans"),
                                                    F.array_sort(F.array_distinct(F.coalesce("__items", F.array().cast("array<string>")))).alias("items"))
    start = F.struct(F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("stop"))
    empty = F.struct(F.array().cast("array<struct<start:long,stop:long>>").alias("done"), start.alias("open"))

    def merge(state, span):
        o = state["open"]
        extend = o["start"].isNotNull() & (span["start"] <= o["stop"])
        grown = F.struct(o["start"].alias("start"), F.greatest(o["stop"], span["stop"]).alias("stop"))
        shut = F.when(extend | o["start"].isNull(), state["done"]).otherwise(F.concat(state["done"], F.array(o)))
        return F.struct(shut.alias("done"), F.when(extend, grown).otherwise(span).alias("open"))

    merged = F.aggregate(F.array_sort("__spans"), empty, merge, lambda s: F.when(s["open"]["start"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))))
    return both.select(*keys[:-1], "n_words", merged.alias("spans"), "items")


def cut_spans(docs: DataFrame, kind: str = "alnum") -> DataFrame:
    """docs (columns text and spans among them) with the spans' words, and what
    stands between the words of a span, cut from text; spans is dropped."""
    names = [c for c in docs.columns if c != "spans"]
    rows = docs.select(*names, "spans")

    def work(batches):
        for batch in batches:
            out = []
            spans = batch.column(batch.num_columns - 1).to_pylist()
            for lo, hi, raw, offsets in text_chunks(batch, "text"):
                w = None
                for d in range(lo, hi):
                    data = raw[offsets[d - lo]:offsets[d - lo + 1]].tobytes()
                    if spans[d]:
                        w = w or words_of(raw, offsets, kind)
                        base, first = int(offsets[d - lo]), int(w.off[d - lo])
                        parts, at = [], 0
                        for s in spans[d]:
                            parts.append(data[at:int(w.start[first + s["start"]]) - base])
                            at = int(w.end[first + s["stop"] - 1]) - base
                        data = b"".join([*parts, data[at:]])
                    out.append(data)
            column = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([column if c == "text" else batch.column(i) for i, c in enumerate(names)], names=names)

    return map_arrow(rows, work, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1]))
