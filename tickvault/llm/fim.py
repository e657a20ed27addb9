"""Operator 13: fill-in-middle transformation by content-defined chunks.

A text is cut into units (runs of ASCII letters, or single other characters),
and two drawn unit counts make it prefix, middle and suffix, which are put
together in another order between marks.

Unit counts come from chunks.  A rolling hash over the last bytes cuts a text
where the hash is 0 in its low bits, so texts that share a passage share the
chunks inside it.  A chunk is summarised once: its units, its characters and
whether it begins and ends with a letter; a later chunk takes the summary of an
earlier one only if all its bytes are equal.  Two neighbouring chunks have the
sum of their units, less one if a run of letters goes on across their border.
Running sums of these counts say in which chunk a cut lies, and only that
chunk is looked at for its place.

Scale: one pass without a shuffle; a task holds one Arrow batch, and summaries
of at most ``CACHE_BYTES`` of chunks (they are then begun anew, which changes
no result).

Edge cases: null and empty texts have no units and stay plain, as do texts that
contain a mark; a null id is drawn from the word ``null``; repeated rows get the
same cuts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import map_arrow, record
from tickvault.llm.tokens import powers

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of a hundred texts so many are cut; of a hundred cut texts so many begin with the suffix.
CUT, SUFFIX_FIRST, SEED = 90, 20, "1"
#: Bytes that the rolling hash sees; its low bits are 0 at about one place in 2**CHUNK_BITS; least and most bytes of a chunk.
WINDOW, CHUNK_BITS, LEAST, MOST = 48, 11, 256, 1 << 16
CACHE_BYTES = 1 << 25
SLAB = 1 << 20
_VALUES = np.random.default_rng(20240613).integers(0, 1 << 64, 256, dtype=np.uint64)


def _letters(raw: np.ndarray) -> np.ndarray:
    low = raw | 0x20
    return (low >= 97) & (low <= 122)


def chunk_ends(raw: np.ndarray) -> np.ndarray:
    """Where the chunks of a text end (the last at its end)."""
    found = []
    for lo in range(0, len(raw), SLAB):  # a slab and the window before it
        a = max(0, lo - WINDOW)
        part = raw[a:lo + SLAB]
        if len(part) < WINDOW:
            continue
        up, down = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUES[part] * up[:-1], out=total[1:])
        rolling = (total[WINDOW:] - total[:-WINDOW]) * down[:len(part) - WINDOW + 1]
        found.append(np.flatnonzero((rolling >> np.uint64(64 - CHUNK_BITS)) == 0) + a + WINDOW)
    ends, last = [], 0
    for e in np.concatenate(found).tolist() if found else []:
        if e - last < LEAST:
            continue
        while e - last > MOST:
            last += MOST
            ends.append(last)
        if e - last >= LEAST:
            ends.append(e)
            last = e
    while len(raw) - last > MOST:
        last += MOST
        ends.append(last)
    if not ends or ends[-1] < len(raw):
        ends.append(len(raw))
    return np.array(ends)


def unit_starts(raw: np.ndarray) -> np.ndarray:
    """Places where a unit of these bytes begins."""
    letter = _letters(raw)
    starts = (raw & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts)


class Chunks:
    """Summaries of chunks by their bytes."""

    def __init__(self):
        self.seen: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.held = 0

    def summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        """Units, characters, begins with a letter, ends with one."""
        s = self.seen.get(chunk)
        if s is None:
            raw = np.frombuffer(chunk, np.uint8)
            ends = _letters(raw[[0, -1]])
            s = len(unit_starts(raw)), int(((raw & 0xC0) != 0x80).sum()), bool(ends[0]), bool(ends[1])
            self.held += len(chunk)
            if self.held > CACHE_BYTES:
                self.seen.clear()
                self.held = len(chunk)
            self.seen[chunk] = s
        return s

    def units(self, text: bytes) -> "Units":
        return Units(text, self)


class Units:
    """Units of one text: their number, and where a count of them ends."""

    def __init__(self, text: bytes, chunks: Chunks):
        self.raw = np.frombuffer(text, np.uint8)
        ends = chunk_ends(self.raw) if len(text) else np.zeros(0, np.int64)
        self.cuts = np.concatenate([[0], ends]).astype(np.int64)
        parts = [chunks.summary(text[a:b]) for a, b in zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist())]
        units, chars, begins, stops = (np.array(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4
        #: does a chunk begin inside a unit of the one before?
        self.goes_on = np.concatenate([[False], begins[1:].astype(bool) & stops[:-1].astype(bool)])[:len(units)]
        self.units = np.concatenate([[0], np.cumsum(units - self.goes_on)]).astype(np.int64)
        self.chars = np.concatenate([[0], np.cumsum(chars)]).astype(np.int64)
        self.n = int(self.units[-1])

    def after(self, count: int) -> tuple[int, int]:
        """Bytes and characters of the first count units."""
        if count >= self.n:
            return len(self.raw), int(self.chars[-1])
        k = int(np.searchsorted(self.units, count, "right")) - 1  # the chunk in which unit number count begins
        a, b = int(self.cuts[k]), int(self.cuts[k + 1])
        chunk = self.raw[a:b]
        at = int(unit_starts(chunk)[count - int(self.units[k]) + int(self.goes_on[k])])
        return a + at, int(self.chars[k]) + int(((chunk[:at] & 0xC0) != 0x80).sum())


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """Four 32-bit numbers of an id."""
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(h[i:i + 4], "big") for i in (0, 4, 8, 12)]


def _transform(cut: int, suffix_first: int, seed: str):
    schema = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def work(batches):
        chunks = Chunks()
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
                text = value.as_py() or b""
                units = chunks.units(text)
                h1, h2, h3, h4 = draws(doc_id.as_py(), seed)
                if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= cut:
                    rows.append((units.n, "plain", None, None, text))
                    continue
                one, two = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
                (a, a_chars), (b, b_chars) = units.after(one), units.after(two)
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                if h4 % 100 < suffix_first:
                    form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
                else:
                    form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
                rows.append((units.n, form, a_chars, b_chars - a_chars, b"".join(parts)))
            n, form, before, inside, output = zip(*rows) if rows else ((),) * 5
            new = record(schema, n, form, before, inside, pa.array(output, pa.large_binary()).cast(pa.large_string()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *new.columns], names=[*batch.schema.names[2:], *schema.names])

    return work


def fill_in_middle(docs: DataFrame, doc_id: Column, text: Column, keep: list[str], cut: int = CUT, suffix_first: int = SUFFIX_FIRST, seed: str = SEED) -> DataFrame:
    """The columns keep of docs, n (units), form (plain, psm or spm),
    prefix_chars, middle_chars (null if plain) and output (the new text).  Keep
    must not have names of the new columns."""
    rows = docs.select(doc_id.cast("long").alias("__id"), text.alias("__text"), *keep)
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return map_arrow(rows, _transform(cut, suffix_first, seed), f"{schema}n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that a new text and its form were made from: no part contains a
    mark, so the marks part them."""
    parts = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
