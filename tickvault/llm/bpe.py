"""Operator 12: byte-level BPE encoding and decoding by prefix dynamic programming.

A text is split by a pattern, and each match is encoded by itself.  The tokens
of a byte string under BPE are its only split in which every token is what
merging makes of its own bytes, and every two neighbours are what merging makes
of theirs together.  So each prefix of a match has exactly one valid last
token: a token that ends there and fits after the last token of the prefix
before it.  ``Prefixes`` stores these last tokens; reading them from the end gives the
encoding.  Appended bytes leave them as they are, and after an edit only the
entries near it are computed again, until as many in a row agree with the old
ones as the longest token has bytes.

Scale: one pass without a shuffle; the vocabulary (of fixed size) is read on the
driver and broadcast.  Texts are split some at a time; matches that are new are
sorted and encoded one after the other, each from the prefix that it shares with
the one before.  A worker keeps the encodings of about ``MEMO`` short matches and
``PAIRS`` pairs of tokens, also for its next tasks; when full they are begun anew,
which changes no result.  Long texts are split at borders where a match always ends.

Edge cases: null and empty texts have no tokens; a match that is a token as a
whole is that token; token ids that the vocabulary lacks are an error; repeated
rows and an empty table need no care.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickvault.llm.common import map_arrow, text_chunks

#: Matches (of at most MEMO_BYTES characters) and pairs of tokens that a worker remembers; characters that are split at a time.
MEMO, MEMO_BYTES, PAIRS, SPLIT_CHARS = 1 << 19, 64, 1 << 20, 1 << 21
#: Tokens are looked up by so many last bytes first; what stands for the last token of no bytes.
TAIL, START = 3, (1 << 32) - 1
IDS = np.dtype("<u4")


class Vocabulary:
    """Ranks of byte strings (in a rank file's lines: base64, rank), and the pattern that splits texts."""

    def __init__(self, lines: bytes, pattern: str):
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}
        self.token = {r: t for t, r in self.rank.items()}
        self.packed = {r: r.to_bytes(IDS.itemsize, "little") for r in self.token}
        self.longest = max(map(len, self.rank), default=0)
        self.pattern = regex.compile(pattern)
        self.border = regex.compile(r"(?<=\S)\s")
        self.longer: dict[bytes, set[int]] = {}  # lengths of tokens by their last bytes
        for t in self.rank:
            self.longer.setdefault(t[-TAIL:], set()).add(len(t))
        self.ways: dict[bytes, tuple[int, ...]] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.edges: dict[tuple[int, int], list[tuple[bytes, float]]] = {}
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}

    def merged(self, piece: bytes, least: int = 1) -> list[int]:
        """What BPE makes of a short byte string by its definition: of all
        neighbours the pair of lowest rank is merged, the first of equals, as
        long as there are more parts than least."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > least:
            lowest = min(((self.rank[p + q], i) for i, (p, q) in enumerate(zip(parts, parts[1:])) if p + q in self.rank), default=None)
            if lowest is None:
                break
            i = lowest[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merge into a token; of a byte, or of a token that
        merging never makes, none."""
        if token not in self.split:
            parts = self.merged(self.token[token], 2)
            self.split[token] = tuple(parts) if len(parts) == 2 else None
        return self.split[token]

    def edge(self, token: int, side: int) -> list[tuple[bytes, float]]:
        """The parts of a token that lie at its left (0) or right (1) end one
        after the other while it is made, the token itself first, each with the
        rank of the merge that ends it."""
        out = self.edges.get((token, side))
        if out is None:
            out, until, part = [], float("inf"), token
            while part is not None:
                out.append((self.token[part], until))
                parts = self.halves(part)
                until, part = part, parts and parts[side]
            self.edges[token, side] = out
        return out

    def ways_of(self, tail: bytes) -> tuple[int, ...]:
        """Lengths, longest first, of the tokens that end in these last bytes of
        a prefix, or are an end of them."""
        shorter = {n for n in range(1, len(tail)) if tail[-n:] in self.rank}
        self.ways[tail] = tuple(sorted(self.longer.get(tail, set()) | shorter, reverse=True))
        return self.ways[tail]

    def fits(self, before: int, token: int) -> bool:
        """May token follow before (START: begin a match)?  Not if merging never
        makes it, or if a part at the right end of the one and a part at the left
        end of the other merge while both are there; of equal merges the left
        one is first."""
        pair = before << 32 | token
        if pair not in self.pairs:
            known = len(self.token[token]) == 1 or self.halves(token) is not None
            if known and before != START:
                right = self.edge(token, 0)
                for x, x_until in self.edge(before, 1):
                    for y, y_until in right:
                        if (merge := self.rank.get(x + y)) is not None and merge < x_until and merge <= y_until:
                            known = False
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[pair] = known
        return self.pairs[pair]

    def learn(self, pieces: set[str]) -> None:
        """Encode matches that are not known: in order, so that one takes over
        the prefix that it shares with the one before."""
        prefixes, packed, rank = Prefixes(self), self.packed, self.rank
        for piece in sorted(x.encode() for x in pieces):
            whole = rank.get(piece)
            if whole is None:
                prefixes.become(piece)
                ids = b"".join([packed[t] for t in prefixes.tokens()])
            else:
                ids = packed[whole]
            self.memo[piece.decode()] = ids

    def parts(self, text: str):
        """A long text in parts that end where a match always ends: after a
        character that is not white space, before one that is."""
        lo = 0
        while len(text) - lo > SPLIT_CHARS:
            cut = self.border.search(text, lo + SPLIT_CHARS)
            if cut is None:
                break
            yield text[lo:cut.start()]
            lo = cut.start()
        yield text[lo:] if lo else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of texts, four bytes each."""
        out, known = [], self.memo.__getitem__
        for split in self.runs(texts):
            if len(self.memo) >= MEMO:
                self.memo.clear()
            new = set().union(*(pieces for _, pieces in split)).difference(self.memo)
            self.learn(new)
            for text, pieces in split:
                ids = b"".join(map(known, pieces))
                if text == len(out):
                    out.append([])
                out[text].append(ids)
            for piece in new:
                if len(piece) > MEMO_BYTES:
                    del self.memo[piece]
        return [b"".join(x) for x in out]

    def runs(self, texts: list[str]):
        """The matches in texts, by part: lists of (number of the text, matches)
        of about SPLIT_CHARS characters or one part."""
        run, size = [], 0
        for k, text in enumerate(texts):
            for part in self.parts(text):
                run.append((k, self.pattern.findall(part)))
                size += len(part)
                if size >= SPLIT_CHARS:
                    yield run
                    run, size = [], 0
        if run:
            yield run

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, IDS).tolist()))

    def reencode(self, text: str, ids: bytes, start: int, stop: int, new: str) -> bytes:
        """The ids of the text whose characters from start to stop are replaced
        by new: only what lies between the last border before the edit and the
        first after it is encoded again."""
        lo = max((m.start() for m in self.border.finditer(text, max(0, start - SPLIT_CHARS), start)), default=0)
        after = self.border.search(text, min(stop + 1, len(text)))
        hi = after.start() if after and after.start() > stop else len(text)
        ends = np.cumsum([0, *(len(self.token[t]) for t in np.frombuffer(ids, IDS).tolist())])
        a = len(text[:lo].encode())
        b = a + len(text[lo:hi].encode())
        first, last = np.searchsorted(ends, [a, b]) * IDS.itemsize
        return ids[:first] + self.encode([text[lo:start] + new + text[stop:hi]])[0] + ids[last:]


class Prefixes:
    """The last token of every prefix of one match."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def _fill(self, old: list[int] | None = None, edited: int = 0, moved: int = 0) -> int:
        """Find the last tokens that are missing, and say how many.  With old
        entries, which from place edited on are the same moved by so many
        places, end when as many in a row agree as the longest token has bytes."""
        vocabulary, piece, last = self.vocabulary, self.piece, self.last
        rank, pairs, ways = vocabulary.rank, vocabulary.pairs, vocabulary.ways
        first, same = len(last) + 1, 0
        for end in range(first, len(piece) + 1):
            tail = piece[end - TAIL:end] if end > TAIL else piece[:end]
            for n in ways.get(tail) or vocabulary.ways_of(tail):
                if n <= end and (token := rank.get(piece[end - n:end])) is not None:
                    pair = (last[end - n - 1] if n < end else START) << 32 | token
                    known = pairs.get(pair)
                    if vocabulary.fits(pair >> 32, token) if known is None else known:
                        last.append(token)
                        break
            else:
                raise ValueError(f"no token ends at byte {end}")
            if old is not None:
                # an entry hangs on the bytes and entries of one longest token before it
                same = same + 1 if end > edited and last[-1] == old[end - 1 - moved] else 0
                if same == vocabulary.longest:
                    break
        return len(last) + 1 - first

    def append(self, more: bytes) -> None:
        self.piece += more
        self._fill()

    def become(self, piece: bytes) -> None:
        """Take another match: entries of the prefix that both share stay."""
        shared = 0
        for x, y in zip(self.piece, piece):
            if x != y:
                break
            shared += 1
        del self.last[shared:]
        self.piece = piece
        self._fill()

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replace bytes; returns how many entries were computed."""
        old, moved = self.last, len(new) - (stop - start)
        self.piece = self.piece[:start] + new + self.piece[stop:]
        self.last = old[:start]
        done = self._fill(old, start + len(new), moved)
        self.last.extend(old[len(self.last) - moved:])
        return done

    def tokens(self) -> list[int]:
        out, at = [], len(self.last)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.token[out[-1]])
        return out[::-1]


def _mapped(docs: DataFrame, value: Column, keep: list[str], ranks: str, pattern: str, kind: str, made, more: list[Column] = ()) -> DataFrame:
    """keep and the column ``kind``: made(vocabulary, bytes of the values, further values) of some rows."""
    with open(ranks, "rb") as f:  # of the vocabulary's size
        shared = docs.sparkSession.sparkContext.broadcast({"lines": f.read()})
    column, n = kind.split(" ")[0], 1 + len(more)

    def work(batches):
        own = shared.value  # a worker keeps its vocabulary for its next task
        if "vocabulary" not in own:
            own["vocabulary"] = Vocabulary(own["lines"], pattern)
        for batch in batches:
            for lo, hi, raw, offsets in text_chunks(batch, "__value", 2 * SPLIT_CHARS):
                further = [batch.column(k).slice(lo, hi - lo).to_pylist() for k in range(1, n)]
                out = made(own["vocabulary"], [raw[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], *further)
                kept = [c.slice(lo, hi - lo) for c in batch.columns[n:]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.binary())], names=[*batch.schema.names[n:], column])

    rows = docs.select(value.cast("binary").alias("__value"), *(c.alias(f"__{k}") for k, c in enumerate(more)), *keep)
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return map_arrow(rows, work, schema + kind)


def encode(docs: DataFrame, text: Column, keep: list[str], ranks: str, pattern: str) -> DataFrame:
    """The columns keep of docs, and ids (four bytes each, little end first).
    Keep must not have the name ``ids``."""
    return _mapped(docs, text, keep, ranks, pattern, "ids binary", lambda v, texts: v.encode([t.decode("utf-8", "replace") for t in texts]))


def decode(docs: DataFrame, ids: Column, keep: list[str], ranks: str, pattern: str) -> DataFrame:
    """The columns keep of docs, and decoded (the bytes of the ids)."""
    return _mapped(docs, ids, keep, ranks, pattern, "decoded binary", lambda v, all_ids: [v.decode(ids) for ids in all_ids])


def reencode(docs: DataFrame, text: Column, ids: Column, start: Column, stop: Column, new: Column, keep: list[str], ranks: str, pattern: str) -> DataFrame:
    """The columns keep of docs, and ids of the texts whose characters from
    start to stop are replaced by new, made from the ids of the old texts."""
    return _mapped(docs, text, keep, ranks, pattern, "ids binary",
                   lambda v, texts, *rest: [v.reencode(t.decode("utf-8", "replace"), *r) for t, *r in zip(texts, *rest)],
                   [F.coalesce(ids, F.lit(b"")), start, stop, F.coalesce(new, F.lit(""))])
