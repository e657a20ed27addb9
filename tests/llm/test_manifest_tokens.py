"""Merkle manifest, byte-level BPE and fill-in-middle against plain versions
and on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tickvault.llm import bpe, fim, queries
from tickvault.llm.merkle import folded, manifest, proof_digest, row_digest

CHECK, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def sha(s):
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


@pytest.fixture(scope="module")
def vocabulary():
    with open(RANKS, "rb") as f:
        return bpe.Vocabulary(f.read(), PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.rank, special_tokens={})


def awkward():
    rng = random.Random(3)
    texts = [None, "", " ", "a", "A b", "it's  we'll 'x ''", "\n\n\t word\r\n", "Ünïcödé 你好世界 😀😀 ​", "ab<P>cd", "x" * 300, " " * 400 + "end", "12345 678",
             "".join(rng.choice("aA é1\n<>PSM你") for _ in range(3000)), " ".join(rng.choice(["lorem", "Ipsum", "dolor,"]) for _ in range(60000)),
             "".join(rng.choice("abcdefgh") for _ in range(9000))]
    rows = [(i * 7, t, [None, "en", "é", "de"][i % 4], None if i % 3 else f"s{i}", i if i % 5 else None) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, "None Id", "en", "s", 3), (None, None, None, None, None)]


# --- Merkle manifest -------------------------------------------------------

def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_manifest(rows, fanout=8):
    """doc rows -> sorted (doc_id, leaf, subroot, root, proof, folded root)."""
    def leaf(r, text):
        doc_id, _, lang, source, n = r
        return sha("".join(map(field, (doc_id, source, lang, n, text))))

    def tree(digests):
        """All levels of a tree."""
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            run = i // fanout * fanout
            out.append((level[run:i], level[i + 1:run + fanout]))
            i //= fanout
        return out

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for g in langs}
    trees = {g: tree([leaf(r, r[1]) for r in groups[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            steps = path(trees[g], i) + path(top, k)
            d = leaf(r, text)
            for before, after in steps:
                d = sha("".join(before) + d + "".join(after))
            proof = sha("".join(x for before, after in steps for x in before + after))
            out.append((r[0], leaf(r, r[1]), trees[g][-1][0], top[-1][0], proof, d))
    return sorted(out, key=str)


def spark_manifest(spark, rows, fanout=8):
    d = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS + ", tree long, leaf2 long, row long")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bad = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, row_digest(*fields, lower))
    out = manifest(d, F.col("lang"), F.col("doc_id"), row_digest(*fields, F.col("text")), ["doc_id", bad.alias("bad"), "tree", "row"], fanout)
    assert out.columns == ["doc_id", "bad", "tree", "row", "leaf", "subroot", "root", "path"]
    out = out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof"), folded(F.col("path"), F.coalesce("bad", "leaf")).alias("folded"))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_manifest_awkward(spark):
    assert spark_manifest(spark, awkward()) == plain_manifest(awkward())


@pytest.mark.parametrize("fanout", [2, 8])
def test_manifest_levels(spark, fanout):
    """A hot group, groups of one, eight, nine and 65 rows, more groups than a run has."""
    rng = random.Random(fanout)
    sizes = {None: 1, "a": 8, "b": 9, "é": 65, "hot": 700, "z": 64} | {f"l{i}": 1 + i % 2 for i in range(70)}
    rows = [(rng.randrange(1 << 40) if rng.random() < 0.99 else 7, f"Text {rng.random()}", g, None, 1) for g, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    assert spark_manifest(spark, rows, fanout) == plain_manifest(rows, fanout)


def test_manifest_empty(spark):
    assert spark_manifest(spark, []) == []


def test_manifest_finds_tampering(spark):
    out = queries.queries()["op11_merkle_manifest"](spark, SMALL).toPandas()
    assert out.root.nunique() == 1 and 0 < (~out.verified).sum() < len(out) / 2
    assert out[out.verified].folded_root.nunique() == 1


# --- byte-level BPE --------------------------------------------------------

def texts_of(rng, n):
    for _ in range(n):
        yield "".join(rng.choice(["a", "th", "ing", " ", "  ", "\n", "é", "你", "😀", "1", "99", "'s", "'ll", "!", "...", "ABC", " ", "　"]) for _ in range(rng.randrange(60)))


def test_pieces_are_as_merged(vocabulary):
    """The last tokens of prefixes against merging by definition."""
    rng = random.Random(1)
    common = [t for t in vocabulary.rank if len(t) < 8]
    for _ in range(400):
        piece = b"".join(rng.choice(common) for _ in range(rng.randrange(1, 7)))
        p = bpe.Prefixes(vocabulary, piece)
        assert p.tokens() == vocabulary.merged(piece)
        for i in range(1, len(piece)):
            assert p.last[i - 1] == vocabulary.merged(piece[:i])[-1]


def test_pairs_are_as_merged(vocabulary):
    """Which tokens fit after which, against merging both by definition."""
    rng = random.Random(10)
    short = [r for t, r in vocabulary.rank.items() if len(t) < 7]
    for _ in range(6000):
        a, b = rng.choice(short), rng.choice(short)
        if rng.random() < 0.3:  # tokens of one letter or blank, of which merges overlap
            a, b = (rng.choice([vocabulary.rank[c * n] for c in (b" ", b"a", b"-") for n in range(1, 9) if c * n in vocabulary.rank]) for _ in "ab")
        both = vocabulary.merged(vocabulary.token[a] + vocabulary.token[b])
        assert vocabulary.fits(a, b) == (both == [a, b]), (vocabulary.token[a], vocabulary.token[b])
    for t in rng.sample(short, 500):
        assert vocabulary.fits(bpe.START, t) == (vocabulary.merged(vocabulary.token[t]) == [t])


def test_appends_and_edits_of_a_piece(vocabulary):
    rng = random.Random(2)
    for _ in range(60):
        p = bpe.Prefixes(vocabulary)
        piece = b""
        for _ in range(6):
            more = bytes(rng.choice(b"abcdeinrst") for _ in range(rng.randrange(30)))
            p.append(more)
            piece += more
            assert p.tokens() == vocabulary.merged(piece)
        for _ in range(6):
            a, b = sorted(rng.randrange(len(piece) + 1) for _ in range(2))
            new = bytes(rng.choice(b"abcdeinrst") for _ in range(rng.randrange(9)))
            p.replace(a, b, new)
            piece = piece[:a] + new + piece[b:]
            assert p.piece == piece and p.tokens() == vocabulary.merged(piece)


def test_an_edit_costs_little(vocabulary):
    rng = random.Random(4)
    p = bpe.Prefixes(vocabulary, bytes(rng.choice(b"abcdeinrst") for _ in range(20000)))
    done = p.replace(9000, 9003, b"xyz")
    assert done < 3 * vocabulary.longest
    assert p.last == bpe.Prefixes(vocabulary, p.piece).last


def test_texts_are_as_in_the_library(vocabulary, library):
    rng = random.Random(5)
    for t in [*texts_of(rng, 1500), *(r[1] or "" for r in awkward())]:
        ids = vocabulary.encode([t])[0]
        assert np.frombuffer(ids, bpe.IDS).tolist() == library.encode_ordinary(t)
        assert vocabulary.decode(ids) == t.encode()


def test_long_texts_are_cut_where_matches_end(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "SPLIT_CHARS", 7)
    for t in texts_of(random.Random(6), 1500):
        assert np.frombuffer(vocabulary.encode([t])[0], bpe.IDS).tolist() == library.encode_ordinary(t)


def test_many_texts_at_once(vocabulary, library):
    some = [*texts_of(random.Random(11), 3000), *(r[1] or "" for r in awkward())]
    assert [np.frombuffer(ids, bpe.IDS).tolist() for ids in vocabulary.encode(some)] == library.encode_ordinary_batch(some)
    assert vocabulary.encode([]) == []


def test_full_memories_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    monkeypatch.setattr(bpe, "PAIRS", 3)
    for t in texts_of(random.Random(7), 100):
        assert np.frombuffer(vocabulary.encode([t])[0], bpe.IDS).tolist() == library.encode_ordinary(t)


def test_reencode(spark, vocabulary, library):
    rng = random.Random(8)
    rows = []
    for i, t in enumerate(texts_of(rng, 800)):
        a, b = sorted(rng.randrange(len(t) + 1) for _ in range(2))
        rows.append((i, t, a, b, next(texts_of(rng, 1))[:5]))
    for _, t, a, b, new in rows:
        assert vocabulary.reencode(t, vocabulary.encode([t])[0], a, b, new) == vocabulary.encode([t[:a] + new + t[b:]])[0]
    d = spark.createDataFrame(rows[:100], "doc_id long, text string, a long, b long, new string")
    ids = bpe.encode(d, F.col("text"), ["doc_id", "text", "a", "b", "new"], RANKS, PATTERN)
    out = bpe.reencode(ids, F.col("text"), F.col("ids"), F.col("a"), F.col("b"), F.col("new"), ["doc_id"], RANKS, PATTERN)
    for r in out.collect():
        _, t, a, b, new = rows[r.doc_id]
        assert np.frombuffer(r.ids, bpe.IDS).tolist() == library.encode_ordinary(t[:a] + new + t[b:])


def test_bpe_on_spark(spark, library):
    d = spark.createDataFrame([(*r, 5) for r in awkward()], DOCS + ", decoded long")
    out = bpe.encode(d, F.col("text"), ["doc_id", "decoded"], RANKS, PATTERN)
    assert sorted((r.ids for r in out.collect())) == sorted(np.array(library.encode_ordinary(r[1] or ""), bpe.IDS).tobytes() for r in awkward())
    back = bpe.decode(out.drop("decoded"), F.col("ids"), ["doc_id"], RANKS, PATTERN)
    assert sorted(r.decoded for r in back.collect()) == sorted((r[1] or "").encode() for r in awkward())
    assert bpe.encode(d.where("false"), F.col("text"), ["doc_id"], RANKS, PATTERN).count() == 0


def test_bpe_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{CHECK}/documents.parquet").select("doc_id", "text").collect()}
    out = queries.queries()["op12_byte_bpe"](spark, CHECK).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = np.array(library.encode_ordinary(docs[r.doc_id]), bpe.IDS)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(ids.tobytes()), sha(docs[r.doc_id]))


# --- fill-in-middle --------------------------------------------------------

def plain_fim(doc_id, text, cut=90, first=20, seed="1"):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = sha(f"{seed}:{'null' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= cut:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    return (len(units), *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < first else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")))


@pytest.mark.parametrize("bits, least, most", [(11, 256, 1 << 16), (2, 1, 60)])
def test_units(monkeypatch, bits, least, most):
    """Counts and places of units from chunks, also of a few bytes each."""
    for k, v in (("CHUNK_BITS", bits), ("LEAST", least), ("MOST", most), ("SLAB", 100 if least == 1 else 1 << 20), ("CACHE_BYTES", 5000)):
        monkeypatch.setattr(fim, k, v)
    rng = random.Random(bits)
    chunks = fim.Chunks()
    for _, t, *_ in awkward():
        raw = (t or "").encode()
        found = re.findall("[A-Za-z]+|[^A-Za-z]", t or "")
        u = chunks.units(raw)
        assert u.n == len(found) and u.cuts[-1] == len(raw) and (np.diff(u.cuts) > 0).all()
        for count in {0, 1, len(found) - 1, len(found), *(rng.randrange(len(found) + 1) for _ in range(200))} - {-1}:
            part = "".join(found[:count])
            assert u.after(count) == (len(part.encode()), len(part))


def test_chunks_are_shared():
    """A passage of two texts has the same chunks, but for those at its ends."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh ") for _ in range(9))
    passage, one, two = (" ".join(word() for _ in range(n)) for n in (6000, 500, 800))
    chunks, sizes = fim.Chunks(), []
    for t in (one + passage, two + passage):
        chunks.units(t.encode())
        sizes.append(len(chunks.seen))
    assert sizes[1] - sizes[0] < 10 + len(fim.chunk_ends(np.frombuffer(two.encode(), np.uint8))) and sizes[0] > 20


def test_fim_on_spark(spark):
    rows = awkward() + [(i, f"Some text {i}, längere Wörter 你好 {i}", None, None, None) for i in range(1000, 1300)]
    d = spark.createDataFrame([(*r, 5) for r in rows], DOCS + ", units long")
    out = fim.fill_in_middle(d, F.col("doc_id"), F.col("text"), ["doc_id", "lang", "units"]).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out), key=str)
    assert got == sorted(((r[0], *plain_fim(r[0], r[1])) for r in rows), key=str)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in out) == sorted(r[1] or "" for r in rows)
    assert fim.fill_in_middle(d.where("false"), F.col("doc_id"), F.col("text"), ["doc_id"]).count() == 0
