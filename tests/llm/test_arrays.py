"""The array code without Spark, against plain Python."""

import random

import numpy as np
import plain
import pytest
from hypothesis import given, settings, strategies as st

from tickvault.llm import licence
from tickvault.llm.contamination import FMIndex, mask_spans
from tickvault.llm.embedding import calibrate
from tickvault.llm.jaccard import signature, unequal_bits
from tickvault.llm.substring import phrases
from tickvault.llm.tokens import grams, inside, words_of


def run(texts, kind):
    raw = [t.encode() for t in texts]
    return words_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]), kind)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aBZ é9,\t\n\x85 ", max_size=30), max_size=6), st.sampled_from(["plain", "lower", "alnum"]))
def test_words(texts, kind):
    w = run(texts, kind)
    rows = [plain.words(t, kind) for t in texts]
    assert np.diff(w.off).tolist() == [len(r) for r in rows]
    flat = [x for r in rows for x in r]
    names = dict(zip(w.hash.tolist(), flat))
    assert [names[h] for h in w.hash.tolist()] == flat and len(names) == len(set(flat))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=5), st.integers(1, 5))
def test_grams(rows, k):
    w = run([" ".join(r) for r in rows], "plain")
    g, ok = grams(w.hash, k), inside(w.off, k)
    expected = [tuple(r[i:i + k]) for r in rows for i in range(len(r) - k + 1)]
    found = g[ok].tolist()
    assert len(found) == len(expected)
    assert len(set(zip(found, expected))) == len(set(expected)) == len(set(found))


def test_windows_share_phrases():
    rng = random.Random(1)
    passage = [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(40)]
    a = [f"u{i}" for i in range(30)] + passage + [f"v{i}" for i in range(30)]
    b = [f"s{i}" for i in range(11)] + passage + [f"t{i}" for i in range(50)]
    found = []
    for text, at in ((a, 30), (b, 11)):
        starts, place, _ = phrases(run([" ".join(text)], "plain"), 35)
        found.append([p - s for s, p in zip(starts.tolist(), place.tolist()) if at <= s <= at + 5])
        assert all(s <= p <= s + 17 for s, p in zip(starts.tolist(), place.tolist()))
        assert (np.diff(np.unique(place)) <= 18).all()
    assert found[0] == found[1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=20), min_size=1, max_size=5))
def test_fm_index(stretches):
    symbols = np.array([x for s in stretches for x in (*s, 0)])
    index = FMIndex(symbols, 5)
    text = symbols.tolist()
    for n in (1, 2, 3):
        patterns = {tuple(text[i:i + n]) for i in range(len(text)) if 0 not in text[i:i + n] and i + n <= len(text)} | {(4,) * n}
        patterns = sorted(patterns)
        lo, hi = index.search(np.array(patterns))
        for p, a, b in zip(patterns, lo, hi):
            expected = [i for i in range(len(text)) if tuple(text[i:i + n]) == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_spans_stay_in_their_text():
    mask = np.array([1, 1, 1, 0, 1, 1], bool)
    assert mask_spans(mask, np.array([0, 2, 2, 6])) == [[{"start": 0, "stop": 2}], [], [{"start": 0, "stop": 1}, {"start": 2, "stop": 4}]]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=200), st.sets(st.integers(0, 400), min_size=1, max_size=200))
def test_signature_bounds(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    assert unequal_bits(signature(x), signature(y)) <= len(a ^ b)


def test_calibration_grows_slowly():
    assert calibrate(100)[0] == 3 and calibrate(50_000)[0] < calibrate(50_000_000)[0]
    assert all(calibrate(n, recall=0.9)[1] <= calibrate(n, recall=0.99)[1] for n in (10, 10_000, 10_000_000))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("cc by general public license all rights reserved x".split()), max_size=40))
def test_phrases(row):
    automaton = licence.Automaton([licence.plain_words(t) for _, t in licence.TEMPLATES], [licence.plain_words(p) for p, _ in licence.PHRASES])
    hits = []
    automaton.stream(row, 0, [], hits)
    expected = [(n, i) for n, (p, _) in enumerate(licence.PHRASES) for i in range(len(row)) if row[i:i + len(p.split())] == p.split()]
    assert sorted(hits) == sorted(expected)


@pytest.mark.parametrize("name,text", licence.TEMPLATES)
def test_matching_statistics(name, text):
    templates = [licence.plain_words(t) for _, t in licence.TEMPLATES]
    automaton = licence.Automaton(templates, [])
    row = licence.plain_words(text)
    row = row[:8] + ["changed"] + row[9:]
    matches = []
    automaton.stream(row, 0, matches, [])
    assert [(s, n) for s, n, _ in matches] == [(0, 8), (9, len(row) - 9)]
    best = max(automaton.chains(matches), key=lambda c: c[3])
    assert licence.TEMPLATES[best[0]][0] == name and best[3] == pytest.approx((len(row) - 1) / len(row))
