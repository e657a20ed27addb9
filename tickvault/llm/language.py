"""Operator 10: language identification with hyperdimensional profiles.

Every letter has a random +-1 vector; a trigram is the product (binding) of its
letters' vectors, the first two rotated by two and one places (permutation); a
document, and a language, is the sum (bundle) of its trigrams' vectors.  A
document gets the language whose prototype has the largest cosine.

Bundles are linear, so a prototype needs only the trigram counts of all texts
of its language: counts are summed by Spark, and what reaches the driver is one
vector per language and partition of that small table.  Scoring is one pass.

A gate (``accepted``) tells documents of no learned language: a cosine must be
above the noise of the dimensions and above a share of a low quantile of the
cosines that rows labelled with the language have at that size.  Few trigrams
have small cosines, so texts of fewer than SHORT trigrams can be given
prototypes of more dimensions, whose noise is smaller.

Edge cases: text is lower-cased, whatever is not a letter separates words; a
null text or one without letters is ``und`` with score 0; a null language is
not learned; without prototypes everything is ``und``; equal cosines give the
first language by name.  A given score is the cosine, cut to 0..1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import map_arrow
from tickvault.llm.tokens import splitmix

DIMENSIONS = 1024
#: Dimensions for texts of fewer than SHORT trigrams, where a gate needs little noise.
WIDE, SHORT = 8192, 256
UNKNOWN = "und"
#: The gate: standard deviations of noise, and the quantile of a language's own
#: cosines of which SHARE is enough.
NOISE, QUANTILE, SHARE = 4.0, 0.001, 0.25
#: Most trigrams (of DIMENSIONS; fewer of more), and most cells of a table texts x trigrams or of bundles, that are worked on at a time.
GRAMS, CELLS = 1 << 12, 1 << 20
_letters: dict[str, np.ndarray] = {}


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams (three code points of 21 bits, 0 between words) and
    their counts; none if there is no letter."""
    if "is" not in _letters:
        _letters["is"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    code[~_letters["is"][code]] = 0
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    code = code[keep]
    if len(code) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique((code[:-2] << np.uint64(42)) | (code[1:-1] << np.uint64(21)) | code[2:], return_counts=True)


def vectors(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One +-1 vector (int8) per trigram."""
    three = [(grams >> np.uint64(s)) & np.uint64((1 << 21) - 1) for s in (42, 21, 0)]
    letters, at = np.unique(np.concatenate(three), return_inverse=True)
    bits = splitmix(letters[:, None] * np.uint64(dimensions // 64) + np.arange(dimensions // 64, dtype=np.uint64) + np.uint64(1))
    own = (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1)
    first, second, third = at.reshape(3, -1)
    return np.roll(own, 2, axis=1)[first] * np.roll(own, 1, axis=1)[second] * own[third]


def bundles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One bundle (float32) per text; zero if it has no letters."""
    return _bundled([trigrams(t) for t in texts], dimensions) if texts else np.zeros((0, dimensions), np.float32)


def _bundled(counted: list[tuple[np.ndarray, np.ndarray]], dimensions: int) -> np.ndarray:
    known, at = np.unique(np.concatenate([g for g, _ in counted]), return_inverse=True)
    most = max(1, GRAMS * DIMENSIONS // max(dimensions, DIMENSIONS))
    half = len(counted) // 2
    if half and (len(known) > most or len(known) * len(counted) > CELLS):  # many letters: fewer texts at a time
        return np.concatenate([_bundled(counted[:half], dimensions), _bundled(counted[half:], dimensions)])
    out = np.zeros((len(counted), dimensions), np.float32)
    text, n = np.repeat(np.arange(len(counted)), [len(g) for g, _ in counted]), np.concatenate([n for _, n in counted])
    for lo in range(0, len(known), most):
        mine = (at >= lo) & (at < lo + most)
        some = known[lo:lo + most]
        table = np.zeros((len(counted), len(some)), np.float32)
        table[text[mine], at[mine] - lo] = n[mine]
        out += table @ vectors(some, dimensions).astype(np.float32)
    return out


def runs(texts: list[str], chars: int = 1 << 18) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i + 1 == len(texts):
            yield lo, i + 1
            lo, size = i + 1, 0


Prototypes = tuple[list[str], np.ndarray]


def fit(training: DataFrame, text: Column, lang: Column, dimensions: int = DIMENSIONS) -> Prototypes:
    """Languages in order and their prototypes of length 1."""
    return fit_each(training, text, lang, (dimensions,))[0]


def fit_each(training: DataFrame, text: Column, lang: Column, each: tuple[int, ...]) -> list[Prototypes]:
    """The same for each number of dimensions, from one count of trigrams."""

    def count(batches):
        schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            by: dict[str, list] = {}
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(name, []).append(t)
            for name, texts in by.items():
                for lo, hi in runs(texts, 1 << 22):
                    parts = [trigrams(t) for t in texts[lo:hi]]
                    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                    n = np.bincount(at, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], schema=schema)

    def bundle(batches):
        schema = pa.schema([("lang", pa.string()), ("dimensions", pa.int32()), ("vector", pa.binary())])
        total: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            grams, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for d in each:
                step = max(1, GRAMS * DIMENSIONS // max(d, DIMENSIONS))
                for name in set(names):
                    for lo in range(0, len(names), step):
                        mine = np.flatnonzero(names[lo:lo + step] == name) + lo
                        v = n[mine].astype(np.float64) @ vectors(grams[mine].view(np.uint64), d).astype(np.float64)
                        total[name, d] = total.get((name, d), 0) + v
        columns = [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = training.select(text.alias("text"), lang.alias("lang")).where("text is not null and lang is not null")
    counts = map_arrow(rows, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total: dict[int, dict[str, np.ndarray]] = {d: {} for d in each}
    for name, d, vector in map_arrow(counts, bundle, "lang string, dimensions int, vector binary").collect():
        total[d][name] = total[d].get(name, 0) + np.frombuffer(vector, np.float64)
    out = []
    for d in each:
        names = sorted(k for k, v in total[d].items() if np.any(v))
        out.append((names, np.array([total[d][k] / np.linalg.norm(total[d][k]) for k in names]).reshape(len(names), d)))
    return out


def identify(docs: DataFrame, text: Column, prototypes: Prototypes, keep: list[str], wide: Prototypes | None = None, grams: str | None = None) -> DataFrame:
    """The columns ``keep`` of docs, then lang_pred and score; with ``grams``,
    the number of trigrams under that name.  Texts of fewer than SHORT trigrams
    are compared with the prototypes ``wide``, if given."""
    more = ["lang_pred", "score"] + ([grams] if grams else [])
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c not in more], text.alias("__text"))

    def compare(counted, names, matrix):
        v = _bundled(counted, matrix.shape[1])
        size = np.linalg.norm(v.astype(np.float64), axis=1)
        cos = v @ matrix.T / np.maximum(size, 1e-9)[:, None]
        return [(names[k], min(1.0, max(0.0, c[k]))) if s > 0 else (UNKNOWN, 0.0) for k, c, s in zip(cos.argmax(axis=1), cos, size)]

    def predict(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            found, n = [(UNKNOWN, 0.0)] * len(texts), np.zeros(len(texts), np.int64)
            for lo, hi in runs(texts):
                counted = [trigrams(t) for t in texts[lo:hi]]
                n[lo:hi] = [c.sum() for _, c in counted]
                few = np.flatnonzero(n[lo:hi] < SHORT) if wide else np.zeros(0, np.int64)
                many = np.setdiff1d(np.arange(hi - lo), few)
                cut = lambda some, d: (some[i:i + max(1, CELLS // d)] for i in range(0, len(some), max(1, CELLS // d)))
                for some, model in [*((x, prototypes) for x in cut(many, DIMENSIONS)), *((x, wide) for x in cut(few, WIDE))]:
                    if len(some) and model[0]:
                        for i, pair in zip(some, compare([counted[i] for i in some], *model)):
                            found[lo + i] = pair
            columns = [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([float(f[1]) for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n)] if grams else columns, names=[*batch.schema.names[:-1], *more])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["lang_pred string", "score double"]
    return map_arrow(rows, predict, ", ".join(schema + ([f"`{grams}` long"] if grams else [])))


def _size(grams: Column) -> Column:
    """Class of a size: 0, 1, 2-3, 4-7, ..."""
    return F.when(grams > 0, F.floor(F.log2(grams)) + 1).otherwise(0).cast("int")


def accepted(docs: DataFrame, text: Column, lang: Column, keep: list[str], quantile: float = QUANTILE, share: float = SHARE, noise: float = NOISE) -> DataFrame:
    """Documents of a language learned from the labelled rows of ``docs``
    (``lang`` not null): the columns ``keep``, lang_pred and score.

    A document stays if its cosine is above ``noise`` standard deviations of
    the cosine of unrelated vectors, and not below ``share`` of the ``quantile``
    of the cosines of rows with that label and size (a power of two of
    trigrams; where no row has that size, the next smaller one).  Labels
    decide nothing else; documents without letters go.  What reaches the driver
    is the prototypes and one number per language and size."""
    narrow, wide = fit_each(docs, text, lang, (DIMENSIONS, WIDE))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], lang.alias("__label"), text.alias("__t"))
    found = identify(rows.select(F.col("__label"), F.col("__t")), F.col("__t"), narrow, ["__label"], wide, "__grams")
    own = found.where((F.col("__label") == F.col("lang_pred")) & (F.col("__grams") > 0))
    least = own.groupBy("lang_pred", _size(F.col("__grams")).alias("size")).agg(F.percentile_approx("score", quantile, 10000).alias("least"))
    known = {(r["lang_pred"], r["size"]): r["least"] * share for r in least.collect()}
    limits = []
    for name in narrow[0]:
        last = 0.0
        for size in range(65):
            last = known.get((name, size), last)
            limits.append((name, size, float(max(last, noise / ((WIDE if size <= SHORT.bit_length() - 1 else DIMENSIONS) ** 0.5)))))
    bounds = docs.sparkSession.createDataFrame(limits, "lang_pred string, __size int, __least double")
    scored = identify(rows, F.col("__t"), narrow, keep, wide, "__grams").withColumn("__size", _size(F.col("__grams")))
    kept = scored.join(F.broadcast(bounds), ["lang_pred", "__size"]).where("score >= __least")  # 65 rows a language
    return kept.select(*[F.col(f"`{c}`") for c in keep], "lang_pred", "score")
