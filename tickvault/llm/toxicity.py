"""Operator 9: toxicity, a linear classifier on character n-grams.

A document is the set of its lower-cased character n-grams (3 to 5 characters,
hashed to 2**bits features).  A feature is scaled by its naive Bayes log-count
ratio, the log of how much likelier a toxic text is to hold it, and a logistic
regression with L2 penalty is fitted on the scaled features.

The ratios count every labelled training row.  Only the regression is fitted on
a sample: at most ``fit_rows`` distinct texts of each class, those of smallest
hash, each weighted by its rows, so its size is bounded; its intercept is then
moved from the classes' shares in the sample to those in all training rows.  The model is 2**bits numbers, a fixed
bound, and goes to the tasks with the scoring function.

Edge cases: a null text is the empty text, which has no n-grams and gets the
intercept's score; a null label is not learned from; without both classes the
score is the smoothed share of toxic rows; repeated rows count as often.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import map_arrow, written
from tickvault.llm.language import runs

BITS = 18
LENGTHS = (3, 4, 5)
#: Most distinct texts of each class in the regression's sample.
FIT_ROWS = 1500
#: A feature in fewer labelled rows says too little to count.
LEAST_ROWS = 3


@dataclass
class Model:
    weight: np.ndarray
    intercept: float


def features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature of each distinct feature of each text, in order."""
    padded = [f" {t.lower()} " if t else "" for t in texts]
    size = np.array([len(t) for t in padded])
    code = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    code[code < 33] = 32
    owner, last = np.repeat(np.arange(len(texts)), size), np.repeat(np.cumsum(size), size)
    factor = np.random.default_rng(7).integers(1, 1 << 63, max(LENGTHS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    found = []
    total = code * factor[0]
    for n in range(2, max(LENGTHS) + 1):
        total = total[:-1] + code[n - 1:] * factor[n - 1] if len(code) >= n else total[:0]
        if n in LENGTHS and len(total):
            whole = np.arange(len(total)) + n <= last[:len(total)]
            mixed = (total[whole] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((owner[:len(total)][whole].astype(np.uint64) << np.uint64(bits)) | (mixed >> np.uint64(64 - bits)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.sort(np.concatenate(found))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)


def minimise(value, start: np.ndarray, steps: int = 60, kept: int = 6) -> np.ndarray:
    """L-BFGS with a halving line search; value(x) gives loss and gradient."""
    x, past = start, []
    f, g = value(x)
    for _ in range(steps):
        d, alphas = -g, []
        for s, y in reversed(past):
            alphas.append(s @ d / (s @ y))
            d = d - alphas[-1] * y
        if past:
            s, y = past[-1]
            d = d * (s @ y / (y @ y))
        for (s, y), a in zip(past, reversed(alphas)):
            d = d + (a - y @ d / (s @ y)) * s
        step = 1.0 if past else 1.0 / max(1.0, np.abs(g).sum())
        while step > 1e-8:
            new = x + step * d
            f2, g2 = value(new)
            if f2 <= f + 1e-4 * step * (g @ d):
                break
            step /= 2
        else:
            break
        s, y = new - x, g2 - g
        if s @ y > 1e-12:
            past = (past + [(s, y)])[-kept:]
        done = abs(f - f2) < 1e-6 * max(1.0, abs(f))
        x, f, g = new, f2, g2
        if done:
            break
    return x


def regression(labels: np.ndarray, weight: np.ndarray, parts: list[tuple[int, np.ndarray, np.ndarray]], ratio: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Weights by feature (the ratio multiplied in) and intercept.  A part is a
    run of rows: the first, how many features each has, and the features; it
    bounds what a step holds besides four bytes a feature of the sample."""

    def loss(w):
        scaled, z, back = ratio * w[:-1], np.full(len(labels), w[-1]), np.zeros(len(ratio))
        for first, size, feats in parts:
            owner = np.repeat(np.arange(len(size)), size)
            z[first:first + len(size)] += np.bincount(owner, scaled[feats], len(size))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels)
        for first, size, feats in parts:
            back += np.bincount(feats, np.repeat(error[first:first + len(size)], size), len(ratio))
        grad = np.append(ratio * back + penalty * w[:-1], error.sum())
        return weight @ np.logaddexp(0, np.where(labels > 0, -z, z)) + penalty / 2 * (w[:-1] @ w[:-1]), grad

    w = minimise(loss, np.zeros(len(ratio) + 1))
    return w[:-1] * ratio, float(w[-1])


def fit(training: DataFrame, text: Column, label: Column, bits: int = BITS, fit_rows: int = FIT_ROWS, penalty: float = 1.0) -> Model:
    rows = training.select(F.coalesce(text, F.lit("")).alias("text"), label.cast("int").alias("label")).where("label in (0, 1)")

    def count(batches):
        schema = pa.schema([("feature", pa.int32()), ("toxic", pa.int64()), ("clean", pa.int64())])
        total = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            texts, y = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), np.int64)
            for lo, hi in runs(texts):
                owner, feats = features(texts[lo:hi], bits)
                for k in (0, 1):
                    total[k] += np.bincount(feats[y[lo:hi][owner] == k], minlength=1 << bits)
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[1][some]), pa.array(total[0][some])], schema=schema)

    rows = rows.withColumn("print", F.xxhash64("text"))
    distinct = written(rows.groupBy("label", "print").agg(F.count(F.lit(1)).alias("n")), "distinct")
    n = {k: c for k, c in distinct.groupBy("label").agg(F.sum("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Model(np.zeros(1 << bits), float(np.log((toxic + 1) / (clean + 1))))
    counted = (map_arrow(rows.select("text", "label"), count, "feature int, toxic long, clean long").groupBy("feature")
               .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow())  # 2**bits rows at most
    at, p, q = (counted.column(i).to_numpy() for i in range(3))
    ratio = np.zeros(1 << bits)
    ratio[at] = np.where(p + q >= LEAST_ROWS, np.log((p + 1) / (toxic + 2)) - np.log((q + 1) / (clean + 2)), 0)

    def learn(batches):
        y, copies, parts = [], [], []
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in runs(texts):
                owner, f = features(texts[lo:hi], bits)
                some = ratio[f] != 0
                parts.append((len(y) + lo, np.bincount(owner[some], minlength=hi - lo), f[some].astype(np.int32)))
            y += batch.column(1).to_pylist()
            copies += batch.column(2).to_pylist()
        labels, weight = np.array(y, float), np.array(copies, float)
        w, b = regression(labels, weight, parts, ratio, penalty)
        b -= float(np.log(weight[labels > 0].sum() / weight[labels == 0].sum()))
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([b])], schema=pa.schema([("w", pa.binary()), ("b", pa.float64())]))

    last = [distinct.where(F.col("label") == k).orderBy("print").limit(fit_rows).agg(F.max("print")).first()[0] for k in (0, 1)]
    small = rows.where(((F.col("label") == 0) & (F.col("print") <= last[0])) | ((F.col("label") == 1) & (F.col("print") <= last[1])))
    sample = small.groupBy("label", "print").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("n")).coalesce(1).sortWithinPartitions("label", "print")
    w, b = map_arrow(sample.select("text", "label", "n"), learn, "w binary, b double").first()
    return Model(np.frombuffer(w, np.float64), b + float(np.log(toxic / clean)))


def score(docs: DataFrame, text: Column, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of docs, then score and predicted."""
    weight, intercept = model.weight.astype(np.float32), model.intercept
    bits = len(weight).bit_length() - 1
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c not in ("score", "predicted")], text.alias("__text"))

    def predict(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            z = np.full(len(texts), intercept)
            for lo, hi in runs(texts):
                owner, feats = features(texts[lo:hi], bits)
                z[lo:hi] += np.bincount(owner, weight[feats], hi - lo)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, predict, f"{schema}{', ' if schema else ''}score double, predicted int")
