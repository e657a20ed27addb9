"""Operator 5: quality by an interpolated modified Kneser-Ney model.

The model is of character n-grams (5 characters, lower-cased, white space as
one blank), trained on trusted text.  An n-gram is one long of 12 bits a
character, so contexts and suffixes are shifts, and all of the model is Spark
aggregations and joins of count tables, sharded by n-gram: counts, continuation
counts of the lower orders, discounts from the counts of counts, and each
order's probabilities joined with those of the order below.

Documents meet the model in three steps: tasks send the distinct n-grams of
their documents, each is given its probability by joins down the orders, and
the probabilities return in shards of at most ``shard_rows`` n-grams, one pass
over the documents for each.  A shard is bounded; log probabilities add up over
shards.  Nothing is pruned: counts, requests and shards grow with the input.

Trusted text is cut into two folds by the hash of the text (copies stay
together), each with a model of its own, and every document, trusted or not, is
scored by the model of the other fold: no text is scored by counts it is in, so
perplexities of trusted and other documents compare at every size.  If one fold
has no trusted text, the only model scores all.

A document is kept if its perplexity is at most its language's quantile over
trusted documents (over all documents of a language without any).

Edge cases: null texts and texts without characters have no perplexity and are
not kept; a null language is a language of its own; without trusted text all
characters are equally likely; characters from code point 3840 on share 251
symbols by remainder; repeated rows count as often as they stand there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import fingerprint, map_arrow, record, written
from tickvault.llm.language import runs

ORDER, BITS = 5, 12
SYMBOLS = 1 << BITS
SHARD_ROWS, QUANTILE = 4_000_000, 0.995


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram at each character of the texts, and the text it is in."""
    clean = [" ".join(t.lower().split()) for t in texts]
    joined = "".join("\0" * (ORDER - 1) + t for t in clean)
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    code = np.where(code < 3840, code, 3840 + code % 251)
    total = np.zeros(len(code), np.int64)
    for back in range(ORDER):
        total[back:] |= code[:len(code) - back] << (BITS * back)
    size = np.array([len(t) for t in clean], np.int64)
    owner = np.repeat(np.arange(len(texts)), size + ORDER - 1)
    place = np.arange(len(code)) - np.repeat(np.cumsum(size + ORDER - 1) - size - ORDER + 1, size + ORDER - 1)
    real = place >= ORDER - 1
    return total[real], owner[real]


def fold_of(text: Column) -> Column:
    """0 or 1; a model of one fold scores the documents of the other."""
    return F.pmod(F.xxhash64(text), F.lit(2)).cast("int")


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) of the only column of texts."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            grams, at = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
            return grams, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for lo, hi in runs(texts, 1 << 20):
                held.append(np.unique(grams_of(texts[lo:hi])[0], return_counts=True))
                if len(held) == 16:
                    held = [merged()]
                    if len(held[0][0]) > 4_000_000:  # what a task holds stays bounded
                        yield record(schema, *held.pop())
        if held:
            yield record(schema, *merged())

    return map_arrow(texts, work, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> list[float]:
    """Chen and Goodman's discounts of n-grams seen once, twice, and oftener."""
    seen = {r["n"]: r["k"] for r in counts.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}
    n1, n2, n3, n4 = (seen.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.05), i - 0.05) for i, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]


class Model:
    """probability[n]: (key, p) of the n-grams seen; back_off[n]: (context, g)."""

    def __init__(self, counts: DataFrame):
        self.probability: dict[int, DataFrame] = {}
        self.back_off: dict[int, DataFrame] = {}
        tables = {ORDER: counts.select(F.col("gram").alias("key"), "n")}
        for order in range(ORDER - 1, 0, -1):  # n: how many different characters stand before
            suffix = F.col("key").bitwiseAND(F.lit((1 << (BITS * order)) - 1))
            tables[order] = written(tables[order + 1].groupBy(suffix.alias("key")).agg(F.count(F.lit(1)).alias("n")), f"order{order}")
        self.unseen = 1.0 / SYMBOLS
        for order in range(1, ORDER + 1):
            t = tables[order].withColumn("context", F.shiftright("key", BITS))
            d = discounts(tables[order])
            n = F.col("n")
            discount = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
            contexts = written(t.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount).alias("saved")), f"contexts{order}")
            here = t.join(contexts, "context").select("key", ((n - discount) / F.col("total")).alias("own"), (F.col("saved") / F.col("total")).alias("g"))
            if order == 1:
                first = contexts.first()
                self.unseen = (first["saved"] / first["total"] if first else 1.0) / SYMBOLS
                p = here.select("key", (F.col("own") + self.unseen).alias("p"))
            else:
                below = self.probability[order - 1].toDF("suffix", "below")
                here = here.withColumn("suffix", F.col("key").bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1)))
                p = here.join(below, "suffix").select("key", (F.col("own") + F.col("g") * F.col("below")).alias("p"))
            self.probability[order] = written(p, f"p{order}")
            self.back_off[order] = contexts.select("context", (F.col("saved") / F.col("total")).alias("g"))

    def log_probabilities(self, requests: DataFrame) -> DataFrame:
        """(gram, logp) of requested n-grams (column gram)."""
        r = requests
        value = F.lit(self.unseen)
        for order in range(1, ORDER + 1):
            key = F.col("gram").bitwiseAND(F.lit((1 << (BITS * order)) - 1))
            r = r.withColumn("key", key).join(self.probability[order].withColumnRenamed("p", f"p{order}"), "key", "left").drop("key")
            if order > 1:
                r = r.withColumn("context", F.shiftright(key, BITS)).join(self.back_off[order].withColumnRenamed("g", f"g{order}"), "context", "left").drop("context")
                value = F.coalesce(F.col(f"p{order}"), F.coalesce(F.col(f"g{order}"), F.lit(1.0)) * value)
            else:
                value = F.coalesce(F.col("p1"), value)
        return r.select("gram", F.log(value).alias("logp"))


def perplexity(docs: DataFrame, text: Column, keep: list[str], model: Model, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The columns ``keep`` of docs, then n_symbols and perplexity."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c not in ("n_symbols", "perplexity")], text.alias("__text"))
    requests = gram_counts(rows.select("__text").where("__text is not null")).select("gram")
    scored = written(model.log_probabilities(requests), "logp")
    shards = max(1, -(-scored.count() // shard_rows))
    kept = rows.columns[:-1]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])

    def one_pass(shard: int, marked: DataFrame) -> DataFrame:
        part = scored.where(F.pmod(F.xxhash64("gram"), F.lit(shards)) == shard).toArrow().sort_by("gram")
        grams, logp = part.column("gram").to_numpy(), part.column("logp").to_numpy().astype(np.float32)
        sent = marked.sparkSession.sparkContext.broadcast((grams, logp))

        def work(batches):
            known, value = sent.value
            for batch in batches:
                texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
                total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
                for lo, hi in runs(texts, 1 << 20):
                    g, owner = grams_of(texts[lo:hi])
                    distinct, which = np.unique(g, return_inverse=True)
                    at = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
                    mine = (known[at] == distinct) if len(known) else np.zeros(len(distinct), bool)
                    per = np.zeros(len(distinct))
                    per[mine] = value[at[mine]]
                    total[lo:hi] = np.bincount(owner, per[which], hi - lo)
                    count[lo:hi] = np.bincount(owner, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(count), pa.array(total)], names=[*batch.schema.names[:-1], "n_symbols", "logp"])

        extra = "`__print` long, " if "__print" in marked.columns else ""
        return map_arrow(marked, work, f"{fields}{extra}n_symbols long, logp double")

    if shards == 1:
        out = one_pass(0, rows)
    else:  # rows that are equal throughout have equal sums: they are summed once and joined back
        marked = rows.select(*kept, fingerprint(F.col("__text")).alias("__print"), "__text")
        parts = [written(one_pass(s, marked).distinct(), f"shard{s}") for s in range(shards)]
        both = parts[0]
        for p in parts[1:]:
            both = both.unionAll(p)
        sums = both.groupBy(*kept, "__print", "n_symbols").agg(F.sum("logp").alias("logp"))
        times = marked.drop("__text").groupBy(*kept, "__print").agg(F.count(F.lit(1)).alias("__times"))
        same = sums["__print"] == times["__print"]
        for c in kept:
            same = same & sums[c].eqNullSafe(times[c])
        out = sums.join(times, same).withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*[sums[c] for c in kept], "n_symbols", "logp")
    return out.select(*kept, "n_symbols", F.when(F.col("n_symbols") > 0, F.exp(-F.col("logp") / F.col("n_symbols"))).alias("perplexity"))


def cross_perplexity(docs: DataFrame, text: Column, keep: list[str], counts: list[DataFrame], shard_rows: int = SHARD_ROWS) -> DataFrame:
    """perplexity() with each document scored by the other fold's counts."""
    full = [not c.isEmpty() for c in counts]
    if not all(full):
        return perplexity(docs, text, keep, Model(counts[full.index(True) if any(full) else 0]), shard_rows)
    parts = [written(perplexity(docs.where(fold_of(text) == 1 - fold), text, keep, Model(counts[fold]), shard_rows), f"scored{fold}") for fold in (0, 1)]
    return parts[0].unionAll(parts[1])


def classify(scored: DataFrame, lang: Column, trusted: Column, quantile: float = QUANTILE) -> DataFrame:
    """scored with threshold (of its language) and kept."""
    s = scored.withColumn("__lang", F.coalesce(lang, F.lit("\0")))
    some = F.percentile_approx(F.when(trusted, F.col("perplexity")), quantile, 10000)
    every = F.percentile_approx("perplexity", quantile, 10000)
    limits = s.groupBy("__lang").agg(F.coalesce(some, every).alias("threshold"))
    out = s.join(limits, "__lang", "left").drop("__lang")
    return out.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
