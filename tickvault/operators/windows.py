"""Window operators.

Windows over daily series (one row per series and day) are bounded by the
calendar, so a plain ``partitionBy(series)`` window is safe at any data size.
Windows over ticks are not: one symbol may hold a third of all rows.  For
those, ``lag_chunked`` (and ``forward_fill_chunked``) splits every partition into ranges of the order column,
computes the lag inside each range in parallel, and stitches range borders
with a small aggregate -- exact, and no task sees a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col


def _w(partition: Sequence[str], order: Sequence):
    return Window.partitionBy(*partition).orderBy(*[col(c) for c in order])


def lag_compare(df: DataFrame, partition: Sequence[str], order: Sequence, value: str,
                out: str | None = None) -> DataFrame:
    """Previous ``value`` in the series (``prev_<value>``)."""
    return df.withColumn(out or f"prev_{value}", F.lag(value).over(_w(partition, order)))


def lag_chunked(df: DataFrame, partition: Sequence[str], order_col: str, value: str,
                chunk_width: int, out: str | None = None, tiebreak: str | None = None) -> DataFrame:
    """Exact ``lag(value) over (partition by .. order by order_col[, tiebreak])``
    for partitions of unbounded size.

    ``order_col`` must be numeric (an arrival sequence or epoch value).  Rows
    are split into ranges ``floor(order_col / chunk_width)``; the lag runs per
    (partition, range); the first row of a range takes the last value of the
    previous non-empty range of its partition, found with a per-range
    aggregate (#ranges rows) and a window over those ranges only.
    """
    out = out or f"prev_{value}"
    order = [order_col] + ([tiebreak] if tiebreak else [])
    okey = F.struct(*[F.col(c) for c in order])
    chunk = F.floor(F.col(order_col) / F.lit(chunk_width)).cast("long")
    d = df.withColumn("_chunk", chunk)
    inner = Window.partitionBy(*partition, "_chunk").orderBy(*order)
    d = d.withColumn("_lag", F.lag(value).over(inner)).withColumn("_rn", F.row_number().over(inner))
    last_per_chunk = (d.groupBy(*partition, "_chunk")
                       .agg(F.max_by(F.struct(F.col(value).alias("v")), okey)["v"].alias("_last")))
    prev_chunk = last_per_chunk.withColumn(
        "_prev_last", F.lag("_last").over(Window.partitionBy(*partition).orderBy("_chunk"))
    ).drop("_last")
    j = _with_range(d, prev_chunk, partition, "_prev_last")
    res = j.withColumn(out, F.when(F.col("_rn") == 1, F.col("_prev_last")).otherwise(F.col("_lag")))
    return res.select(*df.columns, out)


def _with_range(d: DataFrame, ranges: DataFrame, partition: Sequence[str], value: str) -> DataFrame:
    """Attach a value per (partition, range) to the rows; null-safe equality on
    the partition columns (a null key is a group too)."""
    r = ranges.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(partition)], F.col("_chunk").alias("_chunk_r"), value)
    cond = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(partition)] + [F.col("_chunk").eqNullSafe(F.col("_chunk_r"))]
    return d.join(r, cond, "left")


def forward_fill_chunked(df: DataFrame, partition: Sequence[str], order_col: str, value: str,
                         chunk_width: int, out: str | None = None, tiebreak: str | None = None) -> DataFrame:
    """N3 for partitions of unbounded size (ticks): as ``lag_chunked``, the fill
    runs per (partition, range of ``order_col``), and rows before a range's
    first value take the last value of an earlier range.  Rows of equal order
    without a ``tiebreak`` are in no defined order; a null order comes first."""
    out = out or value
    order = [order_col] + ([tiebreak] if tiebreak else [])
    d = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk_width)).cast("long")).withColumn("_v", F.col(value))
    seen = Window.partitionBy(*partition, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_fill", F.last("_v", ignorenulls=True).over(seen))
    key = F.struct(*[F.col(c) for c in order])
    last = d.groupBy(*partition, "_chunk").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), key)).alias("_last"))
    before = Window.partitionBy(*partition).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
    names = list(df.columns) + ([out] if out not in df.columns else [])
    return _with_range(d, carried, partition, "_carried").withColumn(out, F.coalesce("_fill", "_carried")).select(*names)


def daily_count_window(df: DataFrame, ts: str = "ts_event") -> DataFrame:
    """Rows of the day attached to each row, then per (year, month):
    days, rows, and the row-weighted average daily count."""
    d = df.select(F.to_date(ts).alias("day"))
    per_day = d.groupBy("day").agg(F.count(F.lit(1)).alias("n_day"))
    # count(*) over (partition by day) averaged over rows == sum(n^2)/sum(n)
    return (per_day.groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
                   .agg(F.count(F.lit(1)).alias("days"), F.sum("n_day").alias("quotes"),
                        (F.sum(F.col("n_day") * F.col("n_day")) / F.sum("n_day")).alias("avg_daily_weighted")))


def forward_fill(df: DataFrame, partition: Sequence[str], order: Sequence, value: str,
                 out: str | None = None) -> DataFrame:
    """Last non-null value carried forward within the series."""
    w = _w(partition, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out or value, F.last(value, ignorenulls=True).over(w))


def group_size(df: DataFrame, key: Sequence[str], out: str = "group_size") -> DataFrame:
    """Rows per key attached to each row.  Computed as an aggregate joined
    back on the key (partial aggregation, hot keys do not land in one task)."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias(out))
    cond = [df[c].eqNullSafe(sizes[c]) for c in key]
    return df.join(sizes, cond, "left").select(df["*"], sizes[out])


def pct_change(df: DataFrame, partition: Sequence[str], order: Sequence, value: str,
               out: str = "pct_change") -> DataFrame:
    """Value / previous - 1 (null for the first row or a zero previous)."""
    prev = F.lag(value).over(_w(partition, order))
    return df.withColumn(out, F.try_divide(F.col(value), prev) - F.lit(1.0))


def latest_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """K1: the last ``n`` rows overall (TakeOrderedAndProject: each partition
    keeps its top n, then n x partitions rows are merged)."""
    return df.orderBy(*order).limit(n)


def head_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int,
                   rank_col: str = "rn") -> DataFrame:
    """K1/K2: first ``n`` rows per group by ``order`` (use desc for tail)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top_duplicates(df: DataFrame, key: Sequence[str], n: int = 10) -> DataFrame:
    """K3: the ``n`` most repeated keys (count > 1), ties by key."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("dup_count"))
              .filter(F.col("dup_count") > 1)
              .orderBy(F.desc("dup_count"), *[F.asc_nulls_first(c) for c in key]).limit(n))
