"""Generic column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; none calls Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_key(order: Sequence) -> Column:
    """A single comparable value for "first"/"last": a struct of the order
    columns (field-wise comparison), so ties fall through to the next column.

    Performance: with ONE fixed-width order column (a timestamp or an arrival
    sequence number) ``min_by``/``max_by`` keep a fixed-width buffer and run
    as hash aggregation; a struct order makes Spark fall back to sort-based
    aggregation (still partial map-side, still spill-safe, about 2-3x slower).
    Callers that have a unique arrival number should pass it alone."""
    cols = [col(c) for c in order]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def first_by(value, order: Sequence, skip_nulls: bool = True) -> Column:
    """Value of the earliest row by ``order``.

    ``skip_nulls`` (the default) ignores rows whose value is null, which is
    what SQL engines' ``min_by`` and pandas ``first()`` do; ``False`` keeps the
    null of the positionally first row.
    """
    v = col(value)
    if skip_nulls:
        return F.min_by(v, F.when(v.isNotNull(), order_key(order)))
    return F.min_by(F.struct(v.alias("v")), order_key(order))["v"]


def last_by(value, order: Sequence, skip_nulls: bool = True) -> Column:
    v = col(value)
    if skip_nulls:
        return F.max_by(v, F.when(v.isNotNull(), order_key(order)))
    return F.max_by(F.struct(v.alias("v")), order_key(order))["v"]


def mid(bid="bid_px", ask="ask_px") -> Column:
    return (col(bid) + col(ask)) / F.lit(2.0)


def spread(bid="bid_px", ask="ask_px") -> Column:
    return col(ask) - col(bid)


def time_bucket(ts, width_seconds: int) -> Column:
    """Start of the ``width_seconds`` bucket containing ``ts`` (UTC epoch
    aligned), returned with the input's zone-less type.  Requires a UTC
    session zone (set by ``tickvault.session.configure``)."""
    secs = F.unix_seconds(col(ts).cast("timestamp"))
    start = F.timestamp_seconds(secs - F.pmod(secs, F.lit(int(width_seconds))))
    return start.cast("timestamp_ntz")




def round_dp(c, n: int) -> Column:
    """Round to ``n`` decimals as round(x * 10^n) / 10^n: IEEE operations, so
    every engine gives the same double (decimal half-up rounding of the
    printed value and binary rounding disagree on ties)."""
    f = 10 ** n
    return F.round(col(c) * f) / f
