"""Point lookups (P21) and latest-N reports (K1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def point_lookup(bars: DataFrame, series: Sequence[str], start, end, date_col: str = "trading_date",
                 series_col: str = "contract_series") -> DataFrame:
    """Rows of some series in [start, end], ordered by date.  Both
    predicates are literals: on a table partitioned by series/date they prune
    partitions, otherwise they are pushed to the Parquet row-group filter."""
    return bars.filter(F.col(series_col).isin(*series)
                       & F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))) \
               .orderBy(date_col, series_col)
