"""Set operations and count reports.

U3/U4 (date-set overlap and union) live in ``calendar``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's) -----------------------------
QUALITY_COUNT_NAMES = ["Total Quotes", "Quotes with NULL bid", "Quotes with NULL ask", "Quotes with zero bid",
                       "Quotes with crossed market", "Quotes with negative spread"]
# ---------------------------------------------------------------------------


def table_counts(tables: dict[str, tuple[DataFrame | None, str]]) -> DataFrame:
    """Per existing table its row count and distinct count of one key
    column, as a UNION ALL (absent tables are left out)."""
    out = None
    for name, (df, key) in tables.items():
        if df is None:
            continue
        one = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("unique_keys")) \
                .select(F.lit(name).alias("table_name"), "row_count", "unique_keys")
        out = one if out is None else out.unionByName(one)
    return out


def quality_counts(quotes: DataFrame) -> DataFrame:
    """The six quote counts in one scan (``count_if``), unpivoted."""
    b, a = F.col("bid_px"), F.col("ask_px")
    conds = [F.lit(True), b.isNull(), a.isNull(), b == 0, b > a, (a - b) < 0]
    one = quotes.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conds)])
    items = [F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("count"))
             for i, n in enumerate(QUALITY_COUNT_NAMES)]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")
