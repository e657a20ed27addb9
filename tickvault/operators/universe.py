"""Download-universe expansion (P10) and expected ranks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import parse_ranks


def expand_universe(universe: DataFrame, include_optionals: bool = True,
                    filter_roots: Iterable[str] | None = None) -> DataFrame:
    """P10: one row per (root, rank) continuous symbol ``ROOT.code.rank``.

    ``universe`` has ``root, code, ranks, optional``; ``ranks`` is a spec
    such as ``"0-3,5"`` (sorted, distinct; a range with start > end raises).
    Optional roots can be left out and the roots filtered (case-insensitive).
    """
    u = universe
    if not include_optionals:
        u = u.filter(~F.col("optional"))
    if filter_roots:
        u = u.filter(F.upper("root").isin([r.upper() for r in filter_roots]))
    e = u.select("root", "code", "optional", F.explode(parse_ranks("ranks")).alias("rank"))
    return e.select("root", "code", "rank", F.concat_ws(".", "root", "code", F.col("rank").cast("string")).alias("symbol"),
                    "optional")
