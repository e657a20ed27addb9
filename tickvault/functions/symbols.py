"""Symbol parsing and naming as column expressions.

Everything is ``regexp_extract`` / ``split`` / ``when`` over a symbol column,
so parsing a billion-row symbol column is a narrow, codegen'd projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import col

# --- fixed values (must equal the reference's) -----------------------------
# Futures month codes: F=1 G=2 H=3 J=4 K=5 M=6 N=7 Q=8 U=9 V=10 X=11 Z=12
MONTH_CODES = {"F": 1, "G": 2, "H": 3, "J": 4, "K": 5, "M": 6,
               "N": 7, "Q": 8, "U": 9, "V": 10, "X": 11, "Z": 12}
# Continuous symbol roll codes: (code, roll strategy, roll rule, folder)
ROLL_CODES = [
    ("c", "calendar", "databento_calendar", "calendar"),
    ("v", "volume", "databento_volume", "volume"),
    ("o", "open-interest", "databento_open_interest", "open-interest"),
]
OPTION_SYMBOL_RE = r"^([A-Z]+)([A-Z])(\d)\s+([CP])(\d+)$"
FUTURE_SYMBOL_RE = r"^([A-Z]+)([A-Z])(\d)$"
NATIVE_SYMBOL_RE = r"^(.{1,4}?)([FGHJKMNQUVXZfghjkmnquvxz])([0-9]+)$"
OPTION_FILTER_RE = r"\s[CP]\d+$"
# ---------------------------------------------------------------------------


def month_number(code: Column, strict: bool = False) -> Column:
    """Month of a futures month code; unknown codes give January unless
    ``strict`` (then null)."""
    m = F.create_map(*[x for k, v in MONTH_CODES.items() for x in (F.lit(k), F.lit(v))])
    n = m[code]
    return n if strict else F.coalesce(n, F.lit(1))


def _parsed(symbol: Column, regex: str) -> Column:
    return symbol.rlike(regex)


def parse_option_symbol(symbol="symbol", decade_base: int = 2020, strict_month: bool = False) -> Column:
    """``ESZ5 C6000`` -> struct(root, expiry, strike, put_call, symbol_feed).

    Expiry is the 15th of the coded month; year = ``decade_base`` + digit.
    Symbols that do not match give a null struct."""
    s = col(symbol)
    root = F.regexp_extract(s, OPTION_SYMBOL_RE, 1)
    month = month_number(F.regexp_extract(s, OPTION_SYMBOL_RE, 2), strict_month)
    year = F.lit(decade_base) + F.regexp_extract(s, OPTION_SYMBOL_RE, 3).cast("int")
    put_call = F.regexp_extract(s, OPTION_SYMBOL_RE, 4)
    strike = F.regexp_extract(s, OPTION_SYMBOL_RE, 5).cast("double")
    st = F.struct(root.alias("root"), F.make_date(year, month, F.lit(15)).alias("expiry"),
                  strike.alias("strike"), put_call.alias("put_call"), s.alias("symbol_feed"))
    return F.when(_parsed(s, OPTION_SYMBOL_RE), st)


def parse_future_symbol(symbol="symbol", decade_base: int = 2020, strict_month: bool = False) -> Column:
    """``ESZ5`` -> struct(root, expiry, symbol_feed); null when no match."""
    s = col(symbol)
    root = F.regexp_extract(s, FUTURE_SYMBOL_RE, 1)
    month = month_number(F.regexp_extract(s, FUTURE_SYMBOL_RE, 2), strict_month)
    year = F.lit(decade_base) + F.regexp_extract(s, FUTURE_SYMBOL_RE, 3).cast("int")
    st = F.struct(root.alias("root"), F.make_date(year, month, F.lit(15)).alias("expiry"),
                  s.alias("symbol_feed"))
    return F.when(_parsed(s, FUTURE_SYMBOL_RE), st)


def parse_native_symbol(symbol="native_symbol", single_digit_base: int = 2000) -> Column:
    """``SR3H25`` -> struct(root, month, year, month_code, native_symbol).

    Shortest root of 1-4 characters followed by a month code (any case) and
    digits.  One digit: ``single_digit_base`` + d; two or more digits: n <= 50
    gives 2000 + n, else 1900 + n (a long; null beyond it).  Null when it
    does not parse."""
    s = col(symbol)
    root = F.regexp_extract(s, NATIVE_SYMBOL_RE, 1)
    code = F.upper(F.regexp_extract(s, NATIVE_SYMBOL_RE, 2))
    digits = F.regexp_extract(s, NATIVE_SYMBOL_RE, 3)
    n = digits.try_cast("bigint")
    year = (F.when(F.length(digits) == 1, F.lit(single_digit_base) + n)
            .when(n <= 50, F.lit(2000) + n)
            .otherwise(F.lit(1900) + n))
    st = F.struct(root.alias("root"), month_number(code, strict=True).alias("month"),
                  year.alias("year"), code.alias("month_code"), s.alias("native_symbol"))
    return F.when(s.rlike(NATIVE_SYMBOL_RE), st)


def parse_continuous_symbol(symbol="symbol") -> Column:
    """``ES.c.1`` -> struct(root='ES', rank=1).  Anything else: root = the
    whole symbol, rank 0; a non-numeric rank is 0."""
    s = col(symbol)
    parts = F.split(s, r"\.")
    ok = (F.size(parts) >= 3) & parts[1].isin("c", "v", "o")
    rank_txt = parts[2]
    rank = F.when(rank_txt.rlike(r"^[0-9]+$"), F.coalesce(rank_txt.try_cast("int"), F.lit(0))).otherwise(F.lit(0))
    return F.when(ok, F.struct(parts[0].alias("root"), rank.alias("rank"))) \
        .otherwise(F.struct(s.alias("root"), F.lit(0).alias("rank")))


def normalize_strategy(strategy: Column) -> Column:
    return F.upper(F.translate(strategy, "- ", "__"))


def make_contract_series(root, strategy, rank) -> Column:
    """``ROOT_FRONT_X`` for rank 0, else ``ROOT_RANK_n_X``; X is the strategy
    upper-cased with ``-`` and spaces turned into ``_``."""
    r = col(rank)
    prefix = F.when(r == 0, F.lit("FRONT")).otherwise(F.concat(F.lit("RANK_"), r.cast("string")))
    return F.concat_ws("_", col(root), prefix, normalize_strategy(col(strategy)))


def series_root(series="contract_series") -> Column:
    """Part before the first ``_`` (the whole name when there is none).
    ``substring_index`` gives the same result as ``split_part(.., '_', 1)``
    without building an array per row (measured about 4x faster)."""
    return F.substring_index(col(series), "_", 1)


def series_rank(series="contract_series", variant: str = "front_or_rank") -> Column:
    """Rank of a series name.

    ``front_or_rank``: contains ``_FRONT_`` -> 0, else ``RANK_n`` -> n, else 0.
    ``sortable``: contains ``FRONT`` -> 0, else ``RANK_n`` -> n, else 999.
    ``sql``: ``coalesce(try_cast(regexp_extract(.., 'RANK_([0-9]+)')), 0)``.
    """
    s = col(series)
    n = F.regexp_extract(s, r"RANK_(\d+)", 1).try_cast("int")
    if variant == "front_or_rank":
        return F.when(s.contains("_FRONT_"), F.lit(0)).otherwise(F.coalesce(n, F.lit(0)))
    if variant == "sortable":
        return F.when(s.contains("FRONT"), F.lit(0)).otherwise(F.coalesce(n, F.lit(999)))
    if variant == "sql":
        return F.coalesce(n, F.lit(0))
    raise ValueError(f"unknown variant {variant!r}")


def roll_code(strategy) -> Column:
    """calendar* -> c, volume* -> v, open-interest*/open_interest* -> o, else c."""
    s = F.lower(col(strategy))
    return (F.when(s.startswith("calendar"), F.lit("c"))
            .when(s.startswith("volume"), F.lit("v"))
            .when(s.startswith("open-interest") | s.startswith("open_interest"), F.lit("o"))
            .otherwise(F.lit("c")))


def continuous_symbol(root, rank, strategy) -> Column:
    return F.concat_ws(".", col(root), roll_code(strategy), col(rank).cast("string"))


def roll_code_table(spark) -> DataFrame:
    """The reverse metadata of the roll codes as a tiny DataFrame."""
    return spark.createDataFrame(ROLL_CODES, "roll_code string, roll_strategy string, roll_rule_desc string, folder string")


def parse_ranks(ranks) -> Column:
    """Rank spec text (``"0-3,5"``, ``"2"``) -> sorted distinct int array.
    A range whose start exceeds its end raises an error at run time."""
    parts = F.filter(F.transform(F.split(col(ranks), ","), lambda p: F.trim(p)), lambda p: p != "")

    def one(p):
        a = F.trim(F.split_part(p, F.lit("-"), F.lit(1))).cast("int")
        b = F.trim(F.regexp_extract(p, r"^[^-]*-(.*)$", 1)).cast("int")
        rng = F.when(a > b, F.raise_error(F.concat(F.lit("Invalid rank range '"), p, F.lit("' (start > end)."))).cast("array<int>")) \
            .otherwise(F.sequence(a, b))
        return F.when(p.contains("-"), rng).otherwise(F.array(p.cast("int")))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, one))))


def imm_date(year, month) -> Column:
    """Third Wednesday of (year, month); null for years that no date has."""
    y = col(year)
    first = F.make_date(F.when(y.between(1, 9999), y).cast("int"), col(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "Wed"), 14)


def is_option_symbol(symbol="symbol") -> Column:
    return F.coalesce(col(symbol).rlike(OPTION_FILTER_RE), F.lit(False))


def is_continuous_symbol(symbol="symbol", code: str = "c") -> Column:
    return F.coalesce(col(symbol).rlike(rf"\.{code}\.\d+"), F.lit(False))


def is_calendar_spread(symbol="symbol") -> Column:
    return F.coalesce(col(symbol).contains("-"), F.lit(False))
