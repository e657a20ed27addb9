"""Docstring pairs and symbol edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickvault.functions import symbols as S


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(expr.alias("r")).first()["r"]


def test_continuous_symbol(spark):
    r = one(spark, S.parse_continuous_symbol("s"), s="ES.c.1")
    assert (r["root"], r["rank"]) == ("ES", 1)
    r = one(spark, S.parse_continuous_symbol("s"), s="ES")
    assert (r["root"], r["rank"]) == ("ES", 0)
    r = one(spark, S.parse_continuous_symbol("s"), s="ES.x.1")
    assert (r["root"], r["rank"]) == ("ES.x.1", 0)
    r = one(spark, S.parse_continuous_symbol("s"), s="ES.v.abc")
    assert (r["root"], r["rank"]) == ("ES", 0)


def test_make_contract_series(spark):
    df = spark.createDataFrame([("ES", "calendar-2d", 0), ("SR3", "open interest", 2)], "root string, s string, r int")
    got = [r[0] for r in df.select(S.make_contract_series("root", "s", "r")).collect()]
    assert got == ["ES_FRONT_CALENDAR_2D", "SR3_RANK_2_OPEN_INTEREST"]


def test_native_symbol(spark):
    r = one(spark, S.parse_native_symbol("s"), s="SR3H25")
    assert (r["root"], r["month"], r["year"]) == ("SR3", 3, 2025)
    r = one(spark, S.parse_native_symbol("s"), s="ESH6")
    assert (r["root"], r["month"], r["year"]) == ("ES", 3, 2006)     # coded rule: 2000 + d
    r = one(spark, S.parse_native_symbol("s", single_digit_base=2020), s="ESH6")
    assert r["year"] == 2026                                          # documented rule
    r = one(spark, S.parse_native_symbol("s"), s="ZNZ99")
    assert r["year"] == 1999
    assert one(spark, S.parse_native_symbol("s"), s="SYM349").year == 2249
    far = one(spark, S.parse_native_symbol("s"), s="ESM2147483647")
    assert far.year == 2147485547 and one(spark, S.parse_native_symbol("s"), s="ESM" + "9" * 30).year is None
    assert one(spark, S.imm_date(S.parse_native_symbol("s")["year"], S.parse_native_symbol("s")["month"]), s="ESM2147483647") is None
    for bad in ["ES", "X", "ESH6-ESM6"]:
        assert one(spark, S.parse_native_symbol("s"), s=bad) is None


def test_option_and_future_symbols(spark):
    r = one(spark, S.parse_option_symbol("s"), s="ESZ5 C6000")
    assert (r["root"], r["put_call"], r["strike"], r["expiry"]) == ("ES", "C", 6000.0, dt.date(2025, 12, 15))
    r = one(spark, S.parse_future_symbol("s"), s="ESZ5")
    assert (r["root"], r["expiry"]) == ("ES", dt.date(2025, 12, 15))
    # unknown month letter -> January (reference rule), strict -> null month
    r = one(spark, S.parse_future_symbol("s"), s="ESA5")
    assert r["expiry"] == dt.date(2025, 1, 15)
    assert one(spark, S.parse_native_symbol("s"), s="SYM349").year == 2249
    far = one(spark, S.parse_native_symbol("s"), s="ESM2147483647")
    assert far.year == 2147485547 and one(spark, S.parse_native_symbol("s"), s="ESM" + "9" * 30).year is None
    assert one(spark, S.imm_date(S.parse_native_symbol("s")["year"], S.parse_native_symbol("s")["month"]), s="ESM2147483647") is None
    for bad in ["ES", "X", "ESH6-ESM6"]:
        assert one(spark, S.parse_future_symbol("s"), s=bad) is None
        assert one(spark, S.parse_option_symbol("s"), s=bad) is None


def test_ranks(spark):
    assert one(spark, S.parse_ranks("r"), r="0-3,5") == [0, 1, 2, 3, 5]
    assert one(spark, S.parse_ranks("r"), r=" 2 , 0-1,1") == [0, 1, 2]
    with pytest.raises(Exception):
        one(spark, S.parse_ranks("r"), r="3-1")


def test_imm_date(spark):
    df = spark.createDataFrame([(2025, 3), (2024, 5)], "y int, m int")
    got = [r[0] for r in df.select(S.imm_date("y", "m")).collect()]
    assert got == [dt.date(2025, 3, 19), dt.date(2024, 5, 15)]


def test_roll_code_and_series_rank(spark):
    df = spark.createDataFrame([("calendar-2d",), ("Volume",), ("open_interest",), ("other",)], "s string")
    assert [r[0] for r in df.select(S.roll_code("s")).collect()] == ["c", "v", "o", "c"]
    df = spark.createDataFrame([("ES_FRONT_CALENDAR",), ("SR3_RANK_12_CALENDAR",), ("VX_X",)], "s string")
    assert [r[0] for r in df.select(S.series_rank("s", "sortable")).collect()] == [0, 12, 999]
    assert [r[0] for r in df.select(S.series_rank("s", "sql")).collect()] == [0, 12, 0]
