"""Column helpers: parsers, booleans, dates, whitespace, bins, clip (FIXTURES section 4)."""

import math

from pyspark.sql import functions as F

from claimlens.functions import expr as X

AMOUNTS = [".000000000000", " 12 ", "1e3", "x", "NaN", None, "", "1,234.5", "12,5", "-5", "-5.5x", "R 1 200"]


def _one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_amount_parsers(spark):
    p7 = _one(spark, AMOUNTS, X.amount_strip_commas)
    assert p7 == [0.0, 12.0, 1000.0, None, None, None, None, 1234.5, 125.0, -5.0, None, None]
    p8 = _one(spark, AMOUNTS, X.amount_first_token)
    # integer tokens lose their sign, '1,234.5' -> 1, '12,5' is a decimal comma
    assert p8 == [0.0, 12.0, 1.0, None, None, None, None, 1.0, 12.5, 5.0, -5.5, 1.0]
    p9 = _one(spark, AMOUNTS, X.amount_digits_only)
    assert p9 == [0.0, 12.0, 13.0, 0.0, 0.0, 0.0, 0.0, 1234.5, 125.0, -5.0, -5.5, 1200.0]


def test_bool_from_text(spark):
    vals = ["Yes", "y", "TRUE", "1", "no", "N", "false", "0", "More than 6 months", None]
    assert _one(spark, vals, X.bool_from_text) == [True] * 4 + [False] * 4 + [None, None]


def test_parse_timestamp(spark):
    out = _one(spark, ["2015-03-01 00:00:00", "6/2002", "bad", None], X.parse_timestamp)
    assert str(out[0]) == "2015-03-01 00:00:00" and str(out[1]) == "2002-06-01 00:00:00"
    assert out[2] is None and out[3] is None


def test_squish(spark):
    assert _one(spark, ["  a   b ", "a\t\tb", None], X.squish) == ["a b", "a b", None]


def test_gender_and_zip(spark):
    assert _one(spark, ["M", "male", "FEMALE", "f", "1", "0", "Not specified", None], X.gender_norm) == \
        ["Male", "Male", "Female", "Female", "Male", "Female", None, None]
    assert _one(spark, ["1459", "AB 1234 56", "12", None], X.zip_prefix) == ["1459", "1234", None, None]


def test_fixed_bins_include_lowest(spark):
    ages = [0.0, 3.0, 3.5, 7.0, 12.0, 20.0, 100.0, None]
    inc = _one(spark, ages, lambda c: X.fixed_bins(c, [0, 3, 7, 12, 20, 100], list("ABCDE"), True), "double")
    assert inc == ["A", "A", "B", "B", "C", "D", "E", None]
    exc = _one(spark, ages, lambda c: X.fixed_bins(c, [0, 3, 7, 12, 20, 100], list("ABCDE"), False), "double")
    assert exc[0] is None and exc[1] == "A"


def test_clip_keeps_null_and_safe_div(spark):
    assert _one(spark, [None, -1.0, 5.0], lambda c: X.clip(c, 0.0, 2.0), "double") == [None, 0.0, 2.0]
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (4.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(X.safe_div("a", "b")).collect()] == [None, None, 2.0]


def test_norm_ppf_column(spark):
    ps = [0.001, 0.025, 0.5, 0.975, 0.999]
    got = _one(spark, ps, X.norm_ppf, "double")
    from statistics import NormalDist
    for p, g in zip(ps, got):
        assert math.isclose(g, NormalDist().inv_cdf(p), abs_tol=1e-8)
