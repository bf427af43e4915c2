"""Cleaning semantics and profile statistics against FIXTURES values."""

import math

from pyspark.sql import functions as F

from claimlens.operators import clean as C
from claimlens.operators import profile as P


def test_describe_matches_pandas(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 2.0, 2.0, 3.0, 10.0, None, 7.0, 8.0]], "x double")
    r = P.describe(df, ["x"]).first()
    assert r["q50"] == 3.0 and r["q25"] == 2.0 and r["count"] == 7
    assert math.isclose(r["skewness"], 0.517283, abs_tol=1e-6)
    assert math.isclose(r["kurtosis"], -1.762293, abs_tol=1e-6)
    assert math.isclose(r["std"], 3.545621, abs_tol=1e-6)
    even = spark.createDataFrame([(x,) for x in [1.0, 2.0, 3.0, 10.0]], "x double")
    assert P.describe(even, ["x"]).first()["q50"] == 2.5


def test_correlation_guards(spark):
    const = spark.createDataFrame([(float(i), 1.0) for i in range(5)], "a double, b double")
    rows = {(r.col_a, r.col_b): r.r for r in P.correlation_matrix(const, ["a", "b"]).collect()}
    assert rows[("a", "b")] is None and math.isclose(rows[("a", "a")], 1.0)
    pw = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 4.0)], "a double, b double")
    rows = {(r.col_a, r.col_b): r.r for r in P.correlation_matrix(pw, ["a", "b"]).collect()}
    assert math.isclose(rows[("a", "b")], 0.785714, abs_tol=1e-6)


def test_winsorize_zero_inflated(spark):
    rows = [(0.0,)] * 997 + [(100.0,), (200.0,), (300.0,)]
    df = spark.createDataFrame(rows, "c double")
    flat = C.winsorize_upper(df, "c", 0.99)
    assert flat.agg(F.max("c")).first()[0] == 0.0          # the flat variant kills every claim
    pop = C.winsorize_upper(df, "c", 0.99, population=F.col("c") > 0)
    assert pop.where("c > 0").count() == 3 and pop.agg(F.max("c")).first()[0] < 300.0


def test_loss_ratio_null_on_zero_premium(spark):
    df = spark.createDataFrame([(0.0, 5.0), (-3.0, 1.0), (10.0, 0.0), (None, 1.0), (10.0, 1000.0)],
                               "TotalPremium double, TotalClaims double")
    got = [r[0] for r in C.add_row_loss_ratio(df).select("row_loss_ratio").collect()]
    assert got[0] is None and got[1] == 0.0 and got[2] == 0.0 and got[3] is None and got[4] == 10.0


def test_dedupe_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)], "PolicyID long, k string, v double")
    st = C.duplicate_stats(df).first()
    assert st["duplicate_rows"] == 1 and st["rows_sharing_key"] == 3
    assert C.dedupe(df).count() == 3
    first = C.dedupe(df, ["PolicyID"]).orderBy("PolicyID").collect()
    assert [(r.PolicyID, r.k) for r in first] == [(1, "a"), (2, "c")]


def test_group_median_impute_and_filters(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("x", None), ("y", None), (None, None)], "g string, v double")
    out = {(r.g, r.v) for r in C.impute_group_median(df, "v", "g").collect()}
    assert ("x", 2.0) in out and ("y", None) in out
    assert C.min_group_size(df, "g", 3).count() == 3
    kept, dropped = C.drop_mostly_null(df, 0.5)
    assert dropped == ["v"]
