"""Test statistics and distribution tails."""

import math

from pyspark.sql import functions as F

from claimlens.functions import dist as D
from claimlens.operators import hypothesis as H


def _two_by_two(spark, a1, a0, b1, b0):
    rows = [("A", 1)] * a1 + [("A", 0)] * a0 + [("B", 1)] * b1 + [("B", 0)] * b0
    return spark.createDataFrame(rows, "g string, y int")


def test_chi_square_yates(spark):
    df = _two_by_two(spark, 10, 20, 30, 5)
    r = H.two_by_two(df, "g", "y", "A", "B").first()
    assert math.isclose(r["statistic"], 16.578482, abs_tol=1e-6)
    k2 = H.chi_square_k2(df, "g", "y", min_count=1).first()
    assert math.isclose(k2["statistic"], 16.578482, abs_tol=1e-6) and k2["dof"] == 1
    assert math.isclose(r["p_value"], D.chi2_sf(r["statistic"], 1), rel_tol=1e-9)
    nocorr = H.chi_square_k2(df, "g", "y", min_count=1, yates=False).first()
    assert math.isclose(nocorr["statistic"], 18.726190, abs_tol=1e-6)


def test_fisher_on_zero_cell(spark):
    r = H.two_by_two(_two_by_two(spark, 12, 0, 7, 5), "g", "y", "A", "B").first()
    assert r["test_type"] == "Fisher's Exact Test" and 0 < r["p_value"] < 0.05


def test_anova_and_tukey(spark):
    groups = {"a": [1, 2, 3, 4, 5], "b": [2, 3, 4, 5, 6], "c": [6, 7, 8, 9, 10], "d": [1, 1, 1, 1]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double")
    r = H.anova(df, "g", "x").first()
    # 'd' has 4 values < min_per_group = 5 and is dropped: SSB 70, SSW 30 -> F(2, 12) = 14
    assert r["n_groups"] == 3 and math.isclose(r["statistic"], 14.0, rel_tol=1e-9)
    assert math.isclose(r["effect_size"], 0.7, rel_tol=1e-9)
    assert math.isclose(r["p_value"], D.f_sf(14.0, 2, 12), rel_tol=1e-9)
    pairs = H.tukey_hsd(df, "g", "x").collect()
    assert len(pairs) == 3 and all(0 <= p["p_value"] <= 1 for p in pairs)


def test_t_tests_and_mann_whitney(spark):
    a = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    b = [2.0, 4.0, 6.0, 8.0, 10.0, 12.0, 14.0]
    df = spark.createDataFrame([("A", x) for x in a] + [("B", x) for x in b], "g string, x double")
    w = H.t_test(df, "g", "x", "A", "B", welch=True).first()
    m1, m2 = sum(a) / len(a), sum(b) / len(b)
    v1 = sum((x - m1) ** 2 for x in a) / 5
    v2 = sum((x - m2) ** 2 for x in b) / 6
    t = (m1 - m2) / math.sqrt(v1 / 6 + v2 / 7)
    assert math.isclose(w["statistic"], t, rel_tol=1e-9)
    mw = H.mann_whitney(df, "g", "x", "A", "B").first()
    # U1 = sum of A's average ranks - n1(n1+1)/2, ties at 2, 4, 6 share ranks
    assert math.isclose(mw["statistic"], 7.5, rel_tol=1e-9)


def test_shapiro_near_one_for_normal_scores(spark):
    from statistics import NormalDist
    xs = [NormalDist().inv_cdf((i - 0.375) / (50 + 0.25)) for i in range(1, 51)]
    df = spark.createDataFrame([("g", x) for x in xs], "k string, x double")
    r = H.shapiro_wilk(df, "k", "x").first()
    assert r["statistic"] > 0.99 and r["p_value"] > 0.5
    skew = spark.createDataFrame([("g", float(i ** 3)) for i in range(1, 51)], "k string, x double")
    assert H.shapiro_wilk(skew, "k", "x").first()["p_value"] < 0.01


def test_distribution_tails():
    assert math.isclose(D.chi2_sf(3.841458820694124, 1), 0.05, abs_tol=1e-9)
    assert math.isclose(D.t_sf2(2.0, 10), 0.0733880347, abs_tol=1e-8)
    assert math.isclose(D.f_sf(3.0, 2, 20), 1.3 ** -10, rel_tol=1e-9)
    assert math.isclose(D.t_ppf(0.975, 10), 2.228138852, abs_tol=1e-6)
    assert math.isclose(D.ttest_power(0.5, 64, 64), 0.8015, abs_tol=5e-4)
    assert 0.94 < D.studentized_range_cdf(3.5, 3, 20) < 0.95


def test_proportion_ci(spark):
    df = spark.createDataFrame([(1,)] * 30 + [(0,)] * 70, "y int")
    r = H.proportion_ci(df, "y").first()
    half = 1.959963984540054 * math.sqrt(0.3 * 0.7 / 100)
    assert math.isclose(r["ci_low"], 0.3 - half) and math.isclose(r["ci_high"], 0.3 + half)


def test_edge_frames_give_the_insufficient_row(spark):
    """empty, one group, constant values and zero cells never raise; guards give one row."""
    make = lambda rows: spark.createDataFrame(rows, "g string, y int, x double")
    frames = {"empty": make([]), "one group": make([("A", 1, 1.0)] * 40), "null": make([(None, None, None)] * 3),
              "constant": make([("A", 0, 2.0)] * 40 + [("B", 0, 2.0)] * 40), "zero cell": make([("A", 1, 1.0)] * 40 + [("B", 0, 2.0)] * 40)}
    for name, df in frames.items():
        tests = {"chi": H.chi_square_k2(df, "g", "y"), "2x2": H.two_by_two(df, "g", "y", "A", "B", min_rows=30),
                 "anova": H.anova(df, "g", "x"), "levene": H.levene(df, "g", "x"), "tukey": H.tukey_hsd(df, "g", "x"),
                 "t": H.t_test(df, "g", "x", "A", "B", welch=False), "welch": H.t_test(df, "g", "x", "A", "B"),
                 "mw": H.mann_whitney(df, "g", "x", "A", "B"), "shapiro": H.shapiro_wilk(df, "g", "x")}
        for test, res in tests.items():
            rows = res.collect()
            assert rows, (name, test)
            if name in ("empty", "null"):
                assert [r.test_type for r in rows] == [H.INSUFFICIENT], (name, test)
                assert rows[0].p_value is None and rows[0].reject_null is None
        assert H.effect_size_table(df, "g", "x", "A", "B").count() == 1
    assert H.two_by_two(frames["zero cell"], "g", "y", "A", "B").first()["test_type"] == "Fisher's Exact Test"


def test_fisher_of_large_tables():
    assert math.isclose(D.fisher_exact(3, 1, 1, 3)[1], 0.4857142857142857, rel_tol=1e-12)
    assert math.isclose(D.fisher_exact(8, 2, 1, 5)[1], 0.03496503496503495, rel_tol=1e-9)
    assert 0 <= D.fisher_exact(0, 10**9, 5 * 10**5, 10**9)[1] < 1e-300


def test_counts_beyond_bigint_products(spark):
    """Products of counts near 6e9 stay in doubles."""
    df = spark.createDataFrame([(6_000_000_000, 0.5)], "n long, r double")
    n = F.col("n").cast("double")
    assert df.select(n * (n + 1)).first()[0] > 3e19
