"""Registered profile and trend queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import clean as C
from claimlens.operators import features as FE
from claimlens.operators import profile as P
from claimlens.operators import trends as TR
from claimlens.plans.registry import finish, query
from claimlens.sources.views import policy_cte, policy_view, stored_policy

CTE = policy_cte()
NUM = ["TotalPremium", "TotalClaims", "SumInsured", "cubiccapacity", "kilowatts", "CalculatedPremiumPerTerm"]
ROW_LR = ("(CASE WHEN TotalPremium = 0 OR TotalPremium IS NULL OR TotalClaims IS NULL THEN NULL "
          "ELSE LEAST(GREATEST(TotalClaims / (TotalPremium + 1e-10), 0), 10) END)")


def _pol(spark, sf):
    return policy_view(spark, sf)


DESC_DIGITS = {"mean": 4, "std": 2, "min": 4, "q25": 6, "q50": 6, "q75": 6, "max": 4, "skewness": 6,
               "kurtosis": 5, "zeros_pct": 6}


def _desc_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 2) AS std,
  round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 4) AS max, round(skewness({c}), 6) AS skewness,
  round(kurtosis({c}), 5) AS kurtosis, count_if({c} = 0) AS zeros, round(count_if({c} = 0) * 100.0 / count(*), 6) AS zeros_pct FROM policy""")
    return CTE + "\nUNION ALL\n".join(parts)


@query("a10_a11_describe", _desc_sql(NUM))
def a10_a11_describe(spark, sf):
    return finish(P.describe(stored_policy(spark, sf, NUM), NUM), DESC_DIGITS)


@query("a40_distribution_stats", CTE + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(median({c}), 6) AS median, round(stddev_samp({c}), 2) AS std,
  round(skewness({c}), 6) AS skewness, count({c}) AS count FROM policy HAVING count({c}) > 10 AND stddev_samp({c}) > 0""" for c in NUM) + ")")
def a40_distribution_stats(spark, sf):
    return finish(P.distribution_stats(stored_policy(spark, sf, NUM), NUM), {"mean": 4, "median": 6, "std": 2, "skewness": 6})


@query("a12_claim_distribution", CTE + """SELECT count(*) AS n_rows, count_if(TotalClaims > 0) AS n_claims,
  round(count_if(TotalClaims > 0) * 100.0 / count(*), 6) AS claim_pct,
  round(min(CASE WHEN TotalClaims > 0 THEN TotalClaims END), 4) AS min_claim, round(max(CASE WHEN TotalClaims > 0 THEN TotalClaims END), 4) AS max_claim,
  round(avg(CASE WHEN TotalClaims > 0 THEN TotalClaims END), 4) AS mean_claim, round(median(CASE WHEN TotalClaims > 0 THEN TotalClaims END), 6) AS median_claim,
  round(stddev_pop(CASE WHEN TotalClaims > 0 THEN TotalClaims END), 2) AS std_claim FROM policy""")
def a12_claim_distribution(spark, sf):
    return finish(P.claim_distribution(_pol(spark, sf)), {"claim_pct": 6, "std_claim": 2, "median_claim": 6}, default=4)


@query("a13_claim_summary", CTE + """, c AS (SELECT * FROM policy WHERE TotalClaims > 0)
SELECT count(*) AS n_rows, round(sum(TotalClaims), 2) AS claims_sum, round(avg(TotalClaims), 4) AS claims_mean,
  round(median(TotalClaims), 6) AS claims_median, round(stddev_samp(TotalClaims), 2) AS claims_std,
  round(quantile_cont(TotalClaims, 0.25), 6) AS p25, round(quantile_cont(TotalClaims, 0.5), 6) AS p50,
  round(quantile_cont(TotalClaims, 0.75), 6) AS p75, round(quantile_cont(TotalClaims, 0.9), 6) AS p90,
  round(quantile_cont(TotalClaims, 0.95), 6) AS p95, round(quantile_cont(TotalClaims, 0.99), 6) AS p99,
  round(sum(TotalPremium), 2) AS premium_sum, round(avg(TotalPremium), 4) AS premium_mean,
  round(sum(TotalClaims) / sum(TotalPremium) * 100, 6) AS loss_ratio_pct FROM c""")
def a13_claim_summary(spark, sf):
    d = C.claims_filter(_pol(spark, sf), "positive")
    return finish(P.claim_summary(d), {"claims_sum": 2, "premium_sum": 2, "claims_std": 2, "loss_ratio_pct": 6,
                                       "claims_median": 6, "p25": 6, "p50": 6, "p75": 6, "p90": 6, "p95": 6, "p99": 6},
                  default=4)


MISS_COLS = ["Gender", "SumInsured", "cubiccapacity", "Province", "TotalClaims"]


@query("a15_missing_profile", CTE + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count_if({c} IS NULL{' OR isnan(' + c + ')' if c in ('SumInsured', 'cubiccapacity', 'TotalClaims') else ''}) AS missing,
  round(count_if({c} IS NULL) * 100.0 / count(*), 6) AS missing_pct FROM policy""" for c in MISS_COLS))
def a15_missing_profile(spark, sf):
    return finish(P.missing_profile(_pol(spark, sf), MISS_COLS))


PROF_COLS = ["Province", "Gender", "CoverType", "make", "PostalCode", "LegalType", "RegistrationYear", "CoverSeq"]


def _prof_sql():
    parts = []
    for c in PROF_COLS:
        parts.append(f"""SELECT '{c}' AS "column", (SELECT count_if({c} IS NULL) FROM policy) AS missing,
  (SELECT round(count_if({c} IS NULL) * 100.0 / count(*), 6) FROM policy) AS missing_pct,
  (SELECT count(DISTINCT {c}) FROM policy) AS "unique",
  (SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS f FROM policy WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY f DESC, v LIMIT 1)) AS top,
  (SELECT max(f) FROM (SELECT count(*) AS f FROM policy WHERE {c} IS NOT NULL GROUP BY {c})) AS top_freq,
  (SELECT count(*) FROM policy) AS n_rows""")
    return CTE + "\nUNION ALL\n".join(parts)


@query("a16_a18_column_profile", _prof_sql())
def a16_a18_column_profile(spark, sf):
    d = P.column_profile(_pol(spark, sf).select(*PROF_COLS))
    return finish(d.select("column", "missing", "missing_pct", "unique", "top", "top_freq", "n_rows"))


@query("a17_column_info", CTE + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "unique", count_if({c} IS NULL) AS missing,
  CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM policy""" for c in PROF_COLS))
def a17_column_info(spark, sf):
    return finish(P.column_info(_pol(spark, sf), PROF_COLS).drop("dtype"))


@query("a20_quality_rules", CTE + """, d AS (SELECT PolicyID, count(*) AS k FROM policy GROUP BY PolicyID),
r AS (SELECT 'future_dates' AS rule, CAST(count_if(TransactionMonth > TIMESTAMP '2026-01-01 00:00:00') AS DOUBLE) AS value FROM policy UNION ALL
  SELECT 'negative_TotalPremium', count_if(TotalPremium < 0) FROM policy UNION ALL
  SELECT 'negative_TotalClaims', count_if(TotalClaims < 0) FROM policy UNION ALL
  SELECT 'negative_SumInsured', count_if(SumInsured < 0) FROM policy UNION ALL
  SELECT 'claims_exceed_sum_insured', count_if(TotalClaims > SumInsured) FROM policy UNION ALL
  SELECT 'missing_pct_PolicyID', count_if(PolicyID IS NULL) * 100.0 / count(*) FROM policy UNION ALL
  SELECT 'missing_pct_TransactionMonth', count_if(TransactionMonth IS NULL) * 100.0 / count(*) FROM policy UNION ALL
  SELECT 'missing_pct_TotalPremium', count_if(TotalPremium IS NULL) * 100.0 / count(*) FROM policy UNION ALL
  SELECT 'duplicate_keys', coalesce(sum(CASE WHEN k > 1 THEN k END), 0) FROM d)
SELECT rule, round(value, 6) AS value, CASE WHEN rule LIKE 'missing_pct_%' THEN value > 5 ELSE value > 0 END AS violated FROM r""")
def a20_quality_rules(spark, sf):
    return finish(P.quality_rules(_pol(spark, sf)))


@query("a21_invalid_values", CTE + f"""SELECT count_if(TotalPremium < 0) AS negative_premium, count_if(TotalClaims < 0) AS negative_claims,
  count_if({ROW_LR} < 0 OR {ROW_LR} > 10) AS ratio_out_of_range, count_if(TotalClaims = 0) AS zero_claims FROM policy""")
def a21_invalid_values(spark, sf):
    return finish(P.invalid_values(C.add_row_loss_ratio(_pol(spark, sf))))


@query("a24_histogram_premium", CTE + """, m AS (SELECT min(TotalPremium) AS lo, max(TotalPremium) AS hi FROM policy),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((TotalPremium - lo) / ((hi - lo) / 50)), 49) END AS BIGINT) AS bin, lo, hi
      FROM policy, m WHERE TotalPremium IS NOT NULL)
SELECT bin, round(lo + bin * (hi - lo) / 50, 4) AS lower, round(lo + (bin + 1) * (hi - lo) / 50, 4) AS upper, count(*) AS n FROM b GROUP BY bin, lo, hi""")
def a24_histogram_premium(spark, sf):
    return finish(P.histogram(_pol(spark, sf), "TotalPremium", 50), default=4)


@query("a25_density_2d", CTE + """, d AS (SELECT SumInsured AS x, TotalPremium AS y FROM policy WHERE SumInsured IS NOT NULL AND TotalPremium IS NOT NULL),
m AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM d)
SELECT CAST(CASE WHEN xh = xl THEN 0 ELSE least(floor((x - xl) / ((xh - xl) / 50)), 49) END AS BIGINT) AS bx,
  CAST(CASE WHEN yh = yl THEN 0 ELSE least(floor((y - yl) / ((yh - yl) / 50)), 49) END AS BIGINT) AS "by", count(*) AS n FROM d, m GROUP BY 1, 2""")
def a25_density_2d(spark, sf):
    return finish(P.density_2d(_pol(spark, sf), "SumInsured", "TotalPremium"))


@query("a26_box_stats_by_cover", CTE + """, q AS (SELECT CoverType, quantile_cont(TotalPremium, 0.25) AS q1, quantile_cont(TotalPremium, 0.5) AS median,
  quantile_cont(TotalPremium, 0.75) AS q3, min(TotalPremium) AS mn, max(TotalPremium) AS mx FROM policy WHERE TotalPremium IS NOT NULL AND CoverType IS NOT NULL GROUP BY CoverType),
j AS (SELECT p.TotalPremium AS v, q.* FROM policy p JOIN q ON p.CoverType = q.CoverType WHERE p.TotalPremium IS NOT NULL)
SELECT 'TotalPremium' AS "column", CoverType, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
  round(min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END), 4) AS whisker_low, round(max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END), 4) AS whisker_high,
  count_if(v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM j GROUP BY CoverType, q1, median, q3, mn, mx HAVING mx > mn""")
def a26_box_stats_by_cover(spark, sf):
    return finish(P.box_stats(_pol(spark, sf), ["TotalPremium"], by="CoverType"),
                  {"q1": 6, "median": 6, "q3": 6, "iqr": 6}, default=4)


OUT_COLS = ["TotalPremium", "TotalClaims", "SumInsured", "CalculatedPremiumPerTerm"]


@query("a27_iqr_outliers", CTE + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers,
  round(count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 / count({c}), 6) AS outlier_pct,
  round(q1, 6) AS "Q1", round(q3, 6) AS "Q3", round(q3 - q1, 6) AS "IQR"
FROM policy, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM policy) GROUP BY q1, q3""" for c in OUT_COLS))
def a27_iqr_outliers(spark, sf):
    return finish(P.iqr_outliers(stored_policy(spark, sf, OUT_COLS), OUT_COLS), {"outlier_pct": 6}, default=6)


@query("a28_outlier_impact", CTE + """, q AS (SELECT quantile_cont(CalculatedPremiumPerTerm, 0.25) AS q1, quantile_cont(CalculatedPremiumPerTerm, 0.75) AS q3,
  count(CalculatedPremiumPerTerm) AS n, stddev_samp(CalculatedPremiumPerTerm) AS sd FROM policy),
j AS (SELECT *, CalculatedPremiumPerTerm IS NOT NULL AND (CalculatedPremiumPerTerm < q1 - 1.5 * (q3 - q1) OR CalculatedPremiumPerTerm > q3 + 1.5 * (q3 - q1)) AS o FROM policy, q)
SELECT n AS n_values, count_if(o) AS n_outliers, round(count_if(o) * 100.0 / n, 6) AS outlier_pct,
  round(avg(CASE WHEN o THEN CalculatedPremiumPerTerm END), 4) AS outlier_mean, round(max(CASE WHEN o THEN CalculatedPremiumPerTerm END), 4) AS outlier_max,
  round(CASE WHEN sum(TotalClaims) > 0 THEN sum(CASE WHEN o THEN TotalClaims END) * 100.0 / sum(TotalClaims) END, 6) AS claims_share_pct
FROM j GROUP BY n, sd, q1, q3 HAVING n > 10 AND sd > 0 AND q3 - q1 > 0""")
def a28_outlier_impact(spark, sf):
    return finish(P.outlier_impact(stored_policy(spark, sf, ["CalculatedPremiumPerTerm", "TotalClaims"]), "CalculatedPremiumPerTerm"), {"outlier_mean": 4, "outlier_max": 4})


CORR_COLS = ["TotalPremium", "TotalClaims", "SumInsured", "cubiccapacity", "kilowatts", "CalculatedPremiumPerTerm",
             "CapitalOutstanding"]


def _corr_sql(a, b):
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    xa, xb = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
    return (f"CASE WHEN stddev_samp({xa}) * stddev_samp({xb}) = 0 THEN NULL "
            f"ELSE covar_samp({xa}, {xb}) / (stddev_samp({xa}) * stddev_samp({xb})) END")


@query("a29_correlation_matrix", CTE + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({_corr_sql(a, b)}, 6) AS r FROM policy" for a in CORR_COLS for b in CORR_COLS))
def a29_correlation_matrix(spark, sf):
    return finish(P.correlation_matrix(_pol(spark, sf), CORR_COLS))


@query("a30_strong_pairs", CTE + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({_corr_sql(a, b)}, 6) AS r FROM policy"
    for a in CORR_COLS for b in CORR_COLS if a < b) + ") WHERE abs(r) > 0.5")
def a30_strong_pairs(spark, sf):
    return finish(P.strong_pairs(P.correlation_matrix(_pol(spark, sf), CORR_COLS)))


@query("a31_pair_profile", CTE + """, d AS (SELECT * FROM policy WHERE SumInsured IS NOT NULL AND TotalPremium IS NOT NULL)
SELECT count(*) AS n, round(min(SumInsured), 4) AS min_a, round(max(SumInsured), 4) AS max_a, round(min(TotalPremium), 4) AS min_b,
  round(max(TotalPremium), 4) AS max_b, round(avg(SumInsured), 4) AS mean_a, round(avg(TotalPremium), 4) AS mean_b,
  round(covar_samp(SumInsured, TotalPremium) / (stddev_samp(SumInsured) * stddev_samp(TotalPremium)), 6) AS r FROM d""")
def a31_pair_profile(spark, sf):
    return finish(P.pair_profile(_pol(spark, sf), "SumInsured", "TotalPremium"), {"r": 6}, default=4)


@query("a32_linear_trend_age_loss", CTE + f""", d AS (SELECT CAST(least(greatest(year(TransactionMonth) - RegistrationYear, 0), 50) AS DOUBLE) AS x,
  {ROW_LR} AS y FROM policy), e AS (SELECT * FROM d WHERE x IS NOT NULL AND y IS NOT NULL),
a AS (SELECT count(*) AS n, covar_samp(x, y) / (stddev_samp(x) * stddev_samp(y)) AS r, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM e)
SELECT n, round(r, 6) AS r, round(CASE WHEN abs(r) > 0.0 THEN s END, 8) AS slope, round(CASE WHEN abs(r) > 0.0 THEN i END, 6) AS intercept FROM a""")
def a32_linear_trend_age_loss(spark, sf):
    d = C.add_vehicle_age(C.add_row_loss_ratio(_pol(spark, sf)))
    return finish(TR.linear_trend(d, "VehicleAge", "row_loss_ratio", min_abs_r=0.0), {"slope": 8})


MONTHLY_SQL = CTE + """, g AS (SELECT date_trunc('month', TransactionMonth) AS month, sum(TotalPremium) AS total_premium, sum(TotalClaims) AS total_claims,
  count(PolicyID) AS policy_count, count_if(TotalClaims > 0) AS nc FROM policy WHERE TransactionMonth IS NOT NULL GROUP BY 1)
"""


@query("a33_a34_monthly_series", MONTHLY_SQL + """SELECT month, round(total_premium, 2) AS total_premium, round(total_claims, 2) AS total_claims, policy_count,
  round(total_claims / NULLIF(total_premium, 0), 6) AS loss_ratio, round(total_claims / CASE WHEN policy_count > 0 THEN policy_count ELSE 1 END, 4) AS average_claim,
  round(coalesce(nc / policy_count, 0), 6) AS claim_frequency FROM g""")
def a33_a34_monthly_series(spark, sf):
    return finish(TR.monthly_series(_pol(spark, sf)), {"total_premium": 2, "total_claims": 2, "average_claim": 4})


@query("a35_monthly_by_cover", CTE + """, g AS (SELECT CoverType, date_trunc('month', TransactionMonth) AS month, sum(TotalPremium) AS sp, sum(TotalClaims) AS sc
  FROM policy WHERE CoverType IS NOT NULL AND TransactionMonth IS NOT NULL GROUP BY 1, 2)
SELECT CoverType, month, round(sp, 2) AS sum_TotalPremium, round(sc, 2) AS sum_TotalClaims,
  round(sp - lag(sp) OVER (PARTITION BY CoverType ORDER BY month), 2) AS change_TotalPremium,
  round(sc - lag(sc) OVER (PARTITION BY CoverType ORDER BY month), 2) AS change_TotalClaims FROM g""")
def a35_monthly_by_cover(spark, sf):
    return finish(TR.monthly_sums_by_group(_pol(spark, sf), "CoverType", ["TotalPremium", "TotalClaims"]), default=2)


@query("a36_monthly_slopes", MONTHLY_SQL + """, s AS (SELECT *, total_claims / NULLIF(total_premium, 0) AS lr, CAST(row_number() OVER (ORDER BY month) - 1 AS DOUBLE) AS pos FROM g),
l AS (SELECT lr, CAST(row_number() OVER (ORDER BY month) - 1 AS DOUBLE) AS pos FROM s WHERE lr IS NOT NULL)
SELECT (SELECT count(*) FROM s) AS n_months, (SELECT round(CASE WHEN stddev_samp(total_premium) > 0 THEN regr_slope(total_premium, pos) END, 2) FROM s) AS premium_slope,
  (SELECT round(CASE WHEN stddev_samp(total_claims) > 0 THEN regr_slope(total_claims, pos) END, 2) FROM s) AS claims_slope,
  (SELECT round(CASE WHEN count(*) >= 2 AND stddev_samp(lr) > 0 THEN regr_slope(lr, pos) END, 8) FROM l) AS loss_ratio_slope""")
def a36_monthly_slopes(spark, sf):
    return finish(TR.monthly_slopes(TR.monthly_series(_pol(spark, sf))),
                  {"premium_slope": 2, "claims_slope": 2, "loss_ratio_slope": 8})


@query("a37_recent_direction", MONTHLY_SQL + """, s AS (SELECT month, total_claims, row_number() OVER (ORDER BY month DESC) AS b FROM g),
a AS (SELECT count(*) AS n_months, avg(CASE WHEN b <= 6 THEN total_claims END) AS recent_avg,
  avg(CASE WHEN b > 6 AND b <= 12 THEN total_claims END) AS p12, avg(CASE WHEN b > 6 THEN total_claims END) AS pall,
  min(month) AS first_month, max(month) AS last_month, arg_min(total_claims, month) AS first_value, arg_max(total_claims, month) AS last_value FROM s)
SELECT n_months, round(recent_avg, 2) AS recent_avg, first_month, last_month, round(first_value, 2) AS first_value, round(last_value, 2) AS last_value,
  round(CASE WHEN n_months >= 12 THEN p12 ELSE pall END, 2) AS previous_avg,
  CASE WHEN recent_avg > CASE WHEN n_months >= 12 THEN p12 ELSE pall END THEN 'increasing' ELSE 'decreasing' END AS direction FROM a WHERE n_months >= 6""")
def a37_recent_direction(spark, sf):
    return finish(TR.recent_direction(TR.monthly_series(_pol(spark, sf))), default=2)


@query("j2_claim_rate_by_month", CTE + """SELECT date_trunc('month', TransactionMonth) AS month, count_if(TotalClaims > 0) AS n_claims, count(*) AS n_policies,
  round(count_if(TotalClaims > 0) / count(*), 6) AS claim_rate FROM policy GROUP BY 1""")
def j2_claim_rate_by_month(spark, sf):
    return finish(TR.claim_rate_by_month(_pol(spark, sf)))


@query("a39_claim_sign_distribution", CTE + """SELECT count_if(TotalClaims > 0) AS n_positive, count_if(TotalClaims = 0) AS n_zero, count_if(TotalClaims < 0) AS n_negative,
  round(count_if(TotalClaims > 0) * 100.0 / count(*), 6) AS pct_positive, round(count_if(TotalClaims = 0) * 100.0 / count(*), 6) AS pct_zero,
  round(count_if(TotalClaims < 0) * 100.0 / count(*), 6) AS pct_negative, round(min(TotalClaims), 4) AS min_value,
  round(max(TotalClaims), 4) AS max_value, round(avg(TotalClaims), 4) AS mean_value FROM policy""")
def a39_claim_sign_distribution(spark, sf):
    return finish(P.claim_sign_distribution(_pol(spark, sf)), {"min_value": 4, "max_value": 4, "mean_value": 4})


@query("a41_contingency_province_claim", CTE + """SELECT Province, count_if(NOT (TotalClaims > 0)) AS n_0, count_if(TotalClaims > 0) AS n_1
FROM policy WHERE Province IS NOT NULL GROUP BY Province""")
def a41_contingency_province_claim(spark, sf):
    d = C.add_risk_metrics(_pol(spark, sf))
    t = P.contingency(d, "Province", "HasClaim", values=[0, 1])
    return finish(t.select("Province", F.col("0").alias("n_0"), F.col("1").alias("n_1")))


@query("a42_zip_margin_top_bottom", CTE + """, g AS (SELECT regexp_extract(PostalCode, '([0-9]{3,4})', 1) AS ZipPrefix, avg(TotalPremium - TotalClaims) AS mean_value, count(*) AS n
  FROM policy GROUP BY 1), t AS (SELECT ZipPrefix FROM g ORDER BY mean_value DESC NULLS LAST, ZipPrefix LIMIT 5),
b AS (SELECT ZipPrefix FROM g ORDER BY mean_value ASC NULLS FIRST, ZipPrefix DESC LIMIT 5)
SELECT ZipPrefix, round(mean_value, 4) AS mean_value, n, ZipPrefix IN (SELECT * FROM t) AS is_top, ZipPrefix IN (SELECT * FROM b) AS is_bottom
FROM g WHERE ZipPrefix IN (SELECT * FROM t) OR ZipPrefix IN (SELECT * FROM b)""")
def a42_zip_margin_top_bottom(spark, sf):
    d = C.add_risk_metrics(FE.add_zip_prefix(_pol(spark, sf)))
    return finish(P.group_means_ranked(d, "ZipPrefix", "Margin", 5), {"mean_value": 4})
