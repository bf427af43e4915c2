"""Registered feature-target, split, selection, model, metric and pricing queries
(P35-P44, W1, M1-M24)."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from claimlens.functions import expr as X
from claimlens.operators import clean as C
from claimlens.operators import crossval as CV
from claimlens.operators import features as FE
from claimlens.operators import ml as M
from claimlens.operators import pricing as PR
from claimlens.operators.quantiles import aggregate, quantile
from claimlens.plans import modelling as MO
from claimlens.plans.registry import finish, query
from claimlens.session import scratch_path, stored
from claimlens.sources.views import POLICY_TIE_KEYS, policy_cte, policy_view, stored_policy

CTE = policy_cte()
CTEK = policy_cte(with_keys=True)
TIES = list(POLICY_TIE_KEYS)
TIE_SQL = ", ".join(TIES)


def _pol(spark, sf, keys=False):
    return policy_view(spark, sf, with_keys=keys)


@query("p41_w1_rank_quantile_bins", CTEK + f""", c AS (SELECT * FROM policy WHERE TotalClaims > 0),
r AS (SELECT PolicyID, CoverSeq, TotalClaims, row_number() OVER (ORDER BY TotalClaims, {TIE_SQL}) AS rn, count(*) OVER () AS n FROM c)
SELECT PolicyID, CoverSeq, round(TotalClaims, 4) AS TotalClaims,
  ['VeryLow','Low','Medium','High','VeryHigh'][CAST(CASE WHEN rn <= 1 OR n <= 1 THEN 0 ELSE ((rn - 1) * 5 + (n - 2)) // (n - 1) - 1 END AS BIGINT) + 1] AS ClaimSeverityQuintile,
  CAST(CASE WHEN rn <= 1 OR n <= 1 THEN 0 ELSE ((rn - 1) * 10 + (n - 2)) // (n - 1) - 1 END AS BIGINT) AS StratifyBin FROM r""")
def p41_w1_rank_quantile_bins(spark, sf):
    d = _pol(spark, sf, keys=True).where(F.col("TotalClaims") > 0)
    b = FE.add_rank_bins(d, "TotalClaims", TIES[:], unique=True)
    return finish(b.select("PolicyID", "CoverSeq", "TotalClaims", "ClaimSeverityQuintile", "StratifyBin"), {"TotalClaims": 4})


@query("p41_equal_width_fallback", CTEK + f""", r AS (SELECT PolicyID, CoverSeq, kilowatts AS x, row_number() OVER (PARTITION BY kilowatts IS NULL ORDER BY kilowatts, {TIE_SQL}) AS rn FROM policy),
m AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS n, count_if(x IS NULL) AS gaps FROM r)
SELECT PolicyID, CoverSeq, CASE WHEN x IS NOT NULL THEN
    ['VeryLow','Low','Medium','High','VeryHigh'][CAST(CASE WHEN rn <= 1 OR n <= 1 THEN 0 ELSE ((rn - 1) * 5 + (n - 2)) // (n - 1) - 1 END AS BIGINT) + 1] END AS quintile,
  CAST(CASE WHEN x IS NULL THEN NULL WHEN gaps = 0 THEN (CASE WHEN rn <= 1 OR n <= 1 THEN 0 ELSE ((rn - 1) * 10 + (n - 2)) // (n - 1) - 1 END)
    WHEN lo = hi THEN 4 ELSE len(list_filter(list_transform(range(1, 10), lambda i: lo + i * ((hi - lo) / 10)), lambda e: e < x)) END AS BIGINT) AS StratifyBin
FROM r, m""")
def p41_equal_width_fallback(spark, sf):
    """Rank bins of a column with gaps: bins of equal width for the ids."""
    d = _pol(spark, sf, keys=True).select("PolicyID", "CoverSeq", "kilowatts", *[t for t in TIES if t not in ("PolicyID", "CoverSeq")])
    b = FE.add_rank_bins(d, "kilowatts", TIES, q5_col="quintile", gaps=True)
    return finish(b.select("PolicyID", "CoverSeq", "quintile", "StratifyBin"))


MANUAL_EDGES = [0.0, 1000.0, 5000.0, 20000.0, 50000.0, 1e9]


@query("p40_manual_edges", CTE + f""", e AS (SELECT list_distinct(quantile_cont(TotalClaims, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])) AS d FROM policy),
f AS (SELECT CASE WHEN len(d) > 5 THEN list_sort(d) ELSE {MANUAL_EDGES} END AS m FROM e)
SELECT label, count(*) AS n, round(sum(TotalClaims), 2) AS claims FROM (SELECT TotalClaims, CASE WHEN TotalClaims IS NULL OR TotalClaims < m[1] OR TotalClaims > m[6] THEN NULL
  WHEN TotalClaims <= m[2] THEN 'VeryLow' WHEN TotalClaims <= m[3] THEN 'Low' WHEN TotalClaims <= m[4] THEN 'Medium' WHEN TotalClaims <= m[5] THEN 'High' ELSE 'VeryHigh' END AS label
  FROM policy, f) GROUP BY label""")
def p40_manual_edges(spark, sf):
    """Quantile edges of a column that is mostly 0 coincide, so that manual edges are used."""
    d = _pol(spark, sf)
    edges = aggregate(d, quantile("TotalClaims", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]).alias("_e"))
    label = FE.edge_bins(F.col("TotalClaims"), F.col("_e"), ["VeryLow", "Low", "Medium", "High", "VeryHigh"], MANUAL_EDGES)
    return finish(d.crossJoin(F.broadcast(edges)).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.sum("TotalClaims").alias("claims")), default=2)


@query("p42_p44_target_transforms", CTE + """, t AS (SELECT PolicyID, CoverSeq, coalesce(TotalClaims, 0.0) AS y FROM policy),
s AS (SELECT avg(y) AS mu, stddev_samp(y) AS sd, median(y) AS med, quantile_cont(y, 0.33) AS q1, quantile_cont(y, 0.66) AS q2,
  min(y) AS mn, max(y) AS mx FROM t)
SELECT PolicyID, CoverSeq, round(ln(1 + y), 6) AS Log_TotalClaims, round(sqrt(greatest(y, 0)), 6) AS Sqrt_TotalClaims,
  round((y - mu) / (sd + 1e-10), 6) AS Std_TotalClaims, CAST(y > med AS BIGINT) AS HighClaim,
  CASE WHEN q1 = q2 THEN (CASE WHEN y <= mn + (mx - mn) / 3 THEN 'Low' WHEN y <= mn + 2 * (mx - mn) / 3 THEN 'Medium' ELSE 'High' END)
       ELSE (CASE WHEN y <= q1 THEN 'Low' WHEN y <= q2 THEN 'Medium' ELSE 'High' END) END AS ClaimSeverityCategory FROM t, s""")
def p42_p44_target_transforms(spark, sf):
    d = FE.add_target_transforms(stored_policy(spark, sf, ["PolicyID", "CoverSeq", "TotalClaims"]))
    return finish(d.drop("TotalClaims"))


P35_SQL = CTE + """, a AS (SELECT PolicyID, CoverSeq, CAST(least(greatest(year(TransactionMonth) - RegistrationYear, 0), 50) AS DOUBLE) AS VehicleAge,
  SumInsured, TotalPremium, cubiccapacity, kilowatts / (NULLIF(cubiccapacity, 0) + 1) AS pr FROM policy),
m0 AS (SELECT median(pr) AS mp FROM a),
b AS (SELECT a.*, CAST(coalesce(pr > mp, false) AS INTEGER) AS HasHighPower FROM a, m0),
st AS (SELECT count(DISTINCT VehicleAge) AS nd_age, count(DISTINCT SumInsured) AS nd_si, median(cubiccapacity) AS ccm,
  quantile_cont(SumInsured, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM b),
c AS (SELECT b.*, st.*, CASE WHEN (VehicleAge) IS NULL THEN NULL ELSE least(greatest(VehicleAge, 0), 50) END AS ac, CASE WHEN (SumInsured) IS NULL THEN NULL ELSE least(greatest(SumInsured, 1000), 1000000) END AS sc,
  CASE WHEN (TotalPremium) IS NULL THEN NULL ELSE least(greatest(TotalPremium, 100), 10000) END AS pc FROM b, st)
SELECT PolicyID, CoverSeq,
  round(CASE WHEN nd_age > 1 THEN CASE WHEN (VehicleAge ^ 2) IS NULL THEN NULL ELSE least(greatest(VehicleAge ^ 2, -1e10), 1e10) END END, 4) AS VehicleAge_squared,
  round(CASE WHEN nd_si > 1 THEN CASE WHEN (SumInsured ^ 3) IS NULL THEN NULL ELSE least(greatest(SumInsured ^ 3, -1e10), 1e10) END END, 4) AS SumInsured_cubed,
  round(CASE WHEN nd_si > 1 THEN ln(1 + abs(SumInsured + 1e-10)) END, 6) AS log_SumInsured,
  round(ac * sc, 4) AS Age_Value_Interaction, round(least(greatest(coalesce(ac / sc, 0.0), -100), 100), 8) AS Age_Value_Ratio,
  round(least(greatest(coalesce(pc / sc, 0.0), 0), 0.1), 8) AS Premium_Per_Value,
  round((CAST(coalesce(VehicleAge > 10, false) AS INTEGER) + CAST(coalesce(cubiccapacity > ccm, false) AS INTEGER) + HasHighPower) / 3.0, 6) AS Risk_Score,
  CASE WHEN least(greatest(VehicleAge, 0), 100) >= 0 AND least(greatest(VehicleAge, 0), 100) <= 3 THEN 'New'
       WHEN least(greatest(VehicleAge, 0), 100) <= 7 THEN 'Young' WHEN least(greatest(VehicleAge, 0), 100) <= 12 THEN 'Middle'
       WHEN least(greatest(VehicleAge, 0), 100) <= 20 THEN 'Old' WHEN least(greatest(VehicleAge, 0), 100) <= 100 THEN 'VeryOld' END AS VehicleAge_Binned,
  CASE WHEN SumInsured IS NULL OR SumInsured < e[1] OR SumInsured > e[6] THEN NULL WHEN SumInsured <= e[2] THEN 'VeryLow'
       WHEN SumInsured <= e[3] THEN 'Low' WHEN SumInsured <= e[4] THEN 'Medium' WHEN SumInsured <= e[5] THEN 'High' ELSE 'VeryHigh' END AS SumInsured_Binned
FROM c"""


@query("p35_p40_model_features", P35_SQL)
def p35_p40_model_features(spark, sf):
    d = stored(C.add_vehicle_age(_pol(spark, sf)).select("PolicyID", "CoverSeq", "VehicleAge", "SumInsured", "TotalPremium",
                                                          "cubiccapacity", "kilowatts"), "policy")
    d = FE.add_power_features(d)
    st = FE.fit_feature_stats(d, poly_cols=("VehicleAge", "SumInsured"))
    f = FE.add_model_features(d, st, poly_cols=("VehicleAge", "SumInsured"))
    return finish(f.select("PolicyID", "CoverSeq", "VehicleAge_squared", "SumInsured_cubed", "log_SumInsured",
                           "Age_Value_Interaction", "Age_Value_Ratio", "Premium_Per_Value", "Risk_Score",
                           "VehicleAge_Binned", "SumInsured_Binned"),
                  {"VehicleAge_squared": 4, "SumInsured_cubed": 4, "Age_Value_Interaction": 4, "Age_Value_Ratio": 8,
                   "Premium_Per_Value": 8})


@query("m8_stratified_split_counts", CTEK + f""", c AS (SELECT * FROM policy WHERE TotalClaims > 0),
r AS (SELECT row_number() OVER (ORDER BY TotalClaims, {TIE_SQL}) AS rn, count(*) OVER () AS n FROM c),
b AS (SELECT CAST(CASE WHEN rn <= 1 OR n <= 1 THEN 0 ELSE ((rn - 1) * 10 + (n - 2)) // (n - 1) - 1 END AS BIGINT) AS StratifyBin FROM r),
g AS (SELECT StratifyBin, count(*) AS n FROM b GROUP BY 1)
SELECT StratifyBin, 'test' AS split, CAST(floor(n * 0.2 + 0.5) AS BIGINT) AS n FROM g UNION ALL
SELECT StratifyBin, 'train', n - CAST(floor(n * 0.2 + 0.5) AS BIGINT) FROM g""")
def m8_stratified_split_counts(spark, sf):
    d = FE.add_rank_bins(_pol(spark, sf, keys=True).where(F.col("TotalClaims") > 0), "TotalClaims", TIES, unique=True)
    s = M.stratified_split(d, "StratifyBin", 0.2, 42)
    return finish(s.groupBy("StratifyBin", "split").agg(F.count(F.lit(1)).alias("n")))


SP_FEATS = ["SumInsured", "TotalPremium", "kilowatts", "CalculatedPremiumPerTerm"]


def _avg_rank_sql(c):
    return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)"


@query("m6_spearman_correlations", CTE + "\nUNION ALL\n".join(
    f"""SELECT '{f}' AS feature, round(corr(rf, rt), 6) AS spearman_rho, count(*) AS n FROM (
  SELECT {_avg_rank_sql(f)} AS rf, {_avg_rank_sql('TotalClaims')} AS rt FROM policy WHERE TotalClaims > 0 AND {f} IS NOT NULL)""" for f in SP_FEATS))
def m6_spearman_correlations(spark, sf):
    d = _pol(spark, sf).where(F.col("TotalClaims") > 0)
    return finish(M.spearman_table(d, SP_FEATS, "TotalClaims"))


VAR_FEATS = ["SumInsured", "TotalPremium", "kilowatts", "CalculatedPremiumPerTerm", "cubiccapacity"]


@query("m7_variance_threshold", CTE + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, round(var_samp(ln(1 + abs({f}))), 6) AS variance, var_samp(ln(1 + abs({f}))) > 0.01 AS selected FROM policy"
    for f in VAR_FEATS))
def m7_variance_threshold(spark, sf):
    d = _pol(spark, sf).select(*[F.log1p(F.abs(F.col(f))).alias(f) for f in VAR_FEATS])
    keep = set(M.variance_select(d, VAR_FEATS, 0.01))
    a = d.agg(*[F.var_samp(f).alias(f) for f in VAR_FEATS])
    parts = ", ".join(f"'{f}', `{f}`" for f in VAR_FEATS)
    out = a.select(F.expr(f"stack({len(VAR_FEATS)}, {parts}) as (feature, variance)"))
    return finish(out.withColumn("selected", F.col("feature").isin(*keep)))


M9_SQL = CTE + """, c AS (SELECT ln(1 + SumInsured) AS x, ln(1 + TotalClaims) AS y FROM policy WHERE TotalClaims > 0 AND SumInsured IS NOT NULL),
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM c),
p AS (SELECT y, a + b * x AS yhat FROM c, f)
SELECT (SELECT round(b, 6) FROM f) AS slope, (SELECT round(a, 6) FROM f) AS intercept, count(*) AS n,
  round(sqrt(avg((y - yhat) ^ 2)), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae, round(1 - sum((y - yhat) ^ 2) / (var_pop(y) * count(*)), 6) AS r2,
  round(avg(CASE WHEN y != 0 THEN abs((y - yhat) / y) END) * 100, 6) AS mape, round(avg(CASE WHEN y != 0 THEN (y - yhat) / y END) * 100, 6) AS mpe,
  round(avg(2 * abs(yhat - y) / (abs(y) + abs(yhat))) * 100, 6) AS smape FROM p"""


@query("m9_m14_single_feature_regression", M9_SQL)
def m9_m14_single_feature_regression(spark, sf):
    d = _pol(spark, sf).where((F.col("TotalClaims") > 0) & F.col("SumInsured").isNotNull()) \
        .select(F.log1p("SumInsured").alias("x"), F.log1p("TotalClaims").alias("y"))
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    model = LinearRegression(featuresCol="features", labelCol="y", regParam=0.0, solver="normal").fit(v)
    pred = model.transform(v)
    met = M.regression_metrics(pred, "y", "prediction")
    coef = spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double")
    return finish(coef.crossJoin(met).select("slope", "intercept", "n", "rmse", "mae", "r2", "mape", "mpe", "smape"))


@query("m15_auc_accuracy", CTE + """, s AS (SELECT CAST(TotalClaims > 0 AS INTEGER) AS label, CalculatedPremiumPerTerm / SumInsured AS score,
  CAST(TotalPremium > 60000 AS INTEGER) AS pred FROM policy WHERE SumInsured IS NOT NULL),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS ar FROM s WHERE score IS NOT NULL)
SELECT round((sum(CASE WHEN label = 1 THEN ar END) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))), 6) AS auc,
  count(*) AS n, (SELECT round(avg(CAST(pred = label AS DOUBLE)), 6) FROM s) AS accuracy FROM r""")
def m15_auc_accuracy(spark, sf):
    d = _pol(spark, sf).where(F.col("SumInsured").isNotNull()).select(
        (F.col("TotalClaims") > 0).cast("int").alias("label"),
        (F.col("CalculatedPremiumPerTerm") / F.col("SumInsured")).alias("score"),
        (F.col("TotalPremium") > 60000).cast("int").alias("prediction"))
    return finish(M.classification_metrics(d, "label", "score", "prediction"))


SEG_SQL = CTE + """, g AS (SELECT Province, CoverType, count(*) AS n_policies, avg(CASE WHEN TotalClaims > 0 THEN 1.0 ELSE 0.0 END) AS p_claim,
  coalesce(avg(CASE WHEN TotalClaims > 0 THEN TotalClaims END), 0.0) AS expected_severity FROM policy WHERE Province IS NOT NULL GROUP BY 1, 2),
p AS (SELECT *, p_claim * expected_severity AS pure_premium, p_claim * expected_severity * 1.15 AS wexp,
  p_claim * expected_severity * 1.15 * 1.10 AS final_premium,
  CASE WHEN p_claim <= 0.0005 THEN 'Very Low Risk' WHEN p_claim <= 0.001 THEN 'Low Risk' WHEN p_claim <= 0.01 THEN 'Medium Risk'
       WHEN p_claim <= 0.05 THEN 'High Risk' ELSE 'Very High Risk' END AS risk_band FROM g)
"""


@query("m22_segment_premiums", SEG_SQL + """SELECT Province, CoverType, n_policies, round(p_claim, 6) AS p_claim, round(expected_severity, 4) AS expected_severity,
  round(pure_premium, 4) AS pure_premium, round(wexp - pure_premium, 4) AS expense_loading, round(final_premium - wexp, 4) AS profit_margin_amount,
  round(final_premium, 4) AS final_premium, risk_band FROM p""")
def m22_segment_premiums(spark, sf):
    s = PR.segment_premiums(_pol(spark, sf), ["Province", "CoverType"])
    return finish(s, {"expected_severity": 4, "pure_premium": 4, "expense_loading": 4, "profit_margin_amount": 4,
                      "final_premium": 4})


@query("m23_premium_by_band", SEG_SQL + """SELECT risk_band, sum(n_policies) AS n_policies, count(*) AS n_segments,
  round(sum(p_claim * n_policies) / sum(n_policies), 6) AS p_claim, round(sum(final_premium * n_policies) / sum(n_policies), 4) AS avg_final_premium
FROM p GROUP BY risk_band""")
def m23_premium_by_band(spark, sf):
    s = PR.segment_premiums(_pol(spark, sf), ["Province", "CoverType"])
    return finish(PR.premium_by_band(s), {"avg_final_premium": 4})


# ------------------------------------------------------------- rows-only model queries

ENC_NUM, ENC_CAT = ["SumInsured", "TotalPremium", "kilowatts", "cubiccapacity"], ["Province", "LegalType", "CoverType", "make"]


def _encoded_sql() -> str:
    fill = ", ".join([f"coalesce({c}, (SELECT median({c}) FROM policy)) AS {c}" for c in ENC_NUM] + [f"coalesce({c}, 'Unknown') AS {c}" for c in ENC_CAT])
    parts = [f"d AS (SELECT {fill} FROM policy)"]
    rows = []
    for i, c in enumerate(ENC_NUM):
        rows.append(f"SELECT {i} AS pos, '{c}' AS feature, avg(abs(z)) AS mean_abs, max(z) AS top FROM (SELECT ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z FROM d)")
    for i, c in enumerate(ENC_CAT):
        parts.append(f"k{i} AS (SELECT {c} AS v, count(*) AS n, row_number() OVER (ORDER BY {c}) - 1 AS place, count(*) OVER () AS size FROM d GROUP BY 1)")
        rows.append(f"SELECT {10 * (i + 1)} + place, regexp_replace('{c}_' || v, '[^A-Za-z0-9_]', '_', 'g'), n * 1.0 / (SELECT count(*) FROM d), 1.0 FROM k{i} WHERE size <= 10 AND place > 0")
        rows.append(f"SELECT {10 * (i + 1)}, '{c}', sum(n * place) * 1.0 / sum(n), max(place) FROM k{i} WHERE size > 10 HAVING count(*) > 0")
    return CTE + ", " + ", ".join(parts) + ", u AS (" + " UNION ALL ".join(rows) + """)
SELECT row_number() OVER (ORDER BY pos) - 1 AS slot, feature, round(mean_abs, 6) AS mean_abs, round(top, 6) AS top FROM u"""


@query("m1_m5_encoded_features", _encoded_sql())
def m1_m5_encoded_features(spark, sf):
    """Preprocessor fit (median impute, scale, one-hot without the first category / ordinal): name, mean absolute and
    largest value of every slot."""
    d = stored_policy(spark, sf, [*ENC_NUM, *ENC_CAT])
    d = M.fit_imputer(d, ENC_NUM, ENC_CAT).apply(d)
    model = M.build_preprocessor(d, ENC_NUM, ENC_CAT, max_onehot=10, cardinality=M.cardinalities(d, ENC_CAT)).fit(d)
    t = model.transform(d)
    names = spark.createDataFrame(list(enumerate(M.feature_names(model, t, ENC_NUM))), "slot bigint, feature string")
    values = t.select(F.posexplode(vector_to_array("features")).alias("slot", "x")).groupBy("slot").agg(
        F.avg(F.abs("x")).alias("mean_abs"), F.max("x").alias("top"))
    return finish(names.join(values, "slot"))


LOGIT_SQL = CTE + """, g AS (SELECT CAST(CoverSeq = 1 AS INTEGER) AS x, count_if(TotalClaims > 0) AS yes, count_if(NOT coalesce(TotalClaims > 0, false)) AS no FROM policy GROUP BY 1)
SELECT round(ln(max(CASE WHEN x = 1 THEN yes * 1.0 / no END)) - ln(max(CASE WHEN x = 0 THEN yes * 1.0 / no END)), 3) AS coefficient,
  round(ln(max(CASE WHEN x = 0 THEN yes * 1.0 / no END)), 3) AS intercept FROM g"""


@query("m13_logistic_one_flag", LOGIT_SQL)
def m13_logistic_one_flag(spark, sf):
    """The claim classifier's logistic regression on one 0/1 column: log odds of either side."""
    d = stored(_pol(spark, sf).select(X.flag(F.col("CoverSeq") == 1).cast("double").alias("x"), X.flag(F.col("TotalClaims") > 0).cast("double").alias("label")), "policy")
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    model = M.classifiers("label")["LogisticRegression"].setTol(1e-10).fit(v)
    return finish(spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "coefficient double, intercept double"), default=3)


SPLIT_SQL = CTE + """, c AS (SELECT CAST(CoverSeq AS DOUBLE) AS x, ln(1 + TotalClaims) AS y FROM policy WHERE TotalClaims > 0),
v AS (SELECT x, count(*) AS n, sum(y) AS s FROM c GROUP BY x),
k AS (SELECT (x + lead(x) OVER (ORDER BY x)) / 2 AS cut, sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM v),
b AS (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) AS gain FROM k WHERE cut IS NOT NULL ORDER BY gain DESC, cut LIMIT 1)
SELECT m AS model, round(cut, 6) AS cut, round(sl / nl, 6) AS below, round((s - sl) / (n - nl), 6) AS above FROM b, (VALUES ('DecisionTree'), ('GradientBoosting'), ('RandomForest')) AS t(m)"""


@query("m10_m12_one_split", SPLIT_SQL)
def m10_m12_one_split(spark, sf):
    """Tree, forest and boosting cut down to one split of one column: the split of least squared error and its means."""
    d = _pol(spark, sf).where(F.col("TotalClaims") > 0).select(F.col("CoverSeq").cast("double").alias("x"), F.log1p("TotalClaims").alias("label"))
    v = MO.stored_features(VectorAssembler(inputCols=["x"], outputCol="features").transform(d))
    rows = []
    for name in ("DecisionTree", "GradientBoosting", "RandomForest"):
        est = M.regressors("label", trees=1, rounds=1, depth=1)[name]
        if name == "RandomForest":
            est = est.setBootstrap(False)
        model = est.fit(v)
        tree = model.trees[0] if hasattr(model, "trees") else model
        root = tree._call_java("rootNode")
        rows.append((name, float(root.split().threshold()), float(root.leftChild().prediction()), float(root.rightChild().prediction())))
    return finish(spark.createDataFrame(rows, "model string, cut double, below double, above double"))


LINE_SQL = CTE + """, c AS (SELECT ln(1 + SumInsured) AS x, ln(1 + TotalClaims) AS y FROM policy WHERE TotalClaims > 0 AND SumInsured IS NOT NULL),
f AS (SELECT regr_slope(y, x) AS b, avg(x) AS m FROM c)
SELECT 'x' AS feature, round(abs(max(b)), 6) AS importance, round(avg(abs(b * (x - m))), 6) AS mean_abs_attribution FROM c, f"""


@query("m19_m20_one_feature_line", LINE_SQL)
def m19_m20_one_feature_line(spark, sf):
    """Importance and exact attribution of a line through one column."""
    d = _pol(spark, sf).where((F.col("TotalClaims") > 0) & F.col("SumInsured").isNotNull()).select(F.log1p("SumInsured").alias("x"), F.log1p("TotalClaims").alias("label"))
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    model = M.regressors("label")["LinearRegression"].setSolver("normal").fit(v)
    importance = spark.createDataFrame(M.feature_importance(model, ["x"]), "feature string, importance double")
    return finish(importance.join(M.linear_attribution(v, list(model.coefficients.toArray()), ["x"]), "feature"))


def _sev(spark, sf, models=None):
    return MO.severity_run(_pol(spark, sf, keys=True), tie_keys=TIES, models=models)


@query("m9_m12_m18_model_comparison", None)
def m9_m12_m18_model_comparison(spark, sf):
    """The nine severity models on the claim rows (log target, 80/20 stratified split, 200 trees or
    rounds) and the best-model flag."""
    comp, *_ = _sev(spark, sf)
    return comp.drop("fit_seconds")


@query("m13_m15_claim_classifiers", None)
def m13_m15_claim_classifiers(spark, sf):
    """Logistic, random-forest and boosted claim classifiers (200 trees or rounds) with exact AUC and accuracy."""
    return MO.classification_run(_pol(spark, sf))


@query("m16_m17_cross_validation", None)
def m16_m17_cross_validation(spark, sf):
    """5-fold RMSE (mean and std over folds) of all nine models on the features of the training split, and
    the winner's own grid on 3 folds."""
    return MO.cross_validation_run(_pol(spark, sf, keys=True), tie_keys=TIES)


GRAM_SQL = CTE.replace("WITH ", "WITH RECURSIVE ", 1) + """, c AS (SELECT SumInsured AS x1, kilowatts AS x2, ln(1 + TotalClaims) AS y, PolicyID % 5 AS fold FROM policy WHERE TotalClaims > 0),
k AS (SELECT DISTINCT fold AS k FROM c),
med AS (SELECT k, median(x1) AS m1, median(x2) AS m2 FROM c, k WHERE fold <> k GROUP BY k),
t AS (SELECT k, fold = k AS test, y, coalesce(x1, m1) AS x1, coalesce(x2, m2) AS x2 FROM c, med),
s AS (SELECT k, avg(x1) AS a1, avg(x2) AS a2, avg(y) AS ay, stddev_samp(x1) AS d1, stddev_samp(x2) AS d2,
  (count(*) - 1) / count(*) AS h, covar_pop(x1, x2) / (stddev_samp(x1) * stddev_samp(x2)) AS h12,
  covar_pop(x1, y) / stddev_samp(x1) AS g1, covar_pop(x2, y) / stddev_samp(x2) AS g2 FROM t WHERE NOT test GROUP BY k),
mo AS (SELECT * FROM (VALUES ('LinearRegression', 0.0, 0.0), ('Ridge', 1.0, 0.0), ('Lasso', 0.1, 1.0), ('ElasticNet', 0.1, 0.5)) AS v(model, pen, l1)),
it AS (SELECT k, model, 0 AS i, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM s, mo UNION ALL
  SELECT k, model, i + 1, n1, sign(g2 - h12 * n1) * greatest(abs(g2 - h12 * n1) - pen * l1, 0) / (h + pen * (1 - l1)) FROM (
    SELECT it.k, it.model, i, g2, h12, h, pen, l1, sign(g1 - h12 * b2) * greatest(abs(g1 - h12 * b2) - pen * l1, 0) / (h + pen * (1 - l1)) AS n1
    FROM it JOIN s ON s.k = it.k JOIN mo ON mo.model = it.model WHERE i < 300)),
e AS (SELECT it.model, t.k, sqrt(avg((y - ay - b1 * (x1 - a1) / d1 - b2 * (x2 - a2) / d2) ^ 2)) AS rmse
  FROM it JOIN s ON s.k = it.k JOIN t ON t.k = it.k AND t.test WHERE i = 300 GROUP BY 1, 2)
SELECT model, count(*) AS folds, round(avg(rmse), 6) AS mean_rmse, round(stddev_samp(rmse), 6) AS std_rmse FROM e GROUP BY model"""


@query("m16_linear_folds", GRAM_SQL)
def m16_linear_folds(spark, sf):
    """The four linear models from per-fold Gram matrices: medians, scales and coefficients of each training
    set, two columns with gaps; folds are PolicyID % 5. The SQL descends by coordinates in a recursive query."""
    d = _pol(spark, sf).where(F.col("TotalClaims") > 0).select(
        "SumInsured", "kilowatts", F.log1p("TotalClaims").alias("label"), (F.col("PolicyID") % 5).cast("int").alias("_fold"))
    scores = CV.cross_validate_linear(CV.fold_grams(d, ["SumInsured", "kilowatts"], [], "label"))
    rows = [(n, len(v), float(np.mean(v)), float(np.std(v, ddof=1))) for n, v in scores.items()]
    return finish(spark.createDataFrame(rows, "model string, folds bigint, mean_rmse double, std_rmse double"))


FOLD_SQL = CTE + """, c AS (SELECT ln(1 + SumInsured) AS x, ln(1 + TotalClaims) AS y, PolicyID % 5 AS fold FROM policy WHERE TotalClaims > 0 AND SumInsured IS NOT NULL),
f AS (SELECT k.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM c, (SELECT DISTINCT fold FROM c) k WHERE c.fold <> k.fold GROUP BY k.fold),
e AS (SELECT fold, sqrt(avg((y - a - b * x) ^ 2)) AS rmse FROM c JOIN f USING (fold) GROUP BY fold)
SELECT CAST(5 AS BIGINT) AS folds, round(avg(rmse), 5) AS mean_rmse FROM e"""


@query("m16_one_feature_folds", FOLD_SQL)
def m16_one_feature_folds(spark, sf):
    """Mean fold RMSE of a one-feature linear regression; folds are PolicyID % 5."""
    d = _pol(spark, sf).where((F.col("TotalClaims") > 0) & F.col("SumInsured").isNotNull())
    d = d.select(F.log1p("SumInsured").alias("x"), F.log1p("TotalClaims").alias("label"), (F.col("PolicyID") % 5).cast("int").alias("fold"))
    d = stored(d, "policy")  # five fits and five errors at a time would join the tables ten times, with ten sets of broadcast sides in the driver
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    cvm = M.cross_validate(M.regressors("label")["LinearRegression"], data, "label", folds=5, fold_col="fold")
    return finish(spark.createDataFrame([(5, float(cvm.avgMetrics[0]))], "folds bigint, mean_rmse double"), default=5)


@query("s13_model_save_load", CTE + """SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM policy WHERE TotalClaims > 0""")
def s13_model_save_load(spark, sf):
    """A fitted pipeline and its imputer, saved, loaded and scored again: predictions that differ."""
    num, cat = ["SumInsured", "TotalPremium", "kilowatts"], ["CoverType", "Province"]
    d = _pol(spark, sf).where(F.col("TotalClaims") > 0).withColumn("label", F.log1p("TotalClaims"))
    imputer = M.fit_imputer(d, num, cat, categorical="most_frequent")
    x = imputer.apply(d)
    stages = M.build_preprocessor(x, num, cat, cardinality=M.cardinalities(x, cat)).getStages()
    model = Pipeline(stages=[*stages, M.regressors("label")["Ridge"]]).fit(x)
    path = scratch_path(spark, "model")
    M.save_model(model, imputer, path)
    again, fills = M.load_model(spark, path)
    scored = model.transform(x).select(*d.columns, F.col("prediction").alias("before"))
    both = again.transform(fills.apply(scored.drop("features"))).select("before", "prediction")
    return finish(both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") != F.col("prediction")).alias("n_different")))


ONE_FEATURE = """, c AS (SELECT PolicyID, CoverSeq, CASE WHEN PolicyID % 4 = 0 THEN 'test' ELSE 'train' END AS part, SumInsured FROM policy),
m AS (SELECT median(SumInsured) AS med FROM c WHERE part = 'train')"""


@query("m1_fitted_imputer", CTE + ONE_FEATURE + """ SELECT part, count(*) AS n, count_if(SumInsured IS NULL) AS n_filled,
  round(sum(coalesce(SumInsured, med)), 2) AS total FROM c, m GROUP BY part""")
def m1_fitted_imputer(spark, sf):
    """The training median fills train and test rows alike."""
    d = _pol(spark, sf).withColumn("part", F.when(F.col("PolicyID") % 4 == 0, "test").otherwise("train"))
    imputer = M.fit_imputer(d.where("part = 'train'"), ["SumInsured"], [])
    filled = imputer.apply(d.withColumn("_gap", F.col("SumInsured").isNull()))
    return finish(filled.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if("_gap").alias("n_filled"), F.sum("SumInsured").alias("total")), default=2)


@query("m19_m20_importance_attribution", None)
def m19_m20_importance_attribution(spark, sf):
    """Linear |coef| ranking with exact mean |linear attribution|, plus forest importances and permutation importance, and the forest's
    own mean |attribution| (exact Shapley values); each ranked."""
    comp, fitted, names, preds, _ = _sev(spark, sf, ["LinearRegression", "RandomForest"])
    lin, rf = fitted["LinearRegression"].stages[-1], fitted["RandomForest"].stages[-1]
    test = preds.select("features", F.col("Log_TotalClaims").alias("label"))
    att = M.with_rank(M.linear_attribution(test, list(lin.coefficients.toArray()), names), "mean_abs_attribution", "attribution_rank")
    tables = [(M.feature_importance(lin, names), "linear_importance", "linear_rank"), (M.feature_importance(rf, names), "rf_importance", "rf_rank")]
    out = att
    for rows, value, rank in tables:
        out = out.join(M.with_rank(spark.createDataFrame(rows, f"feature string, {value} double"), value, rank), "feature", "full")
    shap = M.tree_attribution(rf, test, names).withColumnRenamed("mean_abs_attribution", "rf_mean_abs_attribution")
    out = out.join(M.with_rank(shap, "rf_mean_abs_attribution", "rf_attribution_rank"), "feature", "full")
    return out.join(M.with_rank(M.permutation_importance(rf, test, names, label="label"), "rmse_increase", "permutation_rank"), "feature", "full")


@query("m20_permutation_importance", None)
def m20_permutation_importance(spark, sf):
    """RMSE increase per permuted feature slot of the forest (every slot)."""
    comp, fitted, names, preds, _ = _sev(spark, sf, ["RandomForest"])
    rf = fitted["RandomForest"].stages[-1]
    data = preds.select("features", F.col("Log_TotalClaims").alias("label"))
    return M.permutation_importance(rf, data, names, label="label")


@query("m21_frequency_severity", None)
def m21_frequency_severity(spark, sf):
    """Two-part model: claim probability x severity -> expected cost, averaged by province."""
    num, cat = ["SumInsured", "TotalPremium", "kilowatts", "cubiccapacity"], ["CoverType", "LegalType"]
    d = stored_policy(spark, sf, ["Province", *num, *cat, "TotalClaims"])
    _, _, score = M.frequency_severity(d, num, cat)
    s = score(d)
    return s.groupBy("Province").agg(F.avg("p_claim").alias("p_claim"), F.avg("expected_severity").alias("severity"),
                                     F.avg("expected_cost").alias("expected_cost"))
