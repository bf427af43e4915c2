"""Registered cleaning / typing / repair / filter / set-operation queries
(P1-P34, P45-P49, F1-F8, U1-U2, A19, A22) over the policy view.

Text-cleaning operators need text input; each query builds it from the policy
columns (the rule that builds the text is stated next to it) and then runs the
library operator on it. The oracle SQL states the same rule independently.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.functions import expr as X
from claimlens.operators import clean as C
from claimlens.operators import features as FE
from claimlens.plans.registry import finish, query
from claimlens.sources.views import policy_cte, policy_view, stored_policy

CTE = policy_cte()


def _pol(spark, sf):
    return policy_view(spark, sf)


KEY = ["PolicyID", "CoverSeq"]

# ---------------------------------------------------------------- P1 whitespace

P1_SQL = CTE + """SELECT PolicyID, CoverSeq, trim(regexp_replace(concat('  ', make, chr(9), '   ', CoverType, ' '), '\\s+', ' ', 'g')) AS clean_text
FROM policy"""


@query("p1_squish_whitespace", P1_SQL)
def p1_squish_whitespace(spark, sf):
    d = _pol(spark, sf).select(*KEY, F.concat(F.lit("  "), "make", F.lit("\t   "), "CoverType", F.lit(" ")).alias("clean_text"))
    return finish(C.squish_strings(d, ["clean_text"]))


# ---------------------------------------------------------------- P2 booleans

BOOL_TOKENS = ["Yes", "y", "TRUE", "1", "no", "N", "false", "0", "More than 6 months", None]


def _token_sql(tokens):
    return "[" + ", ".join("NULL" if t is None else f"'{t}'" for t in tokens) + "]"


@query("p2_bool_from_text", CTE + f""", t AS (SELECT {_token_sql(BOOL_TOKENS)}[(PolicyID % 10) + 1] AS txt FROM policy)
SELECT txt, CASE WHEN lower(txt) IN ('yes','y','true','1') THEN true WHEN lower(txt) IN ('no','n','false','0') THEN false END AS flag_value,
  count(*) AS n FROM t GROUP BY ALL""")
def p2_bool_from_text(spark, sf):
    toks = F.array(*[F.lit(t).cast("string") for t in BOOL_TOKENS])
    d = _pol(spark, sf).select(F.element_at(toks, (F.col("PolicyID") % 10 + 1).cast("int")).alias("txt"))
    d = C.to_boolean(d.withColumn("flag_value", F.col("txt")), ["flag_value"])
    return finish(d.groupBy("txt", "flag_value").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------- P3/P7/P8/P9/P10/P11 amounts

# Rule for the amount text (index = PolicyID % 12) built from TotalPremium:
# i = integer part, c = cents of |TotalPremium|.
def _amount_text_spark():
    x = F.abs(F.col("TotalPremium"))
    i = F.floor(x).cast("bigint")
    c = F.lpad((F.floor(x * 100) % 100).cast("bigint").cast("string"), 2, "0")
    si = i.cast("string")
    th = F.concat((i / 1000).cast("bigint").cast("string"), F.lit(","), F.lpad((i % 1000).cast("string"), 3, "0"))
    forms = [th, F.concat(F.lit(" "), si, F.lit(" ")), F.concat(si, F.lit(","), c), F.concat(F.lit("-"), si),
             F.concat(F.lit("R "), si), F.lit("NaN"), F.lit(None).cast("string"), F.lit(""),
             F.concat(si, F.lit("."), c), F.concat(F.lit("-"), si, F.lit("."), c, F.lit("x")),
             F.concat(F.lit("."), c), F.concat(th, F.lit("."), c)]
    idx = (F.col("PolicyID") % 12).cast("int")
    e = None
    for k, f in enumerate(forms):
        e = F.when(idx == k, f) if e is None else e.when(idx == k, f)
    return e


_AMT_SQL = """CASE PolicyID % 12
  WHEN 0 THEN concat(CAST(i // 1000 AS VARCHAR), ',', lpad(CAST(i % 1000 AS VARCHAR), 3, '0'))
  WHEN 1 THEN concat(' ', CAST(i AS VARCHAR), ' ') WHEN 2 THEN concat(CAST(i AS VARCHAR), ',', c)
  WHEN 3 THEN concat('-', CAST(i AS VARCHAR)) WHEN 4 THEN concat('R ', CAST(i AS VARCHAR)) WHEN 5 THEN 'NaN'
  WHEN 6 THEN NULL WHEN 7 THEN '' WHEN 8 THEN concat(CAST(i AS VARCHAR), '.', c)
  WHEN 9 THEN concat('-', CAST(i AS VARCHAR), '.', c, 'x') WHEN 10 THEN concat('.', c)
  ELSE concat(CAST(i // 1000 AS VARCHAR), ',', lpad(CAST(i % 1000 AS VARCHAR), 3, '0'), '.', c) END"""

AMT_CTE = CTE + f""", b AS (SELECT PolicyID, CoverSeq, CAST(floor(abs(TotalPremium)) AS BIGINT) AS i,
  lpad(CAST(CAST(floor(abs(TotalPremium) * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS c FROM policy),
t AS (SELECT PolicyID, CoverSeq, {_AMT_SQL} AS txt FROM b)
"""


def _p8_sql(s):
    return (f"try_cast(NULLIF(regexp_extract(CASE WHEN strpos({s}, '.') = 0 AND length({s}) - length(replace({s}, ',', '')) = 1 "
            f"AND length({s}) - strpos({s}, ',') <= 2 THEN replace({s}, ',', '.') ELSE {s} END, '[-+]?\\d*\\.\\d+|\\d+', 0), '') AS DOUBLE)")


@query("p7_p8_p9_amount_parsers", AMT_CTE + f"""SELECT PolicyID, CoverSeq, txt,
  CASE WHEN isnan(try_cast(NULLIF(replace(trim(txt), ',', ''), '') AS DOUBLE)) THEN NULL ELSE try_cast(NULLIF(replace(trim(txt), ',', ''), '') AS DOUBLE) END AS p7,
  {_p8_sql('trim(txt)')} AS p8,
  coalesce(try_cast(NULLIF(regexp_replace(txt, '[^0-9.\\-]', '', 'g'), '') AS DOUBLE), 0.0) AS p9
FROM t""")
def p7_p8_p9_amount_parsers(spark, sf):
    d = _pol(spark, sf).select(*KEY, _amount_text_spark().alias("txt"))
    d = d.withColumns({"p7": F.col("txt"), "p8": F.col("txt"), "p9": F.col("txt")})
    d = C.parse_amounts(d, ["p7"], "strip_commas")
    d = C.parse_amounts(d, ["p8"], "first_token")
    d = C.parse_amounts(d, ["p9"], "digits_only")
    return finish(d, default=4)


@query("p3_p11_numeric_coercion", AMT_CTE + """SELECT count(*) AS n_rows,
  count(CASE WHEN isnan(try_cast(trim(txt) AS DOUBLE)) THEN NULL ELSE try_cast(trim(txt) AS DOUBLE) END) AS n_parsed,
  round(sum(CASE WHEN isnan(try_cast(trim(txt) AS DOUBLE)) THEN NULL ELSE try_cast(trim(txt) AS DOUBLE) END), 2) AS sum_parsed,
  round(sum(coalesce(CASE WHEN isnan(try_cast(trim(txt) AS DOUBLE)) THEN NULL ELSE try_cast(trim(txt) AS DOUBLE) END, 0.0)), 2) AS sum_filled,
  round(sum(0.0), 2) AS sum_absent
FROM t""")
def p3_p11_numeric_coercion(spark, sf):
    d = _pol(spark, sf).select(_amount_text_spark().alias("txt"))
    a = C.to_numeric(d.withColumn("v", F.col("txt")), ["v"])
    filled = C.fill_amounts(a.withColumn("w", F.col("txt")), ["w", "absent_col"])
    return finish(filled.agg(F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n_parsed"),
                             F.sum("v").alias("sum_parsed"), F.sum("w").alias("sum_filled"),
                             F.sum("absent_col").alias("sum_absent")), default=2)


# ---------------------------------------------------------------- P4 dates

@query("p4_parse_dates", CTE + """, t AS (SELECT PolicyID, CoverSeq, CASE CoverSeq % 4
    WHEN 0 THEN strftime(TransactionMonth, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN concat(CAST(month(TransactionMonth) AS VARCHAR), '/', CAST(year(TransactionMonth) AS VARCHAR))
    WHEN 2 THEN 'bad' ELSE NULL END AS txt FROM policy)
SELECT PolicyID, CoverSeq, txt, coalesce(try_strptime(txt, '%Y-%m-%d %H:%M:%S'), try_strptime(txt, '%m/%Y')) AS parsed FROM t""")
def p4_parse_dates(spark, sf):
    p = _pol(spark, sf)
    k = F.col("CoverSeq") % 4
    txt = (F.when(k == 0, F.date_format("TransactionMonth", "yyyy-MM-dd HH:mm:ss"))
             .when(k == 1, F.concat(F.month("TransactionMonth").cast("string"), F.lit("/"),
                                    F.year("TransactionMonth").cast("string")))
             .when(k == 2, F.lit("bad")))
    d = p.select(*KEY, txt.alias("txt"))
    return finish(C.to_timestamp(d.withColumn("parsed", F.col("txt")), ["parsed"]))


# ------------------------------------------------------------ P12-P15, A22 repair

REPAIR_YEAR = 1999  # a cap inside the data's range so the rule fires


@query("p12_p15_repair_rules", CTE + f"""SELECT PolicyID, CoverSeq, round(abs(TotalPremium), 4) AS TotalPremium,
  round(CASE WHEN TotalClaims IS NULL THEN NULL ELSE greatest(TotalClaims, 0) END, 4) AS TotalClaims,
  CAST(CASE WHEN RegistrationYear IS NULL THEN NULL ELSE least(RegistrationYear, {REPAIR_YEAR}) END AS BIGINT) AS RegistrationYear,
  CAST(least(greatest(year(TransactionMonth) - least(RegistrationYear, {REPAIR_YEAR}), 0), 50) AS DOUBLE) AS VehicleAge
FROM policy""")
def p12_p15_repair_rules(spark, sf):
    d = _pol(spark, sf).select(*KEY, "TotalPremium", "TotalClaims", "RegistrationYear", "TransactionMonth")
    d = C.repair_rules(d, current_year=REPAIR_YEAR).drop("TransactionMonth")
    return finish(d, {"TotalPremium": 4, "TotalClaims": 4})


@query("a22_repair_counts", CTE + f"""SELECT rule, n_rows FROM (
  SELECT 'negative_premium_fixed' AS rule, count_if(TotalPremium < 0) AS n_rows FROM policy UNION ALL
  SELECT 'negative_claims_fixed', count_if(TotalClaims < 0) FROM policy UNION ALL
  SELECT 'future_registration_years_fixed', count_if(RegistrationYear > {REPAIR_YEAR}) FROM policy)""")
def a22_repair_counts(spark, sf):
    return finish(C.repair_counts(_pol(spark, sf), current_year=REPAIR_YEAR))


@query("p16_p17_age_vs_max_year", CTE + """, m AS (SELECT max(year(TransactionMonth)) AS ref FROM policy),
a AS (SELECT PolicyID, CoverSeq, CAST(least(greatest(ref - RegistrationYear, 0), 50) AS DOUBLE) AS VehicleAge FROM policy, m)
SELECT PolicyID, CoverSeq, VehicleAge, CAST(VehicleAge > 10 AS INTEGER) AS IsOldVehicle, CAST(VehicleAge < 3 AS INTEGER) AS IsNewVehicle FROM a""")
def p16_p17_age_vs_max_year(spark, sf):
    d = _pol(spark, sf).select(*KEY, "RegistrationYear", "TransactionMonth")
    return finish(C.add_vehicle_age_vs_max(d).select(*KEY, "VehicleAge", "IsOldVehicle", "IsNewVehicle"))


# ----------------------------------------------------------- P18-P23 derived

@query("p18_p21_insurance_features", CTE + """SELECT PolicyID, CoverSeq,
  round(CASE WHEN TotalPremium = 0 OR TotalPremium IS NULL OR TotalClaims IS NULL THEN NULL ELSE least(greatest(TotalClaims / (TotalPremium + 1e-10), 0), 10) END, 6) + 0.0 AS LossRatio,
  round(CalculatedPremiumPerTerm / (SumInsured + 1e-10), 8) AS PremiumRate,
  CAST(coalesce(TotalClaims > 0, false) AS BIGINT) AS HasClaim, CAST(coalesce(TotalClaims > 0, false) AS BIGINT) AS ClaimIndicator,
  round(ln(1 + CASE WHEN TotalPremium IS NULL THEN NULL ELSE greatest(TotalPremium, 0) END), 6) AS Log_TotalPremium, round(ln(1 + CASE WHEN TotalClaims IS NULL THEN NULL ELSE greatest(TotalClaims, 0) END), 6) AS Log_TotalClaims,
  round(ln(1 + CASE WHEN SumInsured IS NULL THEN NULL ELSE greatest(SumInsured, 0) END), 6) AS Log_SumInsured, round(ln(1 + CASE WHEN CalculatedPremiumPerTerm IS NULL THEN NULL ELSE greatest(CalculatedPremiumPerTerm, 0) END), 6) AS Log_CalculatedPremiumPerTerm
FROM policy""")
def p18_p21_insurance_features(spark, sf):
    d = _pol(spark, sf).select(*KEY, "TotalPremium", "TotalClaims", "SumInsured", "CalculatedPremiumPerTerm")
    d = C.add_insurance_features(d).drop("TotalPremium", "TotalClaims", "SumInsured", "CalculatedPremiumPerTerm")
    return finish(d, {"PremiumRate": 8})


@query("p20_p23_risk_metrics", CTE + """SELECT PolicyID, CoverSeq, CAST(coalesce(TotalClaims > 0, false) AS BIGINT) AS HasClaim,
  round(CASE WHEN TotalClaims > 0 THEN TotalClaims ELSE 0.0 END, 4) AS ClaimSeverity,
  round(TotalPremium - TotalClaims, 4) AS Margin, round((TotalPremium - TotalClaims) / NULLIF(TotalPremium, 0), 6) AS ProfitMarginPct
FROM policy""")
def p20_p23_risk_metrics(spark, sf):
    d = C.add_risk_metrics(_pol(spark, sf).select(*KEY, "TotalPremium", "TotalClaims"))
    return finish(d.drop("TotalPremium", "TotalClaims"), {"ClaimSeverity": 4, "Margin": 4})


# ---------------------------------------------------------- P24-P25 text keys

@query("p24_zip_prefix", CTE + """, t AS (SELECT CASE CoverSeq % 3 WHEN 0 THEN concat('AB ', PostalCode, ' 56')
  WHEN 1 THEN substr(PostalCode, 1, 2) ELSE PostalCode END AS txt FROM policy)
SELECT NULLIF(regexp_extract(txt, '([0-9]{3,4})', 1), '') AS ZipPrefix, count(*) AS n FROM t GROUP BY 1""")
def p24_zip_prefix(spark, sf):
    p = _pol(spark, sf)
    k = F.col("CoverSeq") % 3
    t = F.when(k == 0, F.concat(F.lit("AB "), "PostalCode", F.lit(" 56"))).when(k == 1, F.substring("PostalCode", 1, 2)) \
         .otherwise(F.col("PostalCode"))
    d = FE.add_zip_prefix(p.select(t.alias("txt")), "txt")
    return finish(d.groupBy("ZipPrefix").agg(F.count(F.lit(1)).alias("n")))


@query("p25_gender_normalisation", CTE + """SELECT Gender AS raw_gender, CASE WHEN upper(Gender) IN ('M','MALE','1') THEN 'Male'
  WHEN upper(Gender) IN ('F','FEMALE','0') THEN 'Female' END AS gender, count(*) AS n FROM policy GROUP BY ALL""")
def p25_gender_normalisation(spark, sf):
    d = FE.add_gender(_pol(spark, sf).select(F.col("Gender").alias("raw_gender")), "raw_gender", "gender")
    return finish(d.groupBy("raw_gender", "gender").agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------- P26 excess

def _excess_spark(p):
    k = F.col("CoverSeq") % 3
    amt = F.floor(F.col("kilowatts") * 10).cast("bigint").cast("string")
    return F.when(k == 0, amt).when(k == 1, F.concat(F.lit("Excess "), amt, F.lit(" (fixed)")))


_EXCESS_SQL = """CASE CoverSeq % 3 WHEN 0 THEN CAST(CAST(floor(kilowatts * 10) AS BIGINT) AS VARCHAR)
  WHEN 1 THEN concat('Excess ', CAST(CAST(floor(kilowatts * 10) AS BIGINT) AS VARCHAR), ' (fixed)') END"""


@query("p26_excess_features", CTE + f""", t AS (SELECT PolicyID, CoverSeq,
  try_cast(NULLIF(regexp_extract({_EXCESS_SQL}, '(\\d+\\.?\\d*)', 1), '') AS DOUBLE) AS a FROM policy),
m1 AS (SELECT median(a) AS m FROM t), f AS (SELECT PolicyID, CoverSeq, coalesce(a, m) AS ExcessAmount FROM t, m1),
m2 AS (SELECT median(ExcessAmount) AS m FROM f)
SELECT PolicyID, CoverSeq, ExcessAmount, CAST(coalesce(ExcessAmount > m, false) AS BIGINT) AS HasHighExcess FROM f, m2""")
def p26_excess_features(spark, sf):
    p = stored_policy(spark, sf, [*KEY, "kilowatts"])
    d = p.select(*KEY, _excess_spark(p).alias("ExcessSelected"))
    return finish(FE.add_excess_features(d).drop("ExcessSelected"))


# ---------------------------------------------------------- P27-P34 model feats

@query("p27_temporal_features", CTE + """SELECT PolicyID, CoverSeq, year(TransactionMonth) AS TransactionYear,
  month(TransactionMonth) AS TransactionMonthNum, quarter(TransactionMonth) AS TransactionQuarter,
  CAST(month(TransactionMonth) IN (11, 12) AS BIGINT) AS IsYearEnd FROM policy""")
def p27_temporal_features(spark, sf):
    d = FE.add_temporal(_pol(spark, sf).select(*KEY, "TransactionMonth")).drop("TransactionMonth")
    return finish(d)


@query("p28_p29_ratio_features", CTE + """, a AS (SELECT PolicyID, CoverSeq,
  kilowatts / (NULLIF(cubiccapacity, 0) + 1) AS PowerToCapacityRatio,
  TotalPremium / (NULLIF(SumInsured, 0) + 1) AS r0 FROM policy),
m AS (SELECT median(PowerToCapacityRatio) AS mp, median(r0) AS mr FROM a),
b AS (SELECT PolicyID, CoverSeq, PowerToCapacityRatio, CAST(coalesce(PowerToCapacityRatio > mp, false) AS BIGINT) AS HasHighPower,
  coalesce(r0, mr) AS PremiumToSumInsuredRatio FROM a, m),
q AS (SELECT quantile_cont(PremiumToSumInsuredRatio, 0.75) AS q75 FROM b)
SELECT PolicyID, CoverSeq, round(PowerToCapacityRatio, 8) AS PowerToCapacityRatio, HasHighPower,
  round(PremiumToSumInsuredRatio, 8) AS PremiumToSumInsuredRatio, CAST(coalesce(PremiumToSumInsuredRatio > q75, false) AS BIGINT) AS IsHighRiskPremium FROM b, q""")
def p28_p29_ratio_features(spark, sf):
    d = stored_policy(spark, sf, [*KEY, "kilowatts", "cubiccapacity", "TotalPremium", "SumInsured"])
    d = FE.add_premium_risk(FE.add_power_features(d))
    return finish(d.select(*KEY, "PowerToCapacityRatio", "HasHighPower", "PremiumToSumInsuredRatio", "IsHighRiskPremium"),
                  {"PowerToCapacityRatio": 8, "PremiumToSumInsuredRatio": 8})


@query("p30_p34_flag_features", CTE + """, t AS (SELECT PolicyID, CoverSeq, make, LegalType, VehicleAge_src, SumInsured, CapitalOutstanding,
  concat(CoverType, CASE WHEN CoverSeq % 2 = 0 THEN ' comprehensive' ELSE '' END) AS cover_text,
  CASE WHEN CoverSeq % 2 = 0 THEN 'Yes' END AS AlarmImmobiliser, CASE WHEN PolicyID % 3 = 0 THEN 'No' END AS TrackingDevice
  FROM (SELECT *, CAST(least(greatest(year(TransactionMonth) - RegistrationYear, 0), 50) AS DOUBLE) AS VehicleAge_src FROM policy)),
top AS (SELECT make FROM (SELECT make, count(*) AS n FROM policy WHERE make IS NOT NULL GROUP BY make ORDER BY n DESC, make LIMIT 10))
SELECT PolicyID, CoverSeq,
  CAST(least(CAST(AlarmImmobiliser IS NOT NULL AS INT) + CAST(TrackingDevice IS NOT NULL AS INT), 2) AS BIGINT) AS HasSecurity,
  CAST(CAST(AlarmImmobiliser IS NOT NULL AS INT) + CAST(TrackingDevice IS NOT NULL AS INT) = 2 AS BIGINT) AS HasAdvancedSecurity,
  CAST(regexp_matches(coalesce(LegalType, 'nan'), '(?i)(A|1|High)') AS BIGINT) AS IsHighRiskZone,
  CAST(coalesce(regexp_matches(cover_text, '(?i)Comprehensive'), false) AS BIGINT) AS IsComprehensive,
  CAST(make IN (SELECT make FROM top) AS BIGINT) AS IsTopMake,
  round(VehicleAge_src * SumInsured, 4) AS AgeValueInteraction,
  CAST(coalesce(CapitalOutstanding > 0, false) AS BIGINT) AS HasCapitalOutstanding,
  round(coalesce(CapitalOutstanding / (NULLIF(SumInsured, 0) + 1), 0.0), 8) AS CapitalToSumInsuredRatio
FROM t""")
def p30_p34_flag_features(spark, sf):
    p = C.add_vehicle_age(_pol(spark, sf), out="VehicleAge")
    d = p.select(*KEY, "make", "LegalType", "VehicleAge", "SumInsured", "CapitalOutstanding",
                 F.concat("CoverType", F.when(F.col("CoverSeq") % 2 == 0, F.lit(" comprehensive")).otherwise(F.lit("")))
                  .alias("cover_text"),
                 F.when(F.col("CoverSeq") % 2 == 0, F.lit("Yes")).alias("AlarmImmobiliser"),
                 F.when(F.col("PolicyID") % 3 == 0, F.lit("No")).alias("TrackingDevice"))
    d = FE.add_security(d)
    d = FE.add_pattern_flags(d, zone="LegalType", cover="cover_text")
    d = FE.add_top_make_flag(d)
    d = FE.add_value_features(d)
    return finish(d.select(*KEY, "HasSecurity", "HasAdvancedSecurity", "IsHighRiskZone", "IsComprehensive", "IsTopMake",
                           "AgeValueInteraction", "HasCapitalOutstanding", "CapitalToSumInsuredRatio"),
                  {"AgeValueInteraction": 4, "CapitalToSumInsuredRatio": 8})


# ------------------------------------------------------- P45-P49 imputation

@query("p45_p48_category_fill", CTE + """SELECT coalesce(NULLIF(trim(concat(' ', Gender, ' ')), ''), 'Unknown') AS gender_clean,
  coalesce(Gender, 'Unknown') AS gender_filled, count(*) AS n FROM policy GROUP BY ALL""")
def p45_p48_category_fill(spark, sf):
    p = _pol(spark, sf)
    d = p.select(F.concat(F.lit(" "), "Gender", F.lit(" ")).alias("gender_clean"), F.col("Gender").alias("gender_filled"))
    d = C.fill_unknown(C.sanitize_categories(d, ["gender_clean"]), ["gender_filled"])
    return finish(d.groupBy("gender_clean", "gender_filled").agg(F.count(F.lit(1)).alias("n")))


@query("p46_median_impute", CTE + """, m AS (SELECT median(SumInsured) AS ms, median(cubiccapacity) AS mc FROM policy)
SELECT PolicyID, CoverSeq, round(coalesce(SumInsured, ms), 4) AS SumInsured, round(coalesce(cubiccapacity, mc), 4) AS cubiccapacity FROM policy, m""")
def p46_median_impute(spark, sf):
    d = C.impute_median(stored_policy(spark, sf, [*KEY, "SumInsured", "cubiccapacity"]), ["SumInsured", "cubiccapacity"])
    return finish(d, default=4)


@query("p47_group_median_impute", CTE + """, m AS (SELECT CoverType, median(SumInsured) AS med FROM policy GROUP BY CoverType)
SELECT p.PolicyID, p.CoverSeq, p.CoverType, round(coalesce(p.SumInsured, m.med), 4) AS SumInsured FROM policy p LEFT JOIN m ON p.CoverType = m.CoverType""")
def p47_group_median_impute(spark, sf):
    d = C.impute_group_median(_pol(spark, sf).select(*KEY, "CoverType", "SumInsured"), "SumInsured", "CoverType")
    return finish(d, default=4)


@query("p49_winsorize_report", CTE + """, c1 AS (SELECT quantile_cont(TotalClaims, 0.99) AS cap FROM policy),
c2 AS (SELECT quantile_cont(TotalClaims, 0.99) AS cap FROM policy WHERE TotalClaims > 0),
c3 AS (SELECT quantile_cont(TotalPremium, 0.995) AS cap FROM policy)
SELECT 'claims_flat' AS variant, round(cap, 4) AS cap, count_if(TotalClaims > cap) AS n_capped, round(sum(CASE WHEN TotalClaims > cap THEN TotalClaims END), 2) AS sum_capped,
  round(sum(least(TotalClaims, cap)), 2) AS sum_after FROM policy, c1 GROUP BY cap UNION ALL
SELECT 'claims_population', round(cap, 4), count_if(TotalClaims > cap), round(sum(CASE WHEN TotalClaims > cap THEN TotalClaims END), 2),
  round(sum(least(TotalClaims, cap)), 2) FROM policy, c2 GROUP BY cap UNION ALL
SELECT 'premium_flat', round(cap, 4), count_if(TotalPremium > cap), round(sum(CASE WHEN TotalPremium > cap THEN TotalPremium END), 2),
  round(sum(least(TotalPremium, cap)), 2) FROM policy, c3 GROUP BY cap""")
def p49_winsorize_report(spark, sf):
    p = stored_policy(spark, sf, ["TotalClaims", "TotalPremium"])
    names = ["claims_flat", "claims_population", "premium_flat"]
    out = C.winsorize_reports(p, [("TotalClaims", 0.99, None), ("TotalClaims", 0.99, F.col("TotalClaims") > 0), ("TotalPremium", 0.995, None)])
    variant = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("place") + 1).alias("variant")
    return finish(out.select(variant, "cap", "n_capped", "sum_capped", "sum_after"), {"cap": 4, "sum_capped": 2, "sum_after": 2})


# -------------------------------------------------------------- filters F1-F6

@query("f1_f4_filters", CTE + """SELECT 'none' AS mode, count(*) AS n FROM policy UNION ALL
SELECT 'positive', count(*) FROM policy WHERE TotalClaims > 0 UNION ALL
SELECT 'non-zero', count(*) FROM policy WHERE TotalClaims != 0 UNION ALL
SELECT 'zero', count(*) FROM policy WHERE TotalClaims = 0 UNION ALL
SELECT 'valid_target', count(*) FROM policy WHERE TotalClaims IS NOT NULL AND TotalClaims >= 0 UNION ALL
SELECT 'dropna_si_cc', count(*) FROM policy WHERE SumInsured IS NOT NULL AND cubiccapacity IS NOT NULL""")
def f1_f4_filters(spark, sf):
    p = _pol(spark, sf).select("TotalClaims", "SumInsured", "cubiccapacity")
    parts = [C.claims_filter(p, m).agg(F.count(F.lit(1)).alias("n")).select(F.lit(m).alias("mode"), "n")
             for m in ("none", "positive", "non-zero", "zero")]
    parts.append(C.valid_target(p).agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid_target").alias("mode"), "n"))
    parts.append(C.drop_null_rows(p, ["SumInsured", "cubiccapacity"]).agg(F.count(F.lit(1)).alias("n"))
                  .select(F.lit("dropna_si_cc").alias("mode"), "n"))
    return finish(C.union_all(parts))


@query("f2_extract_claims", AMT_CTE + """
SELECT count(*) AS n_claims, round(sum(TotalClaims), 2) AS claims_sum FROM policy WHERE TotalClaims > 0""")
def f2_extract_claims(spark, sf):
    p = _pol(spark, sf).select(F.format_string("%.6f", "TotalClaims").alias("TotalClaims"))
    d = C.extract_claims(p, amount_cols=["TotalClaims"])
    return finish(d.agg(F.count(F.lit(1)).alias("n_claims"), F.sum("TotalClaims").alias("claims_sum")), default=2)


@query("f5_min_group_size", CTE + """, g AS (SELECT PostalCode FROM policy GROUP BY PostalCode HAVING count(*) >= 600)
SELECT PostalCode, count(*) AS n, round(sum(TotalPremium), 2) AS premium FROM policy WHERE PostalCode IN (SELECT PostalCode FROM g) GROUP BY PostalCode""")
def f5_min_group_size(spark, sf):
    d = C.min_group_size(_pol(spark, sf), "PostalCode", 600)
    return finish(d.groupBy("PostalCode").agg(F.count(F.lit(1)).alias("n"), F.sum("TotalPremium").alias("premium")), default=2)


@query("f6_keep_top_groups", CTE + """, g AS (SELECT Province FROM policy WHERE Province IS NOT NULL GROUP BY Province ORDER BY count(*) DESC, Province LIMIT 5)
SELECT Province, count(*) AS n FROM policy WHERE Province IN (SELECT Province FROM g) GROUP BY Province""")
def f6_keep_top_groups(spark, sf):
    d = C.keep_top_groups(_pol(spark, sf), "Province", 5)
    return finish(d.groupBy("Province").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------ U1-U2, A19 dupes

@query("u1_u2_a19_duplicates", CTE + """, u AS (SELECT PolicyID, CoverSeq, Province, TotalPremium, TotalClaims FROM policy UNION ALL
  SELECT PolicyID, CoverSeq, Province, TotalPremium, TotalClaims FROM policy WHERE CoverSeq = 1),
full_dup AS (SELECT sum(n - 1) AS duplicate_rows, sum(n) AS n_rows FROM (SELECT count(*) AS n FROM u GROUP BY PolicyID, CoverSeq, Province, TotalPremium, TotalClaims)),
key_dup AS (SELECT sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS rows_sharing_key FROM (SELECT PolicyID, count(*) AS n FROM u GROUP BY PolicyID)),
dd AS (SELECT count(*) AS n_after_dedupe FROM (SELECT DISTINCT * FROM u))
SELECT duplicate_rows, n_rows, rows_sharing_key, round(duplicate_rows * 100.0 / n_rows, 6) AS duplicate_pct, n_after_dedupe FROM full_dup, key_dup, dd""")
def u1_u2_a19_duplicates(spark, sf):
    p = stored_policy(spark, sf, ["PolicyID", "CoverSeq", "Province", "TotalPremium", "TotalClaims"])
    u = C.union_all([p, p.where(F.col("CoverSeq") == 1)])
    st = C.duplicate_stats(u)
    dd = C.dedupe(u).agg(F.count(F.lit(1)).alias("n_after_dedupe"))
    return finish(st.crossJoin(dd).select("duplicate_rows", "n_rows", "rows_sharing_key", "duplicate_pct", "n_after_dedupe"))


@query("u2_dedupe_on_key", CTE + """, u AS (SELECT PolicyID, CoverSeq, Province, round(TotalPremium, 4) AS TotalPremium FROM policy)
SELECT PolicyID, min(CoverSeq) AS CoverSeq, count(*) AS n_rows FROM u GROUP BY PolicyID""")
def u2_dedupe_on_key(spark, sf):
    p = _pol(spark, sf).select("PolicyID", "CoverSeq", "Province", F.round("TotalPremium", 4).alias("TotalPremium"))
    first = C.dedupe(p, ["PolicyID"]).select("PolicyID", "CoverSeq")
    counts = p.groupBy("PolicyID").agg(F.count(F.lit(1)).alias("n_rows"))
    return finish(first.join(counts, "PolicyID"))
