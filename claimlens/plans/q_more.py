"""Registered queries of sources, sinks, schema operators and logs that no other query exercises
(S1, S3, S4, S8-S12, S14, P5, P50-P53, F7, F8, F10, U3, A18, A22, A43, L4, M3)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators import clean as C
from claimlens.operators import features as FE
from claimlens.operators import ml as M
from claimlens.operators import profile as P
from claimlens.plans import etl
from claimlens.plans.q_io import raw_from_policy
from claimlens.plans.registry import finish, query
from claimlens.session import scratch_path
from claimlens.sources import io as IO
from claimlens.sources.views import policy_cte, policy_view, stored_policy

CTE = policy_cte()


@query("s1_malformed_utf8", CTE + """SELECT count(*) AS n_rows, count_if(make IS NOT NULL) AS n_replaced FROM policy""")
def s1_malformed_utf8(spark, sf):
    """A raw file in Latin-1 with accented text, read as UTF-8: malformed bytes become U+FFFD."""
    raw = raw_from_policy(policy_view(spark, sf)).withColumn("make", F.concat(F.col("make"), F.lit("\u00e9")))
    path = scratch_path(spark, "latin1")
    raw.write.option("header", True).option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    return finish(IO.read_raw(spark, path).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("make").contains("\ufffd")).alias("n_replaced")))


@query("s3_column_subset", CTE + """SELECT Province, count(*) AS n, round(sum(TotalPremium), 2) AS total_premium FROM policy GROUP BY Province""")
def s3_column_subset(spark, sf):
    """Two columns of the raw text file."""
    path = IO.write_table(raw_from_policy(policy_view(spark, sf)), scratch_path(spark, "raw"), fmt="csv")
    d = IO.read_columns(spark, path, ["Province", "TotalPremium"])
    return finish(d.groupBy("Province").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("TotalPremium").cast("double")).alias("total_premium")), default=2)


@query("s4_s9_split_table", CTE + """SELECT CASE WHEN PolicyID % 5 = 0 THEN 'test' ELSE 'train' END AS split, count(*) AS n,
  round(sum(SumInsured), 2) AS sum_insured FROM policy GROUP BY 1""")
def s4_s9_split_table(spark, sf):
    """The prepared table written by split (S9), and its CSV form read with a schema."""
    d = policy_view(spark, sf).select("PolicyID", "SumInsured", F.when(F.col("PolicyID") % 5 == 0, "test").otherwise("train").alias("split"))
    table = spark.read.parquet(IO.write_splits(d, scratch_path(spark, "splits")))
    path = IO.write_table(table.select("PolicyID", "SumInsured", "split"), scratch_path(spark, "prepared"), fmt="csv", sep=",")
    back = IO.read_prepared_csv(spark, path, T.StructType.fromDDL("PolicyID long, SumInsured double, split string"))
    return finish(back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("SumInsured").alias("sum_insured")), default=2)


@query("s8_reproducible_sample", CTE + """SELECT PolicyID, CoverSeq, round(TotalClaims, 4) AS TotalClaims FROM policy WHERE TotalClaims > 0
ORDER BY md5(PolicyID || '|' || CoverSeq) LIMIT 1000""")
def s8_reproducible_sample(spark, sf):
    """The claim rows' sample of at most 1000, written and read back."""
    claims = policy_view(spark, sf).where(F.col("TotalClaims") > 0).select("PolicyID", "CoverSeq", "TotalClaims")
    path = IO.write_sample(claims, scratch_path(spark, "sample"), 1000, "parquet", ["PolicyID", "CoverSeq"])
    return finish(spark.read.parquet(path), default=4)


@query("s10_s14_head", CTE + """SELECT PolicyID, CoverSeq, round(TotalPremium, 4) AS TotalPremium FROM policy ORDER BY PolicyID, CoverSeq LIMIT 1000""")
def s10_s14_head(spark, sf):
    """The first 1000 rows in key order, written and read back."""
    d = policy_view(spark, sf).select("PolicyID", "CoverSeq", "TotalPremium")
    path = IO.write_head(d, scratch_path(spark, "head"), ["PolicyID", "CoverSeq"])
    return finish(IO.read_prepared_csv(spark, path, T.StructType.fromDDL("PolicyID long, CoverSeq long, TotalPremium double"), sep="|"), default=4)


@query("s11_s12_report_sinks", CTE + """, k AS (SELECT Province, count(*) AS n, sum(TotalClaims) AS claims FROM policy GROUP BY Province)
SELECT f AS format, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n, round(sum(claims), 2) AS claims FROM k, (VALUES ('json'), ('csv')) v(f) GROUP BY f""")
def s11_s12_report_sinks(spark, sf):
    """A result table written as JSON and CSV reports and read back."""
    k = policy_view(spark, sf).groupBy("Province").agg(F.count(F.lit(1)).alias("n"), F.sum("TotalClaims").alias("claims"))
    schema = T.StructType.fromDDL("Province string, n long, claims double")
    out = None
    for fmt, path in zip(("json", "csv"), IO.write_report(k, scratch_path(spark, "report"))):
        back = spark.read.schema(schema).json(path) if fmt == "json" else IO.read_prepared_csv(spark, path, schema)
        part = back.agg(F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n"), F.sum("claims").alias("claims"))
        out = part if out is None else out.unionByName(part)
    return finish(out, default=2)


@query("p5_category_domain", CTE + "SELECT DISTINCT CoverType FROM policy WHERE CoverType IS NOT NULL")
def p5_category_domain(spark, sf):
    return C.category_domain(policy_view(spark, sf), "CoverType")


TEXT_COLS = ["Country", "Province", "PostalCode", "Gender", "LegalType", "CoverType", "make", "Model"]


@query("p50_discover_columns", CTE + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS name FROM policy HAVING count(DISTINCT {c}) BETWEEN 2 AND 30" for c in TEXT_COLS) + ")")
def p50_discover_columns(spark, sf):
    """Text columns of 2 to 30 categories."""
    found = FE.discover_columns(policy_view(spark, sf), kind="string", min_cardinality=2, max_cardinality=30)
    return spark.createDataFrame([(c,) for c in found], "name string")


@query("p51_u3_align_columns", CTE + """SELECT count(*) AS n, round(sum(TotalPremium), 2) AS premium, CAST(0 AS DOUBLE) AS missing_total,
  count(*) AS n_labelled FROM policy""")
def p51_u3_align_columns(spark, sf):
    """Columns aligned to a stated list: absent ones filled, others dropped."""
    d = C.align_columns(policy_view(spark, sf), ["TotalPremium", "NotThere", "Label"], {"Label": "none"})
    assert d.columns == ["TotalPremium", "NotThere", "Label"]
    return finish(d.agg(F.count(F.lit(1)).alias("n"), F.sum("TotalPremium").alias("premium"), F.sum("NotThere").alias("missing_total"),
                        F.count_if(F.col("Label") == "none").alias("n_labelled")), default=2)


def _counts(d):
    parts = ", ".join(f"'{c}', `{c}`" for c in d.columns)
    return d.agg(*[F.count(c).alias(c) for c in d.columns]).select(F.expr(f"stack({len(d.columns)}, {parts}) AS (name, n)"))


def _counts_sql(cols):
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS name, count({c}) AS n FROM policy" for c in cols)


KEPT = ["TransactionMonth", *TEXT_COLS, "RegistrationYear", "cubiccapacity", "kilowatts", "SumInsured", "CapitalOutstanding",
        "CalculatedPremiumPerTerm", "TotalPremium"]


@query("p52_drop_leakage", CTE + _counts_sql(KEPT))
def p52_drop_leakage(spark, sf):
    """The columns that stay when identifiers and leaks go, with their values."""
    return finish(_counts(FE.drop_leakage(policy_view(spark, sf))))


@query("p53_category_codes", CTE + """SELECT LegalType, CAST(dense_rank() OVER (ORDER BY LegalType) - 1 AS BIGINT) AS LegalType_code, count(*) AS n
FROM policy WHERE LegalType IS NOT NULL GROUP BY LegalType""")
def p53_category_codes(spark, sf):
    d = FE.category_codes(policy_view(spark, sf).where(F.col("LegalType").isNotNull()), "LegalType")
    return finish(d.groupBy("LegalType", "LegalType_code").agg(F.count(F.lit(1)).alias("n")))


@query("f7_f8_dropped_columns", CTE + """, d AS (SELECT PolicyID, Gender, cubiccapacity, CASE WHEN CoverSeq = 7 THEN 1.0 END AS rare, 'x' AS constant,
  CASE WHEN CoverSeq > 1 THEN 'y' END AS one_value, CAST(NULL AS VARCHAR) AS nothing FROM policy)
SELECT c.name, c.mostly_null, c.constant FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS name, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 0.5 AS mostly_null, "
    f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= 1 OR '{c}' = 'PolicyID' AS constant FROM d"
    for c in ("PolicyID", "Gender", "cubiccapacity", "rare", "constant", "one_value", "nothing")) + ") c")
def f7_f8_dropped_columns(spark, sf):
    """Which columns go as mostly null (F7) and which as constant or identifiers (F8)."""
    d = policy_view(spark, sf).select("PolicyID", "Gender", "cubiccapacity", F.when(F.col("CoverSeq") == 7, 1.0).alias("rare"),
                                      F.lit("x").alias("constant"), F.when(F.col("CoverSeq") > 1, "y").alias("one_value"),
                                      F.lit(None).cast("string").alias("nothing"))
    sparse, constant = set(C.drop_mostly_null(d)[1]), set(C.drop_constant_columns(d)[1])
    return spark.createDataFrame([(c, c in sparse, c in constant) for c in d.columns], "name string, mostly_null boolean, constant boolean")


# The essential columns that the policy view has.
ESSENTIAL = ["PolicyID", "TransactionMonth", "Gender", "Country", "Province", "RegistrationYear", "make", "Model", "cubiccapacity",
             "kilowatts", "CapitalOutstanding", "SumInsured", "CoverType", "TotalPremium", "TotalClaims"]


@query("f10_essential_columns", CTE + _counts_sql(ESSENTIAL))
def f10_essential_columns(spark, sf):
    """The essential columns of the claim extract and their values."""
    return finish(_counts(C.essential_projection(policy_view(spark, sf))))


_ALL = ["PolicyID", "CoverSeq", *KEPT, "TotalClaims"]


@query("a18_type_census", CTE + """, c AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS name, lower(any_value(typeof({c}))) AS t, count(*) AS n, count_if({c} IS NULL) AS missing, count(DISTINCT {c}) AS u FROM policy" for c in _ALL) + """)
SELECT CASE t WHEN 'varchar' THEN 'string' WHEN 'integer' THEN 'int' WHEN 'date' THEN 'timestamp' ELSE t END AS dtype,
  count(*) AS columns_of_type, max(n) AS n_rows, CAST(sum(missing) AS BIGINT) AS missing, CAST(sum(u) AS BIGINT) AS distinct_values FROM c GROUP BY 1""")
def a18_type_census(spark, sf):
    """Columns per type with the table's rows and the types' missing and distinct values."""
    d = P.column_profile(policy_view(spark, sf))
    return finish(d.groupBy("dtype").agg(F.max("columns_of_type").alias("columns_of_type"), F.max("n_rows").alias("n_rows"),
                                         F.sum("missing").cast("bigint").alias("missing"), F.sum("unique").alias("distinct_values")))


@query("a22_repair_log", CTE + """, d AS (SELECT abs(TotalPremium) AS p, greatest(TotalClaims, 0) AS c, SumInsured AS s FROM policy),
q AS (SELECT quantile_cont(p, 0.995) AS qp, quantile_cont(c, 0.99) AS qc, quantile_cont(s, 0.999) AS qs FROM d)
SELECT 'negative_premium_fixed' AS rule, count_if(TotalPremium < 0) AS n_rows FROM policy UNION ALL
SELECT 'negative_claims_fixed', count_if(TotalClaims < 0) FROM policy UNION ALL
SELECT 'future_registration_years_fixed', count_if(RegistrationYear > 2026) FROM policy UNION ALL
SELECT 'winsorized_TotalPremium', count_if(p > qp) FROM d, q UNION ALL
SELECT 'winsorized_TotalClaims', count_if(c > qc) FROM d, q UNION ALL
SELECT 'winsorized_SumInsured', count_if(s > qs) FROM d, q UNION ALL
SELECT 'imputed_SumInsured', count_if(SumInsured IS NULL) FROM policy UNION ALL
SELECT 'imputed_cubiccapacity', count_if(cubiccapacity IS NULL) FROM policy UNION ALL
SELECT 'imputed_kilowatts', count_if(kilowatts IS NULL) FROM policy""")
def a22_repair_log(spark, sf):
    return finish(etl.repair_log(stored_policy(spark, sf, ["TotalPremium", "TotalClaims", "SumInsured", "RegistrationYear", "cubiccapacity", "kilowatts"])))


@query("a43_prepared_summary", CTE + """SELECT count(*) AS n_records, count_if(PolicyID % 5 <> 0) AS n_train, count_if(PolicyID % 5 = 0) AS n_test,
  round(avg(TotalClaims), 4) AS target_mean, round(stddev_samp(TotalClaims), 4) AS target_std, CAST(4 AS BIGINT) AS n_features,
  CAST(2 AS BIGINT) AS n_numeric, CAST(2 AS BIGINT) AS n_categorical FROM policy""")
def a43_prepared_summary(spark, sf):
    d = policy_view(spark, sf).withColumn("split", F.when(F.col("PolicyID") % 5 == 0, "test").otherwise("train"))
    return finish(P.prepared_summary(d, feature_cols=["SumInsured", "kilowatts", "Province", "CoverType"]), default=4)


@query("l4_feature_importance", CTE + """SELECT 'x' AS feature, round(abs(regr_slope(ln(1 + TotalClaims), ln(1 + SumInsured))), 5) AS importance
FROM policy WHERE TotalClaims > 0 AND SumInsured IS NOT NULL""")
def l4_feature_importance(spark, sf):
    """Ranked |coefficient| of a one-feature regression."""
    d = policy_view(spark, sf).where((F.col("TotalClaims") > 0) & F.col("SumInsured").isNotNull())
    d = d.select(F.log1p("SumInsured").alias("x"), F.log1p("TotalClaims").alias("label"))
    model = M.regressors("label")["LinearRegression"].fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(d))
    return finish(spark.createDataFrame(M.feature_importance(model, ["x"]), "feature string, importance double"), default=5)


@query("m3_ordinal_codes", CTE + """, t AS (SELECT DISTINCT make FROM policy WHERE make <> 'Brand#11')
SELECT p.make, CAST(CASE WHEN p.make = 'Brand#11' THEN -1 ELSE (SELECT count(*) FROM t WHERE t.make < p.make) END AS DOUBLE) AS code, count(*) AS n
FROM policy p WHERE p.make IS NOT NULL GROUP BY p.make""")
def m3_ordinal_codes(spark, sf):
    """Alphabetical codes of a column of many categories; one unseen in training gets -1."""
    d = policy_view(spark, sf).where(F.col("make").isNotNull()).select("make")
    train = d.where(F.col("make") != "Brand#11")
    encoder = M.build_preprocessor(train, [], ["make"], cardinality=M.cardinalities(train, ["make"])).fit(train)
    return finish(encoder.transform(d).groupBy("make", F.col("make__idx").alias("code")).agg(F.count(F.lit(1)).alias("n")))
