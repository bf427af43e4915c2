"""Registered source / sink / ETL / streaming queries (S1-S14, section 3.1, streaming ingest).

Each query writes Spark-derived raw text from the test tables into a fresh
folder under the shared checkpoint directory, then runs the library's readers on
it, so the reader's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import clean as C
from claimlens.plans import etl
from claimlens.plans.registry import finish, query
from claimlens.session import scratch_path
from claimlens.sources import io as IO
from claimlens.sources.views import policy_cte, policy_view
from claimlens.streaming import ingest as ST

CTE = policy_cte()


def raw_from_policy(p, keep=()):
    """The policy rows in the 52-column raw layout, every value as text as a raw
    file would hold it (booleans as Yes/No, months as 'yyyy-MM-dd HH:mm:ss'), and the columns ``keep``."""
    have = {
        "UnderwrittenCoverID": F.concat_ws("-", F.col("PolicyID").cast("string"), F.col("CoverSeq").cast("string")),
        "PolicyID": F.col("PolicyID").cast("string"),
        "TransactionMonth": F.date_format("TransactionMonth", "yyyy-MM-dd HH:mm:ss"),
        "IsVATRegistered": F.when(F.col("CoverSeq") % 2 == 0, "True").otherwise("False"),
        "NewVehicle": F.when(F.col("CoverSeq") % 3 == 0, "More than 6 months").otherwise("Yes"),
        "RegistrationYear": F.col("RegistrationYear").cast("string"),
        "cubiccapacity": F.col("cubiccapacity").cast("string"),
        "kilowatts": F.col("kilowatts").cast("string"),
        "SumInsured": F.col("SumInsured").cast("string"),
        "CapitalOutstanding": F.col("CapitalOutstanding").cast("string"),
        "CalculatedPremiumPerTerm": F.col("CalculatedPremiumPerTerm").cast("string"),
        "TotalPremium": F.col("TotalPremium").cast("string"),
        "TotalClaims": F.col("TotalClaims").cast("string"),
        "Country": F.col("Country"), "Province": F.col("Province"), "PostalCode": F.col("PostalCode"),
        "Gender": F.col("Gender"), "LegalType": F.col("LegalType"), "CoverType": F.col("CoverType"),
        "make": F.concat(F.lit("  "), F.col("make"), F.lit(" ")), "Model": F.col("Model"),
    }
    return p.select(*[(have[c] if c in have else F.lit(None).cast("string")).alias(c) for c in IO.RAW_COLUMNS], *keep)


RT_SQL = CTE + """SELECT count(*) AS n_rows, round(sum(TotalPremium), 2) AS total_premium, round(sum(TotalClaims), 2) AS total_claims,
  count(SumInsured) AS n_sum_insured, count(DISTINCT PostalCode) AS n_postal, count(cubiccapacity) AS n_cc,
  count_if(CoverSeq % 3 = 0) AS n_new_vehicle_null, count_if(CoverSeq % 2 = 0) AS n_vat, count(DISTINCT trim(make)) AS n_make FROM policy"""


@query("s1_s2_s7_raw_roundtrip", RT_SQL)
def s1_s2_s7_raw_roundtrip(spark, sf):
    """Write the policy rows as a pipe-delimited raw file (S7), scan it back
    tolerantly (S1/S2) and type it (P1-P6); aggregates must equal the source."""
    path = IO.write_table(raw_from_policy(policy_view(spark, sf)), scratch_path(spark, "raw"), fmt="csv")
    t = C.type_raw(IO.read_raw_tolerant(spark, path))
    return finish(t.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("TotalPremium").alias("total_premium"),
                        F.sum("TotalClaims").alias("total_claims"), F.count("SumInsured").alias("n_sum_insured"),
                        F.count_distinct("PostalCode").alias("n_postal"), F.count("cubiccapacity").alias("n_cc"),
                        F.count_if(F.col("NewVehicle").isNull()).alias("n_new_vehicle_null"),
                        F.count_if(F.col("IsVATRegistered")).alias("n_vat"),
                        F.count_distinct("make").alias("n_make")), default=2)


@query("s3_s6_s9_prepared_tables", CTE + """SELECT CoverType, count(*) AS n, round(sum(TotalPremium), 2) AS total_premium FROM policy
WHERE CoverType IS NOT NULL GROUP BY CoverType""")
def s3_s6_s9_prepared_tables(spark, sf):
    """Column-subset scan (S3) of a prepared Parquet table materialised once by
    read-or-build (S6), written partitioned by cover type (S9-style partitioning)."""
    path = scratch_path(spark, "prepared")
    d = IO.read_or_build(spark, path, lambda: policy_view(spark, sf).select("CoverType", "TotalPremium", "PolicyID"))
    w = IO.write_table(d, scratch_path(spark, "bycover"), partition_by=["CoverType"])
    back = spark.read.parquet(w).select("CoverType", "TotalPremium")
    return finish(back.groupBy("CoverType").agg(F.count(F.lit(1)).alias("n"), F.sum("TotalPremium").alias("total_premium")),
                  default=2)


@query("s8_s10_s14_samples", None)
def s8_s10_s14_samples(spark, sf):
    """Reproducible 1000-row sample of the claim rows (S8) and the ordered head (S10/S14), written and re-read."""
    claims = policy_view(spark, sf).where(F.col("TotalClaims") > 0)
    p1 = IO.write_sample(claims, scratch_path(spark, "sample"), n=1000, fmt="parquet")
    p2 = IO.write_table(IO.head_rows(claims, 1000, ["PolicyID", "CoverSeq", "TotalClaims"]), scratch_path(spark, "head"))
    a = spark.read.parquet(p1).agg(F.count(F.lit(1)).alias("n"), F.sum("TotalClaims").alias("claims")).withColumn("sink", F.lit("sample"))
    b = spark.read.parquet(p2).agg(F.count(F.lit(1)).alias("n"), F.sum("TotalClaims").alias("claims")).withColumn("sink", F.lit("head"))
    return finish(a.unionByName(b), default=2)


@query("etl_process_summary", None)
def etl_process_summary(spark, sf):
    """The full ETL (section 3.1) on the raw round-trip file: quality-rule report rows."""
    path = IO.write_table(raw_from_policy(policy_view(spark, sf)), scratch_path(spark, "raw"), fmt="csv", compression="gzip")
    out, report = etl.process(IO.read_raw_tolerant(spark, path), current_year=1999)
    summ = out.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("TotalPremium").alias("total_premium"),
                   F.sum("TotalClaims").alias("total_claims"), F.avg("LossRatio").alias("mean_loss_ratio"))
    return finish(report.crossJoin(summ), default=4)


@query("stream_monthly_ingest", CTE + """SELECT date_trunc('month', TransactionMonth) AS month, round(sum(abs(TotalPremium)), 2) AS total_premium,
  round(sum(TotalClaims), 2) AS total_claims, count(*) AS policy_count, count_if(TotalClaims > 0) AS n_claims FROM policy GROUP BY 1""")
def stream_monthly_ingest(spark, sf):
    """Raw files land in a folder (two files: odd and even cover lines); the
    streaming ingest types and appends them (available-now trigger, checkpointed);
    the landed table's monthly series must equal the source's after the row
    repairs (absolute premium)."""
    # joined and written once, compressed, a folder for each of the two
    p = policy_view(spark, sf)
    raw = raw_from_policy(p.withColumn("_part", F.col("CoverSeq") % 2), ["_part"]).where("_part IN (0, 1)").withColumnRenamed("_part", "part")
    land = IO.write_table(raw, scratch_path(spark, "landing"), fmt="csv", partition_by=["part"], compression="gzip")
    out, ck = scratch_path(spark, "landed"), scratch_path(spark, "stream-ck")
    q = ST.start_ingest(spark, land + "/part=*", out, ck)
    q.awaitTermination()
    landed = spark.read.parquet(out)
    return finish(landed.groupBy("month").agg(F.sum("TotalPremium").alias("total_premium"),
                                              F.sum("TotalClaims").alias("total_claims"),
                                              F.count(F.lit(1)).alias("policy_count"),
                                              F.count_if(F.col("TotalClaims") > 0).alias("n_claims")), default=2)
