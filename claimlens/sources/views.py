"""The ``policy`` view: one insurance policy-month transaction per line item.

The driver's test tables form a star schema; the insurance table the operators
expect is a projection over it. The DataFrame form below and the SQL text used by
the DuckDB oracle describe the same rows. Joins carry no hints: the dimension
sides are planned as broadcast only when Spark's own size estimate (file size,
then AQE's runtime statistics) is under ``autoBroadcastJoinThreshold``; larger
dimensions at scale fall back to sort-merge joins on their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import stored

# Hidden columns that, together with PolicyID and CoverSeq, make every row unique
# (full line-item rows are unique; (l_orderkey, l_linenumber) is not).
POLICY_TIE_KEYS = ("PolicyID", "CoverSeq", "_k_partkey", "_k_suppkey", "_k_quantity",
                   "_k_extendedprice", "_k_discount", "_k_tax", "_k_returnflag",
                   "_k_linestatus", "_k_shipdate")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def policy_view(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    """Build the 19-column policy table (plus hidden tie keys when ``with_keys``)."""
    t = lambda n: load_table(spark, sf_dir, n)
    # Each side is cut to what the policy needs of it before it is joined, so that a join moves no column twice: customers
    # join orders, not line items, and the 25 nations come last, when a policy's nation is one number.
    l = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.date_trunc("month", F.col("l_shipdate")).alias("TransactionMonth"),
        F.when(F.col("l_quantity") == 13, F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice") * F.lit(10.0)).alias("SumInsured"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("CalculatedPremiumPerTerm"),
        F.when(F.col("l_linenumber") == 7, F.lit(0.0))
         .when(F.col("l_quantity") == 1, -F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("TotalPremium"),
        F.when((F.col("l_discount") >= 0.08) & (F.col("l_tax") >= 0.06),
               F.col("l_extendedprice") * F.col("l_discount") * F.lit(10.0))
         .otherwise(F.lit(0.0)).alias("TotalClaims"),
        *[F.col(f"l_{k[3:]}").alias(k) for k in POLICY_TIE_KEYS[2:] if with_keys])
    o = t("orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("_order_year"),
        (F.when(F.col("o_orderpriority") == "1-URGENT", "Male")
          .when(F.col("o_orderpriority") == "2-HIGH", "female")
          .when(F.col("o_orderpriority") == "3-MEDIUM", "M")
          .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Not specified")).alias("Gender"))
    c = t("customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    rg = t("region").select("r_regionkey", "r_name")
    p = t("part").select(
        "p_partkey", "p_name", "p_brand", "p_type", (F.col("p_size") % 25).alias("_years"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("p_size") * F.lit(100.0)).alias("cubiccapacity"),
        (F.col("p_retailprice") / F.lit(10.0)).alias("kilowatts"))
    j = (l.join(o.join(c, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
          .join(p, F.col("l_partkey") == F.col("p_partkey"))
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(rg, F.col("n_regionkey") == F.col("r_regionkey")))
    cols = [
        F.col("l_orderkey").alias("PolicyID"),
        F.col("l_linenumber").alias("CoverSeq"),
        "TransactionMonth",
        F.col("r_name").alias("Country"),
        F.col("n_name").alias("Province"),
        (F.lit(1000) + F.col("l_suppkey")).cast("string").alias("PostalCode"),
        "Gender",
        F.col("c_mktsegment").alias("LegalType"),
        F.col("p_type").alias("CoverType"),
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("Model"),
        (F.col("_order_year") - F.col("_years")).cast("int").alias("RegistrationYear"),
        "cubiccapacity", "kilowatts", "SumInsured",
        F.col("c_acctbal").alias("CapitalOutstanding"),
        "CalculatedPremiumPerTerm", "TotalPremium", "TotalClaims",
    ]
    if with_keys:
        cols += POLICY_TIE_KEYS[2:]
    return j.select(*cols)


def stored_policy(spark: SparkSession, sf_dir: str, columns, with_keys: bool = False) -> DataFrame:
    """Columns of the policy table, joined once and stored for queries that pass over them several times."""
    return stored(policy_view(spark, sf_dir, with_keys).select(*columns), "policy")


_POLICY_SELECT = """SELECT l.l_orderkey AS PolicyID, l.l_linenumber AS CoverSeq,
  date_trunc('month', l.l_shipdate) AS TransactionMonth,
  r.r_name AS Country, n.n_name AS Province, cast(1000 + l.l_suppkey as varchar) AS PostalCode,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Male' WHEN '2-HIGH' THEN 'female'
       WHEN '3-MEDIUM' THEN 'M' WHEN '4-NOT SPECIFIED' THEN 'Not specified' END AS Gender,
  c.c_mktsegment AS LegalType, p.p_type AS CoverType, p.p_brand AS make, p.p_name AS Model,
  cast(year(o.o_orderdate) - p.p_size % 25 as integer) AS RegistrationYear,
  CASE WHEN p.p_size % 10 = 0 THEN NULL ELSE p.p_size * 100.0e0 END AS cubiccapacity,
  p.p_retailprice / 10.0e0 AS kilowatts,
  CASE WHEN l.l_quantity = 13 THEN NULL ELSE l.l_extendedprice * 10.0e0 END AS SumInsured,
  c.c_acctbal AS CapitalOutstanding, l.l_extendedprice * l.l_tax AS CalculatedPremiumPerTerm,
  CASE WHEN l.l_linenumber = 7 THEN 0.0e0 WHEN l.l_quantity = 1 THEN -l.l_extendedprice
       ELSE l.l_extendedprice * (1.0e0 - l.l_discount) END AS TotalPremium,
  CASE WHEN l.l_discount >= 0.08e0 AND l.l_tax >= 0.06e0
       THEN l.l_extendedprice * l.l_discount * 10.0e0 ELSE 0.0e0 END AS TotalClaims{keys}
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey JOIN part p ON l.l_partkey = p.p_partkey"""

_KEYS_SQL = (",\n  l.l_partkey AS _k_partkey, l.l_suppkey AS _k_suppkey, l.l_quantity AS _k_quantity,"
             " l.l_extendedprice AS _k_extendedprice, l.l_discount AS _k_discount, l.l_tax AS _k_tax,"
             " l.l_returnflag AS _k_returnflag, l.l_linestatus AS _k_linestatus, l.l_shipdate AS _k_shipdate")


def policy_cte(with_keys: bool = False, name: str = "policy") -> str:
    """``WITH policy AS (...)`` text for the DuckDB oracle."""
    return f"WITH {name} AS (\n{_POLICY_SELECT.format(keys=_KEYS_SQL if with_keys else '')}\n)\n"
