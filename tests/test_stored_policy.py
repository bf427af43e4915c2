"""The policy view: narrow joins with the rows of its SQL, and queries of several passes that join it once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from claimlens.operators import clean as C
from claimlens.plans import etl
from claimlens.plans import modelling as MO
from claimlens.session import stored
from claimlens.sources.views import policy_view

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "AFRICA"), (1, None)]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "KENYA", 0), (1, "PERU", 1), (2, "LOST", 9)]),
    "customer": ("c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string",
                 [(1, 0, 10.0, "BUILDING"), (2, 1, -5.0, None), (3, 2, 1.0, "AUTO"), (2, 1, -5.0, "TWICE"), (None, 0, 2.0, "X")]),
    "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
             [(1, "a", "Brand#11", "T1", 10, 900.0), (2, "b", "Brand#12", "T2", 33, None), (3, "c", None, "T3", None, 100.0)]),
    "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
               [(k, k % 4, None if k == 5 else dt.datetime(1995, 1 + k % 12, 3), ["1-URGENT", "2-HIGH", "5-LOW", None][k % 4]) for k in range(1, 40)]),
    "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
                 "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                 [(None if i == 7 else 1 + i // 7, 1 + i % 7, 1 + i % 4, i % 9, float(1 + i % 14), None if i % 31 == 0 else 100.0 + i * 7.25,
                   i % 11 / 100, i % 9 / 100, "R", "O", None if i == 11 else dt.datetime(1996, 1 + i % 12, 5)) for i in range(250)]),
}


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("star"))
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stored_rows_are_read_not_replayed(spark):
    d = spark.range(100).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") * 0.5).alias("b"))
    kept = stored(d)
    assert sorted(kept.collect(), key=str) == sorted(d.collect(), key=str) and "Range" not in optimized(kept)


def test_only_what_is_asked_for_is_joined(spark, star):
    """Prices give way to the amounts made of them before a line item is joined, and customers join orders."""
    joined = [x for x in optimized(policy_view(spark, star).select("PolicyID", "TotalClaims")).splitlines() if "Project" in x]
    assert not [x for x in joined if "l_tax" in x and "CASE" not in x]
    assert [x for x in joined if "o_orderkey" in x and "c_nationkey" in x and "l_orderkey" not in x]


def test_rows_of_the_view(spark, star):
    """Null, missing and repeated keys: as many rows of the same values as the tables joined whole gave."""
    d = policy_view(spark, star)
    assert d.count() == 144
    assert int(d.select(F.sum(F.xxhash64(*d.columns).cast("decimal(38,0)"))).first()[0]) == 76674564644351761744


def star_reads(df):
    return optimized(df).count("l_orderkey")


# Queries that pass over the policies several times.
PASSES = [
    "p28_p29_ratio_features",
    "m1_m5_encoded_features",
    "a22_repair_log",
    "p35_p40_model_features",
    "a27_iqr_outliers",
    "p49_winsorize_report",
    "a10_a11_describe",
    "a40_distribution_stats",
    "p26_excess_features",
    "m13_logistic_one_flag",
    "a28_outlier_impact",
    "p46_median_impute",
    "f9_guards",
    "p42_p44_target_transforms",
]


@pytest.mark.parametrize("name", PASSES)
def test_policies_are_joined_once(spark, star, name):
    """What a query leaves to its caller reads stored policies; before, it joined the tables again for every pass."""
    assert star_reads(entry.queries()[name](spark, star)) == 0


def test_narrow_rows_are_shuffled_once(spark):
    """Whole rows of few columns are grouped as they are; before, they were shuffled as fingerprints and twice more to split off the twins."""
    d = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", float("nan")), (2, "b", float("nan")), (3, "c", 0.0), (3, "c", -0.0), (4, None, 1.0)], "k int, v string, x double")
    once = C.dedupe(d)
    assert once.count() == 4 and "Join" not in optimized(once)
    assert C.duplicate_stats(d, "k").first()["duplicate_rows"] == 3 and "_print_a" not in optimized(C.duplicate_stats(d, "k"))


def test_etl_stores_columns(spark):
    """The processed table and its report are read from stored columns, not from a checkpoint's whole rows."""
    d = spark.createDataFrame([(f"{i}", "2015-03-01 00:00:00", "Male", f"{i}.5", "0.0" if i % 3 else "7", None if i % 4 else "100") for i in range(60)],
                              "PolicyID string, TransactionMonth string, Gender string, TotalPremium string, TotalClaims string, SumInsured string")
    out, report = etl.process(d)
    assert out.count() == 60 and "parquet" in optimized(out) and "LogicalRDD" not in optimized(out) and "parquet" in optimized(report)


def test_rows_per_task_of_a_fit(spark):
    """120,000 rows are one task a step: histograms of tasks with fewer rows cost more than the rows."""
    d = MO.stored_features(spark.range(120_000))
    assert d.rdd.getNumPartitions() == 1 and d.count() == 120_000
    assert MO.stored_features(spark.range(450_000)).rdd.getNumPartitions() == 3
