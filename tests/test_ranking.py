"""Distributed ranks equal window ranks, for any partition count (section 5, invariance)."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimlens.operators import features as FE
from claimlens.operators import ranking as R


def _frame(spark):
    random.seed(3)
    rows = [(random.choice("abc"), float(random.choice([0, 0, 0, 1, 2, 3, 5, 8])), i % 7) for i in range(400)]
    rows += [("a", 0.0, 1)] * 200  # a hot group of exact copies
    return spark.createDataFrame(rows, "g string, x double, t long")


def test_row_number_matches_window(spark):
    df = _frame(spark)
    ref = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("x", "t")))
                 .select("g", "x", "t", "rn").collect())
    for n in (1, 3, 8):
        got = sorted(tuple(r) for r in R.row_number_global(df, ["x", "t"], by=["g"], num_partitions=n)
                     .select("g", "x", "t", "rn").collect())
        assert got == ref


def test_hot_copies_are_chunked(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 16)
    df = _frame(spark)
    got = R.row_number_global(df, ["x", "t"], by=["g"], num_partitions=4)
    assert got.count() == 600
    assert got.groupBy("g").agg(F.max("rn").alias("m"), F.count(F.lit(1)).alias("n")).where("m != n").count() == 0


def test_value_ranks_are_average_ranks(spark):
    df = _frame(spark)
    pdf = df.toPandas()
    pdf["ar"] = pdf.groupby("g")["x"].rank(method="average")
    exp = pdf.groupby(["g", "x"])["ar"].first().to_dict()
    for r in R.value_ranks(df, "x", by=["g"]).collect():
        assert abs(exp[(r.g, r.x)] - r.avg_rank) < 1e-9


def test_rank_quintiles_sizes(spark):
    # 13 rows with ties: rank-first quintile sizes 3,2,3,2,3 (pd.qcut on ranks)
    vals = [5, 1, 1, 2, 3, 3, 3, 4, 8, 8, 9, 10, 10]
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(vals)], "t double, k long")
    b = FE.add_rank_bins(df, "t", ["k"], unique=True)
    sizes = [r["count"] for r in b.groupBy("StratifyBin").count().collect()]
    q5 = {r[0]: r[1] for r in b.groupBy("ClaimSeverityQuintile").count().collect()}
    assert [q5[k] for k in FE.SEVERITY_QUINTILES] == [3, 2, 3, 2, 3]
    ranks = pd.Series(vals).rank(method="first")
    exp = pd.qcut(ranks, 10, labels=False).value_counts().sort_index().tolist()
    assert sorted(sizes) == sorted(exp)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranks_hold_without_exchange_reuse(spark, reuse):
    df = spark.range(200_000).select(F.xxhash64("id").alias("x"), (F.col("id") % 3).alias("g"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        for n in (1, 3, 8, 50):
            got = R.row_number_global(df, ["x"], unique=True, num_partitions=n)
            r = got.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn"), F.max("n_group")).first()
            assert tuple(r) == (1, 200_000, 200_000, 200_000)
        ref = df.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("x")))
        got = R.row_number_global(df, ["x"], by=["g"], num_partitions=8)
        assert got.join(ref, ["g", "x"]).where("rn = want").count() == 200_000
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
