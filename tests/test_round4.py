"""Findings of round 4 on steps that were missing, and on tables that were joined or written more than once."""

import datetime as dt
import glob
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from claimlens.operators import ml as M
from claimlens.operators import trees as TR
from claimlens.plans import q_io, q_ml
from claimlens.session import stored


def test_attribution_of_a_forest_is_exact(spark):
    """the trees' Shapley values, by their definition over all sets of columns."""
    rng = np.random.default_rng(5)
    rows = [([float(v) for v in rng.integers(0, 6, 3)], 0.0) for _ in range(400)]
    rows = [(x, x[0] * x[1] - x[2] + float(rng.normal())) for x, _ in rows]
    d = spark.createDataFrame(rows, "x array<double>, y double").select(array_to_vector("x").alias("features"), "y")
    model = TR.fit_all(spark, {"f": (TR.pack(d, "y"), M.regressors("y", trees=3, depth=3)["RandomForest"])})["f"]
    x = np.array([r[0] for r in rows[:20]])
    bins = model.bins(x)

    def value(tree, i, row, known):  # unknown columns go both ways by weight
        if tree.depth == (i + 1).bit_length() - 1:
            return tree.mean[i]
        j = tree.column[i]
        if j < 0:
            return value(tree, 2 * i + 1, row, known)
        if j in known:
            return value(tree, 2 * i + 1 + int(bins[j, row] > tree.bin[i]), row, known)
        return sum(tree.weight[c] / tree.weight[i] * value(tree, c, row, known) for c in (2 * i + 1, 2 * i + 2))
    got = TR.shapley(TR.shapley_paths(model), model.cuts, x)
    for row, j in itertools.product(range(20), range(3)):
        want = 0.0
        for n in range(3):
            for s in itertools.combinations([k for k in range(3) if k != j], n):
                share = math.factorial(n) * math.factorial(2 - n) / 6
                want += share * sum(w * (value(t, 0, row, {*s, j}) - value(t, 0, row, set(s))) for t, w in zip(model.trees, model.weights))
        assert math.isclose(got[j, row], want, abs_tol=1e-9)
    every = TR.shapley(TR.shapley_paths(model), model.cuts, np.array([r[0] for r in rows]))
    table = M.with_rank(M.tree_attribution(model, d, ["a", "b", "c"]), "mean_abs_attribution", "place").orderBy("place").collect()
    assert [r.place for r in table] == [1, 2, 3] and table[0].mean_abs_attribution == pytest.approx(np.abs(every).mean(axis=1).max())


def test_permuted_bins_are_permuted_values(spark):
    """rows that travel as bins give the errors of whole rows."""
    d = spark.range(300).select(array_to_vector(F.array((F.col("id") % 17).cast("double"), (F.col("id") % 5).cast("double"))).alias("features"),
                                (F.col("id") % 17 + F.col("id") % 5 * 0.1).alias("label"))
    model = TR.fit_all(spark, {"t": (TR.pack(d, "label"), M.regressors("label", depth=4)["DecisionTree"])})["t"]
    got = {r.feature: r.rmse_increase for r in M.permutation_importance(model, d, ["a", "b"]).collect()}
    theirs = {r.feature: r.rmse_increase for r in M.permutation_importance(M.regressors("label", depth=4)["DecisionTree"].fit(d), d, ["a", "b"]).collect()}
    assert got["a"] > 1 and abs(got["a"] - theirs["a"]) < 0.5 * theirs["a"] and abs(got["b"] - theirs["b"]) < 0.2


def policies(spark):
    return spark.createDataFrame([(i, 1 + i % 7, dt.datetime(2015, 1 + i % 3, 1), 10.0 * i, 100.0 + i, 5.0 * (i % 2)) for i in range(1, 60)],
                                 "PolicyID long, CoverSeq int, TransactionMonth timestamp, TotalPremium double, SumInsured double, TotalClaims double") \
        .withColumns({c: F.lit(None).cast("string") for c in ("Country", "Province", "PostalCode", "Gender", "LegalType", "CoverType", "make", "Model")}) \
        .withColumns({c: F.lit(1.0) for c in ("RegistrationYear", "cubiccapacity", "kilowatts", "CapitalOutstanding", "CalculatedPremiumPerTerm")})


def test_raw_files_are_written_once_and_compressed(spark, monkeypatch):
    """one write of one join lands both files; before, two plain ones."""
    written, write = [], q_io.IO.write_table
    monkeypatch.setattr(q_io, "policy_view", lambda *_: policies(spark))
    monkeypatch.setattr(q_io.IO, "write_table", lambda *a, **k: written.append(write(*a, **k)) or written[-1])
    got = {r.month.month: r.policy_count for r in q_io.stream_monthly_ingest(spark, "").collect()}
    assert got == {m: sum(1 + i % 3 == m for i in range(1, 60)) for m in (1, 2, 3)}
    assert len(written) == 1 and glob.glob(f"{written[0]}/part=0/*.csv.gz") and glob.glob(f"{written[0]}/part=1/*.csv.gz") and not glob.glob(f"{written[0]}/*/*.csv")


def test_folds_read_stored_rows(spark, monkeypatch):
    """the rows of the folds are stored once, not joined by every fit."""
    kept = []
    monkeypatch.setattr(q_ml, "_pol", lambda *_, **__: policies(spark))
    monkeypatch.setattr(q_ml, "stored", lambda *a: kept.append(stored(*a)) or kept[-1])
    assert q_ml.m16_one_feature_folds(spark, "").first().folds == 5 and [d.columns for d in kept] == [["x", "label", "fold"]]


def test_stored_tables_are_compressed_further(spark):
    """F8."""
    assert all("zstd" in f for f in stored(spark.range(10)).inputFiles())
