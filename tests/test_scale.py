"""Plans and rewrites that matter at scale: split hot keys, selected quantiles, fingerprints, Gram matrices, batches."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators import clean as C
from claimlens.operators import crossval as CV
from claimlens.operators import hypothesis as H
from claimlens.operators import ml as M
from claimlens.operators import profile as P
from claimlens.operators.quantiles import aggregate, from_keys, median, order_keys, quantile, select_ranks
from claimlens.plans import battery as B

HOT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.shuffle.partitions": "8",
       "spark.sql.adaptive.coalescePartitions.enabled": "false",
       "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}


@pytest.fixture
def hot(spark):
    """Thresholds low enough for a small hot key, and no broadcasts."""
    before = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("operator", [lambda d: C.min_group_size(d, "g", 2), lambda d: C.impute_group_median(d, "x", "g")])
def test_hot_key_is_split(hot, operator):
    """A third of all rows on one key: the join back of a group statistic is split."""
    d = hot.range(0, 60_000, 1, 16).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)).alias("g"),
                                          F.when(F.col("id") % 7 > 0, F.rand(1)).alias("x"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    assert "skew=true" in executed(operator(d))


def test_order_keys_round_trip():
    v = np.array([float("-inf"), -1e300, -1.5, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, float("inf"), float("nan")])
    k = order_keys(v)
    assert (np.diff(k) > 0).all() and order_keys(np.array([-0.0]))[0] == order_keys(np.array([0.0]))[0]
    assert (from_keys(k)[:-1] == v[:-1]).all() and math.isnan(from_keys(k)[-1])


def test_selected_quantiles(spark):
    """All ways a bucket ends: one value, first or last of it, and four passes over values that differ in the last bits."""
    rng = random.Random(2)
    near = [1.0 + i * 2.0 ** -52 for i in range(40)]
    cols = {"a": [rng.gauss(0, 1e3) for _ in range(400)], "b": [rng.choice([0.0, -0.0, 1.0]) for _ in range(400)], "c": near * 10,
            "d": [None] * 400, "e": [10.0 ** rng.randint(-300, 300) * rng.choice([-1, 1]) for _ in range(400)], "f": [7.0] + [None] * 399}
    rows = list(zip(*cols.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(7)
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = aggregate(df, *[quantile(c, qs).alias(c) for c in cols], median("a").alias("m"), F.count(F.lit(1)).alias("n")).first()
    assert got["n"] == 400 and list(got.asDict()) == [*cols, "m", "n"]
    for c, values in cols.items():
        values = [v for v in values if v is not None]
        want = np.quantile(values, qs).tolist() if values else [None] * len(qs)
        for x, y in zip(got[c], want):
            assert (x is None and y is None) or math.isclose(x, y, rel_tol=1e-12)
    found, sizes = select_ranks(df, [F.col("c")], lambda j, n: range(n))
    assert sizes == [400] and [found[0][i] for i in range(400)] == sorted(cols["c"])


def test_whole_row_duplicates(spark):
    nan = float("nan")
    rows = [(1, nan, None), (1, nan, None), (1, None, None), (2, 0.0, "x"), (2, -0.0, "x"), (3, 1.0, "y"), (3, 1.0, "z")] + [(9, 9.0, "hot")] * 50
    df = spark.createDataFrame(rows, "k int, x double, `t.t` string").repartition(5)
    assert C.dedupe(df).count() == df.dropDuplicates().count() == 6
    r = C.duplicate_stats(df, "k").first()
    assert (r.duplicate_rows, r.n_rows, r.rows_sharing_key) == (51, 57, 57)
    e = C.duplicate_stats(df.limit(0), "k").first()
    assert (e.duplicate_rows, e.rows_sharing_key, e.duplicate_pct) == (0, 0, None)


def test_correlations_with_gaps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1.0, (300, 4))
    x[:, 1] += 2 * x[:, 0]
    x[:, 3] = 5.0
    x[rng.random((300, 4)) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double, d double").repartition(6)
    got = {(r.col_a, r.col_b): r.r for r in P.correlation_matrix(df, list("abcd")).collect()}
    assert len(got) == 16
    for i, a in enumerate("abcd"):
        for j, b in enumerate("abcd"):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if "d" in (a, b):
                assert got[a, b] is None
            else:
                assert math.isclose(got[a, b], np.corrcoef(x[both, i], x[both, j])[0, 1], rel_tol=1e-7, abs_tol=1e-9)


def claims(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x1, x2 = rng.normal(1000, 50), rng.exponential(3.0)
        g, many = rng.choice(["a", "b", "c"]), f"m{rng.integers(15):02d}"
        y = 0.01 * x1 - 0.5 * x2 + {"a": 0, "b": 1, "c": -1}[g] + 0.1 * int(many[1:]) + rng.normal(0, 0.3)
        rows.append((None if rng.random() < 0.1 else float(x1), None if rng.random() < 0.1 else float(x2), str(g), many, float(y), i % 5))
    return rows, spark.createDataFrame(rows, "x1 double, x2 double, g string, many string, y double, _fold int").repartition(6)


def test_linear_folds_against_a_direct_fit(spark):
    """Gram matrices give the errors of models that are fitted row by row, encoder inside the folds."""
    rows, df = claims(spark)
    folds = CV.fold_grams(df, ["x1", "x2"], ["g", "many"], "y", max_onehot=10)
    got = CV.cross_validate_linear(folds)
    for k in range(5):
        train, test = [r for r in rows if r[5] != k], [r for r in rows if r[5] == k]
        fill = [np.median([r[j] for r in train if r[j] is not None]) for j in (0, 1)]
        many = sorted({r[3] for r in train})
        x = lambda rs: np.array([[*(fill[j] if r[j] is None else r[j] for j in (0, 1)), r[2] == "b", r[2] == "c", many.index(r[3]) if r[3] in many else -1] for r in rs], float)
        a, y = x(train), np.array([r[4] for r in train])
        mean, sd = a.mean(axis=0), a.std(axis=0, ddof=1)
        z, c = (a - mean) / sd, y - y.mean()
        for name, (penalty, l1) in CV.LINEAR_MODELS.items():
            b = np.zeros(z.shape[1])
            for _ in range(3000):  # proximal steps on the rows themselves
                step = 1 / np.linalg.norm(z.T @ z / len(z) + penalty * (1 - l1) * np.eye(z.shape[1]), 2)
                b = b - step * (z.T @ (z @ b - c) / len(z) + penalty * (1 - l1) * b)
                b = np.sign(b) * np.maximum(np.abs(b) - step * penalty * l1, 0)
            error = np.sqrt(np.mean((np.array([r[4] for r in test]) - y.mean() - (x(test) - mean) / sd @ b) ** 2))
            assert math.isclose(got[name][k], error, rel_tol=1e-6), (name, k)


def test_searches_on_gram_matrices(spark):
    _, df = claims(spark)
    folds = CV.fold_grams(df, ["x1", "x2"], ["g", "many"], "y")
    penalty, error, every = CV.search_linear(folds, 1.0)
    assert error == min(every) and len(every) == len(CV.PATH) and penalty < 0.1
    params, least = CV.search_least_squares(folds)
    assert params["fit_intercept"] in (True, False) and least <= np.mean(CV.cross_validate_linear(folds)["LinearRegression"]) + 1e-12
    coef = CV.fitted(folds, 0.0, 0.0)
    assert math.isclose(coef["x1"], 0.01, rel_tol=0.2) and math.isclose(coef["x2"], -0.5, rel_tol=0.2)
    h, g = np.array([[1.0, 0.5], [0.5, 1.0]]), np.array([1.0, -0.2])
    assert (CV.descend(h, g, 0.0, 0.0, positive=True) >= 0).all()
    assert CV.descend(h, g, 5.0, 1.0).tolist() == [0.0, 0.0]
    with pytest.raises(ValueError):
        CV.fold_grams(df, [], ["many"], "y", max_categories=3)


def test_concurrent_fold_fits(spark):
    """Tree models over folds: as many errors as folds, and those of a fit on its own."""
    _, df = claims(spark, 200)
    made = {"DecisionTree": lambda: M.regressors("y", trees=3, rounds=3)["DecisionTree"]}
    got = CV.cross_validate_fits(df, ["x1", "x2"], ["g"], "y", made, parallelism=3)
    train, test = df.where("_fold <> 2"), df.where("_fold = 2")
    imputer = M.fit_imputer(train, ["x1", "x2"], ["g"])
    train = imputer.apply(train)
    encoder = M.build_preprocessor(train, ["x1", "x2"], ["g"], cardinality=M.cardinalities(train, ["g"])).fit(train)
    pred = made["DecisionTree"]().fit(encoder.transform(train)).transform(encoder.transform(imputer.apply(test)))
    assert len(got["DecisionTree"]) == 5
    assert math.isclose(got["DecisionTree"][2], pred.agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0], rel_tol=1e-9)


def test_spearman_in_one_pass(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1.0, 2.0, 3.0]), rng.gauss(0, 1), 5.0, rng.choice([0.0, 1.0, 2.0, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, k double, t double").repartition(5)
    got = {r.feature: r for r in M.spearman_table(df, ["a", "b", "k"], "t").collect()}

    def ranks(v):
        order = sorted(v)
        return [(order.index(x) + len(v) - 1 - order[::-1].index(x)) / 2 for x in v]
    for i, c in enumerate("ab"):
        both = [(r[i], r[3]) for r in rows if r[i] is not None and r[3] is not None]
        want = np.corrcoef(ranks([x for x, _ in both]), ranks([y for _, y in both]))[0, 1]
        assert got[c].n == len(both) and math.isclose(got[c].spearman_rho, want, rel_tol=1e-9)
    assert got["k"].spearman_rho is None


def test_batch_is_one_scan_and_two_exchanges(spark, tmp_path):
    """Lists of features and metrics: the rows of single tests, from a plan that scans once."""
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y"]), rng.randint(0, 1), rng.gauss(0, 1), None if rng.random() < 0.1 else rng.gauss(2, 1)) for _ in range(500)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "p string, q string, HasClaim int, m double, s double").write.parquet(path)
    df = spark.read.parquet(path)
    out = B.two_group_tests(df, ["p", "q"], ["HasClaim", "m", "s"])
    got = {(r.feature, r.metric): r for r in out.collect()}
    assert len(got) == 6
    tests = [(f, m) for f in ("p", "q") for m in ("m", "s")]
    plan = B.two_group_tests(df, ["p", "q"], ["m", "s"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    physical = executed(B.two_group_tests(df, ["p", "q"], ["m", "s"]))
    final = physical.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 2 and final.count("FileScan") == 1
    for f, m in tests:
        rows_, names = B.label_two_largest(df, f)
        one = H.t_test(rows_, "_grp", m, "A", "B").first()
        assert math.isclose(got[f, m].statistic, one.statistic, rel_tol=1e-9) and math.isclose(got[f, m].p_value, one.p_value, rel_tol=1e-9)
    rows_, _ = B.label_two_largest(df, "p")
    assert math.isclose(got["p", "HasClaim"].statistic, H.two_by_two(rows_, "_grp", "HasClaim", "A", "B").first().statistic, rel_tol=1e-9)
    few = B.two_group_tests(df.limit(20), ["p"], ["m"], {"p": ("a", "c")}).first()
    assert (few.group_a, few.group_b, few.decision, few.p_value) == ("a", "c", "Insufficient Data", None)


def test_numeric_coercion_casts_once(spark):
    """a cast named three times is worked out up to three times a row."""
    from claimlens.functions import expr as X
    df = spark.createDataFrame([(" 1.5 ",), ("NaN",), ("Infinity",), ("-Infinity",), ("x",), ("-0",), (None,)], "t string")
    out = df.select(X.to_double("t").alias("v"), X.amount_strip_commas("t").alias("w"))
    assert [tuple(r) for r in out.collect()] == [(1.5, 1.5), (None, None), (None, None), (None, None), (None, None), (0.0, 0.0), (None, None)]
    plan = df.select(X.to_double("t").alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == 1


def test_methods_that_are_too_long_to_compile_are_not_fused(spark):
    """Spark's own bound leaves methods that HotSpot only interprets; another bound of the session's stays."""
    from claimlens.session import METHOD_LIMIT, limit_methods
    was = spark.conf.get(METHOD_LIMIT)
    try:
        for given, kept in (("65535", "8000"), ("20000", "20000")):
            spark.conf.set(METHOD_LIMIT, given)
            limit_methods(spark)
            assert spark.conf.get(METHOD_LIMIT) == kept
    finally:
        spark.conf.set(METHOD_LIMIT, was)


def test_forest_in_groups_of_trees(spark):
    """many rows are fitted in groups of trees; all trees are there and count alike."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import RandomForestRegressor

    from claimlens.operators import ml as M
    d = spark.range(60).select(array_to_vector(F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double"))).alias("features"),
                               (F.col("id") % 2).cast("double").alias("label"), F.col("id"))
    for make in (RandomForestClassifier, RandomForestRegressor):
        parts = M.fit_forest(make(numTrees=7, maxDepth=3), d, 60, whole_rows=50, at_once=3)
        assert [g.getNumTrees for g in parts.groups] == [3, 3, 1]
        whole = M.fit_forest(make(numTrees=7, maxDepth=3), d, 60, whole_rows=60, at_once=3)
        assert [g.getNumTrees for g in whole.groups] == [7]
        plain = make(numTrees=7, maxDepth=3, seed=42).fit(d)
        own = (lambda m: m.transform(d).select("id", (vector_to_array("probability")[1] if make is RandomForestClassifier else F.col("prediction")).alias("s")))
        values = lambda x: [r["s"] for r in x.orderBy("id").collect()]
        assert values(whole.score(d, "s")) == pytest.approx(values(own(plain)))
        each = [values(own(g)) for g in parts.groups]
        assert values(parts.score(d, "s")) == pytest.approx([(3 * a + 3 * b + c) / 7 for a, b, c in zip(*each)])
