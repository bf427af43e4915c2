"""Encoding, selection, splitting, models, evaluation and attribution.

Every estimator is an MLlib stage (distributed training); every metric is one
aggregate over the prediction frame; fitted pipelines persist with MLlib's
writer (S13).
"""

from __future__ import annotations

import functools
import json
import operator
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, StandardScalerModel, StringIndexer, VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators import ranking as R
from claimlens.operators import trees as TR
from claimlens.operators.quantiles import aggregate, median
from claimlens.session import materialize, stored


# ------------------------------------------------------------- encoding M1-M5

def build_preprocessor(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], *,
                       max_onehot: int = 10, drop_first: bool = True, scale: bool = True,
                       cardinality: dict | None = None) -> Pipeline:
    """M1-M4: numeric -> assembled and standardised (mean and sample std);
    categorical with <= ``max_onehot`` categories -> a 0/1 column for each category in alphabetical order, the first one
    dropped (all with ``drop_first=False``), so that an unseen value or a gap is all zeros; above it ->
    alphabetical ordinal index, unseen values -1. ``cardinality`` must hold the exact distinct
    counts of ``df`` (:func:`cardinalities`). Imputation is done before by a fitted
    :class:`Imputer` because MLlib's Imputer median is approximate."""
    cardinality = cardinality or {}
    stages, inputs = [], []
    few = [c for c in cat_cols if cardinality.get(c, 0) <= max_onehot]
    seen = df.agg(*[F.sort_array(F.collect_set(F.col(f"`{c}`").cast("string"))).alias(f"c{i}") for i, c in enumerate(few)]).first() if few else ()
    categories = dict(zip(few, seen))  # at most max_onehot values each
    for c in cat_cols:
        if c in categories:
            kept = categories[c][1:] if drop_first else categories[c]
            names = [re.sub(r"\W", "_", f"{c}_{v}") for v in kept]
            names = [n if names.count(n) == 1 else f"{n}_{i}" for i, n in enumerate(names)]
            quoted = [v.replace("\\", "\\\\").replace("'", "\\'") for v in kept]
            flags = "".join(f", CASE WHEN CAST(`{c}` AS STRING) = '{v}' THEN 1.0D ELSE 0.0D END AS `{n}`" for v, n in zip(quoted, names))
            stages.append(SQLTransformer(statement=f"SELECT *{flags} FROM __THIS__"))
            inputs += names
        else:
            stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__raw", handleInvalid="keep", stringOrderType="alphabetAsc"))
            stages.append(SQLTransformer(statement=f"SELECT *, CASE WHEN `{c}__raw` >= {cardinality[c]} THEN -1.0D "
                                                   f"ELSE `{c}__raw` END AS `{c}__idx` FROM __THIS__"))
            inputs.append(f"{c}__idx")
    if num_cols:
        stages.append(VectorAssembler(inputCols=list(num_cols), outputCol="__num", handleInvalid="keep"))
        if scale:
            stages.append(StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True, withStd=True))
            inputs.insert(0, "__num_s")
        else:
            inputs.insert(0, "__num")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


@dataclass(frozen=True)
class Imputer:
    """Fitted fills: numeric medians and categorical constants or most frequent values. Fitted once
    on the training rows and applied alike to train, test and new rows."""

    medians: dict = field(default_factory=dict)
    fills: dict = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        out = {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in {**self.medians, **self.fills}.items()
               if c in df.columns and v is not None}
        return df.withColumns(out) if out else df

    def save(self, spark, path: str) -> None:
        """The fills as one JSON row."""
        spark.createDataFrame([(json.dumps({"medians": self.medians, "fills": self.fills}),)], "value string").write.text(path)

    @classmethod
    def load(cls, spark, path: str) -> Imputer:
        return cls(**json.loads(spark.read.text(path).first()[0]))


def fit_imputer(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], categorical: str = "constant",
                value: str = "Unknown") -> Imputer:
    """M1 / M2: exact medians (one pass for all columns); for categorical columns ``value``, or with
    ``categorical='most_frequent'`` the most frequent value (ties by value)."""
    num, cat = [c for c in num_cols if c in df.columns], [c for c in cat_cols if c in df.columns]
    row = aggregate(df, *[median(c).alias(f"m{i}") for i, c in enumerate(num)]).first() if num else None
    fills = {c: value for c in cat}
    if cat and categorical == "most_frequent":
        melted = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cat])).alias("e"))
        counts = melted.where("e.v IS NOT NULL").groupBy("e.c", "e.v").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("c").agg(F.min(F.struct(-F.col("n"), F.col("v").alias("v")))["v"].alias("v"))
        fills = {c: None for c in cat} | {r["c"]: r["v"] for r in best.collect()}  # one row per column
    return Imputer({c: row[f"m{i}"] for i, c in enumerate(num)}, fills)


def save_model(model: PipelineModel, imputer: Imputer, path: str) -> None:
    """A fitted pipeline (encoder and estimator) and its imputer."""
    from pyspark.sql import SparkSession
    model.write().overwrite().save(f"{path}/pipeline")
    imputer.save(SparkSession.getActiveSession(), f"{path}/imputer")


def load_model(spark, path: str) -> tuple[PipelineModel, Imputer]:
    return PipelineModel.load(f"{path}/pipeline"), Imputer.load(spark, f"{path}/imputer")


def feature_names(model: PipelineModel, transformed: DataFrame, num_cols: Sequence[str] = (), col: str = "features") -> list[str]:
    """M5: slot names from the vector's ML attribute metadata; the slots of the scaled numeric columns get the names
    ``num_cols``, categories ``column_value``."""
    meta = transformed.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = []
    for kind in ("numeric", "binary", "nominal"):
        slots += meta.get(kind, [])
    names = [a["name"] for a in sorted(slots, key=lambda a: a["idx"])]
    numeric = {f"{prefix}_{i}": c for prefix in ("__num_s", "__num") for i, c in enumerate(num_cols)}
    return [numeric.get(n, n.removesuffix("__idx")) for n in names]


def feature_arrays(model: PipelineModel, df: DataFrame, out: str = "features") -> DataFrame:
    """The fitted preprocessor's features as an array of doubles, by column expressions: vectors assembled, scaled and assembled
    again row by row cost several times as much."""
    cols = df.columns
    parts = {}
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            parts[stage.getOutputCol()] = [x for c in stage.getInputCols()
                                           for x in parts.get(c, [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan")))])]
        elif isinstance(stage, StandardScalerModel):
            mean, std = stage.mean.toArray(), stage.std.toArray()
            parts[stage.getOutputCol()] = [(x - F.lit(float(m))) * F.lit(1.0 / float(s) if s else 0.0)
                                           for x, m, s in zip(parts[stage.getInputCol()], mean, std)]
        else:
            df = stage.transform(df)
    return df.select(*[F.col(f"`{c}`") for c in cols if c != out], F.array(*parts["features"]).alias(out))


def cardinalities(df: DataFrame, cols: Sequence[str]) -> dict:
    """Exact distinct counts of categorical columns (the encoder layout depends on them)."""
    if not cols:
        return {}
    row = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


# --------------------------------------------------------------- selection M6-M7

def spearman_select(df: DataFrame, features: Sequence[str], target: str, threshold: float = 0.05) -> list[str]:
    """M6: keep features with |Spearman rho| > threshold against the target, among
    columns that are fully non-null, finite and non-constant; fall back to all."""
    num = [c for c in features if isinstance(df.schema[c].dataType, T.NumericType)]
    st = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(f"n_{i}") for i, c in enumerate(num)],
                *[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(num)]).first()
    ok = [c for i, c in enumerate(num) if st[f"n_{i}"] == 0 and (st[f"s_{i}"] or 0) > 0]
    if not ok:
        return list(features)
    rho = {r["feature"]: r["spearman_rho"] for r in spearman_table(df, ok, target).collect()}  # one row per feature
    keep = [c for c in ok if rho.get(c) is not None and abs(rho[c]) > threshold]
    return keep or list(features)


def spearman_table(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """W3 / M6 as a DataFrame: Spearman rho = Pearson r of average ranks, over the rows where both
    are present. All columns are ranked in one pass: a row becomes one (feature, value,
    target) pair for each feature it has; both sides of all pairs are melted to (feature, side, value), and one
    range sort ranks them within (feature, side). Equal pairs are counted first, so a hot value is few rows."""
    features = list(features)
    x = lambda c: F.col(c).cast("double")
    pairs = df.where(F.col(target).isNotNull()).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("f"), x(c).alias("a"), x(target).alias("b")) for i, c in enumerate(features)])).alias("p")).select("p.*").where("a IS NOT NULL")
    pairs = materialize(pairs.groupBy("f", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    sides = pairs.select("f", "n", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("v")),
                                                     F.struct(F.lit(1).alias("side"), F.col("b").alias("v")))).alias("s")).select("f", "s.side", "s.v", "n")
    weights = sides.groupBy("f", "side", "v").agg(F.sum("n").alias("_w"))
    ranks = R.prefix_weights(weights, ["f", "side"], ["v"], "_w").select(
        "f", "side", "v", (F.col("_before") + (F.col("_w") + 1) / 2.0).alias("rank"))
    ranks = materialize(ranks)
    of = lambda side, v, out: ranks.where(F.col("side") == side).select("f", F.col("v").alias(v), F.col("rank").alias(out))
    both = pairs.join(of(0, "a", "ra"), ["f", "a"]).join(of(1, "b", "rb"), ["f", "b"])
    n, ra, rb = F.col("n").cast("double"), F.col("ra"), F.col("rb")
    # the mean rank of n values is (n + 1) / 2 on either side, so the sums are centred
    count = pairs.groupBy("f").agg(F.sum("n").alias("rows"))
    both = both.join(F.broadcast(count), "f")
    mid = (F.col("rows") + 1) / 2.0
    sums = both.groupBy("f").agg(F.sum(n * (ra - mid) * (rb - mid)).alias("sab"), F.sum(n * (ra - mid) ** 2).alias("saa"),
                                 F.sum(n * (rb - mid) ** 2).alias("sbb"), F.max("rows").alias("n"))
    name = F.element_at(F.array(*[F.lit(c) for c in features]), (F.col("f") + 1).cast("int"))
    return sums.select(name.alias("feature"), F.try_divide(F.col("sab"), F.sqrt(F.col("saa") * F.col("sbb"))).alias("spearman_rho"), "n")


def variance_select(df: DataFrame, features: Sequence[str], threshold: float = 0.01) -> list[str]:
    """M7: keep numeric features whose sample variance exceeds ``threshold`` (one aggregate)."""
    num = [c for c in features if isinstance(df.schema[c].dataType, T.NumericType)]
    row = df.agg(*[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(num)]).first()
    return [c for i, c in enumerate(num) if (row[f"v{i}"] or 0) > threshold]


# ------------------------------------------------------------------ split M8

def stratified_split(df: DataFrame, stratum: str, test_fraction: float = 0.2, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """M8: exact per-stratum quotas. Within each stratum rows are ordered by a
    seeded hash (ties by the full row) with the distributed row number; the first
    round(test_fraction * n) rows of each stratum are 'test', the rest 'train'.
    Unlike ``sampleBy`` the quotas are exact and the split is reproducible."""
    cols = df.columns
    h = df.withColumn("_h", F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in cols]))
    r = R.row_number_global(h, ["_h"], by=[stratum], out="_rn")
    quota = F.floor(F.col("n_group") * test_fraction + 0.5)
    return r.withColumn(split_col, F.when(F.col("_rn") <= quota, "test").otherwise("train")).drop("_h", "_rn", "n_group")


# --------------------------------------------------------------- models M9-M13

def regressors(label: str = "label", features: str = "features", seed: int = 42, trees: int = 200,
               rounds: int = 200, depth: int = 5, check_col: str | None = None) -> dict:
    """The nine severity models of the comparison. Boosted trees of different depth and
    subsampling stand where the reference run used external boosting libraries. ``check_col``: a boolean
    column of rows that boosting does not learn from; it stops at the first round, of ``rounds`` at most, that does
    not lower their error."""
    kw = {"labelCol": label, "featuresCol": features}
    stop = {"validationIndicatorCol": check_col, "validationTol": 0.0} if check_col else {}
    return {
        "LinearRegression": LinearRegression(regParam=0.0, **kw),
        "Ridge": LinearRegression(regParam=1.0, elasticNetParam=0.0, **kw),
        "Lasso": LinearRegression(regParam=0.1, elasticNetParam=1.0, **kw),
        "ElasticNet": LinearRegression(regParam=0.1, elasticNetParam=0.5, **kw),
        "RandomForest": RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed, **kw),
        "GradientBoosting": GBTRegressor(maxIter=rounds, stepSize=0.05, maxDepth=depth, seed=seed, **kw, **stop),
        "DecisionTree": DecisionTreeRegressor(maxDepth=depth, seed=seed, **kw),
        "GradientBoostingDeep": GBTRegressor(maxIter=rounds, stepSize=0.05, maxDepth=depth + 1, seed=seed, **kw, **stop),
        "GradientBoostingSampled": GBTRegressor(maxIter=rounds, stepSize=0.05, maxDepth=depth, subsamplingRate=0.8, seed=seed, **kw, **stop),
    }


def checked_rows(df: DataFrame, share: float = 0.1, seed: int = 42, out: str = "_check") -> DataFrame:
    """A boolean column that holds back about ``share`` of the rows by a seeded hash of the features and labels."""
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(1000))
    return df.withColumn(out, h < int(1000 * share))


def search_grids(label: str = "label", features: str = "features", seed: int = 42, trees: int = 200, rounds: int = 200,
                 check_col: str | None = None) -> dict[str, dict]:
    """The grid of each tree model: parameters by name -> estimator."""
    def of(name, **params):
        def make():
            est = regressors(label, features, seed, trees, rounds, check_col=check_col)[name]
            return est.copy({est.getParam(k): v for k, v in params.items()})
        return json.dumps(params), make
    boosted = [dict(maxDepth=d, stepSize=s) for d in (3, 5) for s in (0.05, 0.1)]
    grids = {"RandomForest": [dict(maxDepth=d) for d in (3, 5, 8)],
             "DecisionTree": [dict(maxDepth=d, minInstancesPerNode=m) for d in (3, 5, 8) for m in (1, 20)],
             "GradientBoosting": boosted, "GradientBoostingDeep": boosted, "GradientBoostingSampled": boosted}
    return {name: dict(of(name, **p) for p in grid) for name, grid in grids.items()}


def classifiers(label: str = "label", features: str = "features", seed: int = 42, trees: int = 200,
                rounds: int = 200, depth: int = 5, check_col: str | None = None) -> dict:
    """Claim-probability classifiers; ``check_col`` as for the regressors."""
    kw = {"labelCol": label, "featuresCol": features}
    stop = {"validationIndicatorCol": check_col, "validationTol": 0.0} if check_col else {}
    return {
        "LogisticRegression": LogisticRegression(maxIter=2000, **kw),
        "RandomForest": RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **kw),
        "GradientBoosting": GBTClassifier(maxIter=rounds, stepSize=0.05, maxDepth=depth, seed=seed, **kw, **stop),
    }


# -------------------------------------------------------------- metrics M14-M15

def metric_columns(label: str = "label", prediction: str = "prediction", prefix: str = "") -> list:
    """M14 as aggregate columns: RMSE, MAE, R^2, MAPE (rows with a zero actual excluded), MPE, SMAPE (%)."""
    y, p = F.col(label), F.col(prediction)
    nz = y != 0
    found = {"n": F.count(F.lit(1)), "rmse": F.sqrt(F.avg((y - p) ** 2)), "mae": F.avg(F.abs(y - p)),
             "r2": 1 - F.try_divide(F.sum((y - p) ** 2), F.var_pop(y) * F.count(F.lit(1))),
             "mape": F.avg(F.when(nz, F.abs((y - p) / y))) * 100, "mpe": F.avg(F.when(nz, (y - p) / y)) * 100,
             "smape": F.avg(F.try_divide(2 * F.abs(p - y), F.abs(y) + F.abs(p))) * 100}
    return [v.alias(prefix + k) for k, v in found.items()]


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M14 in one aggregate."""
    return pred.agg(*metric_columns(label, prediction))


def classification_metrics(pred: DataFrame, label: str = "label", score: str = "score",
                           prediction: str = "prediction") -> DataFrame:
    """Exact ROC-AUC from average ranks of the score (Mann-Whitney form, ties
    count one half) and accuracy, without collecting scores."""
    d = pred.where(F.col(score).isNotNull())
    v = d.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("_w"))
    p = R.prefix_weights(v, [], [score], "_w")
    ar = (F.col("_before") + (F.col("_w") + 1) / 2.0).cast("double")
    # doubles: products of counts pass the range of bigint
    s = p.agg(F.sum(F.col("pos") * ar).alias("rpos"), F.sum("pos").cast("double").alias("npos"), F.sum("_w").alias("n"))
    auc = F.try_divide(F.col("rpos") - F.col("npos") * (F.col("npos") + 1) / 2.0, F.col("npos") * (F.col("n") - F.col("npos")))
    out = s.select(auc.alias("auc"), "n")
    if prediction in pred.columns:
        acc = pred.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"))
        out = out.crossJoin(F.broadcast(acc))
    return out


def positive_probability(pred: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1 from MLlib's probability vector."""
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn(out, vector_to_array("probability").getItem(1))


# ------------------------------------------------------------ CV / tuning M16-M17

def cross_validate(estimator, data: DataFrame, label: str = "label", folds: int = 5, seed: int = 42,
                   grid=None, parallelism: int = 4, fold_col: str | None = None):
    """K-fold CV RMSE (optionally over a parameter grid). Returns the
    fitted CrossValidatorModel; ``avgMetrics`` / ``stdMetrics`` hold per-grid
    fold-mean and fold-std RMSE (mean of fold RMSE, not the root of the mean MSE)."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    grid = grid if grid is not None else ParamGridBuilder().build()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=seed,
                        parallelism=parallelism, collectSubModels=False)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(data)


def lasso_grid(lr: LinearRegression):
    return ParamGridBuilder().addGrid(lr.regParam, [0.001, 0.01, 0.1, 1.0]).addGrid(lr.elasticNetParam, [1.0]).build()


# ----------------------------------------------------- importance / attribution

def feature_importance(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Tree importances or |coefficient| per feature slot, sorted descending."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        vals = [abs(x) for x in model.coefficients.toArray()]
    else:
        return []
    return sorted(zip(names, [float(v) for v in vals]), key=lambda t: (-t[1], t[0]))


def linear_attribution(pred: DataFrame, coefficients: Sequence[float], names: Sequence[str],
                       features: str = "features") -> DataFrame:
    """M20 (linear models): mean |coef_j * (x_j - mean_j)| per feature over ALL
    rows — the exact linear SHAP value — as one aggregate of column math."""
    from pyspark.ml.functions import vector_to_array
    d = pred.select(vector_to_array(features).alias("_x"))
    k = len(names)
    means = d.agg(*[F.avg(F.col("_x")[i]).alias(f"m{i}") for i in range(k)])
    j = d.crossJoin(F.broadcast(means))
    a = j.agg(*[F.avg(F.abs(F.lit(float(coefficients[i])) * (F.col("_x")[i] - F.col(f"m{i}")))).alias(f"a{i}") for i in range(k)])
    parts = ", ".join(f"'{n}', a{i}" for i, n in enumerate(names))
    return a.select(F.expr(f"stack({k}, {parts}) as (feature, mean_abs_attribution)"))


def tree_attribution(model, data: DataFrame, names: Sequence[str], features: str = "features") -> DataFrame:
    """M20 (tree models): mean |Shapley value| per feature over ALL rows, exact and by the paths of the trees, as the tree
    explainer of the SHAP library gives it."""
    total, n = model.attributions(data, features)
    return data.sparkSession.createDataFrame([(f, float(t / n) if n else None) for f, t in zip(names, total)],
                                             "feature string, mean_abs_attribution double")


def with_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """The place of every feature by a falling ``value``, ties by name; one row per feature."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last(value), "feature")))


def permutation_importance(model, data: DataFrame, names: Sequence[str], label: str = "label",
                           seed: int = 7) -> DataFrame:
    """M20 (tree models): RMSE increase when a feature slot is permuted across rows, for every slot.
    Rows are put in one seeded random order (distributed row numbers) and each is paired with the
    next one (the last with the first): one stored join gives every row its partner's vector.
    Slot ``i`` is then permuted by taking the partner's value, and all slots are scored in
    one job. Packed trees see a row's bins only, so a row travels as a byte a slot."""
    from pyspark.ml.functions import vector_to_array
    trees = isinstance(model, TR.TreeModel)
    base = data.select(F.col(label).cast("double").alias("_y"), vector_to_array("features").alias("_x"))
    base = base.withColumn("_h", F.xxhash64(F.lit(seed), "_x", "_y"))
    if trees:
        base = TR.binned(base, model, ["_y", "_h"], "_x", features="_x")
    ranked = stored(R.row_number_global(base, ["_h"], out="_at").drop("_h"), "ranked")
    partner = ranked.select(F.col("_x").alias("_z"), F.when(F.col("_at") == 1, F.col("n_group")).otherwise(F.col("_at") - 1).alias("_at"))
    pairs = ranked.join(partner, "_at").select("_y", "_x", "_z")
    errors = TR.slot_errors(pairs, model) if trees else _slot_errors(model, materialize(pairs), names)
    if -1 not in errors:
        return data.sparkSession.createDataFrame([], "feature string, rmse_increase double")
    return data.sparkSession.createDataFrame([(n, float(errors[i] - errors[-1])) for i, n in enumerate(names)],
                                             "feature string, rmse_increase double")


def _slot_errors(model, pairs: DataFrame, names: Sequence[str]) -> dict[int, float]:
    """RMSE by permuted slot of a model of MLlib; slot -1: unpermuted, the reference error."""
    from pyspark.ml.functions import array_to_vector
    slots = pairs.withColumn("_slot", F.explode(F.sequence(F.lit(-1), F.lit(len(names) - 1))))
    mixed = F.transform(F.arrays_zip("_x", "_z"), lambda e, i: F.when(i == F.col("_slot"), e["_z"]).otherwise(e["_x"]))
    scored = model.transform(slots.select("_slot", "_y", array_to_vector(mixed).alias("features")))
    return {r["_slot"]: r["e"] for r in scored.groupBy("_slot").agg(
        F.sqrt(F.avg((F.col("prediction") - F.col("_y")) ** 2)).alias("e")).collect()}  # one row per slot


# ------------------------------------------------------------ two-part model M21

@dataclass(frozen=True)
class Forest:
    """A random forest fitted in groups of trees. Its trees count alike: the groups' means, weighted by their trees."""

    groups: list

    def score(self, df: DataFrame, out: str) -> DataFrame:
        """Adds the probability of class 1, or the mean prediction of a regression."""
        from pyspark.ml.functions import vector_to_array
        total, terms, kept = sum(g.getNumTrees for g in self.groups), [], [F.col(f"`{c}`") for c in df.columns]
        for i, g in enumerate(self.groups):
            g, c = g.copy(), f"_forest{i}"
            if g.hasParam("probabilityCol"):
                df = g.setRawPredictionCol("").setPredictionCol("").setProbabilityCol(c).transform(df)
                terms.append(vector_to_array(c).getItem(1) * F.lit(g.getNumTrees / total))
            else:
                df = g.setPredictionCol(c).transform(df)
                terms.append(F.col(c) * F.lit(g.getNumTrees / total))
        return df.select(*kept, functools.reduce(operator.add, terms).alias(out))


def fit_forest(estimator, data: DataFrame, rows: int, *, seed: int = 42, whole_rows: int = 10_000_000, at_once: int = 25) -> Forest:
    """All trees of ``estimator`` in one fit, or of more than ``whole_rows`` rows ``at_once`` trees a fit: a fit keeps
    its draws of every row for every tree, so that 200 trees take a kilobyte a row and are spilled and read again
    for every level."""
    trees = estimator.getNumTrees()
    step = trees if rows <= whole_rows else at_once
    sizes = [min(step, trees - lo) for lo in range(0, trees, step)]
    return Forest([estimator.copy().setNumTrees(n).setSeed(seed + i).fit(data) for i, n in enumerate(sizes)])


def frequency_severity(train: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], *,
                       claims: str = "TotalClaims", seed: int = 42, trees: int = 200):
    """Claim probability (random forest classifier on all rows) and severity
    (random forest on log1p claims of claimants, inverted once with expm1), fitted at the same time over packed rows.
    Imputer and encoder are fitted once on the training rows. Returns a function scoring any
    frame to p_claim, expected_severity, expected_cost: a row scores alike alone or in a batch."""
    imputer = fit_imputer(train, num_cols, cat_cols)
    data = imputer.apply(train)
    encoder = build_preprocessor(data, num_cols, cat_cols, cardinality=cardinalities(data, cat_cols)).fit(data)
    d = feature_arrays(encoder, data).withColumn("label_c", (F.col(claims) > 0).cast("double")) \
            .withColumn("label_s", F.log1p(F.greatest(F.col(claims), F.lit(0.0))))
    found = TR.fit_all(train.sparkSession, {
        "p_claim": (TR.pack(d, "label_c"), RandomForestClassifier(labelCol="label_c", numTrees=trees, maxDepth=5, seed=seed)),
        "severity": (TR.pack(d.where("label_c = 1"), "label_s"), RandomForestRegressor(labelCol="label_s", numTrees=trees, maxDepth=5, seed=seed))})
    clf, sev = found["p_claim"], found["severity"]

    def score(df: DataFrame) -> DataFrame:
        row = F.struct(*[F.col(c) for c in df.columns])
        x = feature_arrays(encoder, imputer.apply(df.withColumn("_row", row))).select("_row", "features")
        s = TR.score_all(x, {"p_claim": clf, "_severity": sev}).select("_row.*", "p_claim", F.expm1("_severity").alias("expected_severity"))
        return s.withColumn("expected_cost", F.col("p_claim") * F.col("expected_severity"))
    return clf, sev, score


__all__ = ["build_preprocessor", "Imputer", "fit_imputer", "save_model", "load_model", "metric_columns", "feature_names", "feature_arrays", "cardinalities", "spearman_select",
           "spearman_table", "variance_select", "stratified_split", "regressors", "classifiers",
           "checked_rows", "search_grids", "regression_metrics", "classification_metrics", "positive_probability", "cross_validate", "lasso_grid",
           "feature_importance", "linear_attribution", "tree_attribution", "with_rank", "permutation_importance", "Forest", "fit_forest", "frequency_severity",
           "median", "PipelineModel"]
