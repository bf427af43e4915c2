"""Feature engineering.

Data-dependent thresholds (medians, quartiles, top-10 makes, bin edges) are
computed by one aggregate each and attached as a one-row broadcast, so they can
be *fitted* on a training frame and *applied* to any other frame unchanged
(the reference recomputed them on test data, or used a constant there).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions import expr as X
from claimlens.operators.quantiles import aggregate, median, quantile
from claimlens.operators import ranking as R


def _attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row statistics frame to every row (broadcast nested-loop join of one row)."""
    return df.crossJoin(F.broadcast(one_row))


# ------------------------------------------------------------------ text

def add_zip_prefix(df: DataFrame, col: str = "PostalCode", out: str = "ZipPrefix") -> DataFrame:
    """First run of 3-4 digits of the postal code; no match -> null."""
    return df.withColumn(out, X.zip_prefix(col))


def add_gender(df: DataFrame, col: str = "Gender", out: str = "Gender") -> DataFrame:
    """P25: Male / Female from the upper-cased spelling, others null."""
    return df.withColumn(out, X.gender_norm(col))


def add_excess_features(df: DataFrame, col: str = "ExcessSelected", approx: bool | None = None) -> DataFrame:
    """ExcessAmount = the number (or the first ``\\d+\\.?\\d*`` in the text),
    null filled with its median; HasHighExcess = amount > median of the filled column."""
    f = df.schema[col].dataType
    amt = F.col(col).cast("double") if isinstance(f, T.NumericType) else \
        F.nullif(F.regexp_extract(F.col(col).cast("string"), r"(\d+\.?\d*)", 1), F.lit("")).try_cast("double")
    d = df.withColumn("ExcessAmount", amt)
    d = _attach(d, aggregate(d, median("ExcessAmount", approx).alias("_m1")))
    d = d.withColumn("ExcessAmount", F.coalesce("ExcessAmount", "_m1")).drop("_m1")
    d = _attach(d, aggregate(d, median("ExcessAmount", approx).alias("_m2")))
    return d.withColumn("HasHighExcess", X.flag(F.col("ExcessAmount") > F.col("_m2"))).drop("_m2")


# ---------------------------------------------------------- temporal & vehicle

def add_temporal(df: DataFrame, col: str = "TransactionMonth") -> DataFrame:
    """TransactionYear, TransactionMonthNum, TransactionQuarter, IsYearEnd (month 11 or 12)."""
    return df.withColumns({
        "TransactionYear": F.year(col), "TransactionMonthNum": F.month(col),
        "TransactionQuarter": F.quarter(col), "IsYearEnd": X.flag(F.month(col).isin(11, 12))})


def add_power_features(df: DataFrame, kw: str = "kilowatts", cc: str = "cubiccapacity",
                       approx: bool | None = None) -> DataFrame:
    """PowerToCapacityRatio = kw / (cc with 0 -> null, + 1); HasHighPower = ratio > its median."""
    d = df.withColumn("PowerToCapacityRatio", X.safe_div(kw, cc, eps=1.0))
    d = _attach(d, aggregate(d, median("PowerToCapacityRatio", approx).alias("_m")))
    return d.withColumn("HasHighPower", X.flag(F.col("PowerToCapacityRatio") > F.col("_m"))).drop("_m")


def add_premium_risk(df: DataFrame, premium: str = "TotalPremium", sum_insured: str = "SumInsured",
                     approx: bool | None = None) -> DataFrame:
    """PremiumToSumInsuredRatio = premium / (sum insured with 0 -> null, + 1),
    missing -> median; IsHighRiskPremium = ratio > its 75th percentile."""
    d = df.withColumn("PremiumToSumInsuredRatio", X.nan_to_null(X.safe_div(premium, sum_insured, eps=1.0)))
    d = _attach(d, aggregate(d, median("PremiumToSumInsuredRatio", approx).alias("_m")))
    d = d.withColumn("PremiumToSumInsuredRatio", F.coalesce("PremiumToSumInsuredRatio", "_m")).drop("_m")
    d = _attach(d, aggregate(d, quantile("PremiumToSumInsuredRatio", 0.75, approx).alias("_q")))
    return d.withColumn("IsHighRiskPremium", X.flag(F.col("PremiumToSumInsuredRatio") > F.col("_q"))).drop("_q")


def add_security(df: DataFrame, cols: Sequence[str] = ("AlarmImmobiliser", "TrackingDevice")) -> DataFrame:
    """HasSecurity = number of non-null security fields (cap 2), HasAdvancedSecurity = 2.
    Build it before imputation, or every row scores 2."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    s = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return df.withColumns({"HasSecurity": F.least(s, F.lit(2))}) \
             .withColumn("HasAdvancedSecurity", X.flag(F.col("HasSecurity") == 2))


def add_pattern_flags(df: DataFrame, zone: str | None = "MainCrestaZone", cover: str = "CoverType") -> DataFrame:
    """IsHighRiskZone = zone text matches ``(A|1|High)`` case-insensitively
    (a missing zone reads as the text 'nan', which matches); IsComprehensive =
    cover contains 'Comprehensive' (case-insensitive, missing -> 0)."""
    out = {}
    if zone and zone in df.columns:
        out["IsHighRiskZone"] = X.flag(F.coalesce(F.col(zone).cast("string"), F.lit("nan")).rlike("(?i)(A|1|High)"))
    if cover in df.columns:
        out["IsComprehensive"] = X.flag(F.col(cover).rlike("(?i)Comprehensive"))
    return df.withColumns(out) if out else df


def add_top_make_flag(df: DataFrame, col: str = "make", k: int = 10) -> DataFrame:
    """IsTopMake = the row's make is among the ``k`` most frequent (ties by
    name). The top table holds at most ``k`` rows, so the broadcast is bounded."""
    top = (df.where(F.col(col).isNotNull()).groupBy(col).count()
             .orderBy(F.desc("count"), F.col(col)).limit(k)
             .select(F.col(col).alias("_top_make"), F.lit(1).alias("IsTopMake")))
    j = df.join(F.broadcast(top), F.col(col) == F.col("_top_make"), "left")
    return j.withColumn("IsTopMake", F.coalesce("IsTopMake", F.lit(0))).drop("_top_make")


def add_value_features(df: DataFrame, age: str = "VehicleAge", sum_insured: str = "SumInsured",
                       capital: str = "CapitalOutstanding") -> DataFrame:
    """AgeValueInteraction = age * sum insured; HasCapitalOutstanding
    (> 0); CapitalToSumInsuredRatio = capital / (sum insured with 0 -> null, + 1), missing -> 0."""
    out = {}
    if age in df.columns and sum_insured in df.columns:
        out["AgeValueInteraction"] = F.col(age) * F.col(sum_insured)
    if capital in df.columns:
        out["HasCapitalOutstanding"] = X.flag(F.col(capital) > 0)
        if sum_insured in df.columns:
            out["CapitalToSumInsuredRatio"] = F.coalesce(
                X.nan_to_null(X.safe_div(capital, sum_insured, eps=1.0)), F.lit(0.0))
    return df.withColumns(out) if out else df


# ------------------------------------------------------ model features

def fit_feature_stats(train: DataFrame, cc: str = "cubiccapacity",
                      poly_cols: Sequence[str] = ("VehicleAge", "SumInsured", "TotalPremium", "cubiccapacity"),
                      approx: bool | None = None) -> DataFrame:
    """Fit the training statistics used by P35/P38/P40: distinct counts of the
    polynomial columns, the engine-size median and the SumInsured quintile edges.
    One aggregate, one row."""
    aggs = [F.count_distinct(c).alias(f"_nd_{c}") for c in poly_cols if c in train.columns]
    if cc in train.columns:
        aggs.append(median(cc, approx).alias("_cc_median"))
    if "SumInsured" in train.columns:
        aggs.append(quantile("SumInsured", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], approx).alias("_si_edges"))
    return aggregate(train, *aggs)


def add_model_features(df: DataFrame, stats: DataFrame,
                       poly_cols: Sequence[str] = ("VehicleAge", "SumInsured", "TotalPremium", "cubiccapacity"),
                       cc: str = "cubiccapacity") -> DataFrame:
    """P35-P40 with fitted ``stats`` (from :func:`fit_feature_stats` on the training frame):

    * P35 ``<c>_squared`` / ``<c>_cubed`` clipped to +-1e10 and ``log_<c>`` = log1p(|c + 1e-10|)
      for polynomial columns with more than one distinct value in training;
    * P36 Age_Value_Interaction / Age_Value_Ratio on age clipped [0, 50] and sum insured [1e3, 1e6];
    * P37 Premium_Per_Value = premium clipped [100, 1e4] / sum insured clipped, in [0, 0.1];
    * P38 Risk_Score = mean of (age > 10, cc > training median, HasHighPower);
    * P39 VehicleAge_Binned on [0, 3, 7, 12, 20, 100] right-closed, lowest included;
    * P40 SumInsured_Binned on the training quintile edges (duplicates dropped).
    """
    d = _attach(df, stats)
    sc = set(stats.columns)
    out = {}
    for c in poly_cols:
        if c in d.columns and f"_nd_{c}" in sc:
            ok = F.col(f"_nd_{c}") > 1
            v = F.col(c).cast("double")
            out[f"{c}_squared"] = F.when(ok, X.clip(F.pow(v, 2), -1e10, 1e10))
            out[f"{c}_cubed"] = F.when(ok, X.clip(F.pow(v, 3), -1e10, 1e10))
            out[f"log_{c}"] = F.when(ok, F.log1p(F.abs(v + F.lit(1e-10))))
    age, si, prem = "VehicleAge", "SumInsured", "TotalPremium"
    if age in d.columns and si in d.columns:
        a = X.clip(age, 0.0, 50.0)
        s = X.clip(si, 1000.0, 1000000.0)
        out["Age_Value_Interaction"] = a * s
        out["Age_Value_Ratio"] = X.clip(F.coalesce(X.safe_div(a, s), F.lit(0.0)), -100.0, 100.0)
        if prem in d.columns:
            p = X.clip(prem, 100.0, 10000.0)
            out["Premium_Per_Value"] = X.clip(F.coalesce(X.safe_div(p, s), F.lit(0.0)), 0.0, 0.1)
    factors = []
    if age in d.columns:
        factors.append(X.flag(F.col(age) > 10))
    if cc in d.columns and "_cc_median" in sc:
        factors.append(X.flag(F.col(cc) > F.col("_cc_median")))
    if "HasHighPower" in d.columns:
        factors.append(F.col("HasHighPower").cast("int"))
    if factors:
        out["Risk_Score"] = sum(factors[1:], factors[0]).cast("double") / len(factors)
    d = d.withColumns(out)
    if age in d.columns:
        d = d.withColumn(age, X.clip(age, 0.0, 100.0))
        d = d.withColumn("VehicleAge_Binned", X.fixed_bins(age, [0, 3, 7, 12, 20, 100],
                                                           ["New", "Young", "Middle", "Old", "VeryOld"], True))
    if si in d.columns and "_si_edges" in sc:
        d = d.withColumn("SumInsured_Binned", edge_bins(F.col(si), F.col("_si_edges"),
                                                        ["VeryLow", "Low", "Medium", "High", "VeryHigh"]))
    return d.drop(*stats.columns)


def edge_bins(x, edges, labels: Sequence[str], manual: Sequence[float] | None = None):
    """Right-closed bins on a data-dependent edge array (duplicates dropped,
    lowest edge included); label i for the i-th interval; outside -> null. ``manual``: edges to use instead
    where dropping duplicates leaves fewer intervals than labels."""
    e = F.array_distinct(edges)
    if manual is not None:
        e = F.when(F.size(e) > len(labels), e).otherwise(F.array(*[F.lit(float(v)) for v in manual]))
    below = F.size(F.filter(e, lambda v: v < x))
    idx = F.when(x == F.element_at(e, 1), F.lit(1)).otherwise(below)
    lab = F.array(*[F.lit(s) for s in labels])
    inside = x.isNotNull() & (x >= F.element_at(e, 1)) & (x <= F.element_at(e, -1)) & (F.size(e) > 1)
    return F.when(inside & (idx <= F.size(e) - 1), F.element_at(lab, idx))


# ------------------------------------------------------------- targets

SEVERITY_QUINTILES = ["VeryLow", "Low", "Medium", "High", "VeryHigh"]


def equal_width_bin(x, low, high, bins: int):
    """P41 fallback: ``pd.cut(x, bins, labels=False)``: right-closed intervals of equal width over the range, the
    least value in the first one; a column of one value is in the middle. Null -> null."""
    step = (high - low) / bins
    inner = F.transform(F.sequence(F.lit(1), F.lit(bins - 1)), lambda i: low + i * step)
    place = F.when(low == high, F.lit((bins - 1) // 2)).otherwise(F.size(F.filter(inner, lambda e: e < x)))
    return F.when(x.isNotNull(), place).cast("long")


def add_rank_bins(df: DataFrame, target: str, tie_keys: Sequence[str], *, q5_col: str = "ClaimSeverityQuintile",
                  q10_col: str = "StratifyBin", unique: bool = True, gaps: bool = False) -> DataFrame:
    """``pd.qcut(target.rank(method='first'), q)`` for q=5 (labels) and
    q=10 (ids). The rank is the distributed row number over (target, tie keys). With ``gaps`` the target may
    be null: such rows have no rank and no bin, and if there are any, the ids of all rows are bins of equal width
    instead of rank bins."""
    if gaps:
        x = F.col(target).cast("double")
        ranked = add_rank_bins(df.where(x.isNotNull()), target, tie_keys, q5_col=q5_col, q10_col=q10_col, unique=unique)
        none = df.where(x.isNull()).withColumns({q5_col: F.lit(None).cast("string"), q10_col: F.lit(None).cast("long")})
        range_ = df.agg(F.count_if(x.isNull()).alias("_gaps"), F.min(x).alias("_low"), F.max(x).alias("_high"))
        both = ranked.unionByName(none).crossJoin(F.broadcast(range_))
        return both.withColumn(q10_col, F.when(F.col("_gaps") > 0, equal_width_bin(x, F.col("_low"), F.col("_high"), 10)).otherwise(F.col(q10_col))) \
            .drop("_gaps", "_low", "_high")
    r = R.row_number_global(df, [target, *tie_keys], out="_rank", unique=unique)
    lab = F.array(*[F.lit(s) for s in SEVERITY_QUINTILES])
    return (r.withColumn(q5_col, F.element_at(lab, (R.rank_quantile_bin("_rank", "n_group", 5) + 1).cast("int")))
             .withColumn(q10_col, R.rank_quantile_bin("_rank", "n_group", 10))
             .drop("_rank", "n_group"))


def add_target_transforms(df: DataFrame, target: str = "TotalClaims", approx: bool | None = None) -> DataFrame:
    """Target coerced (null -> 0); Log_/Sqrt_/Std_ transforms
    (z-score with sample std + 1e-10); HighClaim = target > median; severity
    terciles at the 0.33 / 0.66 quantiles (right-closed), equal-width thirds when
    the two cut points coincide."""
    t = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    d = df.withColumn(target, t)
    st = aggregate(d, F.avg(target).alias("_mu"), F.stddev_samp(target).alias("_sd"),
               median(target, approx).alias("_med"),
               quantile(target, [0.33, 0.66], approx).alias("_qs"),
               F.min(target).alias("_mn"), F.max(target).alias("_mx"))
    d = _attach(d, st)
    q1, q2 = F.element_at("_qs", 1), F.element_at("_qs", 2)
    c = F.col(target)
    terc = F.when(c <= q1, "Low").when(c <= q2, "Medium").otherwise("High")
    width = (F.col("_mx") - F.col("_mn")) / 3.0
    eq = F.when(c <= F.col("_mn") + width, "Low").when(c <= F.col("_mn") + 2 * width, "Medium").otherwise("High")
    return d.withColumns({
        f"Log_{target}": F.log1p(c),
        f"Sqrt_{target}": F.sqrt(X.clip(c, lower=0.0)),
        f"Std_{target}": (c - F.col("_mu")) / (F.col("_sd") + F.lit(1e-10)),
        "HighClaim": X.flag(c > F.col("_med")),
        "ClaimSeverityCategory": F.when(q1 == q2, eq).otherwise(terc),
    }).drop("_mu", "_sd", "_med", "_qs", "_mn", "_mx")


# --------------------------------------------------------- schema

def discover_columns(df: DataFrame, *, keywords: Sequence[str] = (), kind: str | None = None,
                     max_cardinality: int | None = None, min_cardinality: int = 0) -> list[str]:
    """P50: columns whose name contains a keyword (case-insensitive), of a kind
    ('numeric' / 'string'), and optionally with a distinct count inside
    [min_cardinality, max_cardinality] (exact distinct counts of those columns)."""
    cols = df.columns
    if keywords:
        cols = [c for c in cols if any(k.lower() in c.lower() for k in keywords)]
    if kind == "numeric":
        cols = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    elif kind == "string":
        cols = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    if max_cardinality is not None and cols:
        row = df.agg(*[F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(cols)]).first()
        cols = [c for i, c in enumerate(cols) if min_cardinality <= row[f"d{i}"] <= max_cardinality]
    return cols


# Identifier and target-leak columns removed before modelling (P52, section 1.4-11).
ID_COLUMNS = ["PolicyID", "UnderwrittenCoverID", "CoverSeq"]
LEAK_COLUMNS = ["TotalClaims", "Log_TotalClaims", "Sqrt_TotalClaims", "Std_TotalClaims", "HighClaim",
                "ClaimSeverityCategory", "ClaimSeverityQuintile", "StratifyBin", "HasClaim", "ClaimIndicator",
                "LossRatio", "row_loss_ratio", "ClaimSeverity", "Margin", "ProfitMarginPct"]


def drop_leakage(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Remove identifiers and every column derived from the target."""
    return df.drop(*[c for c in ID_COLUMNS + LEAK_COLUMNS + list(extra) if c in df.columns])


def category_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Integer code per category, alphabetical (deterministic), via StringIndexer."""
    from pyspark.ml.feature import StringIndexer
    out = out or f"{col}_code"
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(df)
    return model.transform(df).withColumn(out, F.col(out).cast("bigint"))
