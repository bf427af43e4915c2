"""Data profiles.

Every all-column profile is ONE aggregate pass: the expression list is built from
the schema, evaluated in a single ``agg`` (partial aggregation on every
executor), and reshaped to long form with ``stack``. Per-value statistics
(unique counts, top value) unpivot the columns and group by (column, value),
which also combines map-side, so a value holding a third of all rows is a single
partial count per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators.gram import grams
from claimlens.operators.quantiles import aggregate, quantile
from claimlens.session import joinable


def _q(c: str):
    return F.col(f"`{c}`")


def _stack(df: DataFrame, cols: Sequence[str], fields: Sequence[str], prefix: str = "c") -> DataFrame:
    """Reshape a one-row ``agg`` with columns ``{prefix}{i}_{field}`` to one row per column."""
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"'{c}'")
        parts += [f"`{prefix}{i}_{f}`" for f in fields]
    cols_sql = ", ".join(["column"] + list(fields))
    return df.select(F.expr(f"stack({len(cols)}, {', '.join(parts)}) as ({cols_sql})"))


def bias_corrected_skew(g1, n):
    """pandas ``skew``: G1 = g1 * sqrt(n(n-1)) / (n-2) from Spark's population g1."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def bias_corrected_kurt(g2, n):
    """pandas ``kurtosis`` (excess): G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6)."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def describe(df: DataFrame, cols: Sequence[str], approx: bool | None = None, extended: bool = True) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation),
    max and, when ``extended``, bias-corrected skewness / excess kurtosis, zero
    count and zero share of all rows. One aggregate for every column."""
    aggs = [F.count(F.lit(1)).alias("_n_rows")]
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}_count"), F.avg(x).alias(f"c{i}_mean"), F.stddev_samp(x).alias(f"c{i}_std"),
                 F.min(x).alias(f"c{i}_min"), quantile(x, [0.25, 0.5, 0.75], approx).alias(f"c{i}_q"),
                 F.max(x).alias(f"c{i}_max")]
        if extended:
            aggs += [F.skewness(x).alias(f"c{i}_g1"), F.kurtosis(x).alias(f"c{i}_g2"),
                     F.count_if(x == 0).alias(f"c{i}_zeros")]
    a = aggregate(df, *aggs)
    sel = []
    for i, _ in enumerate(cols):
        n = F.col(f"c{i}_count").cast("double")
        sel += [F.col(f"c{i}_count"), F.col(f"c{i}_mean"), F.col(f"c{i}_std"), F.col(f"c{i}_min"),
                F.element_at(f"c{i}_q", 1).alias(f"c{i}_q25"), F.element_at(f"c{i}_q", 2).alias(f"c{i}_q50"),
                F.element_at(f"c{i}_q", 3).alias(f"c{i}_q75"), F.col(f"c{i}_max")]
        if extended:
            sel += [bias_corrected_skew(F.col(f"c{i}_g1"), n).alias(f"c{i}_skewness"),
                    bias_corrected_kurt(F.col(f"c{i}_g2"), n).alias(f"c{i}_kurtosis"),
                    F.col(f"c{i}_zeros"),
                    (F.col(f"c{i}_zeros") * 100.0 / F.col("_n_rows")).alias(f"c{i}_zeros_pct")]
    fields = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    if extended:
        fields += ["skewness", "kurtosis", "zeros", "zeros_pct"]
    return _stack(a.select(*sel), cols, fields)


def distribution_stats(df: DataFrame, cols: Sequence[str], min_n: int = 10, approx: bool | None = None) -> DataFrame:
    """Mean, median, std, skew, count per column; columns with n <= ``min_n``
    or zero variance are skipped (filtered on the aggregated rows)."""
    d = describe(df, cols, approx)
    return (d.where((F.col("count") > min_n) & (F.col("std") > 0))
             .select("column", "mean", F.col("q50").alias("median"), "std", "skewness", "count"))


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percent per column (NaN counts as missing), sorted descending."""
    cols = list(cols or df.columns)
    n = F.count(F.lit(1))
    def miss(c):
        f = df.schema[c].dataType
        cond = _q(c).isNull()
        if isinstance(f, (T.DoubleType, T.FloatType)):
            cond = cond | F.isnan(_q(c))
        return F.count_if(cond)
    a = df.agg(n.alias("_n"), *[miss(c).alias(f"c{i}_missing") for i, c in enumerate(cols)])
    a = a.select(*[F.col(f"c{i}_missing") for i in range(len(cols))],
                 *[(F.col(f"c{i}_missing") * 100.0 / F.col("_n")).alias(f"c{i}_missing_pct") for i in range(len(cols))])
    return _stack(a, cols, ["missing", "missing_pct"]).orderBy(F.desc("missing"), "column")


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unpivot to (column, value as string); nulls dropped."""
    parts = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    return df.select(F.expr(f"stack({len(cols)}, {parts}) as (column, value)")).where(F.col("value").isNotNull())


def column_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column its Spark type, missing count and %, distinct count,
    most frequent value and its frequency (ties: smallest value text), plus the
    table's row count and how many columns share the column's type."""
    cols = list(cols or df.columns)
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    counts = _long_values(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
    # min over (-freq, value): the most frequent value, ties broken by the smallest text
    per_col = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("freq")).alias("nf"), F.col("value").alias("v"))).alias("_top"))
    per_col = per_col.select("column", "unique", F.col("_top.v").alias("top"), (-F.col("_top.nf")).alias("top_freq"))
    miss = missing_profile(df, cols).select("column", "missing", "missing_pct")
    meta = df.sparkSession.createDataFrame(
        [(c, types[c], sum(1 for v in types.values() if v == types[c])) for c in cols],
        "column string, dtype string, columns_of_type bigint")
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    out = meta.join(miss, "column", "left").join(per_col, "column", "left").crossJoin(F.broadcast(n))
    return out.withColumn("unique", F.coalesce("unique", F.lit(0)).cast("bigint"))


def column_info(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Type, distinct count, missing count, min and max per column. Values are told apart by 128 bits of
    hash: a row is melted to (column, hash) pairs of 16 bytes, whatever the values' length, and pre-combined
    before the one shuffle; the rest is one aggregate."""
    cols = list(cols or df.columns)
    a = df.agg(*[F.count_if(_q(c).isNull()).alias(f"c{i}_missing") for i, c in enumerate(cols)],
               *[F.min(_q(c)).cast("string").alias(f"c{i}_min") for i, c in enumerate(cols)],
               *[F.max(_q(c)).cast("string").alias(f"c{i}_max") for i, c in enumerate(cols)])
    long = _stack(a, cols, ["missing", "min", "max"])
    hashed = df.select(F.explode(F.array(*[F.when(_q(c).isNotNull(), F.struct(
        F.lit(i).alias("i"), F.xxhash64(F.lit(1), _q(c)).alias("a"), F.xxhash64(F.lit(2), _q(c)).alias("b"))) for i, c in enumerate(cols)])).alias("v"))
    unique = hashed.where("v IS NOT NULL").select("v.*").distinct().groupBy("i").agg(F.count(F.lit(1)).alias("unique"))
    types = df.sparkSession.createDataFrame([(i, c, df.schema[c].dataType.simpleString()) for i, c in enumerate(cols)],
                                            "i int, column string, dtype string")
    return types.join(unique, "i", "left").join(long, "column").select("column", "dtype", F.coalesce("unique", F.lit(0)).cast("long").alias("unique"), "missing", "min", "max")


def quality_rules(df: DataFrame, *, now_ts: str = "2026-01-01 00:00:00", month: str = "TransactionMonth",
                  monetary: Sequence[str] = ("TotalPremium", "TotalClaims", "SumInsured"),
                  critical: Sequence[str] = ("PolicyID", "TransactionMonth", "TotalPremium"),
                  key: str = "PolicyID", claims: str = "TotalClaims", sum_insured: str = "SumInsured",
                  max_missing_pct: float = 5.0) -> DataFrame:
    """Future dates, negatives per monetary column, claims above sum insured,
    critical-field missing share > 5 %, rows sharing a key. Long form
    (rule, value, violated); ``now_ts`` is a parameter for reproducibility."""
    n = F.count(F.lit(1))
    aggs = {"future_dates": F.count_if(F.col(month) > F.lit(now_ts).cast("timestamp"))}
    for c in monetary:
        aggs[f"negative_{c}"] = F.count_if(F.col(c) < 0)
    aggs["claims_exceed_sum_insured"] = F.count_if(F.col(claims) > F.col(sum_insured))
    for c in critical:
        aggs[f"missing_pct_{c}"] = F.count_if(F.col(c).isNull()) * 100.0 / n
    a = df.agg(*[v.cast("double").alias(k) for k, v in aggs.items()])
    dup = (df.groupBy(key).agg(F.count(F.lit(1)).alias("k"))
             .agg(F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0)).cast("double").alias("duplicate_keys")))
    a = a.crossJoin(dup)
    names = list(aggs) + ["duplicate_keys"]
    long = a.select(F.expr(f"stack({len(names)}, " + ", ".join(f"'{k}', `{k}`" for k in names) + ") as (rule, value)"))
    return long.withColumn("violated", F.when(F.col("rule").startswith("missing_pct_"), F.col("value") > max_missing_pct)
                                        .otherwise(F.col("value") > 0))


def invalid_values(df: DataFrame, *, premium: str = "TotalPremium", claims: str = "TotalClaims",
                   ratio: str = "row_loss_ratio") -> DataFrame:
    """Negative premiums, negative claims, ratio outside [0, 10], zero-claim rows."""
    return df.agg(F.count_if(F.col(premium) < 0).alias("negative_premium"),
                  F.count_if(F.col(claims) < 0).alias("negative_claims"),
                  F.count_if((F.col(ratio) < 0) | (F.col(ratio) > 10)).alias("ratio_out_of_range"),
                  F.count_if(F.col(claims) == 0).alias("zero_claims"))


def claim_sign_distribution(df: DataFrame, col: str = "TotalClaims") -> DataFrame:
    """Counts and percents of > 0, = 0, < 0 plus min / max / mean of the column."""
    n = F.count(F.lit(1))
    return df.agg(F.count_if(F.col(col) > 0).alias("n_positive"), F.count_if(F.col(col) == 0).alias("n_zero"),
                  F.count_if(F.col(col) < 0).alias("n_negative"),
                  (F.count_if(F.col(col) > 0) * 100.0 / n).alias("pct_positive"),
                  (F.count_if(F.col(col) == 0) * 100.0 / n).alias("pct_zero"),
                  (F.count_if(F.col(col) < 0) * 100.0 / n).alias("pct_negative"),
                  F.min(col).alias("min_value"), F.max(col).alias("max_value"), F.avg(col).alias("mean_value"))


def claim_distribution(df: DataFrame, col: str = "TotalClaims", approx: bool | None = None) -> DataFrame:
    """Rows, claim rows (> 0), claim %, and min / max / mean / median /
    population std of the positive claims."""
    pos = F.when(F.col(col) > 0, F.col(col))
    return aggregate(df, F.count(F.lit(1)).alias("n_rows"), F.count(pos).alias("n_claims"),
                  (F.count(pos) * 100.0 / F.count(F.lit(1))).alias("claim_pct"),
                  F.min(pos).alias("min_claim"), F.max(pos).alias("max_claim"), F.avg(pos).alias("mean_claim"),
                  quantile(pos, 0.5, approx).alias("median_claim"), F.stddev_pop(pos).alias("std_claim"))


def claim_summary(df: DataFrame, claims: str = "TotalClaims", premium: str = "TotalPremium",
                  approx: bool | None = None) -> DataFrame:
    """Sum, mean, median, sample std and percentiles 25/50/75/90/95/99 of
    claims, premium sum / mean, loss ratio % (claims sum / premium sum * 100)."""
    qs = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    a = aggregate(df, F.count(F.lit(1)).alias("n_rows"), F.sum(claims).alias("claims_sum"), F.avg(claims).alias("claims_mean"),
               F.stddev_samp(claims).alias("claims_std"), quantile(claims, qs, approx).alias("_q"),
               F.sum(premium).alias("premium_sum"), F.avg(premium).alias("premium_mean"))
    return a.select("n_rows", "claims_sum", "claims_mean", F.element_at("_q", 2).alias("claims_median"), "claims_std",
                    *[F.element_at("_q", i + 1).alias(f"p{int(q * 100)}") for i, q in enumerate(qs)],
                    "premium_sum", "premium_mean",
                    (F.try_divide(F.col("claims_sum"), F.col("premium_sum")) * 100).alias("loss_ratio_pct"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed), one row per
    non-empty bin: bin index, lower / upper edge, count."""
    mm = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = F.col(col)
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1))).cast("bigint")
    d = df.where(x.isNotNull()).crossJoin(F.broadcast(mm)).withColumn("bin", idx)
    return (d.groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
             .select("bin", (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("lower"),
                     (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("upper"), "n"))


def density_2d(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Rectangular 2-D density (bins x bins) over the pairwise-complete rows."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    mm = d.agg(F.min(x).alias("_xl"), F.max(x).alias("_xh"), F.min(y).alias("_yl"), F.max(y).alias("_yh"))
    def b(c, lo, hi):
        return F.when(F.col(hi) == F.col(lo), F.lit(0)).otherwise(
            F.least(F.floor((F.col(c) - F.col(lo)) / ((F.col(hi) - F.col(lo)) / bins)), F.lit(bins - 1))).cast("bigint")
    return (d.crossJoin(F.broadcast(mm)).select(b(x, "_xl", "_xh").alias("bx"), b(y, "_yl", "_yh").alias("by"))
             .groupBy("bx", "by").agg(F.count(F.lit(1)).alias("n")))


def box_stats(df: DataFrame, cols: Sequence[str], by: str | None = None, approx: bool | None = None) -> DataFrame:
    """Quartiles, IQR, whiskers (most extreme values inside 1.5 IQR) and
    outlier count per column (optionally per group); constant columns skipped. All columns share one
    selection of the quartiles and one pass for the rest."""
    cols, keys = list(cols), [by] if by else []
    base = df.where(F.col(by).isNotNull()) if by else df
    q = aggregate(base, *[quantile(c, [0.25, 0.5, 0.75], approx).alias(f"_q{i}") for i, c in enumerate(cols)], by=keys)
    j = base.join(joinable(q), keys, "left") if keys else base.crossJoin(F.broadcast(q))
    aggs = []
    for i, c in enumerate(cols):
        x, q1, q3 = F.col(c), F.element_at(f"_q{i}", 1), F.element_at(f"_q{i}", 3)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        aggs += [F.first(f"_q{i}", ignorenulls=True).alias(f"q{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                 F.min(F.when(x >= lo, x)).alias(f"wl{i}"), F.max(F.when(x <= hi, x)).alias(f"wh{i}"), F.count_if((x < lo) | (x > hi)).alias(f"n{i}")]
    got = j.groupBy(*keys).agg(*aggs) if keys else j.agg(*aggs)
    d = lambda c: c.cast("double")
    rows = got.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.element_at(f"q{i}", 1).alias("q1"), F.element_at(f"q{i}", 2).alias("median"), F.element_at(f"q{i}", 3).alias("q3"),
                 d(F.col(f"wl{i}")).alias("whisker_low"), d(F.col(f"wh{i}")).alias("whisker_high"), F.col(f"n{i}").alias("n_outliers"),
                 d(F.col(f"mn{i}")).alias("_mn"), d(F.col(f"mx{i}")).alias("_mx")) for i, c in enumerate(cols)])).alias("r"))
    return rows.select(*keys, "r.*").where("_mx > _mn").select("column", *keys, "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                                                              "whisker_low", "whisker_high", "n_outliers")


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, approx: bool | None = None) -> DataFrame:
    """Per column: outlier count (outside Q1 - k IQR .. Q3 + k IQR over the
    non-null values), outlier %, Q1, Q3, IQR. One quantile pass + one count pass."""
    q = aggregate(df, *[quantile(c, [0.25, 0.75], approx).alias(f"_q{i}") for i, c in enumerate(cols)])
    j = df.crossJoin(F.broadcast(q))
    aggs = []
    for i, c in enumerate(cols):
        q1, q3 = F.element_at(f"_q{i}", 1), F.element_at(f"_q{i}", 2)
        iqr = q3 - q1
        out = (F.col(c) < q1 - k * iqr) | (F.col(c) > q3 + k * iqr)
        aggs += [F.count_if(out).alias(f"c{i}_outliers"), F.count(c).alias(f"c{i}_n"),
                 F.first(q1).alias(f"c{i}_Q1"), F.first(q3).alias(f"c{i}_Q3")]
    a = j.agg(*aggs)
    a = a.select(*[x for i in range(len(cols)) for x in (
        F.col(f"c{i}_outliers"), F.try_divide(F.col(f"c{i}_outliers") * 100.0, F.col(f"c{i}_n")).alias(f"c{i}_outlier_pct"),
        F.col(f"c{i}_Q1"), F.col(f"c{i}_Q3"), (F.col(f"c{i}_Q3") - F.col(f"c{i}_Q1")).alias(f"c{i}_IQR"))])
    return _stack(a, cols, ["outliers", "outlier_pct", "Q1", "Q3", "IQR"])


def outlier_impact(df: DataFrame, col: str, claims: str = "TotalClaims", min_n: int = 10,
                   approx: bool | None = None) -> DataFrame:
    """IQR outliers of ``col``: count, %, mean, max, and their share of total claims."""
    base = df.where(F.col(col).isNotNull())
    q = aggregate(base, quantile(col, [0.25, 0.75], approx).alias("_q"), F.count(F.lit(1)).alias("_n"),
                 F.stddev_samp(col).alias("_sd"))
    j = df.crossJoin(F.broadcast(q))
    q1, q3 = F.element_at("_q", 1), F.element_at("_q", 2)
    iqr = q3 - q1
    is_out = F.col(col).isNotNull() & ((F.col(col) < q1 - 1.5 * iqr) | (F.col(col) > q3 + 1.5 * iqr))
    total = F.sum(claims)
    a = j.agg(F.first("_n").alias("n_values"), F.count_if(is_out).alias("n_outliers"),
              F.avg(F.when(is_out, F.col(col))).alias("outlier_mean"), F.max(F.when(is_out, F.col(col))).alias("outlier_max"),
              F.sum(F.when(is_out, F.col(claims))).alias("_oc"), total.alias("_tc"),
              F.first(iqr).alias("iqr"), F.first("_sd").alias("_sd"))
    return a.where((F.col("n_values") > min_n) & (F.col("_sd") > 0) & (F.col("iqr") > 0)).select(
        "n_values", "n_outliers", (F.col("n_outliers") * 100.0 / F.col("n_values")).alias("outlier_pct"),
        "outlier_mean", "outlier_max",
        F.when(F.col("_tc") > 0, F.col("_oc") * 100.0 / F.col("_tc")).alias("claims_share_pct"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long-form Pearson matrix (col_a, col_b, r) for every ordered pair over its pairwise-complete rows; the
    diagonal is 1 for a non-constant column; undefined -> null. One pass: with M the 0/1 matrix of values
    that are there, X the values (0 for a gap) and S their squares, the Gram matrix of [M, X, S] holds counts, sums,
    squares and products of all pairs at once. Columns are shifted and scaled by rough totals first, for the
    arithmetic only; a deviation below 1e-9 of the column's own counts as none."""
    cols = list(cols)
    p = len(cols)
    x = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    stats = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)], *[F.stddev_samp(v).alias(f"s{i}") for i, v in enumerate(x)]).first()
    shift = np.array([stats[f"m{i}"] or 0.0 for i in range(p)])
    scale = np.array([stats[f"s{i}"] or 1.0 for i in range(p)])

    def design(batch):
        values = np.stack([batch.column(j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(p)], axis=1)
        there = ~np.isnan(values)
        values = np.where(there, (values - shift) / scale, 0.0)
        return np.zeros(batch.num_rows, np.int32), np.concatenate([there, values, values ** 2], axis=1)

    g = grams(df.select(*[v.alias(f"v{i}") for i, v in enumerate(x)]), 3 * p, design).get(0, np.zeros((3 * p, 3 * p)))
    m, v, s = slice(0, p), slice(p, 2 * p), slice(2 * p, 3 * p)
    n, total, squares, cross = g[m, m], g[v, m], g[s, m], g[v, v]  # [a, b]: over rows where a and b are there
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = cross - total * total.T / n
        var = squares - total ** 2 / n
        small = var <= 1e-18 * np.maximum(n, 1)
        r = np.where(small | small.T | (n < 2), np.nan, cov / np.sqrt(var * var.T))
    rows = [(a, b, None if np.isnan(r[i, j]) else (1.0 if i == j else float(np.clip(r[i, j], -1.0, 1.0))))
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def strong_pairs(corr: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Unordered pairs with |r| > threshold, sorted by |r| descending."""
    return (corr.where((F.col("col_a") < F.col("col_b")) & (F.abs("r") > threshold))
                .orderBy(F.desc(F.abs("r")), "col_a", "col_b"))


def pair_profile(df: DataFrame, a: str, b: str) -> DataFrame:
    """N, ranges, means and r of two columns after dropping rows null in either."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return d.agg(F.count(F.lit(1)).alias("n"), F.min(a).alias("min_a"), F.max(a).alias("max_a"),
                 F.min(b).alias("min_b"), F.max(b).alias("max_b"), F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"),
                 F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b)).alias("r"))


def contingency(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Cross-tabulation, one row per ``row`` category and one column per
    ``col`` value (zero cells filled). Give ``values`` to skip the distinct pass."""
    d = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    p = d.groupBy(row).pivot(col, list(values) if values is not None else None).count()
    return p.fillna(0)


def group_means_ranked(df: DataFrame, by: str, value: str, k: int = 5) -> DataFrame:
    """Mean of ``value`` per group with its top-k and bottom-k positions
    ('lowest' is the tail of the descending order, still descending). Ranks run
    on the aggregated table, one row per group."""
    g = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(value).alias("mean_value"),
                                                       F.count(F.lit(1)).alias("n"))
    # Two bounded top-k selections (TakeOrdered keeps k rows per task) instead of a
    # window over every group.
    top = g.orderBy(F.desc_nulls_last("mean_value"), F.col(by)).limit(k).select(by, F.lit(True).alias("is_top"))
    bot = g.orderBy(F.asc_nulls_first("mean_value"), F.desc(by)).limit(k).select(by, F.lit(True).alias("is_bottom"))
    flags = top.join(bot, by, "full")
    return (g.join(F.broadcast(flags), by, "inner")
             .select(by, "mean_value", "n", F.coalesce("is_top", F.lit(False)).alias("is_top"),
                     F.coalesce("is_bottom", F.lit(False)).alias("is_bottom")))


def prepared_summary(df: DataFrame, target: str = "TotalClaims", split: str = "split",
                     feature_cols: Sequence[str] = ()) -> DataFrame:
    """Records, train / test sizes, feature counts (numeric / categorical) and target mean / std."""
    num = [c for c in feature_cols if isinstance(df.schema[c].dataType, T.NumericType)]
    cat = [c for c in feature_cols if isinstance(df.schema[c].dataType, T.StringType)]
    return df.agg(F.count(F.lit(1)).alias("n_records"), F.count_if(F.col(split) == "train").alias("n_train"),
                  F.count_if(F.col(split) == "test").alias("n_test"), F.avg(target).alias("target_mean"),
                  F.stddev_samp(target).alias("target_std")) \
             .withColumns({"n_features": F.lit(len(feature_cols)), "n_numeric": F.lit(len(num)),
                           "n_categorical": F.lit(len(cat))})
