"""Hypothesis tests as distributed aggregations.

Each test = one aggregation to a tiny per-group table (counts, sums, moments,
rank sums) -> closed-form statistic in column arithmetic -> p-value added by one
Arrow-batched pandas UDF over the result rows (one row per test or pair). Data
rows never reach Python. Every test returns rows of RESULT_SCHEMA, so a battery
is a ``unionByName``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from claimlens.functions import dist as D
from claimlens.functions.expr import norm_ppf, threshold_label
from claimlens.operators import ranking as R
from claimlens.operators.quantiles import aggregate, median
from claimlens.session import joinable

RESULT_COLS = ["test_name", "test_type", "feature", "metric", "group_a", "group_b", "statistic", "dof",
               "p_value", "effect_size", "effect_label", "n_groups", "n_obs", "reject_null"]

# Effect-size label cut points.
V_CUTS, ETA_CUTS, D_CUTS = [0.1, 0.3, 0.5], [0.01, 0.06, 0.14], [0.2, 0.5, 0.8]
LABELS = ["Negligible", "Small", "Medium", "Large"]


@pandas_udf(DoubleType())
def _pv(kind: pd.Series, a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([D.pvalue(k, x, y, z, w) if k is not None else float("nan")
                      for k, x, y, z, w in zip(kind, a, b, c, d)], dtype="float64")


@pandas_udf(DoubleType())
def _power(d: pd.Series, n1: pd.Series, n2: pd.Series, alpha: pd.Series) -> pd.Series:
    return pd.Series([D.ttest_power(x, y, z, w) for x, y, z, w in zip(d, n1, n2, alpha)], dtype="float64")


@pandas_udf(DoubleType())
def _tppf(q: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([D.t_ppf(x, y) if y and y > 0 else float("nan") for x, y in zip(q, df)], dtype="float64")


def p_value(kind, a, b=None, c=None, d=None, ok: Column | None = None) -> Column:
    """p of a statistic; rows where ``ok`` is false are not evaluated (null)."""
    lit_nan = F.lit(float("nan")).cast("double")
    kind = F.lit(kind) if isinstance(kind, str) else kind
    kind = kind if ok is None else F.when(ok, kind)
    args = [x.cast("double") if x is not None else lit_nan for x in (a, b, c, d)]
    p = _pv(kind, *args)
    return F.when(F.isnan(p), F.lit(None).cast("double")).otherwise(p)


#: The test type of a row whose guard failed.
INSUFFICIENT = "Insufficient data"
_JUDGED = ("statistic", "dof", "p_value", "effect_size", "effect_label", "reject_null")


def _result(df: DataFrame, ok: Column | None = None, extra: dict | None = None, **cols) -> DataFrame:
    """Project onto RESULT_COLS (missing -> typed null). F9: where the guard ``ok`` is not
    true, the row says so in its test type and carries names and counts only."""
    types = {"statistic": "double", "dof": "double", "p_value": "double", "effect_size": "double",
             "n_groups": "int", "n_obs": "bigint", "reject_null": "boolean"}
    out = []
    for c in RESULT_COLS:
        v = cols.get(c)
        if v is None:
            v = F.lit(None)
        elif not isinstance(v, Column):
            v = F.lit(v)
        if ok is not None and c in _JUDGED:
            v = F.when(ok, v)
        elif ok is not None and c == "test_type":
            v = F.when(ok, v).otherwise(INSUFFICIENT)
        out.append(v.cast(types.get(c, "string")).alias(c))
    return df.select(*out, *[v.alias(c) for c, v in (extra or {}).items()])


def decide(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    """reject_null = p < alpha (null p -> null)."""
    return df.withColumn("reject_null", F.col("p_value") < alpha)


# --------------------------------------------------------------- T1 / T4 / T6

def chi_square_k2(df: DataFrame, group: str, flag: str, *, min_count: int = 30, top_k: int | None = None,
                  test_name: str = "Claim Frequency Differences", alpha: float = 0.05,
                  yates: bool = True) -> DataFrame:
    """Chi-square test of independence on the k x 2 table of ``group`` by a
    0/1 ``flag`` (groups with >= ``min_count`` rows, optionally the ``top_k``
    largest); Yates' correction when dof = 1; Cramer's V = sqrt(chi2 / (n * (min(k,2) - 1)))."""
    d = df.where(F.col(group).isNotNull() & F.col(flag).isNotNull())
    g = d.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(flag).cast("double")).alias("c"))
    g = g.where(F.col("n") >= min_count)
    if top_k:
        g = g.orderBy(F.desc("n"), F.col(group)).limit(top_k)
    return chi_square_from_groups(g, group, flag, test_name=test_name, alpha=alpha, yates=yates)


def chi_square_from_groups(g: DataFrame, group: str, flag: str, *, test_name: str = "Claim Frequency Differences", alpha: float = 0.05,
                           yates: bool = True) -> DataFrame:
    """T1 from a table of groups with their rows ``n`` and flagged rows ``c``."""
    tot = g.agg(F.sum("n").alias("nn"), F.sum("c").alias("cc"), F.count(F.lit(1)).alias("k"))
    j = g.crossJoin(F.broadcast(tot))
    e1 = F.try_divide(F.col("n") * F.col("cc"), F.col("nn"))
    e0 = F.try_divide(F.col("n") * (F.col("nn") - F.col("cc")), F.col("nn"))
    o1, o0 = F.col("c"), F.col("n") - F.col("c")
    def term(o, e):
        dev = F.abs(o - e)
        if yates:
            dev = F.when(F.col("k") == 2, dev - F.least(F.lit(0.5), dev)).otherwise(dev)
        return F.try_divide(dev * dev, e)
    # dof of the table: a column without counts is no column
    cols_present = F.when(F.col("cc") > 0, 1).otherwise(0) + F.when(F.col("nn") > F.col("cc"), 1).otherwise(0)
    s = j.agg(F.max("nn").alias("nn"), F.max("cc").alias("cc"), F.coalesce(F.max("k"), F.lit(0)).alias("k"),
              F.sum(term(o1, e1) + term(o0, e0)).alias("chi2"))
    s = s.withColumn("ncols", cols_present).withColumn("dof", (F.col("k") - 1) * (F.col("ncols") - 1))
    v = F.sqrt(F.try_divide(F.col("chi2"), F.col("nn") * (F.least(F.col("k"), F.col("ncols")) - 1)))
    ok = (F.col("k") >= 2) & (F.col("ncols") == 2)
    res = _result(s, ok, test_name=test_name, test_type="Chi-square Test", feature=group,
                  metric=flag, statistic=F.col("chi2"), dof=F.col("dof"),
                  p_value=p_value("chi2", F.col("chi2"), F.col("dof"), ok=ok), effect_size=v,
                  effect_label=threshold_label(v, V_CUTS, LABELS), n_groups=F.col("k"), n_obs=F.col("nn"))
    return decide(res, alpha)


# ----------------------------------------------------------------- T2 / T5 / T9

def anova_from_groups(g: DataFrame, *, test_name: str, feature: str, metric: str, alpha: float,
                       test_type: str = "One-way ANOVA", min_total: int = 0) -> DataFrame:
    """F and eta^2 from per-group (n, mean, var_samp)."""
    tot = g.agg(F.sum("n").alias("_tot_n"), F.count(F.lit(1)).alias("k"),
                F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("gm"))
    j = g.crossJoin(F.broadcast(tot))
    s = j.agg(F.coalesce(F.max("_tot_n"), F.lit(0)).alias("_tot_n"), F.coalesce(F.max("k"), F.lit(0)).alias("k"), F.sum(F.col("n") * (F.col("m") - F.col("gm")) ** 2).alias("ssb"),
                                      F.sum((F.col("n") - 1) * F.coalesce(F.col("v"), F.lit(0.0))).alias("ssw"))
    f = F.try_divide(F.try_divide(F.col("ssb"), F.col("k") - 1), F.try_divide(F.col("ssw"), F.col("_tot_n") - F.col("k")))
    eta = F.try_divide(F.col("ssb"), F.col("ssb") + F.col("ssw"))
    ok = (F.col("k") >= 2) & (F.col("_tot_n") > F.col("k")) & (F.col("_tot_n") >= min_total) & f.isNotNull()
    res = _result(s, ok, test_name=test_name, test_type=test_type, feature=feature, metric=metric,
                  statistic=f, dof=F.col("k") - 1, p_value=p_value("f", f, F.col("k") - 1, F.col("_tot_n") - F.col("k"), ok=ok),
                  effect_size=eta, effect_label=threshold_label(eta, ETA_CUTS, LABELS), n_groups=F.col("k"),
                  n_obs=F.col("_tot_n"))
    return decide(res, alpha)


def select_groups(df: DataFrame, group: str, *, min_rows: int = 30, first: int | None = None) -> DataFrame:
    """The valid groups (>= ``min_rows`` rows) in value-count order (ties by key),
    optionally the first ``first``; a small table of group keys."""
    g = (df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_rows"))
           .where(F.col("_rows") >= min_rows))
    if first:
        g = g.orderBy(F.desc("_rows"), F.col(group)).limit(first)
    return g.select(group)


def anova(df: DataFrame, group: str, value: str, *, groups: DataFrame | None = None, min_per_group: int = 5,
          min_total: int = 0, test_name: str = "Severity Differences", alpha: float = 0.05) -> DataFrame:
    """One-way ANOVA of ``value`` across ``group`` (restricted to ``groups`` if
    given; each kept group needs >= ``min_per_group`` values, all together >= ``min_total``)."""
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    if groups is not None:
        d = d.join(groups, group, "left_semi")
    g = (d.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
          .where(F.col("n") >= min_per_group))
    return anova_from_groups(g, test_name=test_name, feature=group, metric=value, alpha=alpha, min_total=min_total)


def levene(df: DataFrame, group: str, value: str, *, test_name: str = "Equal Variance (Levene)",
           alpha: float = 0.05) -> DataFrame:
    """Levene's test centred on group medians = ANOVA of |x - median(group)|."""
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    meds = joinable(aggregate(d, median(value).alias("_med"), by=[group]))
    z = d.join(meds, group).withColumn("_z", F.abs(F.col(value) - F.col("_med")))
    g = z.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg("_z").alias("m"), F.var_samp("_z").alias("v"))
    return anova_from_groups(g, test_name=test_name, feature=group, metric=value, alpha=alpha,
                              test_type="Levene Test")


def tukey_hsd(df: DataFrame, group: str, value: str, *, groups: DataFrame | None = None, min_per_group: int = 5,
              alpha: float = 0.05) -> DataFrame:
    """Tukey HSD for every pair of groups (a < b) from group moments:
    q = |mean_a - mean_b| / sqrt(MSW / 2 * (1/n_a + 1/n_b)); p from the
    studentised range with k groups and N - k dof. The pair table is a self join
    of the k-row group table."""
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    if groups is not None:
        d = d.join(groups, group, "left_semi")
    g = (d.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
          .where(F.col("n") >= min_per_group))
    tot = g.agg(F.sum("n").alias("_tot_n"), F.count(F.lit(1)).alias("k"),
                F.sum((F.col("n") - 1) * F.coalesce("v", F.lit(0.0))).alias("ssw"))
    a, b = g.alias("a"), g.alias("b")
    pairs = a.join(b, F.col(f"a.{group}") < F.col(f"b.{group}")).crossJoin(F.broadcast(tot))
    msw = F.try_divide(F.col("ssw"), F.col("_tot_n") - F.col("k"))
    se = F.sqrt(msw / 2 * (1 / F.col("a.n") + 1 / F.col("b.n")))
    q = F.try_divide(F.abs(F.col("a.m") - F.col("b.m")), se)
    ok = q.isNotNull()
    res = _result(pairs, ok, test_name="Tukey HSD", test_type="Tukey HSD", feature=F.lit(group), metric=F.lit(value),
                  group_a=F.col(f"a.{group}"), group_b=F.col(f"b.{group}"), statistic=q, dof=F.col("_tot_n") - F.col("k"),
                  p_value=p_value("tukey", q, F.col("k"), F.col("_tot_n") - F.col("k"), ok=ok),
                  effect_size=F.col("a.m") - F.col("b.m"), n_groups=F.col("k"), n_obs=F.col("a.n") + F.col("b.n"))
    few = _result(tot.where(F.col("k") < 2), F.lit(False), test_name="Tukey HSD", test_type="Tukey HSD", feature=group,
                  metric=value, n_groups=F.col("k"), n_obs=F.coalesce("_tot_n", F.lit(0)))
    return decide(res.unionByName(few), alpha)


# ----------------------------------------------------------- two-group tests

def two_group_moments(df: DataFrame, label: str, value: str, a: str, b: str) -> DataFrame:
    """One-row table of n, mean, var for groups ``a`` and ``b`` of ``label`` (nulls omitted)."""
    x = F.col(value)
    ia, ib = F.col(label) == a, F.col(label) == b
    d = df.where(x.isNotNull() & ~F.isnan(x.cast("double")))
    return d.agg(F.count_if(ia).alias("n1"), F.avg(F.when(ia, x)).alias("m1"), F.var_samp(F.when(ia, x)).alias("v1"),
                 F.count_if(ib).alias("n2"), F.avg(F.when(ib, x)).alias("m2"), F.var_samp(F.when(ib, x)).alias("v2"))


def _t_cols(student: bool):
    n1, n2, m1, m2, v1, v2 = (F.col(c) for c in ("n1", "n2", "m1", "m2", "v1", "v2"))
    if student:
        sp2 = F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, n1 + n2 - 2)
        t = F.try_divide(m1 - m2, F.sqrt(sp2 * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2))))
        dof = n1 + n2 - 2
    else:
        a, b = F.try_divide(v1, n1), F.try_divide(v2, n2)
        t = F.try_divide(m1 - m2, F.sqrt(a + b))
        dof = F.try_divide((a + b) ** 2, F.try_divide(a ** 2, n1 - 1) + F.try_divide(b ** 2, n2 - 1))
    return t, dof


def cohens_d_cols(root_mean: bool = False):
    """Pooled (df-weighted) or root-mean-variance Cohen's d."""
    n1, n2, m1, m2, v1, v2 = (F.col(c) for c in ("n1", "n2", "m1", "m2", "v1", "v2"))
    sd = F.sqrt((v1 + v2) / 2) if root_mean else F.sqrt(F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, n1 + n2 - 2))
    return F.try_divide(m1 - m2, sd)


def t_test(df: DataFrame, label: str, value: str, a: str, b: str, *, welch: bool = True, alpha: float = 0.05,
           test_name: str = "Two-group mean difference") -> DataFrame:
    """Student (pooled) or Welch t-test of ``value`` between groups a and b."""
    m = two_group_moments(df, label, value, a, b)
    return t_test_from_moments(m, label, value, F.lit(a), F.lit(b), welch=welch, alpha=alpha, test_name=test_name)


def t_test_from_moments(m: DataFrame, label, value, a, b, *, welch: bool = True, alpha: float = 0.05,
                        test_name: str = "Two-group mean difference", extra: dict | None = None) -> DataFrame:
    """T10 / T11 from rows of moments (n1, m1, v1, n2, m2, v2), one test a row; names may be columns."""
    t, dof = _t_cols(student=not welch)
    dd = cohens_d_cols()
    ok = (F.col("n1") >= 2) & (F.col("n2") >= 2) & t.isNotNull()
    res = _result(m, ok, test_name=test_name, test_type="Welch's t-test" if welch else "Independent t-test",
                  feature=label, metric=value, group_a=a, group_b=b, statistic=t, dof=dof,
                  p_value=p_value("t", t, dof, ok=ok), effect_size=dd, effect_label=threshold_label(F.abs(dd), D_CUTS, LABELS),
                  n_groups=2, n_obs=F.col("n1") + F.col("n2"), extra=extra)
    return decide(res, alpha)


def effect_size_table(df: DataFrame, label: str, value: str, a: str, b: str, alpha: float = 0.05) -> DataFrame:
    """Both Cohen's d, label, mean difference, relative
    difference %, power at the pooled d, and the 1-alpha CI of the mean difference
    (t quantile with n1 + n2 - 2 dof, Welch standard error)."""
    m = two_group_moments(df, label, value, a, b)
    d1, d2 = cohens_d_cols(), cohens_d_cols(root_mean=True)
    n1, n2, m1, m2, v1, v2 = (F.col(c) for c in ("n1", "n2", "m1", "m2", "v1", "v2"))
    se = F.sqrt(F.try_divide(v1, n1) + F.try_divide(v2, n2))
    tq = _tppf(F.lit(1 - alpha / 2), (n1 + n2 - 2).cast("double"))
    return m.select(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), "n1", "n2", "m1", "m2",
                    (m1 - m2).alias("mean_diff"), d1.alias("cohens_d"),
                    threshold_label(F.abs(d1), D_CUTS, LABELS).alias("effect_label"), d2.alias("cohens_d_rms"),
                    F.try_divide((m1 - m2) * 100.0, F.abs(m2)).alias("relative_diff_pct"),
                    _power(F.abs(d1), n1.cast("double"), n2.cast("double"), F.lit(alpha)).alias("power"),
                    (m1 - m2 - tq * se).alias("ci_low"), (m1 - m2 + tq * se).alias("ci_high"))


def two_by_two(df: DataFrame, label: str, flag: str, a: str, b: str, *, fisher_rule: str = "zero",
               alpha: float = 0.05, min_rows: int = 1, test_name: str = "Two-group proportion difference") -> DataFrame:
    """2x2 chi-square (Yates) of a 0/1 ``flag`` between groups a and b,
    with Fisher's exact test when a cell is zero (``fisher_rule='zero'``) or when a
    cell is zero or below 5 (``'small'``). Also reports the rates and the risk ratio of b
    to a. Fewer than ``min_rows`` rows, or an empty side, give the insufficient row (F9).
    Fisher's test is evaluated only where it is chosen."""
    ia, ib = F.col(label) == a, F.col(label) == b
    f = F.col(flag).cast("double")
    m = df.where(F.col(flag).isNotNull()).agg(
        F.sum(F.when(ia, f)).alias("a1"), F.count_if(ia).alias("na"),
        F.sum(F.when(ib, f)).alias("b1"), F.count_if(ib).alias("nb"))
    m = m.select(F.coalesce("a1", F.lit(0.0)).alias("x11"), (F.col("na") - F.coalesce("a1", F.lit(0.0))).alias("x12"),
                 F.coalesce("b1", F.lit(0.0)).alias("x21"), (F.col("nb") - F.coalesce("b1", F.lit(0.0))).alias("x22"))
    return two_by_two_from_counts(m, label, flag, F.lit(a), F.lit(b), fisher_rule=fisher_rule, alpha=alpha, min_rows=min_rows, test_name=test_name)


def two_by_two_from_counts(m: DataFrame, label, flag, a, b, *, fisher_rule: str = "zero", alpha: float = 0.05, min_rows: int = 1,
                           test_name: str = "Two-group proportion difference", extra: dict | None = None) -> DataFrame:
    """T13 from rows of counts (x11, x12, x21, x22: flagged and other rows of either group), one test a row."""
    cells = [F.col(c) for c in ("x11", "x12", "x21", "x22")]
    n = cells[0] + cells[1] + cells[2] + cells[3]
    r1, r2, c1, c2 = cells[0] + cells[1], cells[2] + cells[3], cells[0] + cells[2], cells[1] + cells[3]
    exp = [F.try_divide(r * c, n) for r, c in ((r1, c1), (r1, c2), (r2, c1), (r2, c2))]
    chi = None
    for o, e in zip(cells, exp):
        dev = F.abs(o - e)
        dev = dev - F.least(F.lit(0.5), dev)
        t = F.coalesce(F.try_divide(dev * dev, e), F.lit(0.0))
        chi = t if chi is None else chi + t
    minc = F.least(*cells)
    use_fisher = (minc == 0) if fisher_rule == "zero" else (minc < 5)
    odds = F.try_divide(cells[0] * cells[3], cells[1] * cells[2])
    rate_a, rate_b = F.try_divide(cells[0], r1), F.try_divide(cells[2], r2)
    v = F.sqrt(F.try_divide(chi, n))
    ok = (n >= min_rows) & (r1 > 0) & (r2 > 0)
    none = F.lit(None).cast("double")
    p = p_value(F.when(use_fisher, "fisher").otherwise("chi2"), F.when(use_fisher, cells[0]).otherwise(chi),
                F.when(use_fisher, cells[1]).otherwise(F.lit(1.0)), F.when(use_fisher, cells[2]).otherwise(none),
                F.when(use_fisher, cells[3]).otherwise(none), ok=ok)
    base = m.withColumns({"_rate_a": rate_a, "_rate_b": rate_b})
    res = _result(base, ok, test_name=test_name,
                  test_type=F.when(use_fisher, "Fisher's Exact Test").otherwise("Chi-square Test"), feature=label, metric=flag,
                  group_a=a, group_b=b, statistic=F.when(use_fisher, odds).otherwise(chi),
                  dof=F.when(~use_fisher, F.lit(1.0)), p_value=p, effect_size=v,
                  effect_label=threshold_label(v, V_CUTS, LABELS), n_groups=2, n_obs=n,
                  extra={"rate_a": F.col("_rate_a"), "rate_b": F.col("_rate_b"),
                         "risk_ratio": F.try_divide(F.col("_rate_b"), F.col("_rate_a")), **(extra or {})})
    return decide(res, alpha)


# ------------------------------------------------------- many tests from one melt

def group_table(df: DataFrame, features: Sequence[str], metrics: dict) -> DataFrame:
    """Sufficient statistics of many tests in one pass and one shuffle: a row becomes one (feature, group) pair for
    each feature it has, and every group gets its rows ``n`` and, for each metric, ``n_/m_/v_/s_{metric}``: count, mean,
    sample variance and sum. ``metrics``: name -> Column, null where a row has no part in the metric."""
    x = {k: v.cast("double") for k, v in metrics.items()}
    rows = df.select(*[F.nanvl(v, F.lit(None).cast("double")).alias(f"x_{k}") for k, v in x.items()],
                     F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("group")) for f in features])).alias("_f"))
    rows = rows.select("_f.*", *[f"x_{k}" for k in x]).where("group IS NOT NULL")
    return rows.groupBy("feature", "group").agg(F.count(F.lit(1)).alias("n"), *[
        f(f"x_{k}").alias(f"{p}_{k}") for k in x for p, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp), ("s", F.sum))])


def two_group_batch(table: DataFrame, tests: Sequence[tuple], flags: Sequence[str] = (), groups: dict | None = None, *, min_rows: int = 0,
                    fisher_rule: str = "zero", alpha: float = 0.05, test_name: str = "Two-group test") -> DataFrame:
    """T11 / T13 / T15 for a list of (feature, metric): one row a test, from a :func:`group_table`. The groups are
    the two largest of each feature (ties by name) or the pair that ``groups`` names; metrics in ``flags`` get the 2x2
    test, others Welch's. ``decision`` is 'Insufficient Data' with fewer than ``min_rows`` rows on a side."""
    metrics = sorted({m for _, m in tests})
    given = {f: g for f, g in (groups or {}).items()}
    place = F.lit(None).cast("int")
    for f, (a, b) in given.items():
        place = F.when((F.col("feature") == f) & (F.col("group") == a), 1).when((F.col("feature") == f) & (F.col("group") == b), 2).otherwise(place)
    by = Window.partitionBy("feature").orderBy(F.desc("n"), "group")
    # the two rows of a feature are found before the shuffle by its tasks
    free = table.where(~F.col("feature").isin(list(given)) if given else F.lit(True)).withColumn("_at", F.row_number().over(by)).where("_at <= 2")
    chosen = free if not given else free.unionByName(table.withColumn("_at", place).where("_at IS NOT NULL"))
    one = lambda at, c: F.max(F.when(F.col("_at") == at, F.col(c)))
    wide = chosen.groupBy("feature").agg(one(1, "group").alias("name_a"), one(2, "group").alias("name_b"), *[
        one(at, f"{p}{m}" if p == "n" and not m else f"{p}_{m}").alias(f"{p}{at}_{m}") for at in (1, 2) for p, ms in (("n", ["", *metrics]), ("m", metrics), ("v", metrics), ("s", metrics)) for m in ms])
    rows = wide.select("feature", "name_a", "name_b", F.coalesce("n1_", F.lit(0)).alias("na"), F.coalesce("n2_", F.lit(0)).alias("nb"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), *[F.col(f"{p}{at}_{m}").alias(f"{p}{at}") for at in (1, 2) for p in ("n", "m", "v", "s")]) for m in metrics])).alias("_m"))
    rows = rows.select("feature", "name_a", "name_b", "na", "nb", "_m.*").withColumns({f"n{at}": F.coalesce(f"n{at}", F.lit(0)) for at in (1, 2)})
    wanted = F.lit(False)
    for f, m in tests:
        wanted = wanted | ((F.col("feature") == f) & (F.col("metric") == m))
    rows = rows.where(wanted)
    sides, is_flag = {"na": F.col("na"), "nb": F.col("nb")}, F.col("metric").isin(list(flags))
    num, flag = [m for _, m in tests if m not in flags], [m for _, m in tests if m in flags]
    names = (F.col("feature"), F.col("metric"), F.col("name_a"), F.col("name_b"))
    parts = []
    if num:
        parts.append(t_test_from_moments(rows.where(~is_flag), *names, alpha=alpha, test_name=test_name, extra=sides))
    if flag:
        s1, s2 = F.coalesce("s1", F.lit(0.0)), F.coalesce("s2", F.lit(0.0))
        counts = rows.where(is_flag).withColumns({"x11": s1, "x12": F.col("n1") - s1, "x21": s2, "x22": F.col("n2") - s2})
        parts.append(two_by_two_from_counts(counts, *names, fisher_rule=fisher_rule, alpha=alpha, test_name=test_name, extra=sides)
                     .drop("rate_a", "rate_b", "risk_ratio"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    ok = (F.col("na") >= min_rows) & (F.col("nb") >= min_rows)
    return out.withColumns({
        "decision": F.when(~ok, "Insufficient Data").when(F.col("p_value") < alpha, "Reject H0").otherwise("Fail to Reject H0"),
        "p_value": F.when(ok, F.col("p_value")), "reject_null": F.when(ok, F.col("reject_null"))}).drop("na", "nb")


def mann_whitney(df: DataFrame, label: str, value: str, a: str, b: str, *, alpha: float = 0.05,
                 test_name: str = "Two-group distribution difference") -> DataFrame:
    """Mann-Whitney U (two-sided, tie + continuity corrected). Ranks are
    average ranks of the distinct values over both groups, computed with the
    distributed prefix sum; U1 = R1 - n1(n1+1)/2."""
    x = F.col(value)
    d = df.where(x.isNotNull() & F.col(label).isin(a, b))
    v = d.groupBy(value).agg(F.count_if(F.col(label) == a).alias("c1"), F.count_if(F.col(label) == b).alias("c2"),
                             F.count(F.lit(1)).alias("_w"))
    p = R.prefix_weights(v, [], [value], "_w")
    ar = (F.col("_before") + (F.col("_w") + 1) / 2.0).cast("double")
    s = p.agg(F.sum(F.col("c1") * ar).alias("r1"), F.sum("c1").alias("n1"), F.sum("c2").alias("n2"),
              F.sum(F.col("_w").cast("double") ** 3 - F.col("_w")).alias("tie"))
    n1 = F.coalesce(F.col("n1"), F.lit(0)).cast("double")  # products of counts pass the range of bigint
    n2 = F.coalesce(F.col("n2"), F.lit(0)).cast("double")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    ok = (n1 > 0) & (n2 > 0)
    res = _result(s, ok, test_name=test_name, test_type="Mann-Whitney U test", feature=label, metric=value, group_a=a,
                  group_b=b, statistic=u1, p_value=p_value("mannwhitney", u1, n1, n2, F.col("tie"), ok=ok),
                  n_groups=2, n_obs=n1 + n2)
    return decide(res, alpha)


def shapiro_wilk(df: DataFrame, group: str, value: str, *, alpha: float = 0.05) -> DataFrame:
    """Shapiro-Wilk W per group on ALL values (no sampling). Each value gets its
    within-group rank i from the distributed row number; m_i = Phi^-1((i - 3/8)/(n + 1/4))
    is a column expression; one aggregate gives sum m_i^2, sum m_i x_i and the four
    extreme order statistics; Royston's (1992) coefficient polynomials finish W in
    column arithmetic and his normal approximation gives p (pandas UDF)."""
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("_x"))
    r = R.row_number_global(d, ["_x"], by=[group], out="_i")
    n = F.col("n_group").cast("double")
    m = norm_ppf((F.col("_i") - 0.375) / (n + 0.25))
    r = r.withColumn("_m", m)
    g = r.groupBy(group, "n_group").agg(
        F.sum(F.col("_m") ** 2).alias("mm"), F.sum(F.col("_m") * F.col("_x")).alias("smx"),
        F.sum("_x").alias("sx"), F.sum(F.col("_x") ** 2).alias("sxx"), F.var_samp("_x").alias("vx"),
        F.max(F.when(F.col("_i") == 1, F.col("_x"))).alias("x1"), F.max(F.when(F.col("_i") == 2, F.col("_x"))).alias("x2"),
        F.max(F.when(F.col("_i") == F.col("n_group") - 1, F.col("_x"))).alias("xn1"),
        F.max(F.when(F.col("_i") == F.col("n_group"), F.col("_x"))).alias("xn"),
        F.max(F.when(F.col("_i") == F.col("n_group"), F.col("_m"))).alias("mn"),
        F.max(F.when(F.col("_i") == F.col("n_group") - 1, F.col("_m"))).alias("mn1"))
    nn = F.col("n_group").cast("double")
    u = 1 / F.sqrt(nn)
    cn, cn1 = F.try_divide(F.col("mn"), F.sqrt("mm")), F.try_divide(F.col("mn1"), F.sqrt("mm"))
    # Royston's coefficient polynomials.
    an = cn + 0.221157 * u - 0.147981 * u ** 2 - 2.071190 * u ** 3 + 4.434685 * u ** 4 - 2.706056 * u ** 5
    an1 = cn1 + 0.042981 * u - 0.293762 * u ** 2 - 1.752461 * u ** 3 + 5.682633 * u ** 4 - 3.582633 * u ** 5
    big = nn > 5
    phi = F.when(big, F.try_divide(F.col("mm") - 2 * F.col("mn") ** 2 - 2 * F.col("mn1") ** 2, 1 - 2 * an ** 2 - 2 * an1 ** 2)) \
           .otherwise(F.try_divide(F.col("mm") - 2 * F.col("mn") ** 2, 1 - 2 * an ** 2))
    # m_1 = -m_n and m_2 = -m_{n-1} by symmetry of the normal scores
    inner = F.when(big, F.col("smx") - F.col("mn") * (F.col("xn") - F.col("x1")) - F.col("mn1") * (F.col("xn1") - F.col("x2"))) \
             .otherwise(F.col("smx") - F.col("mn") * (F.col("xn") - F.col("x1")))
    ax = F.when(big, F.try_divide(inner, F.sqrt(phi)) + an * (F.col("xn") - F.col("x1")) + an1 * (F.col("xn1") - F.col("x2"))) \
          .otherwise(F.try_divide(inner, F.sqrt(phi)) + an * (F.col("xn") - F.col("x1")))
    ax = F.when(nn == 3, F.sqrt(F.lit(0.5)) * (F.col("xn") - F.col("x1"))).otherwise(ax)
    ss = F.col("vx") * (nn - 1)
    w = F.least(F.lit(1.0), F.try_divide(ax * ax, ss))
    ok = (F.col("n_group") >= 3) & w.isNotNull()
    res = _result(g, ok, test_name=F.concat(F.lit("Normality "), F.col(group).cast("string")),
                  test_type="Shapiro-Wilk", feature=group, metric=value, group_a=F.col(group).cast("string"),
                  statistic=w, p_value=p_value("shapiro", w, nn, ok=ok), n_groups=1, n_obs=F.col("n_group"))
    none = _result(d.agg(F.count(F.lit(1)).alias("n")).where("n = 0"), F.lit(False), test_name="Normality",
                   test_type="Shapiro-Wilk", feature=group, metric=value, n_groups=0, n_obs=F.col("n"))
    return decide(res.unionByName(none), alpha)


def two_largest(df: DataFrame, feature: str) -> DataFrame:
    """The two most frequent groups of ``feature`` (ties by key): columns rank, group."""
    return (df.where(F.col(feature).isNotNull()).groupBy(feature).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.col(feature)).limit(2))


def proportion_ci(df: DataFrame, flag: str, alpha: float = 0.05, by: str | None = None) -> DataFrame:
    """Wald interval p +- z * sqrt(p(1-p)/n) of a 0/1 flag (z from the normal quantile)."""
    z = D.norm_ppf(1 - alpha / 2)
    keys = [by] if by else []
    d = df.where(F.col(flag).isNotNull())
    g = (d.groupBy(*keys) if keys else d).agg(F.sum(F.col(flag).cast("double")).alias("successes"),
                                              F.count(F.lit(1)).alias("n"))
    p = F.col("successes") / F.col("n")
    se = F.sqrt(p * (1 - p) / F.col("n"))
    return g.select(*keys, "successes", "n", p.alias("proportion"), (p - z * se).alias("ci_low"), (p + z * se).alias("ci_high"))


__all__ = ["RESULT_COLS", "chi_square_k2", "anova", "levene", "tukey_hsd", "t_test", "two_by_two", "mann_whitney",
           "shapiro_wilk", "effect_size_table", "proportion_ci", "two_largest", "select_groups", "decide",
           "p_value", "math"]
