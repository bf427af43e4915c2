"""Hypothesis batteries (T4-T7, T14-T17, T27): compositions of the test operators.

Tests of many features and metrics read one table of sufficient statistics per group
(:func:`claimlens.operators.hypothesis.group_table`: one scan, one shuffle); choosing the two largest groups of each
feature is the second shuffle. Group choices that need the rows themselves are small tables joined back
(at most k rows, so the broadcast is bounded); nothing is collected to the driver, and every branch of a
data-dependent choice is computed and picked with ``when`` on the result row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.operators import clean as C
from claimlens.operators import features as FE
from claimlens.operators import hypothesis as H
from claimlens.session import materialize


def risk_table(df: DataFrame) -> DataFrame:
    """The test input: HasClaim, ClaimSeverity (amount or 0), Margin, ProfitMarginPct."""
    return C.add_risk_metrics(df)


# Columns that the batteries read.
TEST_COLUMNS = ["Province", "PostalCode", "Gender", "TotalClaims", "TotalPremium", "HasClaim", "ClaimSeverity", "Margin"]


def stored_risk(df: DataFrame) -> DataFrame:
    """The risk table's test columns, stored once for all tests of a battery."""
    risk = risk_table(df)
    return materialize(risk.select(*[c for c in TEST_COLUMNS if c in risk.columns]))


def two_largest_positions(df: DataFrame, feature: str) -> DataFrame:
    """The two largest groups, their sizes and positions 1 and 2 (ties by key)."""
    t = H.two_largest(df, feature).select(F.col(feature).cast("string").alias(feature), "n")
    # a window over two rows
    return t.withColumn("_pos", F.row_number().over(Window.orderBy(F.desc("n"), F.col(feature))))


def label_two_largest(df: DataFrame, feature: str, groups: Sequence[str] | None = None):
    """Rows of the two largest groups (or the two ``groups`` given) labelled
    ``_grp`` = 'A' / 'B', plus a one-row table of the chosen names."""
    if groups:
        top = df.sparkSession.createDataFrame([(groups[0], 1), (groups[1], 2)], f"`{feature}` string, _pos int")
    else:
        top = two_largest_positions(df, feature).select(feature, "_pos")
    lab = top.select(feature, F.when(F.col("_pos") == 1, "A").otherwise("B").alias("_grp"))
    rows = df.withColumn(feature, F.col(feature).cast("string")).join(F.broadcast(lab), feature, "inner")
    names = top.agg(F.max(F.when(F.col("_pos") == 1, F.col(feature))).alias("name_a"),
                    F.max(F.when(F.col("_pos") == 2, F.col(feature))).alias("name_b"))
    return rows, names


def _rename(res: DataFrame, names: DataFrame, feature: str) -> DataFrame:
    return (res.crossJoin(F.broadcast(names))
               .withColumn("group_a", F.col("name_a")).withColumn("group_b", F.col("name_b"))
               .withColumn("feature", F.lit(feature)).drop("name_a", "name_b"))


#: 0/1 metrics: tested by their rates, others by their means.
FLAGS = ("HasClaim",)


def two_group_tests(df: DataFrame, features: Sequence[str], metrics: Sequence[str], groups: dict | None = None, min_rows: int = 30,
                    alpha: float = 0.05, tests: Sequence[tuple] | None = None, flags: Sequence[str] = FLAGS) -> DataFrame:
    """T15 for lists: every feature with every metric (or the (feature, metric) pairs ``tests``), one decision row
    each; the two largest groups of a feature, or the pair that ``groups`` names for it. A 0/1 metric -> 2x2
    chi-square (Fisher on a zero cell), else Welch t; fewer than ``min_rows`` rows on a side -> decision
    'Insufficient Data'. One scan and two shuffles for all of them."""
    tests = list(tests) if tests is not None else [(f, m) for f in features for m in metrics]
    features, metrics = sorted({f for f, _ in tests}), sorted({m for _, m in tests})
    table = H.group_table(df, features, {m: F.col(m) for m in metrics})
    return H.two_group_batch(table, tests, [m for m in metrics if m in flags], groups, min_rows=min_rows, alpha=alpha)


def two_group_test(df: DataFrame, feature: str, metric: str, groups: Sequence[str] | None = None,
                   min_rows: int = 30, alpha: float = 0.05) -> DataFrame:
    """One feature and one metric."""
    return two_group_tests(df, [feature], [metric], {feature: tuple(groups)} if groups else None, min_rows, alpha)


# The standard battery of feature x metric tests.
STANDARD_TESTS = [("Province", "HasClaim"), ("PostalCode", "ClaimSeverity"), ("PostalCode", "Margin"),
                  ("Gender", "HasClaim")]


def standard_battery(df: DataFrame, tests=STANDARD_TESTS, alpha: float = 0.05) -> DataFrame:
    """The four feature x metric decisions, from one table of group statistics."""
    return two_group_tests(risk_table(df), [], [], alpha=alpha, tests=tests)


def balance_check(df: DataFrame, feature: str, controls_text: Sequence[str], controls_num: Sequence[str],
                  groups: Sequence[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """Covariate balance between two groups: chi-square for text controls
    (control x group table), Welch t for numeric controls; ``all_clear`` is true
    when no control differs at ``alpha``. One pass melts every control to (control, value, group) with the
    statistics of all tests; the groups compared are then the two largest (or the two ``groups``)."""
    text, num = list(controls_text), list(controls_num)
    none = F.lit(None).cast("string")
    x = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    melted = df.where(F.col(feature).isNotNull()).select(F.col(feature).cast("string").alias("_g"), F.explode(F.array(
        F.struct(F.lit("").alias("name"), none.alias("value"), F.lit(None).cast("double").alias("x")),  # the group itself
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"), F.lit(None).cast("double").alias("x")) for c in text],
        *[F.struct(F.lit(c).alias("name"), none.alias("value"), x(c).alias("x")) for c in num])).alias("_c")).select("_g", "_c.*")
    table = materialize(melted.groupBy("name", "value", "_g").agg(F.count(F.lit(1)).alias("rows"), F.count("x").alias("n"), F.avg("x").alias("m"), F.var_samp("x").alias("v")))
    if groups:
        top = df.sparkSession.createDataFrame([(groups[0], 1), (groups[1], 2)], "_g string, _pos int")
    else:
        largest = table.where("name = ''").orderBy(F.desc("rows"), "_g").limit(2)
        top = largest.select("_g", F.row_number().over(Window.orderBy(F.desc("rows"), "_g")).alias("_pos"))  # a window over two rows
    names = top.agg(F.max(F.when(F.col("_pos") == 1, F.col("_g"))).alias("name_a"), F.max(F.when(F.col("_pos") == 2, F.col("_g"))).alias("name_b"))
    sides = table.join(F.broadcast(top), "_g")
    parts = []
    for c in text:
        counts = sides.where((F.col("name") == c) & F.col("value").isNotNull()).groupBy(F.col("value").alias(c)).agg(
            F.sum("rows").alias("n"), F.sum(F.when(F.col("_pos") == 1, F.col("rows")).otherwise(0)).cast("double").alias("c"))
        parts.append(H.chi_square_from_groups(counts, c, c, test_name=f"Balance {c}", alpha=alpha))
    if num:
        at = lambda pos, c: F.max(F.when(F.col("_pos") == pos, F.col(c)))
        moments = sides.where(F.col("name").isin(num)).groupBy("name").agg(*[at(p, c).alias(f"{c}{p}") for p in (1, 2) for c in ("n", "m", "v")])
        moments = moments.withColumns({f"n{p}": F.coalesce(f"n{p}", F.lit(0)) for p in (1, 2)})
        tests = H.t_test_from_moments(moments, "_grp", F.col("name"), "A", "B", alpha=alpha)
        parts.append(tests.withColumn("test_name", F.concat(F.lit("Balance "), "metric")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = _rename(out, names, feature)
    flag = out.agg(F.bool_and(F.coalesce(F.col("p_value") >= alpha, F.lit(True))).alias("all_clear"))
    return out.crossJoin(F.broadcast(flag))


def gender_severity(df: DataFrame, alpha: float = 0.05, min_claims: int = 30, min_side: int = 10,
                    risk: DataFrame | None = None) -> DataFrame:
    """Claims only, Male vs Female: Shapiro-Wilk per group and Levene decide
    between Student t (all assumptions hold), Welch (equal variance only) and
    Mann-Whitney; all three are computed and the row is chosen by ``when``. Fewer than
    ``min_claims`` claims or ``min_side`` on a side give the insufficient row. ``risk``: a
    stored risk table to use instead of ``df``."""
    risk = FE.add_gender(risk_table(df) if risk is None else risk)
    risk = risk.where(F.col("HasClaim") == 1).where(F.col("Gender").isin("Male", "Female"))
    risk = materialize(risk.select("Gender", "HasClaim", "ClaimSeverity"))
    sw = H.shapiro_wilk(risk, "Gender", "ClaimSeverity")
    normal = sw.agg(F.bool_and(F.col("p_value") > 0.05).alias("normal"))
    lev = H.levene(risk, "Gender", "ClaimSeverity").select((F.col("p_value") > 0.05).alias("equal_var"))
    t = H.t_test(risk, "Gender", "ClaimSeverity", "Male", "Female", welch=False).select(
        *[F.col(c).alias(f"t_{c}") for c in H.RESULT_COLS])
    w = H.t_test(risk, "Gender", "ClaimSeverity", "Male", "Female", welch=True).select(
        *[F.col(c).alias(f"w_{c}") for c in H.RESULT_COLS])
    mw = H.mann_whitney(risk, "Gender", "ClaimSeverity", "Male", "Female").select(
        *[F.col(c).alias(f"m_{c}") for c in H.RESULT_COLS])
    eff = H.effect_size_table(risk, "Gender", "ClaimSeverity", "Male", "Female", alpha).select(
        "cohens_d", "effect_label", "power", "n1", "n2")
    j = t
    for one in (w, mw, normal, lev, eff):
        j = j.crossJoin(F.broadcast(one))
    pick = lambda c: (F.when(F.col("normal") & F.col("equal_var"), F.col(f"t_{c}"))
                      .when(F.col("equal_var"), F.col(f"w_{c}")).otherwise(F.col(f"m_{c}")))
    ok = (F.col("n1") + F.col("n2") >= min_claims) & (F.col("n1") >= min_side) & (F.col("n2") >= min_side)
    out = j.select(F.lit("Gender Claim Severity Differences").alias("test_name"), pick("test_type").alias("test_type"),
                   F.lit("Gender").alias("feature"), F.lit("ClaimSeverity").alias("metric"),
                   F.lit("Male").alias("group_a"), F.lit("Female").alias("group_b"),
                   pick("statistic").alias("statistic"), pick("dof").alias("dof"), pick("p_value").alias("p_value"),
                   F.col("cohens_d").alias("effect_size"), "effect_label", F.lit(2).alias("n_groups"),
                   (F.col("n1") + F.col("n2")).cast("bigint").alias("n_obs"),
                   (pick("p_value") < alpha).alias("reject_null"), "normal", "equal_var", "power",
                   F.coalesce(ok, F.lit(False)).alias("_ok"))
    judged = {c: F.when(F.col("_ok"), F.col(c)) for c in ("statistic", "dof", "p_value", "effect_size", "effect_label", "reject_null", "normal", "equal_var", "power")}
    judged["test_type"] = F.when(F.col("_ok"), F.col("test_type")).otherwise(H.INSUFFICIENT)
    return out.withColumns(judged).drop("_ok")


def zip_extremes(df: DataFrame, k: int = 5, min_rows_claims: int = 50, top_claims: int = 20, min_rows_margin: int = 30, top_margin: int = 15) -> DataFrame:
    """T4 / T5 lists: of the zip prefixes that each test covers, the ``k`` with the highest and the ``k`` with the
    lowest claim frequency (T4), margin and profit margin (T5), ranked from the extreme inwards (ties by
    prefix). One table of group statistics; a list has at most as many rows as its test has groups."""
    risk = FE.add_zip_prefix(risk_table(df))
    table = materialize(H.group_table(risk, ["ZipPrefix"], {m: F.col(m) for m in ("HasClaim", "Margin", "ProfitMarginPct")}))
    tested = lambda least, top: table.where(F.col("n") >= least).orderBy(F.desc("n"), "group").limit(top)
    parts = []
    for test, metric, rows in (("T4", "HasClaim", tested(min_rows_claims, top_claims)), ("T5", "Margin", tested(min_rows_margin, top_margin)),
                               ("T5", "ProfitMarginPct", tested(min_rows_margin, top_margin))):
        for side, order in (("high", F.desc), ("low", F.asc)):
            best = rows.where(F.col(f"m_{metric}").isNotNull()).orderBy(order(f"m_{metric}"), "group").limit(k)
            at = F.row_number().over(Window.orderBy(order(f"m_{metric}"), "group"))  # a window over k rows
            parts.append(best.select(F.lit(test).alias("test"), F.lit(metric).alias("metric"), F.lit(side).alias("side"), at.alias("place"),
                                     F.col("group").alias("ZipPrefix"), "n", F.col(f"m_{metric}").alias("mean")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def full_battery(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Province frequency (T1) and severity (T2), zip-prefix frequency (T4)
    and margin (T5), gender frequency (T6) and severity (T7); one summary row per
    test with significance text and the count of rejected hypotheses."""
    risk = FE.add_gender(FE.add_zip_prefix(stored_risk(df)))
    severity = F.when(F.col("HasClaim") == 1, F.col("ClaimSeverity"))
    # Rows per group and the statistics of all tests: one pass, a small table.
    table = materialize(H.group_table(risk, ["Province", "ZipPrefix", "Gender"], {"HasClaim": F.col("HasClaim"), "ClaimSeverity": severity, "Margin": F.col("Margin")}))

    def groups(feature, metric, least, first=None, least_metric=0):
        g = table.where((F.col("feature") == feature) & (F.col("n") >= least))
        if first:
            g = g.orderBy(F.desc("n"), "group").limit(first)
        return g.where(F.col(f"n_{metric}") >= least_metric).select(
            F.col("group").alias(feature), F.col(f"n_{metric}").alias("n"), F.col(f"m_{metric}").alias("m"), F.col(f"v_{metric}").alias("v"), F.col(f"s_{metric}").alias("c"))

    t1 = H.chi_square_from_groups(groups("Province", "HasClaim", 30), "Province", "HasClaim", test_name="Province Claim Frequency Differences")
    t2 = H.anova_from_groups(groups("Province", "ClaimSeverity", 30, 10, 5), feature="Province", metric="ClaimSeverity", alpha=alpha, min_total=30,
                             test_name="Province Claim Severity Differences")
    t4 = H.chi_square_from_groups(groups("ZipPrefix", "HasClaim", 50, 20), "ZipPrefix", "HasClaim", test_name="Zip Code Risk Differences")
    t5 = H.anova_from_groups(groups("ZipPrefix", "Margin", 30, 15, 5), feature="ZipPrefix", metric="Margin", alpha=alpha,
                             test_name="Zip Code Margin Differences")
    t6 = H.two_group_batch(table, [("Gender", "HasClaim")], ["HasClaim"], {"Gender": ("Male", "Female")}, test_name="Gender Risk Differences")
    few = F.col("n_obs") < 100
    t6 = t6.withColumns({c: F.when(~few, F.col(c)) for c in ("statistic", "dof", "p_value", "effect_size", "effect_label", "reject_null")}).withColumn(
        "test_type", F.when(few, H.INSUFFICIENT).otherwise(F.col("test_type"))).select(*H.RESULT_COLS)
    t7 = gender_severity(df, alpha, risk=risk).select(*H.RESULT_COLS)
    out = t1.unionByName(t2).unionByName(t4).unionByName(t5).unionByName(t6).unionByName(t7)
    out = (out.withColumn("significance", F.when(F.col("test_type") == H.INSUFFICIENT, H.INSUFFICIENT)
                          .when(F.col("reject_null"), "Significant").otherwise("Not significant"))
              .withColumn("conclusion", F.when(F.col("reject_null"), "Reject H0").otherwise("Fail to reject H0")))
    cnt = out.agg(F.count_if(F.col("reject_null")).alias("n_rejected"), F.count(F.lit(1)).alias("n_tests"))
    return out.crossJoin(F.broadcast(cnt))
