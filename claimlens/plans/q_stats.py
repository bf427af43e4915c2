"""Registered hypothesis-test queries.

Oracles compute statistics, effect sizes and counts in plain SQL and p-values as
Simpson sums of the densities, independently of the distribution module.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import features as FE
from claimlens.operators import hypothesis as H
from claimlens.plans import battery as B
from claimlens.plans.registry import finish, query
from claimlens.sources.views import policy_cte, policy_view

CTE = policy_cte()
STAT_COLS = ["test_name", "statistic", "dof", "p_value", "reject_null", "effect_size", "effect_label", "n_groups", "n_obs"]
RISK = CTE + """, risk AS (SELECT *, CAST(coalesce(TotalClaims > 0, false) AS INTEGER) AS HasClaim,
  CASE WHEN TotalClaims > 0 THEN TotalClaims ELSE 0.0 END AS ClaimSeverity, TotalPremium - TotalClaims AS Margin,
  regexp_extract(PostalCode, '([0-9]{3,4})', 1) AS ZipPrefix,
  CASE WHEN upper(Gender) IN ('M','MALE','1') THEN 'Male' WHEN upper(Gender) IN ('F','FEMALE','0') THEN 'Female' END AS G FROM policy)
"""


def _risk(spark, sf):
    return B.risk_table(policy_view(spark, sf))


def _vlabel(x):
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 0.1 THEN 'Negligible' WHEN {x} < 0.3 THEN 'Small' WHEN {x} < 0.5 THEN 'Medium' ELSE 'Large' END"


def _etalabel(x):
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 0.01 THEN 'Negligible' WHEN {x} < 0.06 THEN 'Small' WHEN {x} < 0.14 THEN 'Medium' ELSE 'Large' END"


def _dlabel(x):
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN abs({x}) < 0.2 THEN 'Negligible' WHEN abs({x}) < 0.5 THEN 'Small' WHEN abs({x}) < 0.8 THEN 'Medium' ELSE 'Large' END"


def _simpson(f: str, lo: str, hi: str, n: int = 2000) -> str:
    """Simpson sum of ``f`` (in ``x``) from ``lo`` to ``hi`` as a scalar subquery."""
    x = f"(({lo}) + i * (({hi}) - ({lo})) / {n}.0)"
    w = f"CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"((SELECT sum({w} * ({f.replace('{x}', x)})) FROM range({n + 1}) AS r(i)) * (({hi}) - ({lo})) / {3 * n}.0)"


def _p_norm(z: str) -> str:
    """P(|Z| > z)."""
    return f"(1 - 2 * {_simpson('exp(-{x} * {x} / 2) / sqrt(2 * pi())', '0', f'least({z}, 12.0)')})"


def _p_chi(x: str, dof: str) -> str:
    """Chi-square tail: u = sqrt(x) makes the density smooth at 0."""
    f = f"2 * pow({{x}}, ({dof}) - 1) * exp(-{{x}} * {{x}} / 2 - ({dof}) / 2.0 * ln(2) - lgamma(({dof}) / 2.0))"
    return f"(1 - {_simpson(f, '0', f'sqrt({x})')})"


def _p_f(f: str, d1: str, d2: str) -> str:
    """F tail as an incomplete beta integral in the angle t, x = sin(t)^2."""
    c = f"exp(lgamma((({d1}) + ({d2})) / 2.0) - lgamma(({d1}) / 2.0) - lgamma(({d2}) / 2.0))"
    g = f"2 * {c} * pow(sin({{x}}), ({d1}) - 1) * pow(cos({{x}}), ({d2}) - 1)"
    return f"(1 - {_simpson(g, '0', f'atan(sqrt(({d1}) * ({f}) / ({d2})))')})"


def _p_t(t: str, dof: str) -> str:
    return _p_f(f"({t}) * ({t})", "1", dof)


def _chi_sql(src, name, group, min_count, top=None):
    lim = f"ORDER BY n DESC, {group} LIMIT {top}" if top else ""
    return f""", g0 AS (SELECT {group} AS grp, count(*) AS n, sum(HasClaim) AS c FROM {src} WHERE {group} IS NOT NULL GROUP BY 1 HAVING count(*) >= {min_count} {lim}),
t AS (SELECT sum(n) AS nn, sum(c) AS cc, count(*) AS k FROM g0),
s AS (SELECT nn, cc, k, sum(
    (abs(c - n*cc/nn) - CASE WHEN k = 2 THEN least(0.5, abs(c - n*cc/nn)) ELSE 0 END) ^ 2 / (n*cc/nn)
  + (abs((n-c) - n*(nn-cc)/nn) - CASE WHEN k = 2 THEN least(0.5, abs((n-c) - n*(nn-cc)/nn)) ELSE 0 END) ^ 2 / (n*(nn-cc)/nn)) AS chi2
  FROM g0, t GROUP BY nn, cc, k), pp AS MATERIALIZED (SELECT *, {_p_chi("chi2", "k - 1")} AS p FROM s WHERE k >= 2)
SELECT '{name}' AS test_name, round(chi2, 6) AS statistic, CAST((k - 1) AS DOUBLE) AS dof, round(p, 6) AS p_value, p < 0.05 AS reject_null, round(sqrt(chi2 / nn), 6) AS effect_size,
  {_vlabel('sqrt(chi2 / nn)')} AS effect_label, CAST(k AS BIGINT) AS n_groups, CAST(nn AS BIGINT) AS n_obs FROM pp"""


@query("t1_province_claim_chi2", RISK + _chi_sql("risk", "Province Claim Frequency Differences", "Province", 30))
def t1_province_claim_chi2(spark, sf):
    r = _risk(spark, sf)
    return finish(H.chi_square_k2(r, "Province", "HasClaim", test_name="Province Claim Frequency Differences")
                  .select(*STAT_COLS))


@query("t4_zip_claim_chi2", RISK + _chi_sql("risk", "Zip Code Risk Differences", "ZipPrefix", 50, top=20))
def t4_zip_claim_chi2(spark, sf):
    z = FE.add_zip_prefix(_risk(spark, sf))
    return finish(H.chi_square_k2(z, "ZipPrefix", "HasClaim", min_count=50, top_k=20,
                                  test_name="Zip Code Risk Differences").select(*STAT_COLS))


def _anova_sql(name, src, group, value, groups_sql, min_per=5):
    return f""", sel AS ({groups_sql}),
g AS (SELECT {group} AS grp, count(*) AS n, avg({value}) AS m, var_samp({value}) AS v FROM {src}
  WHERE {group} IS NOT NULL AND {value} IS NOT NULL AND {group} IN (SELECT * FROM sel) GROUP BY 1 HAVING count(*) >= {min_per}),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n*m)/sum(n) AS gm FROM g),
s AS (SELECT nn, k, sum(n*(m-gm)^2) AS ssb, sum((n-1)*coalesce(v, 0)) AS ssw FROM g, t GROUP BY nn, k),
pp AS MATERIALIZED (SELECT *, {_p_f("(ssb/(k-1))/(ssw/(nn-k))", "k - 1", "nn - k")} AS p FROM s WHERE k >= 2)
SELECT '{name}' AS test_name, round((ssb/(k-1))/(ssw/(nn-k)), 6) AS statistic, CAST(k - 1 AS DOUBLE) AS dof,
  round(p, 6) AS p_value, p < 0.05 AS reject_null, round(ssb/(ssb+ssw), 6) AS effect_size, {_etalabel('ssb/(ssb+ssw)')} AS effect_label, CAST(k AS BIGINT) AS n_groups,
  CAST(nn AS BIGINT) AS n_obs FROM pp"""


@query("t2_province_severity_anova", RISK + _anova_sql(
    "Province Claim Severity Differences", "(SELECT * FROM risk WHERE HasClaim = 1)", "Province", "ClaimSeverity",
    "SELECT Province FROM risk WHERE Province IS NOT NULL GROUP BY Province HAVING count(*) >= 30 ORDER BY count(*) DESC, Province LIMIT 10"))
def t2_province_severity_anova(spark, sf):
    r = _risk(spark, sf)
    first10 = H.select_groups(r, "Province", min_rows=30, first=10)
    return finish(H.anova(r.where(F.col("HasClaim") == 1), "Province", "ClaimSeverity", groups=first10,
                          min_total=30, test_name="Province Claim Severity Differences").select(*STAT_COLS))


@query("t5_zip_margin_anova", RISK + _anova_sql(
    "Zip Code Margin Differences", "risk", "ZipPrefix", "Margin",
    "SELECT ZipPrefix FROM risk WHERE ZipPrefix IS NOT NULL GROUP BY ZipPrefix HAVING count(*) >= 30 ORDER BY count(*) DESC, ZipPrefix LIMIT 15"))
def t5_zip_margin_anova(spark, sf):
    z = FE.add_zip_prefix(_risk(spark, sf))
    zg = H.select_groups(z, "ZipPrefix", min_rows=30, first=15)
    return finish(H.anova(z, "ZipPrefix", "Margin", groups=zg, test_name="Zip Code Margin Differences").select(*STAT_COLS))


@query("t3_tukey_pairs", RISK + """, g AS (SELECT Province AS grp, count(*) AS n, avg(ClaimSeverity) AS m, var_samp(ClaimSeverity) AS v
  FROM risk WHERE HasClaim = 1 AND Province IS NOT NULL GROUP BY 1 HAVING count(*) >= 5),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum((n-1)*coalesce(v,0)) AS ssw FROM g)
SELECT a.grp AS group_a, b.grp AS group_b, round(abs(a.m - b.m) / sqrt(ssw/(nn-k)/2*(1.0/a.n + 1.0/b.n)), 6) AS statistic,
  CAST(nn - k AS DOUBLE) AS dof, round(a.m - b.m, 4) AS effect_size FROM g a JOIN g b ON a.grp < b.grp, t""")
def t3_tukey_pairs(spark, sf):
    r = _risk(spark, sf).where(F.col("HasClaim") == 1)
    return finish(H.tukey_hsd(r, "Province", "ClaimSeverity").select("group_a", "group_b", "statistic", "dof", "effect_size"),
                  {"effect_size": 4})


@query("t3_tukey_pvalues", None)
def t3_tukey_pvalues(spark, sf):
    """Tukey HSD of all pairs of T2's groups with studentised-range p-values and decisions, the
    ANOVA decision that gates them, and the place among the significant pairs (the report
    shows the first five)."""
    from pyspark.sql import Window
    risk = _risk(spark, sf)
    first10 = H.select_groups(risk, "Province", min_rows=30, first=10)
    claims = risk.where(F.col("HasClaim") == 1)
    gate = H.anova(claims, "Province", "ClaimSeverity", groups=first10, min_total=30).select(F.col("reject_null").alias("anova_rejects"))
    pairs = H.tukey_hsd(claims, "Province", "ClaimSeverity", groups=first10).crossJoin(F.broadcast(gate))
    # at most 45 pairs
    place = F.row_number().over(Window.partitionBy("reject_null").orderBy("group_a", "group_b"))
    return finish(pairs.withColumn("significant_place", F.when(F.col("reject_null"), place)))


GENDER_2x2 = RISK + """, c AS (SELECT sum(CASE WHEN G='Male' THEN HasClaim END) AS x11, count_if(G='Male') - sum(CASE WHEN G='Male' THEN HasClaim END) AS x12,
  sum(CASE WHEN G='Female' THEN HasClaim END) AS x21, count_if(G='Female') - sum(CASE WHEN G='Female' THEN HasClaim END) AS x22 FROM risk),
e AS (SELECT *, x11+x12+x21+x22 AS n, x11+x12 AS r1, x21+x22 AS r2, x11+x21 AS c1, x12+x22 AS c2 FROM c),
y AS (SELECT *, (abs(x11 - r1*c1/n) - least(0.5, abs(x11 - r1*c1/n)))^2/(r1*c1/n) + (abs(x12 - r1*c2/n) - least(0.5, abs(x12 - r1*c2/n)))^2/(r1*c2/n)
  + (abs(x21 - r2*c1/n) - least(0.5, abs(x21 - r2*c1/n)))^2/(r2*c1/n) + (abs(x22 - r2*c2/n) - least(0.5, abs(x22 - r2*c2/n)))^2/(r2*c2/n) AS chi FROM e)
SELECT 'Chi-square Test' AS test_type, round(chi, 6) AS statistic, round({pchi}, 6) AS p_value, {pchi} < 0.05 AS reject_null, round(sqrt(chi / n), 6) AS effect_size, {vl} AS effect_label,
  CAST(n AS BIGINT) AS n_obs, round(x11 / r1, 6) AS rate_a, round(x21 / r2, 6) AS rate_b, round((x21 / r2) / (x11 / r1), 6) AS risk_ratio FROM y"""


@query("t6_t13_gender_claim_2x2", GENDER_2x2.replace("{vl}", _vlabel("sqrt(chi / n)")).replace("{pchi}", _p_chi("chi", "1")))
def t6_t13_gender_claim_2x2(spark, sf):
    g = FE.add_gender(_risk(spark, sf)).where(F.col("Gender").isin("Male", "Female"))
    res = H.two_by_two(g, "Gender", "HasClaim", "Male", "Female", min_rows=100)
    return finish(res.select("test_type", "statistic", "p_value", "reject_null", "effect_size", "effect_label", "n_obs", "rate_a", "rate_b", "risk_ratio"))


SEV = RISK + """, s AS (SELECT G, ClaimSeverity AS x FROM risk WHERE HasClaim = 1 AND G IN ('Male', 'Female')),
m AS (SELECT count_if(G='Male') AS n1, avg(CASE WHEN G='Male' THEN x END) AS m1, var_samp(CASE WHEN G='Male' THEN x END) AS v1,
  count_if(G='Female') AS n2, avg(CASE WHEN G='Female' THEN x END) AS m2, var_samp(CASE WHEN G='Female' THEN x END) AS v2 FROM s)
"""


@query("t10_t11_gender_severity_t", SEV + f""", v AS (SELECT 'student' AS variant, (m1-m2)/sqrt(((n1-1)*v1+(n2-1)*v2)/(n1+n2-2)*(1.0/n1+1.0/n2)) AS t,
  CAST(n1+n2-2 AS DOUBLE) AS df FROM m UNION ALL
SELECT 'welch', (m1-m2)/sqrt(v1/n1+v2/n2), (v1/n1+v2/n2)^2/((v1/n1)^2/(n1-1)+(v2/n2)^2/(n2-1)) FROM m),
pp AS MATERIALIZED (SELECT *, {_p_t("t", "df")} AS p FROM v)
SELECT variant, round(t, 6) AS statistic, round(df, 4) AS dof, round(p, 6) AS p_value, p < 0.05 AS reject_null FROM pp""")
def t10_t11_gender_severity_t(spark, sf):
    g = FE.add_gender(_risk(spark, sf)).where((F.col("HasClaim") == 1) & F.col("Gender").isin("Male", "Female"))
    cols = ("statistic", "dof", "p_value", "reject_null")
    s = H.t_test(g, "Gender", "ClaimSeverity", "Male", "Female", welch=False).select(F.lit("student").alias("variant"), *cols)
    w = H.t_test(g, "Gender", "ClaimSeverity", "Male", "Female", welch=True).select(F.lit("welch").alias("variant"), *cols)
    return finish(s.unionByName(w), {"dof": 4})


@query("t18_t19_t26_effect_sizes", SEV + f"""SELECT 'Male' AS group_a, 'Female' AS group_b, n1, n2, round(m1, 4) AS m1, round(m2, 4) AS m2, round(m1-m2, 4) AS mean_diff,
  round((m1-m2)/sqrt(((n1-1)*v1+(n2-1)*v2)/(n1+n2-2)), 6) AS cohens_d, {_dlabel('(m1-m2)/sqrt(((n1-1)*v1+(n2-1)*v2)/(n1+n2-2))')} AS effect_label,
  round((m1-m2)/sqrt((v1+v2)/2), 6) AS cohens_d_rms, round((m1-m2)*100.0/abs(m2), 6) AS relative_diff_pct FROM m""")
def t18_t19_t26_effect_sizes(spark, sf):
    g = FE.add_gender(_risk(spark, sf)).where((F.col("HasClaim") == 1) & F.col("Gender").isin("Male", "Female"))
    e = H.effect_size_table(g, "Gender", "ClaimSeverity", "Male", "Female")
    return finish(e.select("group_a", "group_b", "n1", "n2", "m1", "m2", "mean_diff", "cohens_d", "effect_label",
                           "cohens_d_rms", "relative_diff_pct"), {"m1": 4, "m2": 4, "mean_diff": 4})


@query("t22_t23_power_ci", None)
def t22_t23_power_ci(spark, sf):
    """Power at the pooled d and the 95 % CI of the mean difference (rows-only)."""
    g = FE.add_gender(_risk(spark, sf)).where((F.col("HasClaim") == 1) & F.col("Gender").isin("Male", "Female"))
    return finish(H.effect_size_table(g, "Gender", "ClaimSeverity", "Male", "Female"))


@query("t12_mann_whitney_gender", SEV + """, r AS (SELECT G, x, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS ar FROM s),
w AS (SELECT x, count(*) AS t FROM s GROUP BY x),
u AS (SELECT sum(CASE WHEN G='Male' THEN ar END) - count_if(G='Male') * (count_if(G='Male') + 1) / 2.0 AS u1,
  count_if(G='Male')::DOUBLE AS n1, count_if(G='Female')::DOUBLE AS n2, (SELECT sum(t*t*t - t) FROM w) AS tie FROM r),
z AS (SELECT *, greatest((greatest(u1, n1*n2 - u1) - n1*n2/2 - 0.5) / sqrt(n1*n2/12*((n1+n2+1) - tie/((n1+n2)*(n1+n2-1)))), 0) AS z FROM u),
pp AS MATERIALIZED (SELECT *, """ + _p_norm("z") + """ AS p FROM z)
SELECT round(u1, 4) AS statistic, CAST(n1 + n2 AS BIGINT) AS n_obs, round(tie, 1) AS tie_term, round(p, 6) AS p_value, p < 0.05 AS reject_null FROM pp""")
def t12_mann_whitney_gender(spark, sf):
    g = FE.add_gender(_risk(spark, sf)).where((F.col("HasClaim") == 1) & F.col("Gender").isin("Male", "Female"))
    m = H.mann_whitney(g, "Gender", "ClaimSeverity", "Male", "Female")
    # tie term re-derived from value counts for the report
    w = g.groupBy("ClaimSeverity").agg(F.count(F.lit(1)).cast("double").alias("t")) \
         .agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("tie_term"))
    return finish(m.select("statistic", "n_obs", "p_value", "reject_null").crossJoin(F.broadcast(w)), {"statistic": 4, "tie_term": 1})


@query("t9_levene_gender_severity", RISK + """, s AS (SELECT G, ClaimSeverity AS x FROM risk WHERE HasClaim = 1 AND G IS NOT NULL),
md AS (SELECT G, median(x) AS med FROM s GROUP BY G), z AS (SELECT s.G, abs(x - med) AS z FROM s JOIN md USING (G)),
g AS (SELECT G, count(*) AS n, avg(z) AS m, var_samp(z) AS v FROM z GROUP BY G),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n*m)/sum(n) AS gm FROM g),
q AS (SELECT nn, k, sum(n*(m-gm)^2) AS ssb, sum((n-1)*v) AS ssw FROM g, t GROUP BY nn, k),
pp AS MATERIALIZED (SELECT *, """ + _p_f("(ssb/(k-1))/(ssw/(nn-k))", "k - 1", "nn - k") + """ AS p FROM q)
SELECT round((ssb/(k-1))/(ssw/(nn-k)), 6) AS statistic, CAST(k - 1 AS DOUBLE) AS dof, round(p, 6) AS p_value, p < 0.05 AS reject_null,
  CAST(nn AS BIGINT) AS n_obs FROM pp""")
def t9_levene_gender_severity(spark, sf):
    g = FE.add_gender(_risk(spark, sf)).where((F.col("HasClaim") == 1) & F.col("Gender").isNotNull())
    return finish(H.levene(g, "Gender", "ClaimSeverity").select("statistic", "dof", "p_value", "reject_null", "n_obs"))


@query("t8_shapiro_wilk_gender", None)
def t8_shapiro_wilk_gender(spark, sf):
    """Shapiro-Wilk W and p per gender on every claim value (rows-only; W is unit-tested)."""
    g = FE.add_gender(_risk(spark, sf)).where((F.col("HasClaim") == 1) & F.col("Gender").isNotNull())
    return finish(H.shapiro_wilk(g, "Gender", "ClaimSeverity"))


@query("t24_proportion_ci", RISK + """SELECT Province, sum(HasClaim) AS successes, count(*) AS n, round(sum(HasClaim) / count(*), 6) AS proportion,
  round(sum(HasClaim) / count(*) - 1.959963984540054 * sqrt((sum(HasClaim) / count(*)) * (1 - sum(HasClaim) / count(*)) / count(*)), 6) AS ci_low,
  round(sum(HasClaim) / count(*) + 1.959963984540054 * sqrt((sum(HasClaim) / count(*)) * (1 - sum(HasClaim) / count(*)) / count(*)), 6) AS ci_high
FROM risk WHERE Province IS NOT NULL GROUP BY Province""")
def t24_proportion_ci(spark, sf):
    r = _risk(spark, sf).where(F.col("Province").isNotNull())
    return finish(H.proportion_ci(r, "HasClaim", by="Province").withColumn("successes", F.col("successes").cast("bigint")))


@query("t14_t16_two_group_statistics", RISK + """, tops AS (
  SELECT 'Province' AS feature, Province AS v, count(*) AS n FROM risk WHERE Province IS NOT NULL GROUP BY 2 UNION ALL
  SELECT 'PostalCode', PostalCode, count(*) FROM risk WHERE PostalCode IS NOT NULL GROUP BY 2 UNION ALL
  SELECT 'Gender', Gender, count(*) FROM risk WHERE Gender IS NOT NULL GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS pos FROM tops)
SELECT feature, max(CASE WHEN pos = 1 THEN v END) AS group_a, max(CASE WHEN pos = 2 THEN v END) AS group_b,
  max(CASE WHEN pos = 1 THEN n END) AS n_a, max(CASE WHEN pos = 2 THEN n END) AS n_b FROM r WHERE pos <= 2 GROUP BY feature""")
def t14_t16_two_group_statistics(spark, sf):
    r = _risk(spark, sf)
    parts = []
    for f in ("Province", "PostalCode", "Gender"):
        t = B.two_largest_positions(r, f)
        at = lambda c, k: F.max(F.when(F.col("_pos") == k, F.col(c)))
        parts.append(t.agg(F.lit(f).alias("feature"), at(f, 1).alias("group_a"), at(f, 2).alias("group_b"),
                           at("n", 1).alias("n_a"), at("n", 2).alias("n_b")))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return finish(out)


def _two_largest_sql(feature: str) -> str:
    """Names and labels of the two largest groups (ties by key)."""
    return (f"(SELECT v, row_number() OVER (ORDER BY n DESC, v) AS pos FROM (SELECT CAST({feature} AS VARCHAR) AS v, count(*) AS n FROM risk "
            f"WHERE {feature} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 2))")


def _names_sql(feature: str) -> str:
    t = _two_largest_sql(feature)
    return f"(SELECT max(CASE WHEN pos = 1 THEN v END) FROM {t}) AS group_a, (SELECT max(CASE WHEN pos = 2 THEN v END) FROM {t}) AS group_b"


def _battery_sql(i: int, feature: str, metric: str) -> tuple[str, str]:
    """CTEs and the result row of one two-group test."""
    rows = f"r{i} AS (SELECT k.pos, r.{metric} AS x FROM risk r JOIN {_two_largest_sql(feature)} k ON CAST(r.{feature} AS VARCHAR) = k.v)"
    head = f"'Two-group test' AS test_name, {{kind}} AS test_type, '{feature}' AS feature, '{metric}' AS metric, {_names_sql(feature)}"
    tail = (f"CAST(2 AS BIGINT) AS n_groups, CAST(n1 + n2 AS BIGINT) AS n_obs, CASE WHEN n1 >= 30 AND n2 >= 30 THEN p < 0.05 END AS reject_null, "
            f"CASE WHEN n1 < 30 OR n2 < 30 THEN 'Insufficient Data' WHEN p < 0.05 THEN 'Reject H0' ELSE 'Fail to Reject H0' END AS decision")
    if metric == "HasClaim":
        cells = (f"c{i} AS (SELECT sum(CASE WHEN pos = 1 THEN x END)::DOUBLE AS a, count_if(pos = 1)::DOUBLE AS n1, "
                 f"sum(CASE WHEN pos = 2 THEN x END)::DOUBLE AS c, count_if(pos = 2)::DOUBLE AS n2 FROM r{i})")
        term = lambda o, r, col: f"pow(greatest(abs({o} - {r} * {col} / (n1 + n2)) - 0.5, 0), 2) / ({r} * {col} / (n1 + n2))"
        yes, no = "(a + c)", "(n1 + n2 - a - c)"
        chi = " + ".join([term("a", "n1", yes), term("(n1 - a)", "n1", no), term("c", "n2", yes), term("(n2 - c)", "n2", no)])
        stat = f"s{i} AS (SELECT *, {chi} AS s FROM c{i}), p{i} AS MATERIALIZED (SELECT *, sqrt(s / (n1 + n2)) AS e, {_p_chi('s', '1')} AS p FROM s{i})"
        kind, dof, label = "'Chi-square Test'", "1.0::DOUBLE", _vlabel("e")
    else:
        cells = (f"c{i} AS (SELECT count_if(pos = 1)::DOUBLE AS n1, avg(CASE WHEN pos = 1 THEN x END) AS m1, var_samp(CASE WHEN pos = 1 THEN x END) AS v1, "
                 f"count_if(pos = 2)::DOUBLE AS n2, avg(CASE WHEN pos = 2 THEN x END) AS m2, var_samp(CASE WHEN pos = 2 THEN x END) AS v2 FROM r{i} WHERE x IS NOT NULL)")
        stat = (f"s{i} AS (SELECT *, (m1 - m2) / sqrt(v1/n1 + v2/n2) AS s, (v1/n1 + v2/n2)^2 / ((v1/n1)^2/(n1-1) + (v2/n2)^2/(n2-1)) AS df FROM c{i}), "
                f"p{i} AS MATERIALIZED (SELECT *, (m1 - m2) / sqrt(((n1-1)*v1 + (n2-1)*v2) / (n1+n2-2)) AS e, {_p_t('s', 'df')} AS p FROM s{i})")
        kind, dof, label = "'Welch''s t-test'", "round(df, 4)", _dlabel("e")
    row = (f"SELECT {head.format(kind=kind)}, round(s, 5) AS statistic, {dof} AS dof, CASE WHEN n1 >= 30 AND n2 >= 30 THEN round(p, 6) END AS p_value, "
           f"round(e, 6) AS effect_size, {label} AS effect_label, {tail} FROM p{i}")
    return f"{rows}, {cells}, {stat}", row


_BATTERY = [_battery_sql(i, f, m) for i, (f, m) in enumerate(B.STANDARD_TESTS)]


@query("t15_t16_standard_battery", RISK + ", " + ", ".join(c for c, _ in _BATTERY) + "\n" + "\nUNION ALL\n".join(r for _, r in _BATTERY))
def t15_t16_standard_battery(spark, sf):
    """The four two-group decisions."""
    return finish(B.standard_battery(policy_view(spark, sf)), {"statistic": 5, "dof": 4})


def _balance_sql() -> str:
    parts, rows = [f"b AS (SELECT r.*, k.pos FROM risk r JOIN {_two_largest_sql('Province')} k ON r.Province = k.v)"], []
    for i, c in enumerate(("CoverType", "LegalType")):
        parts.append(f"g{i} AS (SELECT {c} AS v, count(*)::DOUBLE AS n, count_if(pos = 1)::DOUBLE AS a FROM b WHERE {c} IS NOT NULL GROUP BY 1), "
                     f"t{i} AS (SELECT sum(n) AS nn, sum(a) AS aa, count(*) AS k FROM g{i}), "
                     f"s{i} AS (SELECT k, sum(pow(a - n*aa/nn, 2) / (n*aa/nn) + pow(n - a - n*(nn-aa)/nn, 2) / (n*(nn-aa)/nn)) AS s FROM g{i}, t{i} GROUP BY k), "
                     f"p{i} AS MATERIALIZED (SELECT *, {_p_chi('s', 'k - 1')} AS p FROM s{i})")
        rows.append(f"SELECT 'Balance {c}' AS test_name, round(s, 5) AS statistic, round(p, 6) AS p_value, p < 0.05 AS reject_null FROM p{i}")
    for i, c in enumerate(("SumInsured", "kilowatts"), 2):
        parts.append(f"c{i} AS (SELECT count_if(pos = 1)::DOUBLE AS n1, avg(CASE WHEN pos = 1 THEN {c} END) AS m1, var_samp(CASE WHEN pos = 1 THEN {c} END) AS v1, "
                     f"count_if(pos = 2)::DOUBLE AS n2, avg(CASE WHEN pos = 2 THEN {c} END) AS m2, var_samp(CASE WHEN pos = 2 THEN {c} END) AS v2 FROM b WHERE {c} IS NOT NULL), "
                     f"s{i} AS (SELECT *, (m1 - m2) / sqrt(v1/n1 + v2/n2) AS s, (v1/n1 + v2/n2)^2 / ((v1/n1)^2/(n1-1) + (v2/n2)^2/(n2-1)) AS df FROM c{i}), "
                     f"p{i} AS MATERIALIZED (SELECT *, {_p_t('s', 'df')} AS p FROM s{i})")
        rows.append(f"SELECT 'Balance {c}', round(s, 5), round(p, 6), p < 0.05 FROM p{i}")
    every = " UNION ALL ".join(rows)
    return RISK + ", " + ", ".join(parts) + f", u AS ({every}) SELECT *, (SELECT bool_and(p_value >= 0.05) FROM u) AS all_clear FROM u"


@query("t17_balance_check", _balance_sql())
def t17_balance_check(spark, sf):
    """Covariate balance between the two largest provinces."""
    out = B.balance_check(_risk(spark, sf), "Province", ["CoverType", "LegalType"], ["SumInsured", "kilowatts"])
    return finish(out.select("test_name", "statistic", "p_value", "reject_null", "all_clear"), {"statistic": 5})


def _extremes_sql() -> str:
    parts = ["z AS (SELECT ZipPrefix, count(*) AS n, avg(HasClaim) AS c, avg(Margin) AS m, avg(Margin / NULLIF(TotalPremium, 0)) AS p FROM risk WHERE ZipPrefix <> '' GROUP BY 1)",
             "a AS (SELECT * FROM z WHERE n >= 50 ORDER BY n DESC, ZipPrefix LIMIT 20)", "b AS (SELECT * FROM z WHERE n >= 30 ORDER BY n DESC, ZipPrefix LIMIT 15)"]
    rows = []
    for test, metric, table, x in (("T4", "HasClaim", "a", "c"), ("T5", "Margin", "b", "m"), ("T5", "ProfitMarginPct", "b", "p")):
        for side, order in (("high", "DESC"), ("low", "ASC")):
            rows.append(f"SELECT * FROM (SELECT '{test}' AS test, '{metric}' AS metric, '{side}' AS side, row_number() OVER (ORDER BY {x} {order}, ZipPrefix) AS place, "
                        f"ZipPrefix, n, round({x}, 6) AS mean FROM {table} WHERE {x} IS NOT NULL) WHERE place <= 5")
    return RISK + ", " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


@query("t4_t5_zip_extremes", _extremes_sql())
def t4_t5_zip_extremes(spark, sf):
    """The five highest and lowest of the tested zip prefixes by claim frequency, margin and profit margin."""
    return finish(B.zip_extremes(policy_view(spark, sf)))


def _lists_sql() -> str:
    tests = [(f, m) for f in ("Province", "CoverType", "Gender") for m in ("HasClaim", "Margin", "ClaimSeverity")]
    found = [_battery_sql(100 + i, f, m) for i, (f, m) in enumerate(tests)]
    return RISK + ", " + ", ".join(c for c, _ in found) + "\n" + "\nUNION ALL\n".join(r for _, r in found)


@query("t15_test_lists", _lists_sql())
def t15_test_lists(spark, sf):
    """Three features with three metrics each, from one scan and two shuffles."""
    return finish(B.two_group_tests(_risk(spark, sf), ["Province", "CoverType", "Gender"], ["HasClaim", "Margin", "ClaimSeverity"]), {"statistic": 5, "dof": 4})



@query("t7_gender_severity_test", None)
def t7_gender_severity_test(spark, sf):
    """Assumption-checked gender severity test (rows-only)."""
    return finish(B.gender_severity(policy_view(spark, sf)))


@query("t27_full_battery", None)
def t27_full_battery(spark, sf):
    """Full battery with summary columns and the rejected count (rows-only)."""
    return finish(B.full_battery(policy_view(spark, sf)))
