"""Registered queries that check results against numerical integration and closed forms in SQL:
studentised range, noncentral t, Shapiro-Wilk, the composed gender test and the battery, guards, reuse of stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import features as FE
from claimlens.operators import hypothesis as H
from claimlens.plans import battery as B
from claimlens.plans.q_stats import RISK, SEV, _p_norm, _risk
from claimlens.plans.registry import ORACLES, finish, query
from claimlens.session import scratch_path, stored
from claimlens.sources import io as IO
from claimlens.sources.views import policy_cte, policy_view

CTE = policy_cte()


def _phi(x: str) -> str:
    """The normal distribution function by the five-term rational approximation of erf (error below 2e-7)."""
    # The coefficients of that approximation.
    t = f"(1 / (1 + 0.3275911 * abs({x}) / sqrt(2)))"
    poly = f"({t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))))"
    return f"(0.5 + 0.5 * sign({x}) * (1 - {poly} * exp(-({x}) * ({x}) / 2)))"


def _weights(i: str, n: int) -> str:
    return f"(CASE WHEN {i} = 0 OR {i} = {n} THEN 1 WHEN {i} % 2 = 1 THEN 4 ELSE 2 END)"


#: Density of s = sqrt(chi-square / nu).
_CHI = "exp(ln(2) + nu / 2 * ln(nu / 2) - lgamma(nu / 2) + (nu - 1) * ln(s) - nu * s * s / 2)"

TUKEY_SQL = RISK + f""", g AS (SELECT Province AS grp, count(*) AS n, avg(ClaimSeverity) AS m, var_samp(ClaimSeverity) AS v
  FROM risk WHERE HasClaim = 1 AND Province IS NOT NULL GROUP BY 1 HAVING count(*) >= 5),
t AS (SELECT (sum(n) - count(*))::DOUBLE AS nu, count(*) AS k, sum((n-1)*coalesce(v,0)) AS ssw FROM g),
p AS (SELECT a.grp AS group_a, b.grp AS group_b, abs(a.m - b.m) / sqrt(ssw/nu/2*(1.0/a.n + 1.0/b.n)) AS q, k, nu FROM g a JOIN g b ON a.grp < b.grp, t),
o AS (SELECT i, 1 + (i - 32) * 8 / (32 * sqrt(2 * nu)) AS s, 8 / (32 * sqrt(2 * nu)) AS hs, nu FROM t, range(65) AS r(i)),
f AS (SELECT s, {_weights('i', 64)} * hs / 3 * {_CHI} AS w FROM o WHERE s > 0),
z AS (SELECT -8 + j * 0.08 AS z, {_weights('j', 200)} * 0.08 / 3 * exp(-pow(-8 + j * 0.08, 2) / 2) / sqrt(2 * pi()) AS w FROM range(201) AS r(j)),
c AS (SELECT group_a, group_b, sum(f.w * k * z.w * pow(greatest({_phi('z.z')} - {_phi('(z.z - q * f.s)')}, 0), k - 1)) AS below FROM p, f, z GROUP BY 1, 2)
SELECT group_a, group_b, round(greatest(1 - below, 0), 4) AS p_value, 1 - below < 0.05 AS reject_null FROM c"""


@query("t3_tukey_p_values", TUKEY_SQL)
def t3_tukey_p_values(spark, sf):
    """P-value and decision of every pair of provinces; the SQL integrates the studentised range twice."""
    r = _risk(spark, sf).where(F.col("HasClaim") == 1)
    return finish(H.tukey_hsd(r, "Province", "ClaimSeverity").where(F.col("group_a").isNotNull()).select("group_a", "group_b", "p_value", "reject_null"), default=4)


POWER_SQL = SEV + f""", a AS (SELECT n1, n2, (n1 + n2 - 2)::DOUBLE AS nu, m1 - m2 AS diff, sqrt(v1 / n1 + v2 / n2) AS se,
  abs(m1 - m2) / sqrt(((n1-1)*v1 + (n2-1)*v2) / (n1 + n2 - 2)) * sqrt(n1 * n2 * 1.0 / (n1 + n2)) AS delta, 1.959963984540054 AS z FROM m),
b AS (SELECT *, z + (pow(z, 3) + z) / (4 * nu) + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / (96 * nu * nu)
  + (3 * pow(z, 7) + 19 * pow(z, 5) + 17 * pow(z, 3) - 15 * z) / (384 * pow(nu, 3)) AS crit FROM a),
o AS (SELECT b.*, i, 1 + (i - 100) * 8 / (100 * sqrt(2 * nu)) AS s, 8 / (100 * sqrt(2 * nu)) AS hs FROM b, range(201) AS r(i)),
c AS (SELECT any_value(diff) AS diff, any_value(se) AS se, any_value(crit) AS crit,
  sum({_weights('i', 200)} * hs / 3 * {_CHI} * ({_phi('(crit * s - delta)')} - {_phi('(-crit * s - delta)')})) AS inside FROM o WHERE s > 0)
SELECT round(1 - inside, 4) AS power, round(diff - crit * se, 3) AS ci_low, round(diff + crit * se, 3) AS ci_high FROM c"""


@query("t22_t23_power_and_interval", POWER_SQL)
def t22_t23_power_and_interval(spark, sf):
    """Power and interval of the gender severity difference; the SQL integrates the noncentral t and expands its quantile."""
    g = FE.add_gender(_risk(spark, sf)).where((F.col("HasClaim") == 1) & F.col("Gender").isin("Male", "Female"))
    e = H.effect_size_table(g, "Gender", "ClaimSeverity", "Male", "Female")
    return finish(e.select("power", "ci_low", "ci_high"), {"power": 4}, default=3)


def _normal_quantile(p: str) -> str:
    """The normal quantile by the rational approximation with a central and two tail branches (error below 2e-9)."""
    # The coefficients of that approximation, from the highest power down.
    a = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
    b = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)

    def horner(x, coefficients):
        out = f"{coefficients[0]!r}::DOUBLE"
        for v in coefficients[1:]:
            out = f"(({out}) * {x} + {v!r}::DOUBLE)"
        return out
    r, t = f"(({p} - 0.5) * ({p} - 0.5))", f"sqrt(-2 * ln(least({p}, 1 - {p})))"
    tail = f"({horner(t, c)}) / ({horner(t, d)})"
    return (f"(CASE WHEN {p} < 0.02425 THEN {tail} WHEN {p} > 0.97575 THEN -({tail}) "
            f"ELSE ({horner(r, a)}) * ({p} - 0.5) / ({horner(r, b)}) END)")


def _poly(u: str, constant: str, *coefficients: float) -> str:
    return constant + "".join(f" + {v!r}::DOUBLE * pow({u}, {i + 1})" for i, v in enumerate(coefficients))


# The published polynomials of the W statistic's two outer weights and of its distribution (n above 11).
_W_LAST, _W_NEXT = (0.221157, -0.147981, -2.07119, 4.434685, -2.706056), (0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SHAPIRO_SQL = SEV + f""", i AS (SELECT G, x, row_number() OVER (PARTITION BY G ORDER BY x) AS k, (count(*) OVER (PARTITION BY G))::DOUBLE AS n FROM s),
q AS (SELECT *, {_normal_quantile('((k - 0.375) / (n + 0.25))')} AS z FROM i),
e AS (SELECT G, n, sum(z * z) AS zz, max(CASE WHEN k = n THEN z END) AS zn, max(CASE WHEN k = n - 1 THEN z END) AS zm, max(CASE WHEN k = n THEN x END) AS xn,
  max(CASE WHEN k = n - 1 THEN x END) AS xm, max(CASE WHEN k = 1 THEN x END) AS x1, max(CASE WHEN k = 2 THEN x END) AS x2, sum(z * x) AS zx, var_samp(x) * (n - 1) AS ss FROM q GROUP BY G, n),
a AS (SELECT *, {_poly('(1 / sqrt(n))', 'zn / sqrt(zz)', *_W_LAST)} AS an, {_poly('(1 / sqrt(n))', 'zm / sqrt(zz)', *_W_NEXT)} AS am FROM e),
b AS (SELECT *, (zz - 2 * zn * zn - 2 * zm * zm) / (1 - 2 * an * an - 2 * am * am) AS phi FROM a),
w AS (SELECT G, n, pow((zx - zn * (xn - x1) - zm * (xm - x2)) / sqrt(phi) + an * (xn - x1) + am * (xm - x2), 2) / ss AS w FROM b),
y AS (SELECT *, (ln(1 - w) - (-1.5861 - 0.31082 * ln(n) - 0.083751 * pow(ln(n), 2) + 0.0038915 * pow(ln(n), 3))) / exp(-0.4803 - 0.082676 * ln(n) + 0.0030302 * pow(ln(n), 2)) AS z FROM w),
pp AS MATERIALIZED (SELECT *, CASE WHEN z >= 0 THEN {_p_norm('abs(z)')} / 2 ELSE 1 - {_p_norm('abs(z)')} / 2 END AS p FROM y)
SELECT G AS group_a, CAST(n AS BIGINT) AS n_obs, round(w, 5) AS statistic, round(p, 5) AS p_value, p < 0.05 AS reject_null FROM pp"""


@query("t8_shapiro_wilk_values", SHAPIRO_SQL)
def t8_shapiro_wilk_values(spark, sf):
    """W, p and decision for each gender on every claim value (more than 11 of them)."""
    g = FE.add_gender(_risk(spark, sf)).where((F.col("HasClaim") == 1) & F.col("Gender").isin("Male", "Female"))
    return finish(H.shapiro_wilk(g, "Gender", "ClaimSeverity").select("group_a", "n_obs", "statistic", "p_value", "reject_null"), default=5)


def _of(name: str) -> str:
    return f"({ORACLES[name]})"


GENDER_SQL = f"""WITH sw AS (SELECT bool_and(p_value > 0.05) AS normal FROM {_of('t8_shapiro_wilk_values')}), lev AS (SELECT p_value > 0.05 AS equal_var FROM {_of('t9_levene_gender_severity')}),
t AS (SELECT * FROM {_of('t10_t11_gender_severity_t')}), u AS (SELECT * FROM {_of('t12_mann_whitney_gender')}),
c AS (SELECT CASE WHEN normal AND equal_var THEN 'student' WHEN equal_var THEN 'welch' ELSE 'rank' END AS kind, normal, equal_var FROM sw, lev)
SELECT CASE kind WHEN 'student' THEN 'Independent t-test' WHEN 'welch' THEN 'Welch''s t-test' ELSE 'Mann-Whitney U test' END AS test_type, normal, equal_var,
  round(CASE WHEN kind = 'rank' THEN u.statistic ELSE (SELECT statistic FROM t WHERE variant = kind) END, 4) AS statistic,
  round(CASE WHEN kind = 'rank' THEN u.p_value ELSE (SELECT p_value FROM t WHERE variant = kind) END, 4) AS p_value,
  CASE WHEN kind = 'rank' THEN u.reject_null ELSE (SELECT reject_null FROM t WHERE variant = kind) END AS reject_null, u.n_obs FROM c, u"""


@query("t7_gender_severity_choice", GENDER_SQL)
def t7_gender_severity_choice(spark, sf):
    """The gender severity test that its assumption checks choose; the SQL composes those of the single tests."""
    out = B.gender_severity(policy_view(spark, sf))
    return finish(out.select("test_type", "normal", "equal_var", "statistic", "p_value", "reject_null", "n_obs"), default=4)


def _battery_rows() -> str:
    names = {"t1_province_claim_chi2": "Province Claim Frequency Differences", "t2_province_severity_anova": "Province Claim Severity Differences",
             "t4_zip_claim_chi2": "Zip Code Risk Differences", "t5_zip_margin_anova": "Zip Code Margin Differences",
             "t6_t13_gender_claim_2x2": "Gender Risk Differences", "t7_gender_severity_choice": "Gender Claim Severity Differences"}
    return " UNION ALL ".join(f"SELECT '{n}' AS test_name, round(statistic, 4) AS statistic, round(p_value, 4) AS p_value, reject_null, CAST(n_obs AS BIGINT) AS n_obs FROM {_of(k)}"
                              for k, n in names.items())


@query("t27_battery_summary", f"""WITH b AS ({_battery_rows()})
SELECT *, CASE WHEN reject_null THEN 'Significant' ELSE 'Not significant' END AS significance, CASE WHEN reject_null THEN 'Reject H0' ELSE 'Fail to reject H0' END AS conclusion,
  (SELECT count_if(reject_null) FROM b) AS n_rejected, (SELECT count(*) FROM b) AS n_tests FROM b""")
def t27_battery_summary(spark, sf):
    """The six tests of the battery with their summary; the SQL is the union of the single tests' own."""
    out = B.full_battery(policy_view(spark, sf))
    return finish(out.select("test_name", "statistic", "p_value", "reject_null", "n_obs", "significance", "conclusion", "n_rejected", "n_tests"), default=4)


@query("f9_guards", RISK + """SELECT 'chi-square' AS test, 'Insufficient data' AS test_type, CAST(0 AS BIGINT) AS n_groups, CAST(NULL AS BIGINT) AS n_obs, CAST(NULL AS DOUBLE) AS p_value FROM (SELECT count(*) FROM risk)
UNION ALL SELECT 'anova', 'Insufficient data', 0, 0, NULL FROM (SELECT count(*) FROM risk)
UNION ALL SELECT 't', 'Insufficient data', 2, count_if(Province IN ('', '?')), NULL FROM risk
UNION ALL SELECT '2x2', 'Insufficient data', 2, count_if(G IS NOT NULL), NULL FROM risk""")
def f9_guards(spark, sf):
    """Tests whose guard fails: groups too small, groups that do not exist, too few rows in all."""
    r = stored(_risk(spark, sf).select("Province", "Gender", "HasClaim", "Margin"), "risk")
    parts = {"chi-square": H.chi_square_k2(r, "Province", "HasClaim", min_count=10 ** 9), "anova": H.anova(r, "Province", "Margin", min_per_group=10 ** 9),
             "t": H.t_test(r, "Province", "Margin", "", "?"),
             "2x2": H.two_by_two(FE.add_gender(r), "Gender", "HasClaim", "Male", "Female", min_rows=10 ** 9)}
    out = None
    for name, p in parts.items():
        p = p.select(F.lit(name).alias("test"), "test_type", "n_groups", "n_obs", "p_value")
        out = p if out is None else out.unionByName(p)
    return finish(out)


@query("s6_reuse_of_stored_table", CTE + """SELECT CoverType, count(*) AS n, round(sum(TotalPremium), 2) AS total_premium FROM policy WHERE CoverSeq = 1 GROUP BY CoverType""")
def s6_reuse_of_stored_table(spark, sf):
    """A table that is there is read, not built again: the second builder would give other rows."""
    path, d = scratch_path(spark, "stored"), policy_view(spark, sf).select("CoverSeq", "CoverType", "TotalPremium")
    IO.read_or_build(spark, path, lambda: d.where("CoverSeq = 1"))
    again = IO.read_or_build(spark, path, lambda: d.where("CoverSeq <> 1"))
    return finish(again.groupBy("CoverType").agg(F.count(F.lit(1)).alias("n"), F.sum("TotalPremium").alias("total_premium")), default=2)
