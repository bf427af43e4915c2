"""Column -> Column helpers.

Everything here is a plain Spark expression (JVM side, inside whole-stage
codegen). No function builds or returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "to_double", "nan_to_null", "safe_div", "clip", "squish", "bool_from_text",
    "parse_timestamp", "amount_strip_commas", "amount_first_token", "amount_digits_only",
    "zip_prefix", "gender_norm", "fixed_bins", "threshold_label", "flag", "log1p_pos",
    "r", "TRUE_TOKENS", "FALSE_TOKENS", "norm_ppf",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN (and +-inf) -> null; Spark orders NaN above every number, pandas drops it."""
    # ``c`` stands here once: an expression named three times is worked out up to three times a row
    c = F.nanvl(col_(c).cast("double"), F.lit(None).cast("double"))
    return F.nullif(F.nullif(c, F.lit(float("inf"))), F.lit(float("-inf")))


def to_double(c) -> Column:
    """Numeric coercion with failure -> null (P3). ``try_cast`` never raises under ANSI."""
    c = col_(c)
    return nan_to_null(F.trim(c.cast("string")).try_cast("double"))


def safe_div(a, b, eps: float | None = None, zero_to_null: bool = True) -> Column:
    """a / b with the reference's guards.

    ``zero_to_null`` mirrors ``replace(0, nan)`` on the denominator; ``eps`` adds
    the reference's small constant. Division by zero yields null (never raises).
    """
    a, b = col_(a), col_(b)
    den = F.when(b == 0, F.lit(None).cast("double")).otherwise(b) if zero_to_null else b
    if eps is not None:
        den = den + F.lit(eps)
    return F.try_divide(a.cast("double"), den.cast("double"))


def clip(c, lower=None, upper=None) -> Column:
    """Null-safe clip (``greatest(null, 0)`` is 0 in Spark, pandas keeps null)."""
    c = col_(c)
    out = c
    if lower is not None:
        out = F.greatest(out, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        out = F.least(out, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def squish(c) -> Column:
    """Trim and collapse any whitespace run to one space (P1); null stays null."""
    return F.trim(F.regexp_replace(col_(c), r"\s+", " "))


# The truthy / falsy spellings mapped to booleans.
TRUE_TOKENS = ("yes", "y", "true", "1")
FALSE_TOKENS = ("no", "n", "false", "0")


def bool_from_text(c) -> Column:
    """Truthy/falsy text -> boolean, everything else -> null (P2). No trimming, as in the reference."""
    low = F.lower(col_(c).cast("string"))
    return (F.when(low.isin(*TRUE_TOKENS), F.lit(True))
             .when(low.isin(*FALSE_TOKENS), F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))


def parse_timestamp(c, formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/yyyy", "M/d/yyyy")) -> Column:
    """Date coercion, failure -> null (P4): first format that parses wins."""
    s = F.trim(col_(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])


def amount_strip_commas(c) -> Column:
    """Strip every comma and spaces, then cast; failure -> null."""
    s = F.replace(F.trim(col_(c).cast("string")), F.lit(","), F.lit(""))
    return nan_to_null(F.nullif(s, F.lit("")).try_cast("double"))


def amount_first_token(c) -> Column:
    """When the text has no '.', exactly one comma and <= 2 characters after it,
    the comma is a decimal comma; then the first match of
    ``[-+]?\\d*\\.\\d+|\\d+`` is taken (an integer token loses its sign)."""
    s = F.trim(col_(c).cast("string"))
    n_commas = F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))
    after = F.substring_index(s, ",", -1)
    is_dec = (~s.contains(".")) & (n_commas == 1) & (F.length(after) <= 2)
    dec = F.when(is_dec, F.replace(s, F.lit(","), F.lit("."))).otherwise(s)
    tok = F.regexp_extract(dec, r"[-+]?\d*\.\d+|\d+", 0)
    return F.nullif(tok, F.lit("")).try_cast("double")


def amount_digits_only(c) -> Column:
    """Keep digits, '.', '-' only; unparsable or null -> 0.0."""
    s = F.regexp_replace(col_(c).cast("string"), r"[^0-9.\-]", "")
    return F.coalesce(nan_to_null(F.nullif(s, F.lit("")).try_cast("double")), F.lit(0.0))


def zip_prefix(c) -> Column:
    """First run of 3-4 digits; no match -> null."""
    return F.nullif(F.regexp_extract(col_(c).cast("string"), r"([0-9]{3,4})", 1), F.lit(""))


# Gender spellings (P25), compared after upper-casing.
MALE_TOKENS = ("M", "MALE", "1")
FEMALE_TOKENS = ("F", "FEMALE", "0")


def gender_norm(c) -> Column:
    """P25: upper-cased map to Male / Female; anything else (incl. null) -> null."""
    u = F.upper(col_(c).cast("string"))
    return (F.when(u.isin(*MALE_TOKENS), F.lit("Male"))
             .when(u.isin(*FEMALE_TOKENS), F.lit("Female"))
             .otherwise(F.lit(None).cast("string")))


def fixed_bins(c, edges: Sequence[float], labels: Sequence[str] | None = None,
               include_lowest: bool = True, right: bool = True) -> Column:
    """Right-closed ``(e_i, e_{i+1}]`` bins as ``pd.cut``; outside -> null.

    ``include_lowest`` closes the first bin on the left too. ``labels`` default to
    the interval text.
    """
    c = col_(c)
    if labels is None:
        labels = [f"({edges[i]}, {edges[i + 1]}]" for i in range(len(edges) - 1)]
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        if right:
            cond = (c > lo) & (c <= hi)
            if i == 0 and include_lowest:
                cond = (c >= lo) & (c <= hi)
        else:
            cond = (c >= lo) & (c < hi)
            if i == len(edges) - 2 and include_lowest:
                cond = (c >= lo) & (c <= hi)
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr.otherwise(F.lit(None).cast("string"))


def threshold_label(c, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Effect-size style label: value < cuts[0] -> labels[0], ... else labels[-1]; null -> null."""
    c = col_(c)
    expr = None
    for cut, lab in zip(cuts, labels):
        expr = F.when(c < cut, F.lit(lab)) if expr is None else expr.when(c < cut, F.lit(lab))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(labels[-1])))


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 int (null -> 0, as pandas comparisons give False)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def log1p_pos(c) -> Column:
    """log1p of the value clipped at 0; null stays null."""
    c = col_(c)
    return F.log1p(clip(c, lower=0.0))


def r(c, digits: int = 6) -> Column:
    """Round a double for order-insensitive comparison with the SQL oracle."""
    return F.round(col_(c).cast("double"), digits)


# Coefficients of the rational approximation to the normal quantile
# (P. J. Acklam's algorithm, relative error < 1.2e-9).
_PPF_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
          1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_PPF_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
          6.680131188771972e+01, -1.328068155288572e+01)
_PPF_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
          -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_PPF_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
          3.754408661907416e+00)


def _poly(coefs, x):
    out = F.lit(coefs[0])
    for k in coefs[1:]:
        out = out * x + F.lit(k)
    return out


def norm_ppf(p) -> Column:
    """Standard-normal quantile as a column expression (no Python UDF)."""
    p = col_(p)
    lo, hi = 0.02425, 1 - 0.02425
    q_low = F.sqrt(-2 * F.log(p))
    low = _poly(_PPF_C, q_low) / (_poly(_PPF_D, q_low) * q_low + 1)
    q_hi = F.sqrt(-2 * F.log(1 - p))
    high = -_poly(_PPF_C, q_hi) / (_poly(_PPF_D, q_hi) * q_hi + 1)
    q = p - 0.5
    rr = q * q
    mid = _poly(_PPF_A, rr) * q / (_poly(_PPF_B, rr) * rr + 1)
    return F.when(p.isNull() | (p <= 0) | (p >= 1), F.lit(None).cast("double")) \
        .when(p < lo, low).when(p > hi, high).otherwise(mid)
