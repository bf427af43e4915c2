"""Risk-based premium (M22) and premium by risk band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Loading ratios of the premium formula.
EXPENSE_RATIO = 0.15
PROFIT_MARGIN = 0.10
# The five risk profiles' claim probabilities, used as band upper bounds.
BAND_BOUNDS = [(0.0005, "Very Low Risk"), (0.001, "Low Risk"), (0.01, "Medium Risk"), (0.05, "High Risk")]
TOP_BAND = "Very High Risk"


def add_premium(df: DataFrame, p_claim: str = "p_claim", severity: str = "expected_severity",
                expense_ratio: float = EXPENSE_RATIO, profit_margin: float = PROFIT_MARGIN) -> DataFrame:
    """Pure premium = p * severity; + expenses; + profit; final premium and components."""
    pure = F.col(p_claim) * F.col(severity)
    with_exp = pure * (1 + expense_ratio)
    final = with_exp * (1 + profit_margin)
    return df.withColumns({"pure_premium": pure, "expense_loading": with_exp - pure,
                           "profit_margin_amount": final - with_exp, "final_premium": final})


def risk_band(p_claim) -> F.Column:
    """Band name by claim probability (upper bounds inclusive)."""
    c = F.col(p_claim) if isinstance(p_claim, str) else p_claim
    e = None
    for bound, name in BAND_BOUNDS:
        e = F.when(c <= bound, name) if e is None else e.when(c <= bound, name)
    return e.otherwise(TOP_BAND)


def segment_premiums(df: DataFrame, segment: Sequence[str], claims: str = "TotalClaims") -> DataFrame:
    """Per segment the claim probability (share of rows with claims) and the
    expected severity (mean claim of claimants, 0 when none), the premium
    components, and the risk band."""
    has = F.col(claims) > 0
    g = (df.where(F.col(segment[0]).isNotNull()).groupBy(*segment)
           .agg(F.count(F.lit(1)).alias("n_policies"), F.avg(has.cast("double")).alias("p_claim"),
                F.coalesce(F.avg(F.when(has, F.col(claims))), F.lit(0.0)).alias("expected_severity")))
    return add_premium(g).withColumn("risk_band", risk_band("p_claim"))


def premium_by_band(seg: DataFrame) -> DataFrame:
    """Policies, mean claim probability, severity and final premium per band (policy-weighted)."""
    w = F.col("n_policies")
    return seg.groupBy("risk_band").agg(
        F.sum(w).alias("n_policies"), F.count(F.lit(1)).alias("n_segments"),
        (F.sum(F.col("p_claim") * w) / F.sum(w)).alias("p_claim"),
        (F.sum(F.col("final_premium") * w) / F.sum(w)).alias("avg_final_premium"))
