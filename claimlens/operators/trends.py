"""Monthly series and trends.

Rows are grouped by ``date_trunc('month', ...)`` (a batch tumbling window); the
series is then one row per month, so ordinal positions and slopes run on that
aggregated table. Slopes are least-squares ``regr_slope`` aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.expr import flag, safe_div


def linear_trend(df: DataFrame, x: str, y: str, min_abs_r: float = 0.1) -> DataFrame:
    """Slope and intercept of y on x (pairwise-complete rows), reported only
    when |r| exceeds ``min_abs_r``."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    a = d.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
              F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias("r"),
              F.count(F.lit(1)).alias("n"))
    return a.select("n", "r", F.when(F.abs("r") > min_abs_r, F.col("slope")).alias("slope"),
                    F.when(F.abs("r") > min_abs_r, F.col("intercept")).alias("intercept"))


def monthly_series(df: DataFrame, *, month: str = "TransactionMonth", claims: str = "TotalClaims",
                   premium: str = "TotalPremium", id_col: str = "PolicyID", enriched: bool = True,
                   by: Sequence[str] = ()) -> DataFrame:
    """Per month (and optional groups): premium sum, claims sum,
    row count, loss ratio (sum / sum, 0 -> null); enriched adds the average claim
    per row and the claim frequency (rows with claims / rows)."""
    m = F.date_trunc("month", F.col(month)).alias("month")
    aggs = [F.sum(premium).alias("total_premium"), F.sum(claims).alias("total_claims"),
            F.count(id_col).alias("policy_count")]
    if enriched:
        aggs.append(F.count_if(F.col(claims) > 0).alias("_n_claims"))
    g = df.where(F.col(month).isNotNull()).groupBy(*by, m).agg(*aggs)
    g = g.withColumn("loss_ratio", safe_div("total_claims", "total_premium"))
    if enriched:
        g = (g.withColumn("average_claim", F.try_divide(F.col("total_claims"),
                                                          F.when(F.col("policy_count") > 0, F.col("policy_count")).otherwise(1)))
              .withColumn("claim_frequency", F.coalesce(F.try_divide(F.col("_n_claims"), F.col("policy_count")), F.lit(0.0)))
              .drop("_n_claims"))
    return g


def monthly_sums_by_group(df: DataFrame, group: str, cols: Sequence[str], month: str = "TransactionMonth") -> DataFrame:
    """Monthly sums of ``cols`` per ``group`` (null groups dropped) plus the
    month-over-month change of each sum within the group (``lag`` over the
    group's months — a window partitioned by group on the aggregated table)."""
    m = F.date_trunc("month", F.col(month)).alias("month")
    g = (df.where(F.col(group).isNotNull() & F.col(month).isNotNull()).groupBy(group, m)
           .agg(*[F.sum(c).alias(f"sum_{c}") for c in cols]))
    w = Window.partitionBy(group).orderBy("month")
    return g.withColumns({f"change_{c}": F.col(f"sum_{c}") - F.lag(f"sum_{c}").over(w) for c in cols})


def _positions(series: DataFrame, order: str = "month") -> DataFrame:
    # The series has one row per month (bounded by the calendar, not the data
    # volume); an ordered window over it is a single small task.
    return series.withColumn("pos", (F.row_number().over(Window.orderBy(order)) - 1).cast("double"))


def monthly_slopes(series: DataFrame) -> DataFrame:
    """Least-squares slope of premium, claims (vs month position, only when
    the series varies) and loss ratio (positions renumbered after dropping null
    ratios), as ``np.polyfit(range(n), y, 1)[0]``."""
    s = _positions(series)
    base = s.agg(F.count(F.lit(1)).alias("n_months"),
                 F.when(F.stddev_samp("total_premium") > 0, F.regr_slope("total_premium", "pos")).alias("premium_slope"),
                 F.when(F.stddev_samp("total_claims") > 0, F.regr_slope("total_claims", "pos")).alias("claims_slope"))
    lr = _positions(series.where(F.col("loss_ratio").isNotNull()).drop("pos") if "pos" in series.columns
                    else series.where(F.col("loss_ratio").isNotNull()))
    lrs = lr.agg(F.when((F.count(F.lit(1)) >= 2) & (F.stddev_samp("loss_ratio") > 0),
                        F.regr_slope("loss_ratio", "pos")).alias("loss_ratio_slope"))
    return base.crossJoin(lrs)


def recent_direction(series: DataFrame, value: str = "total_claims", window: int = 6) -> DataFrame:
    """Mean of the last ``window`` months vs the ``window`` before them (or all
    earlier months when fewer than 2*window exist) -> 'increasing'/'decreasing';
    first and last month, their values, and the number of months covered."""
    w = Window.orderBy(F.desc("month"))
    s = series.withColumn("_back", F.row_number().over(w))
    a = s.agg(F.count(F.lit(1)).alias("n_months"),
              F.avg(F.when(F.col("_back") <= window, F.col(value))).alias("recent_avg"),
              F.avg(F.when(F.col("_back") > window, F.when(F.col("_back") <= 2 * window, F.col(value)))).alias("_prev12"),
              F.avg(F.when(F.col("_back") > window, F.col(value))).alias("_prev_all"),
              F.min("month").alias("first_month"), F.max("month").alias("last_month"),
              F.min_by(value, "month").alias("first_value"), F.max_by(value, "month").alias("last_value"))
    prev = F.when(F.col("n_months") >= 2 * window, F.col("_prev12")).otherwise(F.col("_prev_all"))
    return (a.where(F.col("n_months") >= window)
             .withColumn("previous_avg", prev)
             .withColumn("direction", F.when(F.col("recent_avg") > F.col("previous_avg"), "increasing").otherwise("decreasing"))
             .drop("_prev12", "_prev_all"))


def claim_rate_by_month(df: DataFrame, month: str = "TransactionMonth", claims: str = "TotalClaims") -> DataFrame:
    """Claims-per-month over policies-per-month as ONE aggregation with
    ``count_if`` (no join of two grouped series)."""
    return (df.groupBy(F.date_trunc("month", F.col(month)).alias("month"))
              .agg(F.count_if(F.col(claims) > 0).alias("n_claims"), F.count(F.lit(1)).alias("n_policies"))
              .withColumn("claim_rate", F.col("n_claims") / F.col("n_policies")))


__all__ = ["linear_trend", "monthly_series", "monthly_sums_by_group", "monthly_slopes", "recent_direction",
           "claim_rate_by_month", "flag"]
