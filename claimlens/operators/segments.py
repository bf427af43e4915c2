"""Segment aggregates: loss ratio by dimension, profiles, rankings, top-k.

All are one hash aggregation with map-side partial aggregation, so a hot segment
(one province holding a third of the rows) is pre-combined on every executor
before the shuffle. Rankings run on the aggregated table, never on rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.expr import flag, safe_div

CLAIMS, PREMIUM, POLICY = "TotalClaims", "TotalPremium", "PolicyID"


def loss_ratio_by(df: DataFrame, dim: str | Sequence[str], *, claims: str = CLAIMS, premium: str = PREMIUM,
                  id_col: str = POLICY, min_count: int | None = None) -> DataFrame:
    """A1: per segment sum of claims, sum of premium, row count (``count(id_col)``,
    not distinct policies) and ``loss_ratio = sum claims / sum premium`` (null if
    the premium sum is 0). Null segment keys are dropped (pandas ``groupby``).
    ``min_count`` keeps segments with at least that many rows (HAVING).
    Ordered by loss ratio descending, key ascending."""
    dims = [dim] if isinstance(dim, str) else list(dim)
    keep = F.lit(True)
    for d in dims:
        keep = keep & F.col(d).isNotNull()
    g = (df.where(keep).groupBy(*dims)
           .agg(F.count(id_col).alias("policy_count"),
                F.sum(claims).alias("total_claims"),
                F.sum(premium).alias("total_premium")))
    if min_count is not None:
        g = g.where(F.col("policy_count") >= min_count)
    g = g.withColumn("loss_ratio", safe_div("total_claims", "total_premium"))
    return g.orderBy(F.desc_nulls_last("loss_ratio"), *dims)


def overall_loss_ratio(df: DataFrame, *, claims: str = CLAIMS, premium: str = PREMIUM,
                       row_ratio: str | None = "row_loss_ratio") -> DataFrame:
    """A2: ratio of sums (0 when the premium sum is not positive) and the mean of
    the row-level ratio (a different measure with the same name in the reference)."""
    aggs = [F.sum(claims).alias("total_claims"), F.sum(premium).alias("total_premium")]
    if row_ratio:
        aggs.append(F.avg(row_ratio).alias("mean_row_loss_ratio"))
    g = df.agg(*aggs)
    return g.withColumn("loss_ratio", F.when(F.col("total_premium") > 0,
                                             F.try_divide("total_claims", "total_premium")).otherwise(F.lit(0.0)))


def portfolio_totals(df: DataFrame, *, claims: str = CLAIMS, premium: str = PREMIUM,
                     row_ratio: str | None = "row_loss_ratio") -> DataFrame:
    """Premium sum and mean, claims sum and mean, claim frequency
    (share of rows with claims > 0 over all rows) and mean row loss ratio."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.sum(premium).alias("total_premium"), F.avg(premium).alias("avg_premium"),
            F.sum(claims).alias("total_claims"), F.avg(claims).alias("avg_claims"),
            F.avg(flag(F.col(claims) > 0).cast("double")).alias("claim_frequency")]
    if row_ratio:
        aggs.append(F.avg(row_ratio).alias("avg_loss_ratio"))
    return df.agg(*aggs)


def kpi_table(df: DataFrame, *, claims: str = CLAIMS, premium: str = PREMIUM,
              by: str | Sequence[str] | None = None) -> DataFrame:
    """A4: claim frequency, severity over claimants, mean margin and mean profit
    margin (margin / premium, null where premium is 0), long form (metric, value)."""
    has = F.col(claims) > 0
    margin = F.col(premium) - F.col(claims)
    pm = safe_div(margin, F.col(premium))
    dims = [] if by is None else ([by] if isinstance(by, str) else list(by))
    base = df.where(F.lit(True) if not dims else F.col(dims[0]).isNotNull()) if dims else df
    g = (base.groupBy(*dims) if dims else base).agg(
        F.avg(flag(has).cast("double")).alias("claim_frequency"),
        F.coalesce(F.avg(F.when(has, F.col(claims))), F.lit(0.0)).alias("claim_severity"),
        F.avg(margin).alias("average_margin"),
        F.avg(pm).alias("average_profit_margin"))
    return g.select(*dims, F.expr(
        "stack(4, 'Claim Frequency', claim_frequency, 'Claim Severity', claim_severity, "
        "'Average Margin', average_margin, 'Average Profit Margin', average_profit_margin) as (metric, value)"))


def cover_type_profile(df: DataFrame, dim: str = "CoverType", *, claims: str = CLAIMS, premium: str = PREMIUM,
                       row_ratio: str = "row_loss_ratio") -> DataFrame:
    """A5: count / sum / mean / sample std of premium, sum / mean of claims, mean row loss ratio."""
    return (df.where(F.col(dim).isNotNull()).groupBy(dim)
              .agg(F.count(premium).alias("premium_count"), F.sum(premium).alias("premium_sum"),
                   F.avg(premium).alias("premium_mean"), F.stddev_samp(premium).alias("premium_std"),
                   F.sum(claims).alias("claims_sum"), F.avg(claims).alias("claims_mean"),
                   F.avg(row_ratio).alias("mean_row_loss_ratio")))


def segment_rankings(df: DataFrame, dim: str, *, claims: str = CLAIMS, premium: str = PREMIUM,
                     min_rows: int = 10, top: int = 5) -> DataFrame:
    """Per category count / sum / mean of premium and claims, loss ratio; keep
    categories with >= ``min_rows`` premium values; return the top ``top`` of three
    rankings (loss ratio, total claims, total premium) in long form."""
    g = (df.where(F.col(dim).isNotNull()).groupBy(dim)
           .agg(F.count(premium).alias("premium_count"), F.sum(premium).alias("premium_sum"),
                F.avg(premium).alias("premium_mean"), F.sum(claims).alias("claims_sum"),
                F.avg(claims).alias("claims_mean"))
           .where(F.col("premium_count") >= min_rows)
           .withColumn("loss_ratio", safe_div("claims_sum", "premium_sum")))
    long = g.select(dim, "premium_count", "premium_sum", "claims_sum", "loss_ratio",
                    F.expr("stack(3, 'loss_ratio', loss_ratio, 'claims_sum', claims_sum, "
                           "'premium_sum', premium_sum) as (ranking, score)"))
    w = Window.partitionBy("ranking").orderBy(F.desc_nulls_last("score"), F.col(dim))
    return (long.withColumn("position", F.row_number().over(w).cast("bigint"))
                .where(F.col("position") <= top))


def profile_by(df: DataFrame, dim: str, *, claims: str = CLAIMS, premium: str = PREMIUM,
               row_ratio: str | None = "row_loss_ratio") -> DataFrame:
    """Segment profile (rows, premium sum/mean, claims sum/mean, loss ratio,
    claim frequency, mean row loss ratio). Used with an age-group column (P39)."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.sum(premium).alias("premium_sum"),
            F.avg(premium).alias("premium_mean"), F.sum(claims).alias("claims_sum"),
            F.avg(claims).alias("claims_mean"),
            F.avg(flag(F.col(claims) > 0).cast("double")).alias("claim_frequency")]
    if row_ratio:
        aggs.append(F.avg(row_ratio).alias("mean_row_loss_ratio"))
    return (df.where(F.col(dim).isNotNull()).groupBy(dim).agg(*aggs)
              .withColumn("loss_ratio", safe_div("claims_sum", "premium_sum")))


def total_by(df: DataFrame, dim: str, value: str = PREMIUM) -> DataFrame:
    """Sum of ``value`` per category, descending."""
    return (df.where(F.col(dim).isNotNull()).groupBy(dim).agg(F.sum(value).alias("total"))
              .orderBy(F.desc("total"), dim))


def mean_by_with_extremes(df: DataFrame, dim: str, value: str, top: int = 3) -> DataFrame:
    """Mean of ``value`` per category plus which categories are the maximum,
    the minimum and in the top ``top`` (bounded top-k tables, joined by a broadcast)."""
    g = df.where(F.col(dim).isNotNull()).groupBy(dim).agg(F.avg(value).alias("mean_value"))
    high = F.desc_nulls_last("mean_value"), F.col(dim)
    tops = g.orderBy(*high).limit(top).select(F.col(dim).alias("_top"))
    ends = (g.orderBy(*high).limit(1).select(F.col(dim).alias("_max"))
             .crossJoin(F.broadcast(g.orderBy(F.asc_nulls_last("mean_value"), F.col(dim)).limit(1).select(F.col(dim).alias("_min")))))
    return (g.join(F.broadcast(tops), F.col(dim) == F.col("_top"), "left").crossJoin(F.broadcast(ends))
             .select(dim, "mean_value", F.col("_top").isNotNull().alias("is_top"), (F.col(dim) == F.col("_max")).alias("is_max"),
                     (F.col(dim) == F.col("_min")).alias("is_min")))


def top_counts(df: DataFrame, dim: str, k: int = 5, where=None) -> DataFrame:
    """``value_counts().nlargest(k)``: count per category, ties by key."""
    base = df if where is None else df.where(where)
    return (base.where(F.col(dim).isNotNull()).groupBy(dim).agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.desc("n"), F.col(dim)).limit(k))


def top_n(df: DataFrame, by: str, n: int, *, ascending: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """L1 / L3 / L4: ordered head(n) with explicit tie keys (TakeOrdered, no full sort)."""
    o = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return df.orderBy(o, *[F.col(t) for t in ties]).limit(n)


def high_risk_segments(df: DataFrame, dims: Sequence[str], *, claims: str = CLAIMS, premium: str = PREMIUM,
                       threshold: float = 0.5, top: int = 3, min_rows: int = 10) -> DataFrame:
    """For each dimension, the top ``top`` categories by loss ratio whose ratio
    exceeds ``threshold``; long form (dimension, category, loss_ratio, position)."""
    parts = []
    for d in dims:
        g = (df.where(F.col(d).isNotNull()).groupBy(d)
               .agg(F.count(premium).alias("n_rows"), F.sum(claims).alias("claims_sum"),
                    F.sum(premium).alias("premium_sum"))
               .where(F.col("n_rows") >= min_rows)
               .select(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("category"), "n_rows",
                       safe_div("claims_sum", "premium_sum").alias("loss_ratio")))
        parts.append(g)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    w = Window.partitionBy("dimension").orderBy(F.desc_nulls_last("loss_ratio"), F.col("category"))
    return (u.withColumn("position", F.row_number().over(w).cast("bigint"))
             .where((F.col("position") <= top) & (F.col("loss_ratio") > threshold)))
