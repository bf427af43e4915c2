"""Cleaning, typing, repair, imputation, filters and set operations.

P1-P16, P18-P23, P45-P49, F1-F10, U1-U3, A19, A22. Scalars (medians, quantiles)
come from a one-row aggregate attached with ``crossJoin(broadcast(...))`` — one
row is a proven size bound — so every operator stays lazy and the plan keeps a
single scan per barrier. Group statistics (P47, F5) are stored and joined without a hint: AQE
broadcasts them only when the table is under the threshold, and splits hot keys otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions import expr as X
from claimlens.operators.quantiles import aggregate, median, quantile
from claimlens.session import joinable


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# ---------------------------------------------------------------- typing

def squish_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Trim and collapse whitespace in every (or the given) string column."""
    cols = string_columns(df) if cols is None else _present(df, cols)
    return df.withColumns({c: X.squish(c) for c in cols}) if cols else df


def to_boolean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Truthy / falsy text -> boolean, other text -> null."""
    cols = _present(df, cols)
    return df.withColumns({c: X.bool_from_text(c) for c in cols}) if cols else df


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric coercion to double, failure -> null."""
    cols = _present(df, cols)
    return df.withColumns({c: X.to_double(c) for c in cols}) if cols else df


def to_timestamp(df: DataFrame, cols: Sequence[str], formats: Sequence[str] | None = None) -> DataFrame:
    """Date coercion, failure -> null."""
    cols = _present(df, cols)
    kw = {} if formats is None else {"formats": formats}
    return df.withColumns({c: X.parse_timestamp(c, **kw) for c in cols}) if cols else df


def to_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Categories and identifiers stay strings (a category domain is a ``distinct``)."""
    cols = _present(df, cols)
    return df.withColumns({c: F.col(c).cast("string") for c in cols}) if cols else df


def category_domain(df: DataFrame, col: str) -> DataFrame:
    """P5: the set of categories of a column (nulls excluded)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


AMOUNT_PARSERS = {"strip_commas": X.amount_strip_commas, "first_token": X.amount_first_token,
                  "digits_only": X.amount_digits_only}


def parse_amounts(df: DataFrame, cols: Sequence[str], style: str = "strip_commas") -> DataFrame:
    """The three amount parsers of the reference as column expressions."""
    fn = AMOUNT_PARSERS[style]
    cols = _present(df, cols)
    return df.withColumns({c: fn(c) for c in cols}) if cols else df


def fill_amounts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Amounts coerced to double, null/NaN -> 0.0; an absent column is added as 0.0."""
    out = {}
    for c in cols:
        out[c] = F.coalesce(X.to_double(c), F.lit(0.0)) if c in df.columns else F.lit(0.0)
    return df.withColumns(out)


# ------------------------------------------------------------ raw schema typing

# The raw file's column groups and how each is typed.
RAW_BOOL = ["IsVATRegistered", "NewVehicle", "WrittenOff", "Rebuilt", "Converted", "CrossBorder"]
RAW_NUMERIC = ["RegistrationYear", "Cylinders", "cubiccapacity", "kilowatts", "NumberOfDoors",
               "CustomValueEstimate", "CapitalOutstanding", "NumberOfVehiclesInFleet", "SumInsured",
               "CalculatedPremiumPerTerm", "ExcessSelected", "TotalPremium", "TotalClaims"]
RAW_DATES = ["TransactionMonth", "VehicleIntroDate"]
RAW_IDS = ["UnderwrittenCoverID", "PolicyID", "PostalCode"]


def type_raw(df: DataFrame) -> DataFrame:
    """Typed projection of the all-string raw table (P1-P6 in one ``withColumns``)."""
    df = squish_strings(df)
    df = to_boolean(df, RAW_BOOL)
    df = to_numeric(df, RAW_NUMERIC)
    df = to_timestamp(df, RAW_DATES)
    return to_string(df, RAW_IDS)


# ------------------------------------------------------------ repair

def repair_counts(df: DataFrame, *, premium: str = "TotalPremium", claims: str = "TotalClaims",
                  reg_year: str = "RegistrationYear", current_year: int = 2026) -> DataFrame:
    """How many rows each repair rule will change, one aggregate pass, long form."""
    exprs = {}
    if premium in df.columns:
        exprs["negative_premium_fixed"] = F.count_if(F.col(premium) < 0)
    if claims in df.columns:
        exprs["negative_claims_fixed"] = F.count_if(F.col(claims) < 0)
    if reg_year in df.columns:
        exprs["future_registration_years_fixed"] = F.count_if(F.col(reg_year) > current_year)
    agg = df.agg(*[v.alias(k) for k, v in exprs.items()])
    stack = ", ".join(f"'{k}', `{k}`" for k in exprs)
    return agg.select(F.expr(f"stack({len(exprs)}, {stack}) as (rule, n_rows)"))


def repair_rules(df: DataFrame, *, premium: str = "TotalPremium", claims: str = "TotalClaims",
                 reg_year: str = "RegistrationYear", month: str = "TransactionMonth",
                 current_year: int = 2026) -> DataFrame:
    """abs(premium), claims clipped at 0, registration year capped at
    ``current_year`` (a parameter for reproducibility), VehicleAge = transaction
    year - registration year clipped to [0, 50]. Null stays null."""
    out = {}
    if premium in df.columns:
        out[premium] = F.abs(F.col(premium))
    if claims in df.columns:
        out[claims] = X.clip(claims, lower=0.0)
    if reg_year in df.columns:
        out[reg_year] = X.clip(reg_year, upper=current_year)
    df = df.withColumns(out) if out else df
    return add_vehicle_age(df, reg_year=reg_year, month=month)


def add_vehicle_age(df: DataFrame, *, reg_year: str = "RegistrationYear", month: str = "TransactionMonth",
                    out: str = "VehicleAge", upper: float | None = 50) -> DataFrame:
    """VehicleAge = year(month) - registration year, clipped to [0, upper]."""
    if reg_year not in df.columns or month not in df.columns:
        return df
    age = (F.year(month) - F.col(reg_year)).cast("double")
    return df.withColumn(out, X.clip(age, lower=0.0, upper=upper))


def add_vehicle_age_vs_max(df: DataFrame, *, reg_year: str = "RegistrationYear", month: str = "TransactionMonth",
                           out: str = "VehicleAge") -> DataFrame:
    """Age against the latest transaction year of the table (one-row
    broadcast aggregate), clipped [0, 50]; plus IsOldVehicle (> 10) and IsNewVehicle (< 3)."""
    ref = df.agg(F.max(F.year(month)).alias("_ref_year"))
    j = df.crossJoin(F.broadcast(ref))
    age = X.clip((F.col("_ref_year") - F.col(reg_year)).cast("double"), lower=0.0, upper=50.0)
    return (j.withColumn(out, age)
             .withColumns({"IsOldVehicle": X.flag(F.col(out) > 10), "IsNewVehicle": X.flag(F.col(out) < 3)})
             .drop("_ref_year"))


# ----------------------------------------------------------- derived

def add_row_loss_ratio(df: DataFrame, *, claims: str = "TotalClaims", premium: str = "TotalPremium",
                       out: str = "row_loss_ratio", eps: float | None = 1e-10) -> DataFrame:
    """Claims / (premium with 0 -> null, + eps), clipped to [0, 10]."""
    return df.withColumn(out, X.clip(X.safe_div(claims, premium, eps=eps), lower=0.0, upper=10.0))


def add_insurance_features(df: DataFrame, *, claims: str = "TotalClaims", premium: str = "TotalPremium",
                           per_term: str = "CalculatedPremiumPerTerm", sum_insured: str = "SumInsured",
                           log_cols: Sequence[str] = ("TotalPremium", "TotalClaims", "SumInsured",
                                                      "CalculatedPremiumPerTerm")) -> DataFrame:
    """LossRatio (row), PremiumRate (eps, zero not nulled), HasClaim,
    ClaimIndicator and ``Log_<col>`` = log1p(clip(col, 0))."""
    out = {}
    if claims in df.columns and premium in df.columns:
        out["LossRatio"] = X.clip(X.safe_div(claims, premium, eps=1e-10), lower=0.0, upper=10.0)
    if per_term in df.columns and sum_insured in df.columns:
        out["PremiumRate"] = F.try_divide(F.col(per_term), F.col(sum_insured) + F.lit(1e-10))
    if claims in df.columns:
        out["HasClaim"] = X.flag(F.col(claims) > 0)
        out["ClaimIndicator"] = X.flag(F.col(claims) > 0)
    for c in _present(df, log_cols):
        out[f"Log_{c}"] = X.log1p_pos(c)
    return df.withColumns(out)


def add_risk_metrics(df: DataFrame, *, claims: str = "TotalClaims", premium: str = "TotalPremium") -> DataFrame:
    """HasClaim, ClaimSeverity (claim amount or 0), Margin and
    ProfitMarginPct (margin / premium, null where premium is 0)."""
    has = F.col(claims) > 0
    return df.withColumns({
        "HasClaim": X.flag(has),
        "ClaimSeverity": F.when(has, F.col(claims)).otherwise(F.lit(0.0)),
        "Margin": F.col(premium) - F.col(claims),
        "ProfitMarginPct": X.safe_div(F.col(premium) - F.col(claims), F.col(premium)),
    })


# ------------------------------------------------------- imputation

def sanitize_categories(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Trim; null, '' , 'nan' and 'None' -> 'Unknown'."""
    cols = string_columns(df) if cols is None else _present(df, cols)
    def fix(c):
        t = F.trim(F.col(c))
        return F.when(t.isNull() | t.isin("", "nan", "None", "NaN"), F.lit("Unknown")).otherwise(t)
    return df.withColumns({c: fix(c) for c in cols}) if cols else df


def fill_unknown(df: DataFrame, cols: Sequence[str] | None = None, value: str = "Unknown") -> DataFrame:
    """Fill nulls of categorical columns with 'Unknown'."""
    cols = string_columns(df) if cols is None else _present(df, cols)
    return df.fillna(value, subset=cols) if cols else df


def impute_median(df: DataFrame, cols: Sequence[str], approx: bool | None = None) -> DataFrame:
    """Global median of every listed column in ONE aggregate, attached as a
    one-row broadcast, then ``coalesce``. All-null columns stay null."""
    cols = _present(df, cols)
    if not cols:
        return df
    meds = aggregate(df, *[median(c, approx).alias(f"_med_{i}") for i, c in enumerate(cols)])
    j = df.crossJoin(F.broadcast(meds))
    return j.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{i}")) for i, c in enumerate(cols)}) \
            .drop(*[f"_med_{i}" for i in range(len(cols))])


def impute_group_median(df: DataFrame, col: str, by: str, approx: bool | None = None) -> DataFrame:
    """Fill ``col`` with the median of its ``by`` group
    (``groupby.transform('median')``). Null group keys get no fill."""
    meds = joinable(aggregate(df, median(col, approx).alias("_grp_med"), by=[by]).where(F.col(by).isNotNull()))
    j = df.join(meds, on=by, how="left")
    return j.withColumn(col, F.coalesce(F.col(col), F.col("_grp_med"))).drop("_grp_med").select(*df.columns)


def winsorize_upper(df: DataFrame, col: str, q: float, *, population=None,
                    approx: bool | None = None) -> DataFrame:
    """Clip ``col`` at its ``q`` quantile. The quantile is global (the reference
    computed it per 100k-row chunk). ``population`` (a Column predicate, e.g.
    ``TotalClaims > 0``) computes it over a sub-population so a zero-inflated
    column is not flattened; the flat variant is ``population=None``."""
    return winsorize_columns(df, [(col, q, population)], approx=approx)


def winsorize_columns(df: DataFrame, columns: Sequence[tuple], *, approx: bool | None = None) -> DataFrame:
    """P49 for several (column, quantile, population) at once: all caps in one selection."""
    value = lambda c, where: F.col(c) if where is None else F.when(where, F.col(c))
    caps = aggregate(df, *[quantile(value(c, where), q, approx).alias(f"_cap{i}") for i, (c, q, where) in enumerate(columns)])
    j = df.crossJoin(F.broadcast(caps))
    return j.withColumns({c: X.clip(c, upper=F.col(f"_cap{i}")) for i, (c, _, _) in enumerate(columns)}).drop(*[f"_cap{i}" for i in range(len(columns))])


def winsorize_report(df: DataFrame, col: str, q: float, *, population=None,
                     approx: bool | None = None) -> DataFrame:
    """P49 report: the cap, how many rows exceed it, their sum, and the sum of the clipped column."""
    return winsorize_reports(df, [(col, q, population)], approx=approx).drop("place", "column")


def winsorize_reports(df: DataFrame, columns: Sequence[tuple], *, approx: bool | None = None) -> DataFrame:
    """P49 report of several (column, quantile, population), numbered by ``place``: one selection of the caps, one pass
    over the rows."""
    value = lambda c, where: F.col(c) if where is None else F.when(where, F.col(c))
    caps = aggregate(df, *[quantile(value(c, where), q, approx).alias(f"_cap{i}") for i, (c, q, where) in enumerate(columns)])
    aggs = []
    for i, (c, _, _) in enumerate(columns):
        above = F.col(c) > F.col(f"_cap{i}")
        aggs += [F.first(f"_cap{i}").alias(f"cap{i}"), F.count_if(above).alias(f"n{i}"), F.sum(F.when(above, F.col(c))).alias(f"s{i}"),
                 F.sum(X.clip(F.col(c), upper=F.col(f"_cap{i}"))).alias(f"a{i}")]
    got = df.crossJoin(F.broadcast(caps)).agg(*aggs)
    return got.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), F.col(f"cap{i}").alias("cap"), F.col(f"n{i}").alias("n_capped"),
                 F.col(f"s{i}").cast("double").alias("sum_capped"), F.col(f"a{i}").cast("double").alias("sum_after"))
        for i, (c, _, _) in enumerate(columns)])).alias("r")).select("r.*")


# ---------------------------------------------------------------- filters

def claims_filter(df: DataFrame, mode: str = "none", claims: str = "TotalClaims") -> DataFrame:
    """none / positive (> 0) / non-zero (!= 0) / zero (== 0)."""
    c = F.col(claims)
    return {"none": df, "positive": df.where(c > 0), "non-zero": df.where(c != 0),
            "zero": df.where(c == 0)}[mode]


def extract_claims(df: DataFrame, *, claims: str = "TotalClaims", amount_cols: Sequence[str] = ("TotalClaims",
                   "TotalPremium", "SumInsured", "CalculatedPremiumPerTerm"), style: str = "strip_commas") -> DataFrame:
    """parse the amount columns (P7 by default) then keep claims > 0."""
    return parse_amounts(df, amount_cols, style).where(F.col(claims) > 0)


def valid_target(df: DataFrame, target: str = "TotalClaims") -> DataFrame:
    """keep rows whose target is non-null and >= 0."""
    return df.where(F.col(target).isNotNull() & (F.col(target) >= 0))


def invalid_target_count(df: DataFrame, target: str = "TotalClaims") -> DataFrame:
    """F3 count of removed rows (null or negative target)."""
    return df.agg(F.count_if(F.col(target).isNull() | (F.col(target) < 0)).alias("n_removed"))


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``dropna(subset=cols)``; NaN counts as missing as in pandas."""
    cond = F.lit(True)
    for c in cols:
        f = df.schema[c]
        cond = cond & F.col(c).isNotNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cond = cond & ~F.isnan(c)
    return df.where(cond)


def min_group_size(df: DataFrame, by: str | Sequence[str], n: int) -> DataFrame:
    """Keep rows whose group has at least ``n`` rows (count then semi join).
    The counts table has one row per group; it is broadcast by AQE only when it is small, and a hot
    group is split otherwise."""
    keys = [by] if isinstance(by, str) else list(by)
    ok = joinable(df.groupBy(*keys).count().where(F.col("count") >= n).drop("count"))
    return df.join(ok, on=keys, how="left_semi")


def keep_top_groups(df: DataFrame, by: str, k: int) -> DataFrame:
    """Keep rows of the ``k`` most frequent groups (ties by key). The top
    table has at most ``k`` rows, so broadcasting it is bounded."""
    top = (df.where(F.col(by).isNotNull()).groupBy(by).count()
             .orderBy(F.desc("count"), F.col(by)).limit(k).select(by))
    return df.join(F.broadcast(top), on=by, how="left_semi")


def drop_mostly_null(df: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, list[str]]:
    """drop columns whose null share exceeds ``threshold``. The output schema
    depends on the data, so this runs exactly one aggregate action."""
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"c{i}")
                   for i, c in enumerate(df.columns)]).first()
    drop = [c for i, c in enumerate(df.columns) if row[f"c{i}"] is not None and row[f"c{i}"] > threshold]
    return df.drop(*drop), drop


def drop_constant_columns(df: DataFrame, ids: Sequence[str] = ("PolicyID", "UnderwrittenCoverID"),
                          keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """F8: drop identifier columns and single-valued columns (null counts as a
    value: a column of one value plus nulls has two). One aggregate action."""
    cand = [c for c in df.columns if c not in ids and c not in keep]
    # One value (or none) and no nulls, or nulls only: min and max decide, without distinct counts.
    row = df.agg(*[F.min(F.col(f"`{c}`")).eqNullSafe(F.max(F.col(f"`{c}`"))).alias(f"e{i}") for i, c in enumerate(cand)],
                 *[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(cand)],
                 F.count(F.lit(1)).alias("n")).first()
    single = [c for i, c in enumerate(cand) if row[f"e{i}"] and row[f"v{i}"] in (0, row["n"])]
    drop = [c for c in ids if c in df.columns] + single
    return df.drop(*drop), drop


# The 23 essential columns of the claim extract.
ESSENTIAL_COLUMNS = ["PolicyID", "TransactionMonth", "Gender", "Country", "Province", "MainCrestaZone", "VehicleType",
                     "RegistrationYear", "make", "Model", "cubiccapacity", "kilowatts", "bodytype", "AlarmImmobiliser",
                     "TrackingDevice", "CapitalOutstanding", "NumberOfVehiclesInFleet", "SumInsured", "ExcessSelected",
                     "CoverType", "Product", "TotalPremium", "TotalClaims"]


def essential_projection(df: DataFrame, cols: Sequence[str] = ESSENTIAL_COLUMNS) -> DataFrame:
    """Project the essential columns that exist (column pruning reaches the scan)."""
    return df.select(*_present(df, cols))


# ---------------------------------------------------------------- set ops

def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name, missing columns filled with null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def _repeated_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose 128-bit fingerprint no other row has, and the others. Only fingerprints are shuffled to find
    them (16 bytes a row, pre-combined), and only rows with a twin are compared whole."""
    every = [F.col(f"`{c}`") for c in df.columns]
    prints = df.withColumns({"_print_a": F.xxhash64(F.lit(1), *every), "_print_b": F.xxhash64(F.lit(2), *every)})
    twins = joinable(prints.groupBy("_print_a", "_print_b").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    keys = ["_print_a", "_print_b"]
    return (prints.join(twins, keys, "left_anti").select(*every), prints.join(twins, keys, "left_semi").select(*every))


# Rows of at most so many columns are about as short as their fingerprints.
NARROW = 8


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicate rows (or duplicates on ``subset``; the kept row is
    then the one with the smallest full-row order, so the result is deterministic). Nulls equal nulls and NaN
    equals NaN. Rows of at most ``NARROW`` columns are shuffled once, whole."""
    if subset is None and len(df.columns) <= NARROW:
        return df.dropDuplicates()
    if subset is None:
        single, twins = _repeated_rows(df)
        return single.unionByName(twins.dropDuplicates())
    rest = [c for c in df.columns if c not in subset]
    # min over a struct is an ordinary aggregate with a map-side partial step, so a
    # key holding a third of the rows is reduced on every executor before the shuffle.
    g = df.groupBy(*subset).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_first"))
    return g.select(*subset, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def duplicate_stats(df: DataFrame, key: str = "PolicyID") -> DataFrame:
    """Duplicate full rows (count and %, rows beyond the first copy) and rows
    that share ``key`` with another row. Whole rows of more than ``NARROW`` columns are compared only where fingerprints
    repeat; all aggregates are pre-combined map-side, so a hot group of copies collapses before the shuffle."""
    twins = df if len(df.columns) <= NARROW else _repeated_rows(df)[1]
    full = (twins.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows")))
    by_key = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                .agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)), F.lit(0)).alias("rows_sharing_key"), F.sum("_n").alias("n_rows")))
    return (full.crossJoin(by_key)
                .withColumn("duplicate_pct", F.try_divide(F.col("duplicate_rows") * 100.0, F.col("n_rows"))))


def align_columns(df: DataFrame, columns: Sequence[str], defaults: dict | None = None,
                  default=0.0) -> DataFrame:
    """Add missing columns with a default, drop extra ones, reorder."""
    defaults = defaults or {}
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(defaults.get(c, default)).alias(c) for c in columns])
