"""Mixing sources to target weights by hash-threshold histograms, with built-in
functions only.

Every document gets a 60-bit hash of its id. A source's target is met by taking whole
passes over the source (the integer part of target / size) and, for the rest, all
documents whose hash lies below a threshold. The threshold is found without sorting:
sizes are summed by source and 12-bit hash bucket, the bucket that the remaining budget
falls into is found from the running sums, and only documents of that boundary bucket are
summed again by the next 12 bits. Budgets are nested: a larger target takes a superset.

Defined results: a null text has size 0 and is taken 0 times 0 words; a null source is a
source of its own, last in order; a null id hashes like the text ``null``; repeated rows
share a hash and are taken together; an empty table gives an empty result; other columns are
not read. A boundary group of equal hash is taken if that brings the source nearer its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import n_words, named_as, numbered, staged

LEVELS, DIGITS = 5, 3  # five levels of three hex digits (12 bits) each


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), limit: float = 3.0) -> DataFrame:
    """``source, source_size, target``: shares of the total by weight, capped at
    ``limit`` times a source's size, the excess shared again by weight until no source
    is above its cap. One row per source; sources fill their caps in order of cap /
    weight, so the fixed point of the resharing is read off running sums."""
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    choice = F.array(*[F.lit(float(w)) for w in weights])
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("_w", F.element_at(choice, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
           .withColumn("_cap", F.col("source_size") * limit))
    whole = Window.partitionBy()
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    per = (per.withColumn("_total", F.sum("source_size").over(whole).cast("double"))
           .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), zero))
           .withColumn("_wleft", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), zero))
           # while the level at a source's turn reaches its cap, it is full
           .withColumn("_full", F.col("_left") * F.col("_w") >= F.col("_cap") * F.col("_wleft")))
    # levels fall from the first open source on, so that source's level is the largest
    level = F.max(F.when(~F.col("_full"), F.col("_left") / F.col("_wleft"))).over(whole)
    return per.select("source", "source_size",
                      F.when(F.col("_full"), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("_w"))).alias("target"))


def _digits(level: int) -> Column:
    return F.conv(F.substring("_hash", 1 + DIGITS * level, DIGITS), 16, 10).cast("int")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[float, ...] = (5.0, 2.0, 1.0), limit: float = 3.0, seed: str = "mix") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, times, taken``.

    ``times`` is how often the mix takes the document (0 to ``limit``), ``taken`` the
    words. Only sums by (source, bucket) are shuffled, pre-aggregated on the map side, so a
    hot source costs at most 4,096 rows per task and level."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    sizes = staged(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"), F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, LEVELS * DIGITS).alias("_hash")), "sizes")
    targets = staged(source_targets(sizes, weights, limit).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long").alias("_passes")),
        "targets")
    # State of the search: budget left below the boundary bucket, the hash prefix of that bucket.
    state = targets.select("source", (F.col("target") - F.col("_passes") * F.col("source_size")).alias("_budget"), F.lit("").alias("_prefix"))
    state = state.where("_budget > 0")
    for level in range(LEVELS):
        inside = F.substring("_hash", 1, DIGITS * level) == F.col("_prefix") if level else F.lit(True)
        sums = (sizes.join(state.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")) & inside)
                .groupBy("source", "_prefix", "_budget", _digits(level).alias("_bucket")).agg(F.sum("size").alias("_n")))
        run = Window.partitionBy("source").orderBy("_bucket")
        sums = sums.withColumn("_upto", F.sum("_n").over(run))
        nxt = (sums.where(F.col("_upto") > F.col("_budget")).groupBy("source", "_prefix", "_budget")
               .agg(F.min(F.struct("_bucket", (F.col("_upto") - F.col("_n")).alias("_below"), "_n")).alias("_b"))
               .select("source", (F.col("_budget") - F.col("_b._below")).alias("_budget"),
                       F.concat("_prefix", F.lpad(F.lower(F.hex(F.col("_b._bucket").cast("long"))), DIGITS, "0")).alias("_prefix"),
                       F.col("_b._n").alias("_n")))
        state = staged(nxt, f"level{level}")
    # Rows of one 60-bit hash remain: take them if at least half of their size fits.
    cut = state.select("source", F.col("_prefix").alias("_cut"), (F.col("_budget") * 2 >= F.col("_n")).alias("_with"))
    plan = targets.join(cut.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_s"), "source_size", "target", "_passes", "_cut", "_with")
    extra = F.when(F.col("_cut").isNull(), F.col("target") > F.col("_passes") * F.col("source_size")).otherwise(
        (F.col("_hash") < F.col("_cut")) | ((F.col("_hash") == F.col("_cut")) & F.col("_with")))
    out = sizes.join(plan, F.col("source").eqNullSafe(F.col("_s")))
    times = F.col("_passes") + extra.cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``: a document is
    repeated as often as the mix takes it and left out where it is not taken. Rows of one id
    must agree on the source; otherwise the id's largest count holds."""
    plan = mix_sources(docs, id_col, text_col, source_col, **kw).groupBy("doc_id").agg(F.max("times").alias("times"))
    both = numbered(docs).join(plan.where("times > 0"), F.col(f"_{docs.columns.index(id_col)}").cast("long").eqNullSafe(F.col("doc_id")))
    return named_as(both.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))), docs)


def oracle_sql(weights: tuple[float, ...] = (5.0, 2.0, 1.0), limit: float = 3.0, seed: str = "mix") -> str:
    """The same mix in DuckDB, by sorting instead of histograms."""
    chars = LEVELS * DIGITS
    return rf"""
WITH d AS (SELECT doc_id, source,
                  CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, {chars}) AS h FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n, [{', '.join(str(float(w)) for w in weights)}][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % {len(weights)} + 1)::INT] AS w FROM d GROUP BY source),
c AS (SELECT *, {limit} * n AS cap, sum(n) OVER () AS total, sum(w) OVER () AS wall FROM s),
f AS (SELECT *, total - coalesce(sum(cap) OVER o, 0) AS rest, wall - coalesce(sum(w) OVER o, 0) AS wrest
      FROM c WINDOW o AS (ORDER BY cap / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, rest * w >= cap * wrest AS filled FROM f),
lv AS (SELECT max(rest / wrest) AS level FROM g WHERE NOT filled),
t AS (SELECT source, n, CASE WHEN filled THEN cap ELSE least(cap, level * w) END AS target FROM g LEFT JOIN lv ON true),
p AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS passes, target - CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END * n AS budget FROM t),
hs AS (SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
hc AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY h) AS upto FROM hs)
SELECT d.doc_id, d.size, CAST(p.n AS BIGINT) AS source_size, p.target,
       CAST(d.size * (p.passes + CASE WHEN p.budget > 0 AND (hc.upto <= p.budget OR (hc.upto - hc.n <= p.budget AND (p.budget - (hc.upto - hc.n)) * 2 >= hc.n)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source JOIN hc ON d.source IS NOT DISTINCT FROM hc.source AND d.h = hc.h"""


