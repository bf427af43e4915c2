"""Distributed global ranks (W1, W3, W4, W5) without a single-partition window.

``row_number() OVER (ORDER BY x)`` with no PARTITION BY runs in one task. Here a
rank is built the way ``zipWithIndex`` does it, in DataFrame terms:

1. collapse the rows to distinct sort keys with a weight (a hash aggregate with a
   map-side combine, so a value or a group of copies holding a third of all rows
   becomes one weighted row before any shuffle);
2. range-partition the distinct keys (``repartitionByRange``), sort within
   partitions, and store the rows with their partition number by a reliable
   checkpoint: range bounds are sampled anew by every run of the exchange, so the
   two uses below must read the same stored rows;
3. an Arrow-batched ``mapInArrow`` pass computes, inside each partition, the
   weight of earlier rows of the same group (running sums over whole columns);
4. a per-partition summary (first group, last group, the last group's weight) gives
   each partition's carry-in by a running sum per group over two rows a partition;
   that table is bounded by the partition count, so broadcasting it is safe;
5. rank = carry-in + local offset + 1.

Exact copies are expanded back to rows at the end, dealt out in runs of ``CHUNK``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.session import materialize

CHUNK = 1 << 20
_W, _PID, _BEFORE, _FIRST = "_w", "_pid", "_local_before", "_is_first_grp"


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _local_prefix_fn(group_cols: list[str], weight: str):
    """Build the mapInArrow function: exclusive running weight within a group."""
    def changes(column) -> np.ndarray:
        """Whether each value differs from the one before it (nulls are equal)."""
        code = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        return code[1:] != code[:-1]

    def fn(batches):
        last_key, running, first_group = None, 0, True
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            w = b.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            new = np.zeros(n, dtype=bool)
            for g in group_cols:
                new[1:] |= changes(b.column(g))
            key = tuple(b.column(g)[0].as_py() for g in group_cols)
            goes_on = last_key is None or key == last_key
            new[0] = not goes_on
            sums = np.cumsum(w) - w
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            before = sums - sums[start]
            cut = int(np.argmax(new)) if new.any() else n
            if goes_on:
                before[:cut] += running
            is_first = np.zeros(n, dtype=bool)
            if first_group:
                is_first[:cut] = True
            first_group = first_group and cut == n
            last_key, running = tuple(b.column(g)[n - 1].as_py() for g in group_cols), int(before[-1] + w[-1])
            yield b.append_column(_BEFORE, pa.array(before, pa.int64())) \
                   .append_column(_FIRST, pa.array(is_first, pa.bool_()))
    return fn


def _ranged(d: DataFrame, by: list[str], order: list[str], num_partitions: int | None) -> DataFrame:
    """Stored rows in key order with their partition number."""
    keys = [F.col(k).asc_nulls_first() for k in by + order]
    n = _num_partitions(d, num_partitions)
    return materialize(d.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(_PID, F.spark_partition_id()))


def prefix_weights(d: DataFrame, by: Sequence[str], order: Sequence[str], weight: str = _W,
                   num_partitions: int | None = None, group_size: str | None = None) -> DataFrame:
    """For a table of DISTINCT (by, order) keys with a weight column, add
    ``_before`` = total weight of rows earlier in the same ``by`` group and, as
    ``group_size``, the group's total weight. Eager: the sorted rows are stored."""
    by, order = list(by), list(order)
    ranged = _ranged(d, by, order, num_partitions)
    g = F.struct(*[F.col(k) for k in by]) if by else F.struct(F.lit(0).alias("_g0"))
    ends = ranged.groupBy(_PID).agg(F.min(g).alias("first_g"), F.max(g).alias("last_g"))
    weights = ranged.groupBy(_PID, g.alias("_g")).agg(F.sum(weight).alias("_n"))
    last = weights.join(F.broadcast(ends), _PID).where(F.col("_g") == F.col("last_g")).select(_PID, F.col("last_g").alias("_g"), F.col("_n"), F.lit(1).alias("_kind"))
    asked = ends.select(_PID, F.col("first_g").alias("_g"), F.lit(0).cast("long").alias("_n"), F.lit(0).alias("_kind"))
    run = Window.partitionBy("_g").orderBy(_PID, "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = (asked.unionByName(last).withColumn("_carry", F.sum("_n").over(run)).where("_kind = 0").select(_PID, "_carry"))
    schema = T.StructType(ranged.schema.fields + [T.StructField(_BEFORE, T.LongType(), False),
                                                  T.StructField(_FIRST, T.BooleanType(), False)])
    local = ranged.mapInArrow(_local_prefix_fn(by, weight), schema)
    out = local.join(F.broadcast(carry), on=_PID, how="left")
    out = out.withColumn("_before", F.col(_BEFORE) + F.when(F.col(_FIRST), F.col("_carry")).otherwise(F.lit(0)))
    if group_size:
        sizes = weights.groupBy("_g").agg(F.sum("_n").alias(group_size))
        if by:
            sizes = sizes.select(*[F.col(f"_g.{k}").alias(f"_sz_{k}") for k in by], group_size)
            cond = None
            for k in by:
                c = F.col(k).eqNullSafe(F.col(f"_sz_{k}"))
                cond = c if cond is None else cond & c
            out = out.join(sizes, cond, "left").drop(*[f"_sz_{k}" for k in by])
        else:
            out = out.crossJoin(F.broadcast(sizes.select(group_size)))
    return out.drop(_PID, _BEFORE, _FIRST, "_carry")


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Per distinct non-null ``value`` (within ``by`` groups): its count ``n_value``,
    its first rank ``rank_lo`` and its average rank ``avg_rank`` (ties share the
    mean of their ranks, as scipy ``rankdata``), plus the group size ``n_group``."""
    by = list(by)
    keep = F.col(value).isNotNull()
    for g in by:
        keep = keep & F.col(g).isNotNull()
    d = df.where(keep).groupBy(*by, value).agg(F.count(F.lit(1)).alias(_W))
    p = prefix_weights(d, by, [value], _W, num_partitions, group_size="n_group")
    return p.select(*by, value, F.col(_W).alias("n_value"), (F.col("_before") + 1).alias("rank_lo"),
                    (F.col("_before") + (F.col(_W) + 1) / 2.0).alias("avg_rank"), "n_group")


def with_avg_rank(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "avg_rank") -> DataFrame:
    """W3 on rows: attach the average rank of ``value`` to every row (null value ->
    null rank). The join on the value is skew-split by AQE when one value is hot."""
    r = value_ranks(df, value, by).select(*by, value, F.col("avg_rank").alias(out))
    return df.join(r, on=list(by) + [value], how="left")


def row_number_global(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), out: str = "rn",
                      unique: bool = False, num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY by ORDER BY order)`` as a distributed
    job. ``order`` should end in a total order; fully identical rows are
    interchangeable and receive consecutive numbers. ``unique=True`` skips the
    copy-collapsing aggregate when the caller knows the rows are distinct.
    Also adds ``n_group`` (rows in the ``by`` group)."""
    by, order = list(by), list(order)
    cols = df.columns
    rest = [c for c in cols if c not in by and c not in order]
    if unique:
        d = df.withColumn(_W, F.lit(1).cast("long"))
    else:
        d = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(_W))
    p = prefix_weights(d, by, order + rest, _W, num_partitions, group_size="n_group")
    if unique:
        return p.withColumn(out, F.col("_before") + 1).drop(_W, "_before")
    # A large group of copies is dealt out in runs before it is expanded.
    runs = p.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(_W) - 1) / CHUNK))))
    e = (runs.repartition(F.xxhash64(*[F.col(c) for c in cols], F.col("_c")))
             .withColumn("_k", F.explode(F.sequence(F.col("_c") * CHUNK,
                                                    F.least(F.col("_c") * CHUNK + CHUNK, F.col(_W)) - 1))))
    return e.withColumn(out, F.col("_before") + F.col("_k") + 1).drop(_W, "_before", "_k", "_c")


def rank_quantile_bin(rn, n, q: int):
    """``pd.qcut(rank, q)`` bin index for rank ``rn`` (1-based) out of ``n``,
    in integer arithmetic: 0 for the first rank, else ceil((rn-1)*q/(n-1)) - 1."""
    rn, n = F.col(rn) if isinstance(rn, str) else rn, F.col(n) if isinstance(n, str) else n
    num = (rn - 1) * q + (n - 2)
    return F.when((rn <= 1) | (n <= 1), F.lit(0).cast("long")).otherwise(
        F.floor(num / (n - 1)).cast("long") - 1)
