"""Exact quantiles without a value map in one task.

``F.percentile`` keeps a value -> count map per group in a single reduce task; for a column of
mostly distinct values that map grows with the table. Quantiles of whole columns are selected by refining
histograms instead: a double's bits, made order-preserving, are a 64-bit key; a first pass counts the
values of every column by the 16 highest bits, and the driver sees in which bucket each order statistic
lies; further passes count only the buckets that hold one, by the next 16 bits. A bucket also
carries its least and largest key, so an order statistic is known as soon as its bucket
has one value or it is the first or last one there: mostly after two passes, after four at the latest.
Nothing is sorted or stored; a pass sends at most 65,536 rows per column, or per bucket looked into, to the driver.
The two order statistics around a quantile are interpolated linearly (as pandas and SQL ``quantile_cont`` do).

Quantiles per group come from distributed prefix weights (:mod:`claimlens.operators.ranking`): groups may be as
many as rows, so their histograms have no bound.

``approx=True`` on a call uses the fixed-size ``percentile_approx`` sketch instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators import ranking as R

ACCURACY = 10000


@dataclass(frozen=True)
class Quantile:
    """An exact quantile (or several, as an array) in :func:`aggregate`."""

    value: Column
    q: tuple
    many: bool
    name: str = ""

    def alias(self, name: str) -> Quantile:
        return Quantile(self.value, self.q, self.many, name)


def quantile(c, q, approx: bool | None = None) -> Quantile | Column:
    """Quantile(s) of a column for :func:`aggregate`; ``q`` may be a float or a list."""
    c = F.col(c) if isinstance(c, str) else c
    many = isinstance(q, (list, tuple))
    qs = tuple(float(x) for x in (q if many else [q]))
    if approx:
        return F.percentile_approx(c, F.array(*[F.lit(x) for x in qs]) if many else F.lit(qs[0]), ACCURACY)
    return Quantile(c, qs, many)


def median(c, approx: bool | None = None) -> Quantile | Column:
    return quantile(c, 0.5, approx)


_LOW = np.int64(2**63 - 1)
#: Bits that a pass adds.
STEP = 16


def order_keys(values: np.ndarray) -> np.ndarray:
    """Doubles as 64-bit integers of the same order; NaN comes last, as in Spark."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ _LOW, bits)


def from_keys(keys: np.ndarray) -> np.ndarray:
    keys = np.asarray(keys, np.int64)
    return np.where(keys < 0, keys ^ _LOW, keys).view(np.float64)


def _counts(shift: int, inside: dict | None):
    """Rows to counts of each column's buckets, with their least and largest keys. ``inside``: for each column the
    buckets of the pass before that are looked into."""
    def fold(parts):
        bucket, n, lo, hi = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
        return bucket[first], np.add.reduceat(n[order], first), np.minimum.reduceat(lo[order], first), np.maximum.reduceat(hi[order], first)

    def run(batches):
        held = {}
        for batch in batches:
            for j, column in enumerate(batch.columns):
                if inside is not None and j not in inside:
                    continue
                keys = order_keys(column.drop_null().to_numpy(zero_copy_only=False))
                if inside is not None:
                    keys = keys[np.isin(keys >> np.int64(shift + STEP), inside[j])]
                if len(keys):
                    keys.sort()
                    bucket = keys >> np.int64(shift)
                    first = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
                    last = np.append(first[1:], len(keys))
                    parts = held.setdefault(j, [])
                    parts.append((bucket[first], last - first, keys[first], keys[last - 1]))
                    if len(parts) == 64:
                        held[j] = [fold(parts)]
        for j, parts in held.items():
            bucket, n, lo, hi = fold(parts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), j, np.int32)), pa.array(bucket), pa.array(n), pa.array(lo), pa.array(hi)],
                                             names=["c", "bucket", "n", "lo", "hi"])
    return run


def select_ranks(df: DataFrame, columns: Sequence[Column], ranks) -> tuple[list[dict], list[int]]:
    """Order statistics of columns by histogram refinement. ``ranks(j, n)`` names the wanted positions (from 0)
    among the n values of column j. Returns position -> value for each column, and the counts."""
    picked = df.select(*[c.cast("double").alias(f"v{j}") for j, c in enumerate(columns)])
    found, sizes = [{} for _ in columns], [0] * len(columns)
    pending, shift = None, 64 - STEP  # column -> bucket -> (values before it, positions)
    while shift >= 0 and (pending is None or pending):
        inside = None if pending is None else {j: np.array(sorted(b), np.int64) for j, b in pending.items()}
        used = picked if inside is None else picked.select(*[F.col(f"v{j}") if j in inside else F.lit(None).cast("double").alias(f"v{j}") for j in range(len(columns))])
        got = used.mapInArrow(_counts(shift, inside), "c int, bucket long, n long, lo long, hi long").groupBy("c", "bucket").agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
        col, bucket, n, lo, hi = (got.column(x).to_numpy() for x in ("c", "bucket", "n", "lo", "hi"))
        order = np.lexsort((bucket, col))
        col, bucket, n, lo, hi = (x[order] for x in (col, bucket, n, lo, hi))
        following = {}
        for j in range(len(columns)):
            rows = slice(*np.searchsorted(col, [j, j + 1]))
            own, size = bucket[rows], n[rows]
            if pending is None:
                sizes[j] = int(size.sum())
                asked = [(0, slice(None), sorted(set(ranks(j, sizes[j]))))] if sizes[j] else []
            else:
                asked = [(before, (own >> np.int64(STEP)) == b, at) for b, (before, at) in pending.get(j, {}).items()]
            for before, mask, positions in asked:
                inner, count, low, high = own[mask], size[mask], lo[rows][mask], hi[rows][mask]
                ends = before + np.cumsum(count)
                for position in positions:
                    i = int(np.searchsorted(ends, position, side="right"))
                    start = int(ends[i] - count[i])
                    if low[i] == high[i] or position == start:
                        found[j][position] = float(from_keys(low[i:i + 1])[0])
                    elif position == ends[i] - 1:
                        found[j][position] = float(from_keys(high[i:i + 1])[0])
                    else:
                        following.setdefault(j, {}).setdefault(int(inner[i]), (start, []))[1].append(position)
        pending, shift = following, shift - STEP
    return found, sizes


def column_quantiles(df: DataFrame, wanted: Sequence[Quantile]) -> DataFrame:
    """One row with the named quantiles of whole columns; null where a column has no value."""
    def around(j, n):
        return [p for q in wanted[j].q for p in (int(np.floor((n - 1) * q)), int(np.ceil((n - 1) * q)))]

    found, sizes = select_ranks(df, [w.value for w in wanted], around)
    row, fields = [], []
    for w, at, n in zip(wanted, found, sizes):
        out = []
        for q in w.q:
            place = (n - 1) * q
            lo, hi = int(np.floor(place)), int(np.ceil(place))
            out.append(at[lo] + (at[hi] - at[lo]) * (place - lo) if n else None)
        row.append(out if w.many else out[0])
        fields.append(T.StructField(w.name, T.ArrayType(T.DoubleType()) if w.many else T.DoubleType()))
    return df.sparkSession.createDataFrame([tuple(row)], T.StructType(fields))


def exact_quantiles(df: DataFrame, wanted: Sequence[Quantile], by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` group (one row in all without) with the named quantiles; null where a
    column has no value. Groups without any value are absent."""
    by = list(by)
    if not by:
        return column_quantiles(df, wanted)
    columns = {i: w.value for i, w in enumerate(wanted)}
    melted = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_c"), v.cast("double").alias("_v")) for i, v in columns.items()])).alias("_m"))
    melted = melted.select(*by, "_m._c", "_m._v").where("_v IS NOT NULL")
    weighted = melted.groupBy(*by, "_c", "_v").agg(F.count(F.lit(1)).alias("_w"))
    ranked = R.prefix_weights(weighted, [*by, "_c"], ["_v"], "_w", group_size="_size")
    out = []
    for i, w in enumerate(wanted):
        picked = []
        for q in w.q:
            at = (F.col("_size") - 1) * F.lit(q)
            lo, hi = F.floor(at), F.ceil(at)
            inside = lambda p: (F.col("_c") == i) & (F.col("_before") <= p) & (p < F.col("_before") + F.col("_w"))  # noqa: B023, E731
            a, b = F.max(F.when(inside(lo), F.col("_v"))), F.max(F.when(inside(hi), F.col("_v")))
            share = F.max(F.when(F.col("_c") == i, at - lo))
            picked.append(a + (b - a) * share)
        out.append((F.array(*picked) if w.many else picked[0]).alias(w.name))
    return ranked.groupBy(*by).agg(*out)


def aggregate(df: DataFrame, *items, by: Sequence[str] = ()) -> DataFrame:
    """``df.groupBy(by).agg(items)`` where items may be exact quantiles. Without ``by`` the quantiles
    are one row and join by a broadcast; groups join on their keys (nulls are a group)."""
    by = list(by)
    wanted = [x for x in items if isinstance(x, Quantile)]
    plain = [x for x in items if not isinstance(x, Quantile)]
    base = (df.groupBy(*by) if by else df).agg(*(plain or [F.count(F.lit(1)).alias("_rows")]))
    if not wanted:
        return base
    found = exact_quantiles(df, wanted, by)
    names = iter(base.columns[len(by):])
    order = by + [x.name if isinstance(x, Quantile) else next(names) for x in items]
    if not by:
        return base.crossJoin(F.broadcast(found)).select(*order)
    keys = [f"_key_{k}" for k in by]
    found = found.withColumnsRenamed(dict(zip(by, keys)))
    on = None
    for k, other in zip(by, keys):
        c = F.col(k).eqNullSafe(F.col(other))
        on = c if on is None else on & c
    return base.join(found, on, "left").select(*order)


__all__ = ["Quantile", "quantile", "median", "exact_quantiles", "column_quantiles", "select_ranks", "aggregate"]
