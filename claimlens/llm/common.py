"""Shared helpers of the subpackage: table paths, staged tables, numpy hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import scratch_path

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A null id sorts after every other id and comes back as null.
NO_ID = np.int64(2**63 - 1)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back: cuts
    lineage, survives lost executors and is computed once for several readers."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """Columns named by position (``_0``, ``_1``, ...), so that they clash with no other."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def named_as(rows: DataFrame, df: DataFrame) -> DataFrame:
    """The numbered columns of ``rows`` under their names in ``df``."""
    return rows.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(df.columns)])


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` for files that tasks write, as a URI."""
    path = scratch_path(spark, name)
    return path if path.split("/")[0].endswith(":") else f"file://{path}"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def n_words(c: Column) -> Column:
    """Number of words of a text column; null counts as no words."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def _constants(seed: int, n: int) -> np.ndarray:
    """Odd 64-bit constants, the same in every process."""
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BYTE_CODES = _constants(11, 256)
FOLD = _constants(13, 64)
_MUL_A, _MUL_B, _POW = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * _MUL_A
    h = (h ^ (h >> np.uint64(27))) * _MUL_B
    return h ^ (h >> np.uint64(31))


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive symbol codes, by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    done, out, power, level = 0, None, h, 0
    size = 1
    while True:
        if k & size:
            part = power[done:done + n]
            out = part.copy() if out is None else out * FOLD[32 + level] + part
            done += size
        if done == k:
            return mix(out)
        power = power[:len(power) - size] * FOLD[level] + power[size:]
        size, level = size * 2, level + 1


def window_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` consecutive values."""
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    size = 1
    while size * 2 <= w:
        h = np.minimum(h[:len(h) - size], h[size:])
        size *= 2
    return np.minimum(h[:n], h[w - size:w - size + n])


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of bytes in which words are followed by one space
    (a document without words is a lone space)."""
    sp = np.flatnonzero(text == 32)
    start = np.empty_like(sp)
    if len(sp):
        start[0] = 0
        start[1:] = sp[:-1] + 1
    full = sp > start
    return start[full], sp[full]


def word_hash(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit code of every word: position-weighted sum of byte codes, then mixed."""
    if not len(start):
        return np.empty(0, np.uint64)
    codes = BYTE_CODES.copy()
    codes[32] = 0
    reach = np.diff(np.append(start, len(text)))
    place = np.arange(len(text) - start[0]) - np.repeat(start - start[0], reach)
    powers = np.cumprod(np.full(int(place.max()) + 1, _POW))
    sums = np.add.reduceat(codes[text[start[0]:]] * powers[place], start - start[0])
    return mix(sums + (end - start).astype(np.uint64) * _MUL_A)


def ragged(ptr: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows ``pick`` of a ragged array with offsets ``ptr``: flat element indices
    and, for each, the position in ``pick``."""
    n = ptr[pick + 1] - ptr[pick]
    owner = np.repeat(np.arange(len(pick)), n)
    before = np.cumsum(n) - n
    return np.arange(int(n.sum())) - np.repeat(before, n) + np.repeat(ptr[pick], n), owner
