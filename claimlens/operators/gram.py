"""Gram matrices of designs that do not grow with the rows.

Tasks turn their rows into blocks of a numeric matrix Z and add up Z'Z, for each key; partial matrices travel
as one message per key and matrix row, and are summed as a stream, so neither a task nor the driver holds
more than ``keys x width ** 2`` numbers.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PARTS = "key int, i int, v binary"


def _rows(rows):
    k, i, v = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(i, pa.int32()), pa.array(v, pa.binary())], names=["key", "i", "v"])


def _partial(width: int, design: Callable):
    def run(batches):
        grams = {}
        for batch in batches:
            key, z = design(batch)
            for k in np.unique(key).tolist():
                own = z if len(z) and (key == k).all() else z[key == k]
                grams[k] = grams.get(k, 0.0) + own.T @ own
        for k, g in grams.items():
            yield _rows([(k, i, r.tobytes()) for i, r in enumerate(g)])
    return run


def _add_up(batches):
    """Sorted partial rows to their sums."""
    at, total = None, None
    for batch in batches:
        out = []
        for k, i, v in zip(*(batch.column(c).to_pylist() for c in ("key", "i", "v"))):
            if (k, i) == at:
                total = total + np.frombuffer(v)
            else:
                if at is not None:
                    out.append((*at, total.tobytes()))
                at, total = (k, i), np.frombuffer(v)
        yield _rows(out)
    if at is not None:
        yield _rows([(*at, total.tobytes())])


def grams(df: DataFrame, width: int, design: Callable) -> dict[int, np.ndarray]:
    """Z'Z by key. ``design(batch)`` gives the keys and the matrix of an Arrow batch."""
    parts = df.mapInArrow(_partial(width, design), PARTS)
    found = {}
    for r in parts.repartition("key", "i").sortWithinPartitions("key", "i").mapInArrow(_add_up, PARTS).collect():  # keys x width rows
        found.setdefault(r["key"], np.zeros((width, width)))[r["i"]] = np.frombuffer(r["v"])
    return found


__all__ = ["grams"]
