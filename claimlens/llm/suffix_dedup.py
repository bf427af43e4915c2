"""Suffix-array deduplication by threshold-bounded interval expansion.

Byte windows travel to buckets as super-k-mers (see ``windows``). In a bucket the strings are
laid end to end and all rotations of the result are sorted by prefix doubling, until every
rank is unique: an order that knows nothing of ``length``. On the
Burrows-Wheeler transform of that order, breadth-first backward extension refines suffix
intervals: the intervals of strings one byte longer are the intervals of the strings so far,
extended to the left by one byte through the transform's last-to-first mapping. A boundary that
appears at step ``l`` between neighbouring suffixes is a common prefix of ``l - 1`` bytes, so common
prefixes come out by increasing value, each once; the expansion stops at ``length`` (or when
no interval splits any more), and suffixes with no boundary between them share ``length`` bytes.

Defined results: a null text is empty; texts of fewer than ``length`` bytes lose nothing;
overlapping matches remove their union; rows of one id do not count as earlier documents of each
other; a null id comes after all others; an empty table gives an empty result; columns other
than id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimlens.llm.windows import HOT_BYTES, Chunk, Runs, smallest_ids

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of a cyclic text in the order of the rotations that begin there, by prefix doubling:
    ranks by 8 bytes, then by twice as many in every round, until all differ. Rotations of a
    periodic text that are equal are ordered by position."""
    n = len(text)
    ring = np.resize(text, n + 8).astype(np.uint64)
    word = ring
    for size in (1, 2, 4):  # eight bytes from each position, most significant first
        word = (word[:len(word) - size] << np.uint64(8 * size)) | word[size:]
    open_ = order = np.argsort(word[:n], kind="stable")
    key, place, size = word[order], np.arange(n), 8
    rank = np.empty(n, np.int64)
    while True:
        # the rank of a part is the first place that it takes
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[open_] = np.maximum.accumulate(np.where(new, place, 0))
        # Only positions that share their rank with another one still move.
        shared = ~new
        shared[:-1] |= ~new[1:]
        if size >= n or not shared.any():
            return order
        place, open_ = place[shared], open_[shared]
        behind = open_ + size
        behind[behind >= n] -= n
        key = rank[open_] * n + rank[behind]
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        order[place] = open_
        size *= 2


def interval_classes(text: np.ndarray, length: int) -> np.ndarray:
    """Class of the ``length`` bytes from each position of a cyclic text on."""
    n = len(text)
    order = suffix_order(text)
    row_of = np.empty(n, np.int32)
    row_of[order] = np.arange(n, dtype=np.int32)
    # Burrows-Wheeler transform: the byte before each suffix. Last-to-first: the row of the
    # suffix that starts with it; ``back`` is its inverse, from a row to that of the suffix one
    # byte shorter.
    bwt = text[order - 1]
    last_to_first = row_of[order - 1]
    back = np.empty(n, np.int32)
    back[last_to_first] = np.arange(n, dtype=np.int32)
    starts = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=256))[:-1]])
    bound = np.zeros(n, bool)
    bound[starts[np.unique(bwt)]] = True  # step 1: one interval for each byte
    open_rows = np.flatnonzero(~bound).astype(np.int32)
    above, below = back[open_rows - 1], back[open_rows]
    # Most neighbours stay neighbours one byte on: a boundary between those is read off, not found by counting.
    near = below - above == 1
    near_rows, near_below = open_rows[near], below[near]
    open_rows, above, below = open_rows[~near], above[~near], below[~near]
    for _ in range(1, length):
        # Extend every interval to the left: two neighbours with the same first byte part when
        # the suffixes behind that byte lie in different intervals.
        near_parts = bound[near_below]
        interval = np.cumsum(bound, dtype=np.int32) if len(open_rows) else bound
        parts = interval[above] != interval[below]
        if not (parts.any() or near_parts.any()):
            break
        bound[open_rows[parts]] = True
        bound[near_rows[near_parts]] = True
        stay, near_stay = ~parts, ~near_parts
        open_rows, above, below = open_rows[stay], above[stay], below[stay]
        near_rows, near_below = near_rows[near_stay], near_below[near_stay]
    interval = np.cumsum(bound, dtype=np.int32)
    return interval[row_of].astype(np.int64) - 1


def _byte_classes(length: int):
    def classes(strings: list[bytes]):
        sizes = np.array([len(s) for s in strings])
        cls = interval_classes(np.frombuffer(b"".join(strings), np.uint8), length)
        windows = sizes - length + 1
        first = np.cumsum(sizes) - sizes
        at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(first, windows)
        return cls[at], windows
    return classes


def _result(length: int):
    def digest(c: Chunk, r: Runs, covered: np.ndarray) -> pa.RecordBatch:
        rows = []
        for i, doc_id in enumerate(c.raw_ids):
            lo, hi = int(c.starts[i]), int(c.starts[i + 1])
            n, gone = hi - lo, covered[lo:hi]
            if c.skip[i] and n >= length:
                removed, spans, text = n, 1, b""
            elif removed := int(gone.sum()):
                spans = int(gone[0]) + int((gone[1:] > gone[:-1]).sum())
                text = c.text[lo:hi][~gone].tobytes()
            else:
                spans, text = 0, c.data[lo:hi]
            rows.append((doc_id, n, removed, spans, hashlib.sha256(text).hexdigest()))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*(pa.array(cols[j], pa.int64()) for j in range(4)), pa.array(cols[4], pa.string())],
                                          names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return digest


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, k: int = 20,
                 chunk_bytes: int = 2 << 20, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Remove every byte covered by ``length`` bytes that also start in a document of smaller id.
    One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return smallest_ids(docs, id_col, text_col, False, length, min(k, length), _byte_classes(length), _result(length), RESULT, chunk_bytes, hot_bytes)
