"""Substring deduplication by super-k-mer partitioning.

Windows of ``length`` words travel as super-k-mers (see ``windows``): consecutive windows
that share a minimiser as one packed string, to the bucket of the minimiser. In the bucket
words become numbers and the windows are sorted exactly: ranks of runs of 1, 2, 4, ... words
are combined until runs have ``length`` words, so equal ranks are equal word sequences and no
hash decides.

Defined results: a null or empty text has no words and keeps the empty text; texts of fewer than
``length`` words lose nothing; rows of one id do not count as earlier documents of each other; a
null id comes after all others; an empty table gives an empty result; columns other than id
and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimlens.llm.windows import HOT_BYTES, Chunk, Runs, smallest_ids

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def sorted_windows(symbols: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` symbols from each position on (fewer at the end: by what is there
    and an end mark). Equal ranks are equal sequences."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    powers, size = {1: rank}, 1

    def joined(a, b, shift):
        later = np.zeros(len(a), np.int64)
        later[:max(len(a) - shift, 0)] = b[shift:]
        return np.unique(a * (int(later.max()) + 1) + later, return_inverse=True)[1].astype(np.int64) + 1

    while size * 2 <= length:
        powers[size * 2] = joined(powers[size], powers[size], size)
        size *= 2
    out, done = powers[size], size
    while done < length:
        size //= 2
        if done + size <= length:
            out = joined(out, powers[size], done)
            done += size
    return out


def _word_classes(length: int):
    def classes(strings: list[bytes]):
        numbers, flat, sizes = {}, [], []
        for s in strings:
            words = s.split(b" ")
            flat += [numbers.setdefault(w, len(numbers)) for w in words]
            sizes.append(len(words))
        sizes = np.array(sizes)
        rank = sorted_windows(np.array(flat, np.int64), length)
        first = np.cumsum(sizes) - sizes
        windows = sizes - length + 1
        at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(first, windows)
        return rank[at], windows
    return classes


def _result(length: int):
    def digest(c: Chunk, r: Runs, covered: np.ndarray) -> pa.RecordBatch:
        bound = np.searchsorted(r.begin, c.starts)
        rows = []
        keep = np.flatnonzero(~covered)
        for i, doc_id in enumerate(c.raw_ids):
            lo, hi = int(bound[i]), int(bound[i + 1])
            n = hi - lo
            if c.skip[i] and n >= length:
                text, removed = b"", n
            else:
                own = keep[np.searchsorted(keep, lo):np.searchsorted(keep, hi)]
                removed = n - len(own)
                if not removed:
                    text = c.data[r.begin[lo]:r.end[hi - 1]] if n else b""
                elif len(own):  # runs of kept words
                    cut = np.flatnonzero(np.diff(own) > 1)
                    text = b" ".join(c.data[r.begin[a]:r.end[b]] for a, b in zip(own[np.append(0, cut + 1)], own[np.append(cut, len(own) - 1)]))
                else:
                    text = b""
            rows.append((doc_id, n, removed, hashlib.sha256(text).hexdigest()))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                                          names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return digest


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, k: int = 10,
                    chunk_bytes: int = 2 << 20, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Remove every word covered by ``length`` consecutive words that also start in a document
    of smaller id. One row per document: ``doc_id, n_words, n_removed, kept_sha256``."""
    return smallest_ids(docs, id_col, text_col, True, length, min(k, length), _word_classes(length), _result(length), RESULT, chunk_bytes, hot_bytes)
