"""Benchmark decontamination by spaced-seed hashing.

A leak is an aligned stretch of ``span`` words of a benchmark item and a document (equal
offsets, A-Z lower-cased) in which at most ``mismatches`` words differ; an item shorter than
``span`` must occur whole and unchanged. Fixed masks of ``weight`` significant positions are chosen
so that any placing of the mismatches in a stretch leaves some mask, at some shift, untouched:
hashes of the masked words of items and documents then meet, and every leak is found. Around
each hit the whole item is laid against the document on that diagonal and the words are compared.

The benchmark is taken in blocks of at most ``block_words`` words; only a block is broadcast. One
block is the usual case; further ones are further passes over the documents.

Defined results: a null or empty text is clean; a null item text or one of fewer than
``min_words`` words (too short to be evidence) matches nothing; ties between items go to the
smallest item id; repeated rows are judged alike; a null item id is reported as null; empty
tables give clean documents or an empty result; other columns are not read by ``find_leaks``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import NO_ID, FOLD, mix, n_words, ragged, staged, word_hash, word_spans
from claimlens.llm.windows import canonical

FOUND = "contaminated boolean, n_items long, item_id long, matched long, span_start long, span_words long"
_BITS = 22


def covering_masks(span: int, mismatches: int, weight: int) -> list[tuple[int, ...]]:
    """Masks (offsets of significant positions, from 0) such that any ``mismatches`` positions of
    ``span`` leave one mask at one shift untouched; chosen greedily, so the same each time."""
    masks = [(0, *mid, m - 1) for m in range(weight, span + 1) for mid in combinations(range(1, m - 1), weight - 2)]
    left, chosen = set(combinations(range(span), mismatches)), []

    def free(mask):
        return {p for p in left if any(not {s + o for o in mask} & set(p) for s in range(span - mask[-1]))}

    while left:
        mask = max(masks, key=lambda m: (len(free(m)), -m[-1]))
        got = free(mask)
        if not got:
            raise ValueError("no mask of this weight can miss that many mismatches")
        chosen.append(mask)
        left -= got
    return chosen


def _seeds(codes: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    n = len(codes) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, salt + 1, np.uint64)
    for j, o in enumerate(mask):
        out = out + codes[o:o + n] * FOLD[j]
    return mix(out)


class Seeds:
    """Seeds of a block of benchmark items."""

    def __init__(self, items: list[tuple], span: int, mismatches: int, weight: int, min_words: int):
        self.span, self.mismatches = span, mismatches
        self.ids, codes, seeds, owner, place = [], [], [], [], []
        masks = covering_masks(span, mismatches, weight)
        for item_id, text in items:
            t = np.frombuffer(canonical((text or "").encode(), True, True), np.uint8)
            h = word_hash(t, *word_spans(t))
            if len(h) < min_words:
                continue
            own = [(i, m) for i, m in enumerate(masks)] if len(h) >= span else [(100 + len(h), tuple(range(len(h))))]
            for i, m in own:
                s = _seeds(h, m, i)
                seeds.append(s)
                owner.append(np.full(len(s), len(self.ids)))
                place.append(np.arange(len(s)))
            self.ids.append(item_id)
            codes.append(h)
        self.ptr = np.concatenate([[0], np.cumsum([len(h) for h in codes])]).astype(np.int64)
        self.codes = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        short = {len(h) for h in codes if len(h) < span}
        self.masks = [*enumerate(masks), *((100 + n, tuple(range(n))) for n in sorted(short))] if codes else []
        every = np.concatenate(seeds) if seeds else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.seed, first = np.unique(every[order], return_index=True)
        self.at = np.append(first, len(every)).astype(np.int64)
        self.owner = (np.concatenate(owner) if owner else np.empty(0, int))[order]
        self.place = (np.concatenate(place) if place else np.empty(0, int))[order]
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.seed & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True

    def search(self, texts: list[bytes]) -> list[tuple | None]:
        """For each document: (items, item id, matched words, first word, words) or None."""
        parts = [canonical(t, True, True) for t in texts]
        text = np.frombuffer(b"".join(parts), np.uint8)
        begin, end = word_spans(text)
        codes = word_hash(text, begin, end)
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        doc = np.searchsorted(starts, begin, side="right") - 1
        bound = np.searchsorted(begin, starts)
        hits = []
        for salt, mask in self.masks:
            s = _seeds(codes, mask, salt)
            at = np.flatnonzero(self.maybe[(s & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
            at = at[doc[at] == doc[at + mask[-1]]]
            where = np.searchsorted(self.seed, s[at])
            where[where == len(self.seed)] = 0
            ok = self.seed[where] == s[at]
            at, where = at[ok], where[ok]
            flat, own = ragged(self.at, where)
            hits.append(np.stack([doc[at[own]], self.owner[flat], at[own] - self.place[flat]]))
        out: list = [None] * len(texts)
        if not hits:
            return out
        best: dict = {}
        for d, item, diagonal in np.unique(np.concatenate(hits, axis=1), axis=1).T.tolist():
            got = self._verify(codes, int(bound[d]), int(bound[d + 1]), item, diagonal)
            if got:
                seen = best.setdefault(d, {})
                seen[item] = max(seen.get(item, (0,)), got, key=lambda g: g[0])
        for d, seen in best.items():
            item = min(seen, key=lambda i: (-seen[i][0], NO_ID if self.ids[i] is None else self.ids[i]))
            out[d] = (len({self.ids[i] for i in seen}), self.ids[item], seen[item][0], seen[item][1] - int(bound[d]), seen[item][2])
        return out

    def _verify(self, codes, lo, hi, item, diagonal):
        """Matched words, first word and length of the leaking stretches on a diagonal."""
        own = self.codes[self.ptr[item]:self.ptr[item + 1]]
        a, b = max(lo, diagonal), min(hi, diagonal + len(own))
        equal = codes[a:b] == own[a - diagonal:b - diagonal]
        n = min(self.span, len(own))
        most = self.mismatches if n == self.span else 0
        if len(equal) < n:
            return None
        total = np.concatenate([[0], np.cumsum(equal)])
        good = np.flatnonzero(total[n:] - total[:-n] >= n - most)
        if not len(good):
            return None
        inside = np.zeros(len(equal) + 1, np.int64)
        np.add.at(inside, good, 1)
        np.add.at(inside, good + n, -1)
        inside = np.cumsum(inside[:-1]) > 0
        at = np.flatnonzero(inside)
        return int(equal[inside].sum()), a + int(at[0]), int(at[-1] - at[0] + 1)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", span: int = 12, mismatches: int = 2,
               weight: int = 6, min_words: int = 5, block_words: int = 2_000_000, keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id``, whether it holds a leak, the number of items, the item with
    most matched words, those words and where they stand. ``keep`` returns these columns of ``docs``
    in place of the id (names that clash with the result's are the caller's to rename)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text"))
    words = items.agg(F.coalesce(F.sum(n_words(F.col("text"))), F.lit(0))).first()[0]
    blocks = words // block_words + 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    names = ["doc_id"] if keep is None else list(keep)
    state = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")) if keep is None else \
        docs.select(*keep, F.col(text_col).alias("_text"))
    state = state.select("*", F.lit(False).alias("contaminated"), F.lit(0).cast("long").alias("n_items"),
                         *(F.lit(None).cast("long").alias(c) for c in ("item_id", "matched", "span_start", "span_words")))
    at, width = len(names), len(names) + 1
    for b in range(blocks):
        found = [(r["id"], r["text"]) for r in items.where(block == b).collect()]
        table = spark.sparkContext.broadcast(Seeds(found, span, mismatches, weight, min_words))

        def run(batches, table=table):
            seeds = table.value
            for batch in batches:
                texts = batch.column(at)
                size = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in texts.cast(pa.binary())])
                lo = 0
                while lo < batch.num_rows:  # about 2 MB of text at a time
                    hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + (2 << 20), side="right")))
                    yield mark(batch.slice(lo, hi - lo), seeds)
                    lo = hi

        def mark(part, seeds):
            got = seeds.search([(t or "").encode() for t in part.column(at).to_pylist()])
            old = list(zip(*(part.column(width + j).to_pylist() for j in range(6))))
            new = []
            for o, g in zip(old, got):
                if g is None:
                    new.append(o)
                elif not o[0] or (-g[2], NO_ID if g[1] is None else g[1]) < (-o[3], NO_ID if o[2] is None else o[2]):
                    new.append((True, o[1] + g[0], *g[1:]))
                else:
                    new.append((True, o[1] + g[0], *o[2:]))
            cols = [pa.array(c, pa.bool_() if j == 0 else pa.int64()) for j, c in enumerate(zip(*new))]
            return pa.RecordBatch.from_arrays([*(part.column(j) for j in range(width)), *cols], names=part.schema.names)

        state = state.mapInArrow(run, state.schema)
        if b + 1 < blocks:
            state = staged(state, "leaks")
    return state.drop("_text")
