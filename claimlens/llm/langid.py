"""Language identification: averaged hashed subword embeddings with a linear softmax.

Features are the 2- to 4-byte pieces of lower-cased words (a word keeps one boundary
mark on either side), hashed to ``buckets`` rows of an embedding table. A text is the
average of its pieces' embeddings; a linear softmax over the average gives the language.
Embeddings and softmax are trained together by stochastic gradient descent in numpy on a
bounded sample (``per_language`` rows of each language, a documented bound); a held-back fifth of
it calibrates the temperature of the softmax and the score below which a text is rejected.

A softmax spreads all its weight over the languages it knows, so texts in other languages, code and noise
score high. A second rejection does not depend on it: the share of a text's pieces that training rows have
(a table of one bit per piece hash, ``2 ** SEEN_BITS`` bits). Its threshold is half-way between the lowest share that right
answers on the held-back rows must keep and the middle share of the same rows with the letters of every word
reversed: text of the same letters in no language. Short texts are given the doubt of their few pieces.

As embedding, average and softmax layer are linear, prediction sums one row of per-bucket
class scores per piece; those scores (buckets x languages floats) are all that is broadcast.

Defined results: a text that is null or without any letter gets ``und``, score 0, and is
rejected; letters without a piece (a text of one letter) get the most common language's
score; labels that are null are not learned from; repeated rows are predicted alike; with no
labelled row every text is ``und``; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UND = "und"
SIZES = (2, 3, 4)
#: Pieces of these sizes are evidence of a known language; bits of their table.
SEEN_SIZES, SEEN_BITS = (3, 4), 20
# Lower-cased A-Z; bytes of a-z and of non-ASCII letters stay; all else is a boundary (0).
_FOLD = np.zeros(256, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def hashed(text: np.ndarray, starts: np.ndarray):
    """Hashed pieces of concatenated documents: for each piece size, the hash of every
    piece and its document. ``starts`` has one entry more than there are documents; every
    document ends in a boundary byte of its own."""
    t = _FOLD[text]
    edge = t == 0
    keep = ~(edge & np.concatenate([[False], edge[:-1]]))  # runs of boundaries become one
    doc_of_kept = np.cumsum(keep) - 1
    first = np.append(doc_of_kept[starts[:-1]], int(keep.sum()))
    t, edge = t[keep].astype(np.uint32), edge[keep]
    inner, doc = np.cumsum(edge), np.repeat(np.arange(len(starts) - 1), np.diff(first))
    for size in SIZES:
        n = len(t) - size + 1
        if n <= 0:
            continue
        h = np.full(n, size, np.uint32)
        for j in range(size):
            h = (h ^ t[j:j + n]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        # no boundary strictly inside a piece
        ok = (inner[size - 2:size - 2 + n] - inner[:n] == 0) if size > 2 else ~(edge[:n] & edge[1:n + 1])
        at = np.flatnonzero(ok)
        yield size, h[at], doc[at]


def pieces(text: np.ndarray, starts: np.ndarray, buckets: int):
    """Buckets of the pieces instead of their hashes."""
    for _, h, doc in hashed(text, starts):
        yield (h % np.uint32(buckets)).astype(np.int64), doc


def seen_slots(h: np.ndarray) -> np.ndarray:
    """Places of piece hashes in the table of pieces that training rows have."""
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - SEEN_BITS)).astype(np.int64)


def reversed_words(text: bytes) -> bytes:
    """Every run of letters back to front."""
    return re.sub(rb"[A-Za-z\x80-\xff]+", lambda m: m[0][::-1], text)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Documents behind one boundary byte each, and where they start."""
    text = np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)
    return text, np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])])


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def is_training(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the id as text, mod 4, is not 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2


class Model:
    """Labels, per-bucket class scores, bias, temperature, the rejection score, the bits of pieces that training
    rows have and the share of them below which a text is rejected."""

    def __init__(self, labels, scores, bias, temperature=1.0, reject_below=0.0, seen=None, seen_below=0.0):
        self.labels, self.scores, self.bias = list(labels), scores, bias
        self.temperature, self.reject_below = temperature, reject_below
        self.seen, self.seen_below = seen, seen_below

    def evidence(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class logits of each text, its share of seen pieces and how many pieces that is a share of."""
        text, starts = _joined(texts)
        total = np.zeros((len(texts), len(self.labels)))
        count, seen, asked = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts))
        for size, h, doc in hashed(text, starts):
            bucket = (h % np.uint32(len(self.scores))).astype(np.int64)
            count += np.bincount(doc, minlength=len(texts))
            for c in range(len(self.labels)):
                total[:, c] += np.bincount(doc, self.scores[bucket, c], minlength=len(texts))
            if size in SEEN_SIZES and self.seen is not None:
                asked += np.bincount(doc, minlength=len(texts))
                seen += np.bincount(doc, self.seen[seen_slots(h)], minlength=len(texts))
        return total / np.maximum(count, 1)[:, None] + self.bias, np.where(asked > 0, seen / np.maximum(asked, 1), 1.0), asked

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best label, its probability, and whether the text is rejected."""
        z, share, asked = self.evidence(texts)
        z = z / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        score = p[np.arange(len(best)), best]
        return best, score, (score < self.reject_below) | (share + 0.5 / np.sqrt(np.maximum(asked, 1)) < self.seen_below)


def _sgd(rows, labels, n_labels, buckets, dim, epochs, rate, seed):
    """Train embeddings and softmax; ``rows`` are (buckets, weights) of averaged texts."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out, bias = np.zeros((dim, n_labels), np.float32), np.zeros(n_labels, np.float32)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, w = rows[i]
            lr = rate * (1 - step / steps)
            step += 1
            x = w @ emb[at]
            z = x @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= lr * np.outer(x, p)
            bias -= lr * 0.1 * p
            emb[at] -= (lr * len(at) ** 0.5) * np.outer(w, back)
    return emb @ out, bias


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = 500, buckets: int = 1 << 14, dim: int = 16, epochs: int = 20, rate: float = 0.5,
          reject_share: float = 0.001, seed: int = 7) -> Model | None:
    """Fit on at most about ``per_language`` rows of each language, drawn by a hash of the
    id. The tasks reduce sampled texts to bucket counts, so at most
    ``languages x per_language x buckets`` numbers reach the driver.

    ``reject_share``: the share of right answers on the held-back fifth that may fall below what
    the thresholds are taken from."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    labels = sorted(counts)
    share = F.lit(0.0)
    for lang in labels:
        share = F.when(F.col(lang_col) == lang, per_language / counts[lang]).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.where(draw < share).select(F.col(lang_col).alias("lang"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def counted(values):
        at, n = np.unique(np.concatenate(values), return_counts=True)
        return at.astype("<i4").tobytes(), n.astype("<i4").tobytes()

    def slots(raw: bytes):
        return counted([seen_slots(h) for size, h, _ in hashed(*_joined([raw])) if size in SEEN_SIZES] or [np.empty(0, np.int64)])

    def count(batches):
        for batch in batches:
            for lang, i, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                raw, starts = _joined([text.encode()])
                found = [b for b, _ in pieces(raw, starts, buckets)]
                if found and sum(map(len, found)):
                    values = [*counted(found), *slots(text.encode()), *slots(reversed_words(text.encode()))]
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([i], pa.int64()), *(pa.array([v], pa.binary()) for v in values)],
                                                     names=["lang", "id", "at", "n", "slot", "slot_n", "back", "back_n"])

    got = sorted(sample.mapInArrow(count, "lang string, id long, at binary, n binary, slot binary, slot_n binary, back binary, back_n binary").collect(),
                 key=lambda r: (r["lang"], r["id"] or 0, r["at"]))
    rows, y = [], []
    for r in got:
        n = np.frombuffer(r["n"], "<i4").astype(np.float32)
        rows.append((np.frombuffer(r["at"], "<i4"), n / n.sum()))
        y.append(labels.index(r["lang"]))
    if not rows:
        return None
    held = np.arange(len(rows)) % 5 == 0
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
    scores, bias = _sgd([rows[i] for i in fit], [y[i] for i in fit], len(labels), buckets, dim, epochs, rate, seed)
    # Calibration on the held-back rows: the temperature of least log loss, then the threshold.
    check = np.flatnonzero(held)
    z = np.array([rows[i][1] @ scores[rows[i][0]] + bias for i in check], dtype=np.float64)
    t = np.array([y[i] for i in check])

    def probabilities(temperature):
        p = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
        return p / p.sum(axis=1, keepdims=True)

    grid = [2.0 ** (e / 4) for e in range(-8, 17)]
    temperature = min(grid, key=lambda u: -np.log(probabilities(u)[np.arange(len(t)), t] + 1e-12).mean())
    p = probabilities(temperature)
    hit = p.argmax(axis=1) == t
    right = np.sort(p.max(axis=1)[hit])
    floor = 1.0 / len(labels)
    # Half-way between the lowest score that must stay and an even guess.
    reject = (right[int(len(right) * reject_share)] + floor) / 2 if len(right) else floor
    # Pieces that two of the fitted rows have (one, if the rows are few).
    rows_with = np.zeros(1 << SEEN_BITS, np.int32)
    for i in fit:
        rows_with[np.frombuffer(got[i]["slot"], "<i4")] += 1
    seen = rows_with >= (2 if len(fit) >= 100 else 1)

    def shares(at, n):
        out = []
        for i in check[hit]:
            where, times = np.frombuffer(got[i][at], "<i4"), np.frombuffer(got[i][n], "<i4")
            if len(where):
                out.append(times[seen[where]].sum() / times.sum())
        return np.sort(np.array(out))

    real, back = shares("slot", "slot_n"), shares("back", "back_n")
    seen_below = 0.0
    if len(real):
        lowest = real[int(len(real) * reject_share)]
        seen_below = max(0.0, (lowest + min(np.median(back), lowest)) / 2)
    return Model(labels, scores.astype(np.float32), bias.astype(np.float64), temperature, float(reject) if len(labels) > 1 else 0.0, seen, float(seen_below))


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs[keep]`` plus ``lang_pred``, ``score`` and ``rejected``."""
    keep = docs.columns if keep is None else keep
    base = docs.select(*keep) if text_col in keep else docs.select(*keep, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = base.columns.index(text_col)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def label(part: pa.RecordBatch) -> pa.RecordBatch:
        m, texts = shared.value, part.column(at).to_pylist()
        told, score, bad = [UND] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        rows = [i for i, t in enumerate(texts) if _has_letter(t)] if m else []
        if rows:
            best, score[rows], bad[rows] = m.predict([texts[i].encode() for i in rows])
            for i, b in zip(rows, best):
                told[i] = m.labels[b]
        cols = [part.column(part.schema.get_field_index(c)) for c in keep]
        return pa.RecordBatch.from_arrays([*cols, pa.array(told, pa.string()), pa.array(score), pa.array(bad, pa.bool_())],
                                          names=[*keep, "lang_pred", "score", "rejected"])

    def run(batches):
        for batch in batches:
            sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < batch.num_rows:  # about 2 MB of text at a time
                base_size = sizes[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(sizes, base_size + (2 << 20), side="right")))
                yield label(batch.slice(lo, hi - lo))
                lo = hi

    return base.mapInArrow(run, schema)
