"""Repeated windows of documents: super-k-mers, minimisers and their exchange.

A window is ``length`` consecutive symbols (bytes or words) of one document. Its
minimiser is the smallest hash of the ``k``-symbol pieces in it; equal windows have equal
minimisers, and consecutive windows that share one form a super-k-mer, a packed string of all
their symbols. So equal windows meet if super-k-mers are dealt by minimiser.

Documents are packed into chunks (one row each: ids, lengths, compressed bytes), a staged
table. Three passes run over the chunks, each one a shuffle of compact messages:

1. ``_send_keys``: every chunk sends its distinct minimisers to their buckets (4 bytes each, one
   message per chunk and bucket, and one byte for how much text has it); a bucket answers with two
   bits each: does the minimiser occur in two documents, and is it hot, with more than
   ``hot_bytes`` of strings?
2. ``_send_strings``: of those that do, the chunk sends its distinct super-k-mers with the
   smallest document id that has each; a bucket finds the equal windows among them (by the
   operator's own method) and answers with the smallest id for each window.
3. ``_mark``: the chunk marks what windows of smaller documents cover.

The strings of a hot minimiser (at the edges of a passage that many documents share there is one
for each document) go to no single bucket. Their windows are dealt by window hash: first the hashes
alone, to learn which occur in a second chunk, then the symbols of those, which are compared.
A hot window costs one entry per chunk, however many documents of the chunk hold it; texts
with a copy of smaller id are settled by an aggregate beforehand and send no strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import (BYTE_CODES, NO_ID, mix, ragged, staged, window_hash, window_min, word_hash,
                                  word_spans)

CHUNK = "chunk long, ids array<bigint>, lens array<int>, prints array<binary>, raw long, blob binary"
MESSAGE = "dst long, kind int, src long, payload binary"
BLOB, SKIP, FLAGS, ANSWER, HASHES, HELD, WINDOWS = range(7)
#: Bytes of the strings of one minimiser that a bucket takes; also of the strings it compares at once.
HOT_BYTES = 1 << 20


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed message."""
    head = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unsqueeze(data: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    at, out = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(data, "<i8", len(kinds)), kinds):
        out.append(np.frombuffer(data, kind, int(n) // np.dtype(kind).itemsize, at))
        at += int(n)
    return out


def canonical(text: bytes, words: bool, lower: bool) -> bytes:
    """Bytes as they are packed: words followed by one space each, or the text itself."""
    if lower:
        text = text.lower()  # bytes: A-Z only
    return b" ".join(text.split()) + b" " if words else text  # bytes.split: ASCII white space


def pack(docs: DataFrame, id_col: str, text_col: str, words: bool, lower: bool = False,
         chunk_bytes: int = 2 << 20) -> DataFrame:
    """Staged chunks of about ``chunk_bytes`` of text (a longer document is a chunk of its own).
    ``prints`` are 128-bit digests of the packed documents. Raise ``chunk_bytes`` with the data: a
    pass sends one message per chunk and bucket."""

    def run(batches):
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 22
        ids, parts, size = [], [], 0

        def row():
            return pa.RecordBatch.from_arrays([
                pa.array([chunk], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(p) for p in parts]], pa.list_(pa.int32())),
                pa.array([[hashlib.blake2b(p, digest_size=16).digest() for p in parts]], pa.list_(pa.binary())),
                pa.array([size], pa.int64()),
                pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(parts))], pa.binary())],
                names=["chunk", "ids", "lens", "prints", "raw", "blob"])

        for batch in batches:
            texts = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                t = texts[i]
                parts.append(canonical(t.as_buffer().to_pybytes() if t.is_valid else b"", words, lower))
                ids.append(doc_id)
                size += len(parts[-1])
                if size >= chunk_bytes or len(ids) >= 1 << 20:
                    yield row()
                    chunk, ids, parts, size = chunk + 1, [], [], 0
        if ids:
            yield row()

    raw = docs.select(F.col(id_col).cast("long"), F.encode(F.col(text_col), "UTF-8"))
    return staged(raw.mapInArrow(run, CHUNK), "chunks")


def documents_of(chunks: DataFrame) -> DataFrame:
    """``chunk, row, doc_id, print`` of every packed document."""
    return chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "prints")).alias("row", "d")).select(
        "chunk", "row", F.col("d.ids").alias("doc_id"), F.col("d.prints").alias("print"))


def bucket_count(chunks: DataFrame, bucket_bytes: int = 16 << 20) -> int:
    """Buckets so that each holds what ``bucket_bytes`` of text send."""
    return int(chunks.agg(F.coalesce(F.sum("raw"), F.lit(0))).first()[0]) // bucket_bytes + 8


def inbox(chunks: DataFrame, *messages: DataFrame) -> DataFrame:
    """Chunks and the messages to them, by destination."""
    body = F.struct("ids", "lens")
    own = chunks.select(F.col("chunk").alias("dst"), F.lit(BLOB).alias("kind"), F.lit(0).cast("long").alias("src"),
                        F.col("blob").alias("payload"), body.alias("doc"))
    for m in messages:
        own = own.unionByName(m.withColumn("doc", F.lit(None).cast("struct<ids:array<bigint>,lens:array<int>>")))
    return own


class Chunk:
    """A packed chunk with the messages that it got, by kind and sender."""

    def __init__(self, mail: pa.Table):
        rows = mail.to_pylist()
        own = next(r for r in rows if r["kind"] == BLOB)
        self._open(own["dst"], own["doc"]["ids"], own["doc"]["lens"], own["payload"])
        self.mail = {(r["kind"], r["src"]): r["payload"] for r in rows if r["kind"] != BLOB}
        self.skip = np.zeros(len(self.ids), bool)
        if (SKIP, 0) in self.mail:
            self.skip[np.frombuffer(self.mail[SKIP, 0], "<i4")] = True

    @classmethod
    def of(cls, chunk: int, ids: list, lens: list, blob: bytes) -> Chunk:
        new = cls.__new__(cls)
        new._open(chunk, ids, lens, blob)
        return new

    def _open(self, chunk, ids, lens, blob):
        self.chunk, self.raw_ids = chunk, ids
        self.ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
        self.data = zstandard.ZstdDecompressor().decompress(blob)
        self.text = np.frombuffer(self.data, np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)


def skip_messages(docs: DataFrame, later: bool) -> DataFrame:
    """Messages that tell chunks which rows have a copy elsewhere. ``later``: only rows of a
    larger id than their smallest copy; else all but one row of each text."""
    row = F.struct(F.coalesce(F.col("doc_id"), F.lit(int(NO_ID))).alias("id"), F.col("chunk"), F.col("row"))
    first = docs.groupBy("print").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    both = docs.join(staged(first, "copied"), "print")  # staged, so that AQE can split a hot text
    other = row["id"] > F.col("first.id") if later else row != F.col("first")
    gone = both.where(other).groupBy("chunk").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def message(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([SKIP] * b.num_rows, pa.int32()), pa.array([0] * b.num_rows, pa.int64()),
                pa.array([np.array(r, "<i4").tobytes() for r in b.column(1).to_pylist()], pa.binary())],
                names=["dst", "kind", "src", "payload"])

    return gone.mapInArrow(message, MESSAGE)


def messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    cols = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["dst", "kind", "src", "payload"])


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of ``keys`` by (bucket, key), their buckets in that order, and the bounds of each
    run of one bucket."""
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((keys, bucket))
    bucket = bucket[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    return order, bucket, np.concatenate([[0], cuts, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)


def window_minimisers(codes: Callable, n: int, length: int, k: int, block: int = 1 << 15) -> np.ndarray:
    """Minimiser of each of the windows of ``n`` symbols, in blocks that stay in the CPU's cache.
    ``codes(lo, hi)`` gives the codes of a range of symbols."""
    out = np.empty(max(n - length + 1, 0), np.uint64)
    for lo in range(0, len(out), block):
        hi = min(lo + block, len(out))
        out[lo:hi] = window_min(window_hash(codes(lo, hi + length - 1), k), length - k + 1)
    return out


class Runs:
    """Super-k-mers of a chunk: minimiser, document, symbol range and byte range of each."""

    def __init__(self, c: Chunk, words: bool, length: int, k: int):
        if words:
            self.begin, self.end = word_spans(c.text)
            hashes = word_hash(c.text, self.begin, self.end)
            starts = np.searchsorted(self.begin, c.starts)
            self.n = len(hashes)
            low = window_minimisers(lambda lo, hi: hashes[lo:hi], self.n, length, k)
        else:
            starts, self.n = c.starts, len(c.text)
            low = window_minimisers(lambda lo, hi: BYTE_CODES[c.text[lo:hi]], self.n, length, k)
        # A run ends where the minimiser changes, a document begins, or its last window has begun.
        bounds = np.concatenate([starts[:-1], starts[1:] - length + 1])
        cuts = np.unique(np.concatenate([np.flatnonzero(low[1:] != low[:-1]) + 1, np.clip(bounds, 0, len(low)), [0, len(low)]]))
        head, stop = cuts[:-1], cuts[1:]
        doc = np.searchsorted(starts, head, side="right") - 1
        ok = head + length <= starts[doc + 1] if len(head) else np.empty(0, bool)
        self.first, self.doc = head[ok], doc[ok]
        self.windows = (stop - head)[ok]
        self.key = mix(low[self.first] + np.uint64(1))
        last = self.first + self.windows + length - 1  # symbol behind the last window
        self.lo = self.begin[self.first] if words else self.first
        self.hi = self.end[last - 1] if words else last


def _distinct_keys(c: Chunk, r: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct minimisers, whether two documents of the chunk have each, and the index of
    each run's minimiser."""
    keys, inverse = np.unique(r.key, return_inverse=True)
    lo = np.full(len(keys), len(c.ids))
    hi = np.full(len(keys), -1)
    np.minimum.at(lo, inverse, r.doc)
    np.maximum.at(hi, inverse, r.doc)
    return keys, lo != hi, inverse


def _weights(r: Runs, inverse: np.ndarray, n: int) -> np.ndarray:
    """Bytes of the runs of each minimiser, rounded up to a quarter power of two, as its exponent."""
    return np.ceil(4 * np.log2(np.bincount(inverse, r.hi - r.lo, n))).astype(np.uint8)


def _flags(c: Chunk, r: Runs, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs whose minimiser occurs in two documents, without and with those of hot minimisers."""
    keys, _, inverse = _distinct_keys(c, r)
    order, bucket, cuts = by_bucket(keys, buckets)
    told, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        bits = np.unpackbits(np.frombuffer(c.mail[FLAGS, int(bucket[lo])], np.uint8), count=2 * (hi - lo)).astype(bool)
        told[order[lo:hi]], hot[order[lo:hi]] = bits[:hi - lo], bits[hi - lo:]
    kept = told[inverse] & ~c.skip[r.doc]
    return np.flatnonzero(kept & ~hot[inverse]), np.flatnonzero(kept & hot[inverse])


def _strings(c: Chunk, r: Runs, kept: np.ndarray):
    """Distinct super-k-mers of the runs ``kept``: for each of them key and smallest id; the
    runs and their string; strings in the order they are sent."""
    seen, of_run = {}, np.empty(len(kept), np.int64)
    data = c.data
    for i, (lo, hi) in enumerate(zip(r.lo[kept].tolist(), r.hi[kept].tolist())):
        of_run[i] = seen.setdefault(data[lo:hi], len(seen))
    key, least = np.empty(len(seen), np.uint64), np.full(len(seen), NO_ID)
    key[of_run] = r.key[kept]
    np.minimum.at(least, of_run, c.ids[r.doc[kept]])
    return list(seen), key, least, kept, of_run


class Windows:
    """Distinct windows of strings with the smallest id of each, and the order they are sent in."""

    def __init__(self, strings: list[bytes], least: np.ndarray, words: bool, length: int, buckets: int):
        seen, flat, counts = {}, [], []
        for s in strings:
            if words:
                space = [-1, *(i for i, b in enumerate(s) if b == 32), len(s)]
                cut = [(space[i] + 1, space[i + length]) for i in range(len(space) - length)]
            else:
                cut = [(i, i + length) for i in range(len(s) - length + 1)]
            flat += [seen.setdefault(s[lo:hi], len(seen)) for lo, hi in cut]
            counts.append(len(cut))
        self.text, self.of_string = list(seen), np.array(flat, np.int64)
        self.ptr = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.least = np.full(len(seen), NO_ID)
        np.minimum.at(self.least, self.of_string, np.repeat(least, counts))
        self.hash = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=8).digest() for t in seen), "<u8")
        self.order, bucket, cuts = by_bucket(self.hash, buckets)
        self.parts = [(int(bucket[lo]), self.order[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:])]

    def repeated(self, mail: dict):
        """Bucket and windows that another chunk may have, by the answers to the hashes."""
        for b, own in self.parts:
            bits = np.unpackbits(np.frombuffer(mail[HASHES, b], np.uint8), count=len(own)).astype(bool)
            if bits.any():
                yield b, own[bits]


def smallest_ids(docs: DataFrame, id_col: str, text_col: str, words: bool, length: int, k: int,
                 classes: Callable, digest: Callable, schema: str, chunk_bytes: int = 2 << 20,
                 hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Run the three passes. ``classes(strings)`` numbers the windows of a list of packed strings
    so that equal windows get equal numbers (windows in order, strings in order);
    ``digest(chunk, runs, covered)`` makes the result batch from a mask of covered symbols."""
    chunks = pack(docs, id_col, text_col, words, chunk_bytes=chunk_bytes)
    buckets = bucket_count(chunks)

    def send_keys(batches):
        for batch in batches:
            for chunk, ids, lens, blob in zip(*(x.to_pylist() for x in batch.columns)):
                c = Chunk.of(chunk, ids, lens, blob)
                r = Runs(c, words, length, k)
                keys, several, inverse = _distinct_keys(c, r)
                weight = _weights(r, inverse, len(keys))
                order, bucket, cuts = by_bucket(keys, buckets)
                packed = (keys[order].astype(np.uint32) & np.uint32(0xFFFFFFFE)) | several[order].astype(np.uint32)
                yield messages([(int(bucket[lo]), FLAGS, chunk, packed[lo:hi].tobytes() + weight[order[lo:hi]].tobytes())
                                for lo, hi in zip(cuts[:-1], cuts[1:])])

    def answer_keys(mail: pa.Table) -> pa.Table:
        src, sent = mail["src"].to_pylist(), mail["payload"].to_pylist()
        got = [np.frombuffer(p, np.uint32, len(p) // 5) for p in sent]
        weight = np.concatenate([np.frombuffer(p, np.uint8, len(p) // 5, len(p) // 5 * 4) for p in sent])
        every = np.concatenate(got)
        _, inverse, count = np.unique(every >> np.uint32(1), return_inverse=True, return_counts=True)
        twice = count > 1
        np.logical_or.at(twice, inverse, (every & np.uint32(1)).astype(bool))
        hot = np.bincount(inverse, 2.0 ** (weight / 4)) > hot_bytes
        bits, hot, cuts = twice[inverse], hot[inverse], np.concatenate([[0], np.cumsum([len(g) for g in got])])
        me = mail["dst"][0].as_py()
        return pa.Table.from_batches([messages([(s, FLAGS, me, np.packbits(np.concatenate([bits[lo:hi], hot[lo:hi]])).tobytes())
                                                for s, lo, hi in zip(src, cuts[:-1], cuts[1:])])])

    def send_strings(mail: pa.Table) -> pa.Table:
        c = Chunk(mail)
        r = Runs(c, words, length, k)
        light, hot = _flags(c, r, buckets)
        text, key, least, _, _ = _strings(c, r, light)
        bucket = (key >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]]) if len(order) else [0]
        rows = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = order[lo:hi]
            part = [text[i] for i in own]
            rows.append((int(bucket[own[0]]), ANSWER, c.chunk, squeeze(
                key[own], least[own], np.array([len(p) for p in part], "<i4"), np.frombuffer(b"".join(part), np.uint8))))
        if len(hot):
            text, _, least, _, _ = _strings(c, r, hot)
            w = Windows(text, least, words, length, buckets)
            rows += [(b, HASHES, c.chunk, w.hash[own].tobytes()) for b, own in w.parts]
            rows.append((-1 - c.chunk, HELD, c.chunk, squeeze(least, np.array([len(t) for t in text], "<i4"), np.frombuffer(b"".join(text), np.uint8))))
        return pa.Table.from_batches([messages(rows)])

    def answer_hashes(mail: pa.Table) -> list[tuple]:
        """One bit for every hash: does a second chunk have it?"""
        me, src = mail["dst"][0].as_py(), mail["src"].to_pylist()
        got = [np.frombuffer(p, "<u8") for p in mail["payload"].to_pylist()]
        _, inverse, count = np.unique(np.concatenate(got), return_inverse=True, return_counts=True)
        bits, cuts = count[inverse] > 1, np.concatenate([[0], np.cumsum([len(g) for g in got])])
        return [(s, HASHES, me, np.packbits(bits[lo:hi]).tobytes()) for s, lo, hi in zip(src, cuts[:-1], cuts[1:])]

    def send_windows(mail: pa.Table) -> pa.Table:
        """Of the strings that a chunk held back, the windows that a second chunk may have."""
        me, got = mail["dst"][0].as_py(), {(r["kind"], r["src"]): r["payload"] for r in mail.to_pylist()}
        least, lens, data = unsqueeze(got[HELD, me], "<i8", "<i4", "u1")
        data, ends = data.tobytes(), np.cumsum(lens).tolist()
        w = Windows([data[lo:hi] for lo, hi in zip([0] + ends, ends)], least, words, length, buckets)
        rows = []
        for b, own in w.repeated(got):
            part = [w.text[i] for i in own]
            rows.append((b, WINDOWS, me, squeeze(w.least[own], np.array([len(p) for p in part], "<i4"), np.frombuffer(b"".join(part), np.uint8))))
        return pa.Table.from_batches([messages(rows)])

    def answer_windows(mail: pa.Table) -> pa.Table:
        seen, asked = {}, []
        for payload in mail["payload"].to_pylist():
            least, lens, data = unsqueeze(payload, "<i8", "<i4", "u1")
            data, ends = data.tobytes(), np.cumsum(lens).tolist()
            own = [data[lo:hi] for lo, hi in zip([0] + ends, ends)]
            for t, i in zip(own, least.tolist()):
                seen[t] = min(seen.get(t, i), i)
            asked.append(own)
        me = mail["dst"][0].as_py()
        return pa.Table.from_batches([messages([(s, WINDOWS, me, squeeze(np.array([seen[t] for t in own], "<i8")))
                                                for s, own in zip(mail["src"].to_pylist(), asked)])])

    def answer_strings(mail: pa.Table) -> pa.Table:
        if mail["dst"][0].as_py() < 0:  # held back by a chunk for itself
            return pa.Table.from_batches([messages([(s, HELD, s, p) for s, p in zip(mail["src"].to_pylist(), mail["payload"].to_pylist())])])
        kind = np.array(mail["kind"].to_pylist())
        rows = answer_hashes(mail.filter(pa.array(kind == HASHES))) if (kind == HASHES).any() else []
        mail = mail.filter(pa.array(kind == ANSWER))
        if not mail.num_rows:
            return pa.Table.from_batches([messages(rows)])
        src, seen, key, least, asked = mail["src"].to_pylist(), {}, [], [], []
        for payload in mail["payload"].to_pylist():
            k_, least_, lens, data = unsqueeze(payload, "<u8", "<i8", "<i4", "u1")
            data, ends = data.tobytes(), np.cumsum(lens).tolist()
            own = []
            for lo, hi, kk, ll in zip([0] + ends, ends, k_.tolist(), least_.tolist()):
                s = data[lo:hi]
                at = seen.setdefault(s, len(seen))
                if at == len(key):
                    key.append(kk)
                    least.append(ll)
                elif ll < least[at]:
                    least[at] = ll
                own.append(at)
            asked.append(np.array(own, np.int64))
        text, key, least = list(seen), np.array(key, np.uint64), np.array(least, np.int64)
        # A minimiser with one distinct string: all windows are as old as the string.
        _, group, count = np.unique(key, return_inverse=True, return_counts=True)
        run_n, pieces = np.ones(len(text), np.int64), {}
        many = np.flatnonzero(count[group] > 1)
        many = many[np.argsort(group[many], kind="stable")]
        for block in _blocks(many, group, text):
            cls, windows = classes([text[i] for i in block])
            first = np.full(int(cls.max()) + 1, NO_ID)
            np.minimum.at(first, cls, np.repeat(least[block], windows))
            oldest = first[cls]
            begin = np.cumsum(windows) - windows
            new = np.ones(len(oldest), bool)
            new[1:] = oldest[1:] != oldest[:-1]
            new[begin] = True
            at = np.flatnonzero(new)
            owner = np.searchsorted(begin, at, side="right") - 1
            n = np.bincount(owner, minlength=len(block))
            run_n[block] = n
            cuts = np.concatenate([[0], np.cumsum(n)])
            where = at - begin[owner]
            for j, i in enumerate(block):
                pieces[int(i)] = (where[cuts[j]:cuts[j + 1]], oldest[at[cuts[j]:cuts[j + 1]]])
        ptr = np.concatenate([[0], np.cumsum(run_n)])
        run_at, run_id = np.zeros(ptr[-1], np.int32), np.empty(ptr[-1], np.int64)
        run_id[ptr[:-1]] = least
        for i, (a, b) in pieces.items():
            run_at[ptr[i]:ptr[i + 1]], run_id[ptr[i]:ptr[i + 1]] = a, b
        me = mail["dst"][0].as_py()
        for s, own in zip(src, asked):
            at, _ = ragged(ptr, own)
            rows.append((s, ANSWER, me, squeeze(run_n[own].astype("<i4"), run_at[at], run_id[at])))
        return pa.Table.from_batches([messages(rows)])

    def _blocks(many, group, text, most: int = hot_bytes):
        """Whole minimiser groups, together up to ``most`` bytes."""
        block, size = [], 0
        for n, i in enumerate(many):
            if size >= most and group[i] != group[many[n - 1]]:
                yield np.array(block)
                block, size = [], 0
            block.append(i)
            size += len(text[i])
        if block:
            yield np.array(block)

    def mark(mail: pa.Table) -> pa.Table:
        c = Chunk(mail)
        r = Runs(c, words, length, k)
        light, hot = _flags(c, r, buckets)
        _, key, _, kept, of_run = _strings(c, r, light)
        bucket = (key >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        change = np.zeros(r.n + 1, np.int32)
        if len(order):
            got = [unsqueeze(c.mail[ANSWER, int(b)], "<i4", "<i4", "<i8") for b in bucket[order][np.concatenate([[True], np.diff(bucket[order]) > 0])]]
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            n = np.concatenate([g[0] for g in got])
            ptr = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
            run_at, run_id = np.concatenate([g[1] for g in got]), np.concatenate([g[2] for g in got])
            flat, owner = ragged(ptr, place[of_run])
            mine = kept[owner]
            old = run_id[flat] < c.ids[r.doc[mine]]
            following = np.append(run_at[1:], 0)[flat]
            last = flat == ptr[place[of_run] + 1][owner] - 1
            to = np.where(last, r.windows[mine], following)
            np.add.at(change, r.first[mine][old] + run_at[flat][old], 1)
            np.add.at(change, r.first[mine][old] + to[old] - 1 + length, -1)
        if len(hot):
            text, _, least, _, of_run = _strings(c, r, hot)
            w = Windows(text, least, words, length, buckets)
            for b, own in w.repeated(c.mail):
                w.least[own] = unsqueeze(c.mail[WINDOWS, b], "<i8")[0]
            flat, owner = ragged(w.ptr, of_run)
            mine = hot[owner]
            old = w.least[w.of_string[flat]] < c.ids[r.doc[mine]]
            at = (r.first[mine] + flat - w.ptr[of_run][owner])[old]
            np.add.at(change, at, 1)
            np.add.at(change, at + length, -1)
        covered = np.cumsum(change[:-1]) > 0
        return pa.Table.from_batches([digest(c, r, covered)])

    asked = chunks.select("chunk", "ids", "lens", "blob").mapInArrow(send_keys, MESSAGE)
    flags = staged(asked.groupBy("dst").applyInArrow(answer_keys, MESSAGE), "flags")
    skip = skip_messages(documents_of(chunks), later=True)
    skip = staged(skip, "copies")
    sent = inbox(chunks, flags, skip).groupBy("dst").applyInArrow(send_strings, MESSAGE)
    told = staged(sent.groupBy("dst").applyInArrow(answer_strings, MESSAGE), "answers")
    held = told.where(F.col("kind").isin(HELD, HASHES)).groupBy("dst").applyInArrow(send_windows, MESSAGE)
    compared = held.groupBy("dst").applyInArrow(answer_windows, MESSAGE)
    return inbox(chunks, flags, skip, told.where(F.col("kind") != HELD), compared).groupBy("dst").applyInArrow(mark, schema)
