"""Token ids as flat binary files.

Documents are range-partitioned by id. Every partition becomes one or more shards, rolled at ``roll_bytes``: a flat file of
unsigned token ids (``.bin``; 16 bits each if the vocabulary fits, else 32; the manifest says which) and an index (``.idx``) of signed 64-bit document ids,
then 64-bit offsets (documents + 1) into the shard's ids, all little-endian. A task
writes under a temporary name and renames when the file is whole; a shard counts only
through its row in the manifest, which Spark commits, so a lost or repeated task leaves at
most an unread file. A shard's base, the ids of all documents before it, is the prefix
sum of the manifest's counts. Readers map the files into memory (file systems without
memory maps are read into a buffer), one task for each shard.

Defined results: a null text is empty and becomes the end id alone; a null id sorts first;
rows of one id keep the order of their texts; an empty table gives no shards and an empty
result; columns other than id and text are not read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import staged

MANIFEST = "shard int, part int, file string, documents long, ids long, id_bytes int"
#: White space before a space inside a run: there a cut could change how the run is split.
_RUN = re.compile(r"\s (?:\s|$)")
#: Bytes of remembered pieces in a worker (text, ids and some 200 bytes for each), longest one, pieces encoded at once.
CACHE_BYTES, LONGEST, AT_ONCE = 256 << 20, 64, 250
_EACH = 200
#: Stands for the first piece of a text, the only one without a space before it.
_FIRST = None
_MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
_caches: dict = {}


class Encoder:
    """Byte-level BPE by the tokenizers library, with a cache of encoded pieces.

    The tokenizer splits a text before every space that follows a character other than
    white space, so pieces between such spaces encode alone; a text with longer runs of white
    space around spaces is encoded whole. New pieces are encoded many at a time as one text, as only the
    first token of a piece begins with its space. Ids are kept as little-endian bytes of the file's width.

    The cache is bounded by ``cache_bytes``; when it is full, the half that came first goes. Pieces of more than
    ``LONGEST`` characters are not kept."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        # A task has one core; the library would start threads for each batch.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.opens = np.zeros(size, bool)  # tokens that begin with a space
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("\u0120")
        self.known, self.held, self.cache_bytes = {}, 0, cache_bytes

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self.pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of new pieces, each with a space before it, and of the words in them."""
        found, plain, marked, ends = {}, [], [], set()
        for p in pieces:
            if p.isalpha():
                plain.append(p)
            elif not p or p[0].isspace():  # would make one run of white space with what ends the piece before
                found[p] = self._whole([" " + p])[0]
            else:
                # The tokenizer parts letters from marks behind them, so a word with marks is a word, then marks.
                w = p.rstrip(_MARKS)
                if w.isalpha() and len(w) < len(p):
                    marked.append((p, w))
                    ends.add(p[len(w):])
                else:
                    plain.append(p)
        known = self.known
        plain += {w for _, w in marked if w not in known and w not in pieces}
        for lo in range(0, len(plain), AT_ONCE):
            part = plain[lo:lo + AT_ONCE]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, f"<u{self.width}")
            cuts = (np.append(np.flatnonzero(self.opens[ids]), len(ids)) * self.width).tolist()
            packed = ids.tobytes()
            found.update(zip(part, [packed[a:b] for a, b in zip(cuts, cuts[1:])]))
        marks = dict(zip(ends, self._whole(list(ends))))
        for p, w in marked:
            found[p] = (found[w] if w in found else known[w]) + marks[p[len(w):]]
        return found

    def _keep(self, found: dict[str, bytes]) -> None:
        """Forget the long ones of new pieces; drop the older half beyond the bound."""
        size = lambda some: sum(map(len, some)) + sum(map(len, some.values())) + _EACH * len(some)
        large = {p: found[p] for p in found if len(p) > LONGEST}
        for p in large:
            del self.known[p]
        self.held += size(found) - size(large)
        while self.held > self.cache_bytes and self.known:
            old = {p: self.known.pop(p) for p in list(islice(self.known, max(1, len(self.known) // 2)))}
            self.held -= size(old)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes."""
        out, split, firsts = [b""] * len(texts), [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            if _RUN.search(text):
                out[i] = self._whole([text])[0]
                continue
            pieces = text.split(" ")
            firsts.append(pieces[0])
            pieces[0] = _FIRST
            split.append((i, pieces))
        self.known[_FIRST] = b""
        new = set().union(*[pieces for _, pieces in split]).difference(self.known)
        found = self._learn(new) if new else {}
        self.known.update(found)
        ids = self.known.__getitem__
        for (i, pieces), first in zip(split, self._whole(firsts)):
            out[i] = first + b"".join(map(ids, pieces))
        del self.known[_FIRST]
        self._keep(found)
        return out


def _encoder(path: str) -> Encoder:
    if path not in _caches:
        _caches[path] = Encoder(path)
    return _caches[path]


def _batches(batch: pa.RecordBatch, most: int = 1 << 18):
    """Rows of a batch in lists of about ``most`` characters."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        ids.append(i)
        texts.append(t or "")
        size += len(texts[-1])
        if size >= most:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, roll_bytes: int = 256 << 20) -> DataFrame:
    """Encode every text, append ``end_id`` and write shards of about ``roll_bytes`` below ``path`` in ascending
    id order; returns the committed manifest with ``base``, the ids before each shard."""
    ranged = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
              .repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text"))

    def write(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        files, root = pafs.FileSystem.from_uri(path)
        coder, done, out = _encoder(tokenizer), [], None
        end = coder.pack([end_id])

        def close():
            out.close()
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
            with files.open_output_stream(f"{root}/{name}.idx.tmp") as idx:
                # the smallest 64-bit number stands for a null id
                idx.write(np.array([-2**63 if i is None else i for i in doc_ids], dtype="<i8").tobytes())
                idx.write(offsets.tobytes())
            for kind in ("bin", "idx"):
                files.move(f"{root}/{name}.{kind}.tmp", f"{root}/{name}.{kind}")
            done.append((shard, len(done), name, len(lengths), int(offsets[-1]), coder.width))

        for batch in batches:
            for ids, texts in _batches(batch):
                for i, b in zip(ids, coder.encode(texts)):
                    if out is None:
                        name, doc_ids, lengths, size = f"{shard:06d}-{uuid.uuid4().hex}", [], [], 0
                        files.create_dir(root, recursive=True)
                        out = files.open_output_stream(f"{root}/{name}.bin.tmp")
                    out.write(b + end)
                    doc_ids.append(i)
                    lengths.append(len(b) // coder.width + 1)
                    size += len(b) + 64
                    if size >= roll_bytes:
                        close()
                        out = None
        if out is not None:
            close()
        if done:
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                             names=["shard", "part", "file", "documents", "ids", "id_bytes"])

    manifest = staged(ranged.mapInArrow(write, MANIFEST), "token-manifest")
    # one row per shard
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(
        Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))


def read_tokens(manifest: DataFrame, path: str) -> DataFrame:
    """One row per document read from the files of the manifest:
    ``doc_id, start, n_tokens, ids_crc32``."""

    def read(batches):
        files, root = pafs.FileSystem.from_uri(path)

        def mapped(name):
            if isinstance(files, pafs.LocalFileSystem):
                return memoryview(np.memmap(f"{root}/{name}", mode="r"))
            with files.open_input_file(f"{root}/{name}") as f:
                return memoryview(f.read())

        for batch in batches:
            for row in batch.to_pylist():
                index = np.frombuffer(mapped(f"{row['file']}.idx"), "<i8")
                ids = np.frombuffer(mapped(f"{row['file']}.bin"), f"<u{row['id_bytes']}")
                n = row["documents"]
                doc_ids, offsets = index[:n], index[n:]
                for lo in range(0, n, 10_000):
                    hi = min(n, lo + 10_000)
                    crc = [zlib.crc32(ids[offsets[i]:offsets[i + 1]].astype("<u4")) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc_ids[lo:hi], pa.int64(), mask=doc_ids[lo:hi] == -2**63),
                        "start": pa.array(offsets[lo:hi] + row["base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(offsets[lo:hi + 1]), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64())})

    # a task for each shard: a number that is asked for is not coalesced
    spread = manifest.repartitionByRange(max(1, manifest.count()), "shard", "part")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
