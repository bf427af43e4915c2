"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted by page id; every partition writes gzip files (one member per
record) and rolls to a new file once ``roll_bytes`` of compressed data are reached.
Headers and digests are made anew from the payload, with record ids derived from page id
and digest, so a repeated run or task writes the same bytes. Files are written under
temporary names and renamed when whole; a file counts only through its row in the manifest,
which Spark commits.

Of records with equal payloads (by SHA-1, the format's own notion of identity, and
length) the one with the smallest page id is a ``response``, the others are ``revisit``
records that carry its id and digest but no payload.

Defined results: a null payload is empty; empty payloads equal each other; a null url becomes
``about:blank``; line ends in a url are percent-encoded; rows that share the smallest page
id are all responses; a null page id sorts first, is written as ``null``, and is referred to
only when no other page has the payload (``refers_to`` is then null); an empty table writes no
file and reads back empty; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import staged

MANIFEST = "file string, records long, compressed_bytes long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compressed bytes given to the decompressor at once.
STEP = 16 << 10
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _b32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}:{digest}')}>"


def format_record(page_id, url: str | None, payload: bytes, digest: str, target, date: str) -> bytes:
    """One uncompressed record. ``target`` is the page id that a revisit refers to; a
    response has the string ``self``."""
    revisit = target != "self"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    import hashlib
    uri = quote(url or "about:blank", safe=":/?#[]@!$&'()*+,;=%-._~")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{_b32(hashlib.sha1(block).digest())}",
            f"X-Page-Id: {'null' if page_id is None else page_id}"]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(target, digest)}",
                 f"X-Refers-To-Page-Id: {'null' if target is None else target}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               revisit_from: int = 0, roll_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the archive below ``path`` and return its committed manifest. Payloads of
    fewer than ``revisit_from`` bytes are always responses.

    Payloads move once, to the range partition of their id. Which records are revisits is found on
    narrow rows: groups are pre-aggregated, one row per digest and task, and staged, so that the join with them
    has an exchange on either side and a hot digest can be split there."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload"))).withColumn("n", F.length("payload"))
    groups = staged(rows.where(F.col("n") >= revisit_from).groupBy("sha1", "n")
                    .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "payload-groups")
    # Narrow rows say which records revisit which page; they travel with the records of their id.
    told = (rows.select("page_id", "sha1", "n").join(groups, ["sha1", "n"])
            .where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).select("page_id", "sha1", "first").distinct())
    none = F.lit(None)
    every = rows.select("page_id", "url", "payload", "sha1", F.lit(1).alias("kind"), none.cast("long").alias("first")).unionByName(
        told.select("page_id", none.cast("string").alias("url"), none.cast("binary").alias("payload"), "sha1", F.lit(0).alias("kind"), "first"))
    ranged = every.repartitionByRange(F.col("page_id").asc_nulls_first()).sortWithinPartitions(
        F.col("page_id").asc_nulls_first(), "kind", "url", "sha1")

    def write(batches):
        from pyspark import TaskContext
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        files, root = pafs.FileSystem.from_uri(path)
        out, name, size, count, rolled, done = None, "", 0, 0, 0, []
        of_page, known = (), {}

        def close():
            out.close()
            files.move(f"{root}/{name}.tmp", f"{root}/{name}")
            done.append((name, count, size))

        for batch in batches:
            cols = [batch.column(c) for c in range(6)]
            for i in range(batch.num_rows):
                page_id, url, payload, sha1, kind, first = (c[i].as_py() for c in cols)
                if page_id != of_page:
                    of_page, known = page_id, {}
                if kind == 0:
                    known[sha1] = first
                    continue
                if out is None:
                    files.create_dir(root, recursive=True)
                    # the attempt keeps two tries of one task apart; contents are equal
                    name, size, count = f"pages-{part:06d}-{rolled:04d}-{attempt}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{name}.tmp", compression=None)
                member = gzip.compress(format_record(page_id, url, payload, _b32(sha1), known.get(sha1, "self"), date), mtime=0)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= roll_bytes:
                    close()
                    out, rolled = None, rolled + 1
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("file", "records", "compressed_bytes"), map(list, zip(*done)))))

    return staged(ranged.mapInArrow(write, MANIFEST), "warc-manifest")


def _members(stream, block: int = 1 << 20):
    """Contents of each gzip member of a stream."""
    d, parts, data, at = zlib.decompressobj(31), [], b"", 0
    while True:
        if at >= len(data):
            data, at = stream.read(block), 0
            if not data:
                break
        step = data[at:at + STEP]  # what follows a member's end is copied, so it is kept short
        parts.append(d.decompress(step))
        at += len(step) - len(d.unused_data)
        if d.eof:
            yield b"".join(parts)
            d, parts = zlib.decompressobj(31), []


def parse_record(record: bytes) -> tuple[dict, dict, bytes]:
    """WARC headers, HTTP headers (names in lower case) and payload of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, {k.lower(): v for k, v in (x.split(": ", 1) for x in http.decode().split("\r\n")[1:])}, payload


def read_warc(manifest: DataFrame, path: str, verify: bool = True) -> DataFrame:
    """Records of the files of a manifest (``RECORDS``). A revisit has no payload; its
    length is that of the payload it stands for. ``verify`` checks block and payload digests."""

    def number(x):
        return None if x is None or x == "null" else int(x)

    def read(batches):
        import hashlib
        files, root = pafs.FileSystem.from_uri(path)
        names = ("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload")
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in _members(stream):
                        w, http, payload = parse_record(record)
                        digest, revisit = w["warc-payload-digest"].removeprefix("sha1:"), w["warc-type"] == "revisit"
                        if verify and not revisit and _b32(hashlib.sha1(payload).digest()) != digest:
                            raise ValueError(f"{name}: payload digest of page {w['x-page-id']} does not match")
                        rows.append((number(w["x-page-id"]), w["warc-target-uri"], w["warc-type"],
                                     number(w.get("x-refers-to-page-id")), digest, int(http["content-length"]),
                                     None if revisit else payload))
                        held += len(payload)
                        if held > 4 << 20 or len(rows) >= 5000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    # a task for each file: a number that is asked for is not coalesced
    return manifest.select("file").repartitionByRange(max(1, manifest.count()), "file").mapInArrow(read, RECORDS)
