"""Conversation prefix trie by adaptive radix trees over fixed-width turn ids.

A turn (role and text) is known by 16 bytes, the big-endian head of its SHA-256; a conversation is
the string of its turn ids. Tasks insert the conversations they hold into adaptive radix trees (nodes
that grow from 4 to 16, 48 and 256 places, paths without a fork compressed) and emit one partial node for
each turn-aligned byte depth. All that a node reports adds up over trees, so no prefix, however
common, is gathered in one task: partial nodes of one prefix meet in a hash aggregate.

* First pass: members, smallest member, text sizes below a node over all members, children.
* A conversation *owns* the nodes whose smallest member it is: a suffix of its path, from one depth
  on (its head). Counting each node below a prefix once is then a sum over members of what they own.
* Second pass: every member adds the sizes that it owns and the leaf that it owns.
* Ids of conversations that end in one node are range-sorted and packed, and the packs of a node are
  hashed in order, as a stream.

Conversations are cut into segments of ``segment`` turns at fixed depths; a segment's tree hangs below
the XOR of the digests of the segments before it, so a conversation that holds a third of all turns
is many rows. Turns are put in order by a range sort, without a window per conversation.

Defined results: rows without conv_id belong to no conversation and are left out; a null turn
comes first; turns of equal number are ordered by their id; repeated rows are turns of their own; null
role or text is empty; a conversation without turns (after rebuilding) ends at the root; an empty table
has no nodes, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import staged

#: Bytes of a turn id; turns of a segment; bytes of ids in one tree; bytes of a pack of ids.
WIDTH, SEGMENT, BLOCK, PACK = 16, 512, 4 << 20, 1 << 20
#: Turns that a conversation may take from its donor, and conversations that share one donor.
SHARED, DONORS = 5, 100
ROOT = bytes(WIDTH)


class Node:
    """A node of an adaptive radix tree: the compressed path to it, its items, and its
    children in a layout of 4, 16, 48 or 256 places."""

    __slots__ = ("path", "ends", "layout", "marks", "kids")

    def __init__(self, path: bytes):
        self.path, self.ends = path, []
        self.layout, self.marks, self.kids = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:  # sorted marks beside the children
            at = bisect_left(self.marks, byte)
            return self.kids[at] if at < len(self.marks) and self.marks[at] == byte else None
        if self.layout == 48:  # a place for each byte, which names the child
            return self.kids[self.marks[byte] - 1] if self.marks[byte] else None
        return self.kids[byte]

    def put(self, byte: int, node: Node) -> None:
        """Add or replace a child, in the next layout if this one is full."""
        if self.layout <= 16:
            at = bisect_left(self.marks, byte)
            if at < len(self.marks) and self.marks[at] == byte:
                self.kids[at] = node
                return
            if len(self.kids) < self.layout:
                self.marks.insert(at, byte)
                self.kids.insert(at, node)
                return
            if self.layout == 4:
                self.layout = 16
            else:
                index = bytearray(256)
                for i, b in enumerate(self.marks):
                    index[b] = i + 1
                self.layout, self.marks = 48, index
            self.put(byte, node)
        elif self.layout == 48:
            if self.marks[byte]:
                self.kids[self.marks[byte] - 1] = node
            elif len(self.kids) < 48:
                self.kids.append(node)
                self.marks[byte] = len(self.kids)
            else:
                every = [self.kids[i - 1] if i else None for i in self.marks]
                self.layout, self.marks, self.kids = 256, bytearray(), every
                self.put(byte, node)
        else:
            self.kids[byte] = node

    def children(self) -> list[Node]:
        return [k for k in self.kids if k is not None]


def insert(root: Node, key: bytes, item: int) -> None:
    """Put ``item`` at the end of ``key`` below ``root``."""
    node, at, above = root, 0, None
    while True:
        path = node.path
        if not key.startswith(path, at):
            m = 0
            while at + m < len(key) and key[at + m] == path[m]:
                m += 1
            fork = Node(path[:m])
            node.path = path[m + 1:]
            fork.put(path[m], node)
            if above is None:  # the root object stays: trade places
                keep = Node(node.path)
                keep.ends, keep.layout, keep.marks, keep.kids = node.ends, node.layout, node.marks, node.kids
                node.path, node.ends, node.layout, node.marks, node.kids = fork.path, [], 4, bytearray(), []
                node.put(path[m], keep)
            else:
                above[0].put(above[1], fork)
                node = fork
            path = node.path
        at += len(path)
        if at == len(key):
            node.ends.append(item)
            return
        byte = key[at]
        below = node.child(byte)
        if below is None:
            below = Node(key[at + 1:])
            node.put(byte, below)
        above, node, at = (node, byte), below, at + 1


def tree(keys: list[bytes]) -> Node:
    root = Node(keys[0])
    for i, key in enumerate(keys):
        insert(root, key, i)
    return root


def _xor(a: bytes, b: bytes) -> bytes:
    return (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).to_bytes(WIDTH, "big")


def segment_digest(seg: int, ids: bytes) -> bytes:
    return hashlib.sha256(seg.to_bytes(8, "big") + ids).digest()[:WIDTH]


def walk(keys, conv, seg, segment, start, grow):
    """Emit the turn-aligned nodes of the tree of ``keys`` (state and turn ids).

    ``start(i)``: the two sums that item i brings to its last node; ``grow(item, members, turn, depth)``: what
    the node adds to the first sum. Yields (key, parent key, depth, smallest item, turn, members, sums)."""
    nodes, above, first_byte = [tree(keys)], [-1], [0]
    last_byte = []
    at = 0
    while at < len(nodes):  # parents before children
        end = first_byte[at] + (at > 0) + len(nodes[at].path)
        last_byte.append(end)
        for kid in nodes[at].children():
            nodes.append(kid)
            above.append(at)
            first_byte.append(end)
        at += 1
    least, members = [None] * len(nodes), [0] * len(nodes)
    one, two = [0] * len(nodes), [0] * len(nodes)
    for at in range(len(nodes) - 1, -1, -1):
        for i in nodes[at].ends:
            if least[at] is None or conv[i] < conv[least[at]]:
                least[at] = i
            a, b = start(i)
            one[at] += a
            two[at] += b
        members[at] += len(nodes[at].ends)
        up = above[at]
        if up >= 0:
            members[up] += members[at]
            if least[up] is None or conv[least[at]] < conv[least[up]]:
                least[up] = least[at]
    # Names of the turn-aligned depths in each node, and of the nearest one above it.
    hashers, named, outer = [None] * len(nodes), [None] * len(nodes), [None] * len(nodes)
    for at in range(len(nodes)):
        key, up, hasher = keys[least[at]], above[at], None
        if at:
            outer[at] = named[up][-1] if named[up] else outer[up]
            hasher = hashers[up].copy() if hashers[up] else None
        names = []
        for k in range(first_byte[at] // WIDTH + 1, last_byte[at] // WIDTH + 1):
            if k == 1:  # the state
                hasher = hashlib.sha256(seg[least[at]].to_bytes(8, "big"))
                names.append(key[:WIDTH])
            else:
                hasher.update(key[WIDTH * (k - 1):WIDTH * k])
                names.append(_xor(key[:WIDTH], hasher.digest()[:WIDTH]))
        hashers[at], named[at] = hasher, names
    for at in range(len(nodes) - 1, -1, -1):
        i, names = least[at], named[at]
        for j in range(len(names) - 1, -1, -1):
            turn = first_byte[at] // WIDTH + j
            depth = seg[i] * segment + turn
            one[at] += grow(i, members[at], turn, depth)
            if turn or not seg[i]:
                parent = (names[j - 1] if j else outer[at]) if turn else None
                yield names[j], parent, depth, i, turn, members[at], one[at], two[at]
        if at:
            one[above[at]] += one[at]
            two[above[at]] += two[at]


def _blocks(batches, columns):
    """Columns of rows as lists, some ``BLOCK`` bytes of ids at a time."""
    held, size = {c: [] for c in columns}, 0
    for batch in batches:
        got = [batch.column(c).to_pylist() for c in columns]
        ids = got[columns.index("ids")]
        lo = 0
        for i, s in enumerate(ids):
            size += len(s) + 64
            if size >= BLOCK or i + 1 == len(ids):
                for c, values in zip(columns, got):
                    held[c] += values[lo:i + 1]
                lo = i + 1
            if size >= BLOCK:
                yield held
                held, size = {c: [] for c in columns}, 0
    if held["ids"]:
        yield held


def _suffixes(lens: bytes, tail: int) -> list[int]:
    """Size of the turns from each place of a segment on, later segments included."""
    n = np.frombuffer(lens, "<i4").astype(np.int64)
    return [*(n[::-1].cumsum()[::-1] + tail).tolist(), tail]


PARTIAL = "key binary, parent binary, depth long, c long, n long, total long, size long, rest long"


def _first_pass(segment: int):
    def run(batches):
        for held in _blocks(batches, ["c", "seg", "ids", "lens", "state", "tail"]):
            keys = [s + i for s, i in zip(held["state"], held["ids"])]
            sums = [_suffixes(x, t) for x, t in zip(held["lens"], held["tail"])]
            size = lambda i, turn: sums[i][turn - 1] - sums[i][turn] if turn else 0
            out = {n: [] for n in ("key", "parent", "depth", "c", "n", "total", "size", "rest")}
            for key, parent, depth, i, turn, n, total, _ in walk(
                    keys, held["c"], held["seg"], segment, lambda i: (held["tail"][i], 0),
                    lambda i, n, turn, depth: n * size(i, turn)):
                for k, v in zip(out.values(), (key, parent, depth, held["c"][i], n, total, size(i, turn), sums[i][max(turn - 1, 0)])):
                    k.append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k in ("key", "parent") else pa.int64()) for k, v in out.items()})
    return run


def _second_pass(segment: int):
    def run(batches):
        for held in _blocks(batches, ["c", "seg", "ids", "lens", "state", "tail", "head", "rest", "leaf"]):
            keys = [s + i for s, i in zip(held["state"], held["ids"])]
            sums = [_suffixes(x, 0) for x in held["lens"]]
            head = held["head"]

            def start(i):
                """What the conversation owns in later segments, and the leaf that it owns."""
                if head[i] is None:
                    return 0, 0
                end = held["seg"][i] * segment + len(held["ids"][i]) // WIDTH
                return (held["tail"][i] if head[i] <= end else held["rest"][i] if held["tail"][i] else 0), held["leaf"][i]

            def grow(i, n, turn, depth):
                return sums[i][turn - 1] - sums[i][turn] if turn and head[i] is not None and head[i] <= depth else 0

            out = {n: [] for n in ("key", "owned", "leaves")}
            for key, _, _, _, _, _, owned, leaves in walk(keys, held["c"], held["seg"], segment, start, grow):
                if owned or leaves:
                    for k, v in zip(out.values(), (key, owned, leaves)):
                        k.append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "key" else pa.int64()) for k, v in out.items()})
    return run


def _pieces(segment: int):
    """Sorted turns to runs of one conversation: its turns before in this partition, ids and sizes."""
    def run(batches):
        now, before = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.column("c").to_numpy()
            ids, lens = batch.column("id").to_pylist(), batch.column("size").to_numpy().astype("<i4")
            edge = np.flatnonzero(np.diff(c)) + 1
            rows = []
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(c)]):
                if now != c[lo]:
                    now, before = c[lo], 0
                for a in range(lo, hi, segment):
                    b = min(a + segment, hi)
                    rows.append((int(now), before, b - a, b"".join(ids[a:b]), lens[a:b].tobytes()))
                    before += b - a
            part = batch.column("part")[0].as_py()
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array([part] * len(rows), pa.int32()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())],
                names=["c", "part", "start", "n", "ids", "lens"])
    return run


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ordered_pieces(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Turns of every conversation in order, packed: ``c, start, n, ids, lens`` (16 and 4 bytes a turn)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    told = F.concat(F.char_length(text("role")).cast("string"), F.lit(":"), text("role"), text("text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"),
        F.unhex(F.substring(F.sha2(told, 256), 1, 2 * WIDTH)).alias("id"), F.char_length(text("text")).alias("size"))
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("id")]
    sorted_ = turns.repartitionByRange(_partitions(conversations), *order).sortWithinPartitions(*order)
    pieces = staged(sorted_.select("c", "id", "size", F.spark_partition_id().alias("part")).mapInArrow(
        _pieces(segment), "c long, part int, start long, n long, ids binary, lens binary"), "pieces")
    # Conversations in several partitions: fewer than there are partitions.
    several = pieces.groupBy("c").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("c")
    by_part = pieces.join(F.broadcast(several), "c").groupBy("c", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = by_part.select("c", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("carry"))
    return pieces.join(F.broadcast(carry), ["c", "part"], "left").select(
        "c", (F.col("start") + F.coalesce("carry", F.lit(0))).alias("start"), "n", "ids", "lens")


def rebuilt_pieces(pieces: DataFrame) -> DataFrame:
    """Conversation c with its first h = crc32(c) % 6 turns taken from conversation c - c % 100."""
    part = lambda c, lo, n, w: F.substring(F.col(c), (lo * w + 1).cast("int"), (n * w).cast("int"))
    zero, few = F.lit(0).cast("long"), F.lit(SHARED) - F.col("start")
    heads = pieces.where((F.col("c") % DONORS == 0) & (F.col("start") < SHARED)).select(
        "c", F.struct("start", part("ids", zero, few, WIDTH).alias("ids"), part("lens", zero, few, 4).alias("lens")).alias("x"))
    joined = lambda f: F.aggregate(F.transform("xs", lambda x: x[f]), F.lit(b""), lambda a, b: F.concat(a, b))
    donors = staged(heads.groupBy("c").agg(F.sort_array(F.collect_list("x")).alias("xs")).select(  # at most 5 turns
        F.col("c").alias("donor"), joined("ids").alias("d_ids"), joined("lens").alias("d_lens")), "donors")
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % (SHARED + 1)).alias("h")
    rows = pieces.withColumn("h", h).withColumn("donor", F.col("c") - F.col("c") % DONORS).join(donors, "donor", "left")
    drop = F.greatest(F.lit(0), F.col("h") - F.col("start"))
    rows = rows.withColumn("drop", drop).withColumn("own", F.greatest(F.lit(0), F.col("n") - F.col("drop"))).withColumn(
        "g", F.least("h", F.coalesce((F.octet_length("d_ids") / WIDTH).cast("long"), F.lit(0))))
    first = F.col("start") == 0
    both = lambda own, given, w: F.when(first, F.concat(
        F.coalesce(part(given, zero, F.col("g"), w), F.lit(b"")), part(own, F.col("drop"), F.col("own"), w))
    ).otherwise(part(own, F.col("drop"), F.col("own"), w))
    return rows.where(first | (F.col("own") > 0)).select(
        "c", F.when(first, 0).otherwise(F.col("start") + F.col("drop") - F.col("h") + F.col("g")).cast("long").alias("start"),
        (F.col("own") + F.when(first, F.col("g")).otherwise(0)).alias("n"),
        both("ids", "d_ids", WIDTH).alias("ids"), both("lens", "d_lens", 4).alias("lens"))


def _links(batches):
    for batch in batches:
        seg, ids, lens = (batch.column(c).to_pylist() for c in ("seg", "ids", "lens"))
        digests = [segment_digest(s, i) for s, i in zip(seg, ids)]
        word = lambda d, lo: int.from_bytes(d[lo:lo + 8], "big", signed=True)
        yield pa.RecordBatch.from_arrays(
            [batch.column("c"), batch.column("seg"), pa.array([word(d, 0) for d in digests], pa.int64()),
             pa.array([word(d, 8) for d in digests], pa.int64()),
             pa.array([int(np.frombuffer(x, "<i4").sum(dtype=np.int64)) for x in lens], pa.int64())],
            names=["c", "seg", "hi", "lo", "total"])


def _bytes(hi, lo):
    return F.unhex(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def segments(pieces: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Pieces cut at multiples of ``segment`` turns: ``c, seg, ids, lens`` with the digest ``hi, lo`` of the
    segments before, the size ``tail`` of those after, and whether it is the ``last`` one."""
    cut = pieces.withColumn("seg", F.explode(F.expr(f"sequence(start div {segment}, greatest(start, start + n - 1) div {segment})")))
    lo = F.greatest(F.col("seg") * segment, F.col("start"))
    size = F.least((F.col("seg") + 1) * segment, F.col("start") + F.col("n")) - lo
    part = lambda c, w: F.substring(F.col(c), ((lo - F.col("start")) * w + 1).cast("int"), (size * w).cast("int")).alias(c)
    cut = cut.select("c", "seg", F.struct(lo.alias("lo"), part("ids", WIDTH), part("lens", 4)).alias("x"))
    joined = lambda f: F.aggregate(F.transform("xs", lambda x: x[f]), F.lit(b""), lambda a, b: F.concat(a, b)).alias(f)
    items = staged(cut.groupBy("c", "seg").agg(F.sort_array(F.collect_list("x")).alias("xs")).select(
        "c", "seg", joined("ids"), joined("lens")), "segments")
    long_ = (F.col("seg") > 0) | (F.octet_length("ids") == segment * WIDTH)
    links = items.where(long_).mapInArrow(_links, "c long, seg long, hi long, lo long, total long")
    by = Window.partitionBy("c").orderBy("seg")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    links = staged(links.select("c", "seg", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(x) for x in ("hi", "lo")],
                                F.coalesce(F.sum("total").over(after), F.lit(0)).alias("tail"),
                                F.lead("seg").over(by).isNull().alias("last")), "links")
    alone = items.where(~long_).select("*", *[F.lit(0).cast("long").alias(x) for x in ("hi", "lo", "tail")], F.lit(True).alias("last"))
    return alone.unionByName(items.where(long_).join(links, ["c", "seg"]))


def _pack(batches):
    """Sorted (key, conversation) rows to packs: the ids of one key, comma-joined."""
    key, ids, size = None, [], 0

    def flush(rows):
        if ids:
            rows.append((key, int(ids[0]), ",".join(ids).encode()))
    for batch in batches:
        rows = []
        for k, c in zip(batch.column("key").to_pylist(), batch.column("c").to_pylist()):
            if k != key or size > PACK:
                flush(rows)
                key, ids, size = k, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if rows:
            yield _packed(rows)
    rows = []
    flush(rows)
    if rows:
        yield _packed(rows)


def _packed(rows):
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["key", "first", "ids"])


def _hash_packs(batches):
    """Sorted packs to one digest a key."""
    key, digest = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            digest.update(ids)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], names=["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["key", "ends"])


def ends_digests(items: DataFrame) -> DataFrame:
    """``key, ends``: SHA-256 of the ascending ids of the conversations that end in a node."""
    hashed = F.sha2(F.concat(F.unhex(F.lpad(F.hex("seg"), 16, "0")), F.col("ids")), 256)
    half = lambda lo, x: F.conv(F.substring(hashed, lo, 16), 16, -10).cast("long").bitwiseXOR(F.col(x))
    key = F.when(F.octet_length("ids") == 0, _bytes(F.col("hi"), F.col("lo"))).otherwise(_bytes(half(1, "hi"), half(17, "lo")))
    ended = items.where("last").select(key.alias("key"), "c")
    n = _partitions(items)
    packs = ended.repartitionByRange(n, "key", "c").sortWithinPartitions("key", "c").mapInArrow(_pack, "key binary, first long, ids binary")
    return packs.repartition(n, "key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(_hash_packs, "key binary, ends string")


def trie_nodes(pieces: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The nodes of the trie of packed conversations (``ordered_pieces`` or ``rebuilt_pieces``)."""
    items = segments(pieces, segment).withColumn("state", _bytes(F.col("hi"), F.col("lo")))
    found = items.select("c", "seg", "ids", "lens", "state", "tail").mapInArrow(_first_pass(segment), PARTIAL)
    merged = staged(found.groupBy("key").agg(
        F.min(F.struct("c", "rest")).alias("f"), *[F.sum(x).alias(x) for x in ("n", "total")],
        *[F.max(x).alias(x) for x in ("size", "depth", "parent")]).select("key", "parent", "depth", "f.c", "f.rest", "n", "total"), "nodes")
    kids = merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(merged.join(kids, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    # The first node that a conversation owns, and whether it owns a leaf.
    heads = staged(nodes.groupBy("c").agg(F.min(F.struct("depth", "key", "rest", "parent")).alias("h"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
                   .select("c", F.col("h.depth").alias("head"), "h.key", "h.rest", "h.parent", "leaf"), "heads")
    owned = items.select("c", "seg", "ids", "lens", "state", "tail").join(heads.select("c", "head", "rest", "leaf"), "c", "left").mapInArrow(
        _second_pass(segment), "key binary, owned long, leaves long")
    parents = heads.where("parent IS NOT NULL").select("key", "parent").join(nodes.select(F.col("key").alias("parent"), F.col("c").alias("up")), "parent").select("key", "up")
    columns = {"c": "long", "depth": "long", "n": "long", "n_children": "long", "total": "long", "up": "long", "ends": "string", "owned": "long", "leaves": "long"}
    full = lambda df: df.select("key", *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
    rows = full(nodes).unionByName(full(owned)).unionByName(full(parents)).unionByName(full(ends_digests(items)))
    got = rows.groupBy("key").agg(*[(F.sum(c) if c in ("owned", "leaves") else F.max(c)).alias(c) for c in columns])
    return got.select(
        F.col("c").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("up", "c")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", F.coalesce("leaves", F.lit(0).cast("long")).alias("n_leaves"),
        (F.col("total") - F.coalesce("owned", F.lit(0))).alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT, rebuild: bool = True) -> DataFrame:
    """One row for each distinct prefix of the (rebuilt) conversations."""
    pieces = ordered_pieces(conversations, segment)
    return trie_nodes(rebuilt_pieces(pieces) if rebuild else pieces, segment)


def oracle_sql() -> str:
    """The nodes in DuckDB's SQL, prefix by prefix. CRC-32 is written out, as DuckDB has no such function."""
    bit = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = "list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {bit}))"
    return f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {DONORS} AS donor, {crc} % {SHARED + 1} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.donor AND t.k <= c.h
  UNION ALL SELECT c.conv_id, 1, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
q AS (SELECT conv_id, list(length(role) || ':' || role || text ORDER BY own, k) AS path, list(length(text) ORDER BY own, k) AS sizes FROM r GROUP BY conv_id),
p AS (SELECT c.conv_id, coalesce(path, []) AS path, coalesce(sizes, []) AS sizes FROM c LEFT JOIN q USING (conv_id)),
n AS (SELECT path[1:d] AS pre, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(coalesce(sizes[d], 0)) AS size
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM p) GROUP BY 1, 2),
kids AS (SELECT pre[1:depth - 1] AS pre, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (pre)),
up AS (SELECT pre[1:j] AS pre, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM m) GROUP BY 1),
e AS (SELECT path AS pre, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM p GROUP BY 1)
SELECT m.conv_id, m.depth, parent.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM m JOIN up USING (pre) LEFT JOIN e USING (pre) LEFT JOIN n AS parent ON m.depth > 0 AND parent.pre = m.pre[1:m.depth - 1]"""
