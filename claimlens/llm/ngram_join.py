"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are the rows and word n-grams the columns of a sparse 0/1 matrix; the overlaps of
all pairs are the product with its transpose. The product is taken in blocks of columns (buckets of
n-gram hashes) and bounded by sizes:

* a column that only one document has adds to no overlap and leaves the matrix;
* sets of sizes ``m <= n`` can reach the threshold ``t`` only if ``m >= t * n``;
* the overlap must be at least ``t * n``, so a pair meets within the first ``n - ceil(t * n) + 1``
  columns of each row, if columns are put in one order for all rows; they are ordered by the number of
  documents, rarest first, and only these corners of the rows are multiplied to get candidate pairs;
  columns before the pair's first common one are lost to it, which bounds the overlap once more;
* the overlap of a candidate pair is accumulated over blocks of columns, and the pair is given up as
  soon as what is left cannot reach its bound.

A column with many rows is not expanded into all pairs: first its most central row (the least part
of its columns is its own) is multiplied with the others; rows that this joins into one component need no more products, since the result is the
components of links; then pairs of rows still in different components are multiplied, save where
the distances to the central row show (triangle inequality of the Jaccard distance) that the
pair cannot reach the threshold. No link between components is lost.

N-grams are told apart by 64-bit hashes. Equal word sequences are one row of the matrix.

Defined results: a null or wordless text has no n-grams, links with nothing and is a component
of its own; a text of fewer than ``width`` words is one n-gram of all its words; repeated rows link
like copies; a null id is larger than all others; an empty table gives an empty result; columns
other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import NO_ID, FOLD, mix, staged, window_hash, word_hash, word_spans
from claimlens.llm.components import connected_components
from claimlens.llm.windows import (FLAGS, MESSAGE, Chunk, bucket_count, by_bucket, documents_of, inbox, messages, pack,
                                   skip_messages, squeeze, unsqueeze)

ROWS = "chunk long, row int, size long, shared long, corner array<bigint>, places array<int>, grams binary"
BLOCKS = 4  # column blocks of the overlap of a pair


def gram_sets(c: Chunk, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every document, ascending, and their offsets."""
    begin, end = word_spans(c.text)
    codes = word_hash(c.text, begin, end)
    doc = np.searchsorted(c.starts, begin, side="right") - 1
    gram = window_hash(codes, width)
    n = len(gram)
    at = np.flatnonzero(doc[:n] == doc[width - 1:width - 1 + n]) if n else np.empty(0, np.int64)
    gram, owner = gram[at], doc[at]
    words = np.bincount(doc, minlength=len(c.ids))
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        first = np.searchsorted(doc, short)
        whole = [mix(np.array([(codes[f:f + n] * FOLD[40:40 + n]).sum(dtype=np.uint64) + np.uint64(n)]))[0]
                 for f, n in zip(first, words[short])]
        gram, owner = np.concatenate([gram, np.array(whole, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[new], owner[new]
    return gram, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(c.ids)))]).astype(np.int64)


def overlap(x: np.ndarray, y: np.ndarray, need: int) -> int:
    """Size of the intersection of two ascending arrays, by blocks of columns; -1 once it cannot
    reach ``need``."""
    cuts = [np.uint64(b << 62) for b in range(1, BLOCKS)]
    xs, ys = [0, *np.searchsorted(x, cuts), len(x)], [0, *np.searchsorted(y, cuts), len(y)]
    got = 0
    for i in range(BLOCKS):
        a, b = x[xs[i]:xs[i + 1]], y[ys[i]:ys[i + 1]]
        if len(a) and len(b):
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            got += int((b[at] == a).sum())
        if got + min(len(x) - xs[i + 1], len(y) - ys[i + 1]) < need:
            return -1
    return got


def matrix_rows(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, chunk_bytes: int):
    """The staged matrix: one row per distinct word sequence with its set size, its corner (the
    candidate columns) and its shared columns; and all documents with the row that stands for them."""
    chunks = pack(docs, id_col, text_col, words=True, lower=True, chunk_bytes=chunk_bytes)
    buckets = bucket_count(chunks)

    def send(batches):
        for batch in batches:
            for chunk, ids, lens, blob in zip(*(x.to_pylist() for x in batch.columns)):
                gram, _ = gram_sets(Chunk.of(chunk, ids, lens, blob), width)
                keys, count = np.unique(gram, return_counts=True)
                order, bucket, cuts = by_bucket(keys, buckets)
                low, count = keys[order].astype(np.uint32), np.minimum(count[order], 255).astype(np.uint8)
                yield messages([(int(bucket[lo]), FLAGS, chunk, squeeze(low[lo:hi], count[lo:hi]))
                                for lo, hi in zip(cuts[:-1], cuts[1:])])

    def answer(mail: pa.Table) -> pa.Table:
        src = mail["src"].to_pylist()
        got = [unsqueeze(p, "<u4", "u1") for p in mail["payload"].to_pylist()]
        _, inverse = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        docs_of = np.bincount(inverse, np.concatenate([g[1] for g in got]))
        scale = np.minimum(255, np.round(8 * np.log2(docs_of))).astype(np.uint8)[inverse]  # 0: one document
        cuts, me = np.concatenate([[0], np.cumsum([len(g[0]) for g in got])]), mail["dst"][0].as_py()
        return pa.Table.from_batches([messages([(s, FLAGS, me, squeeze(scale[lo:hi])) for s, lo, hi in zip(src, cuts[:-1], cuts[1:])])])

    def corners(mail: pa.Table) -> pa.Table:
        c = Chunk(mail)
        gram, ptr = gram_sets(c, width)
        keys, inverse = np.unique(gram, return_inverse=True)
        order, bucket, cuts = by_bucket(keys, buckets)
        common = np.zeros(len(keys), np.uint8)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            common[order[lo:hi]] = unsqueeze(c.mail[FLAGS, int(bucket[lo])], "u1")[0]
        common = common[inverse]
        rows = []
        for i in range(len(c.ids)):
            if c.skip[i]:
                continue
            own, often = gram[ptr[i]:ptr[i + 1]], common[ptr[i]:ptr[i + 1]]
            n = len(own)
            take = n - (percent * n + 99) // 100 + 1
            corner, places = np.empty(0, np.uint64), np.empty(0, np.int64)
            shared = int(np.count_nonzero(often))
            if n and n - shared < take:
                first = np.lexsort((own, often))[:take]
                places = np.flatnonzero(often[first])  # in the order of columns, the row's own ones included
                corner = own[first[places]]
            rows.append((c.chunk, i, n, shared, corner.view(np.int64), places, own[often > 0].tobytes() if len(corner) else None))
        cols = list(zip(*rows)) if rows else [()] * 7
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
        return pa.Table.from_arrays([pa.array(list(x), k) for x, k in zip(cols, kinds)],
                                    names=["chunk", "row", "size", "shared", "corner", "places", "grams"])

    asked = chunks.select("chunk", "ids", "lens", "blob").mapInArrow(send, MESSAGE)
    scales = asked.groupBy("dst").applyInArrow(answer, MESSAGE)
    every = documents_of(chunks)
    rows = inbox(chunks, scales, skip_messages(every, later=False)).groupBy("dst").applyInArrow(corners, ROWS)
    rid = (F.col("chunk") * (1 << 20) + F.col("row")).alias("rid")
    key = F.struct(F.coalesce(F.col("doc_id"), F.lit(int(NO_ID))).alias("id"), F.col("chunk"), F.col("row"))
    first = every.groupBy("print").agg(F.min(key).alias("f")).select("print", (F.col("f.chunk") * (1 << 20) + F.col("f.row")).alias("class"))
    members = staged(every.join(staged(first, "prints"), "print").select("doc_id", rid, "class"), "members")
    return staged(rows.select(rid, "size", "shared", "corner", "places", "grams"), "matrix"), members


def reachable(size_a, place_a, size_b, place_b, percent: int):
    """Whether rows of these sizes that meet at these places can reach the threshold: what
    lies before their first common column cannot be common."""
    a, b = F.col(size_a), F.col(size_b)
    most = F.least(a - F.col(place_a), b - F.col(place_b))
    return most * (100 + percent) >= (a + b) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, size_a, size_b, inter`` of pairs ``a, b``; ``inter`` is -1 if it is below what
    ``percent`` needs (0: always the full overlap)."""
    one = sets.select(F.col("rid").alias("a"), F.col("size").alias("size_a"), F.col("grams").alias("ga"))
    two = sets.select(F.col("rid").alias("b"), F.col("size").alias("size_b"), F.col("grams").alias("gb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "size_a", "size_b", "ga", "gb")

    def run(batches):
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            need = -(-percent * (na + nb) // (100 + percent))
            inter = [overlap(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), int(n))
                     for x, y, n in zip(batch.column(4), batch.column(5), need)]
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(4)), pa.array(inter, pa.int64())],
                                             names=["a", "b", "size_a", "size_b", "inter"])

    return staged(both.mapInArrow(run, "a long, b long, size_a long, size_b long, inter long"), "products")


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further ``links`` (a, b) between nodes of ``found`` or new ones: the graph of
    components is much smaller than that of rows."""
    side = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    joined = links.join(side("a"), "a", "left").join(side("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
    joined = staged(joined.distinct(), "component-links")
    if joined.isEmpty():
        return found
    top = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("top"))
    moved = found.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    new = top.join(found.select(F.col("node").alias("component")), "component", "left_anti").select(F.col("component").alias("node"), F.col("top").alias("component"))
    return moved.unionByName(new)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                       percent: int = 85, chunk_bytes: int = 2 << 20) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``. Two documents link when
    ``100 * intersection >= percent * union`` of their sets of ``width``-word n-grams;
    ``component_id`` is the smallest id reachable by links, ``kept`` marks one row of each component
    (of its smallest id)."""
    matrix, members = matrix_rows(docs, id_col, text_col, width, percent, chunk_bytes)
    sets = matrix.where("grams IS NOT NULL").select("rid", "size", "grams")
    entries = matrix.where("grams IS NOT NULL").select(
        "rid", "size", (1 - F.col("shared") / F.col("size")).alias("own"), F.explode(F.arrays_zip("corner", "places")).alias("e")).select(
        "rid", "size", "own", F.col("e.corner").alias("g"), F.col("e.places").alias("place"))
    heads = entries.groupBy("g").agg(F.min(F.struct("own", "rid", "size", "place")).alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "g", F.col("h.rid").alias("a"), F.col("h.size").alias("size_a"), F.col("h.place").alias("place_a"))
    entries = staged(entries.drop("own").join(heads, "g"), "corners")
    linked = F.col("inter") * (100 + percent) >= F.lit(percent) * (F.col("size_a") + F.col("size_b"))
    stars = entries.where((F.col("rid") != F.col("a")) & reachable("size", "place", "size_a", "place_a", percent)).select("a", F.col("rid").alias("b")).distinct()
    stars = verified(stars, sets, 0)  # in full, for the distances below
    edges = stars.where(linked).select("a", "b")
    found = connected_components(edges)
    # Rows of one column that are still in different components.
    parts = entries.join(found.withColumnRenamed("node", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    open_columns = parts.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("g")
    # Distance of a column's rows to its central row, where their product was taken.
    near = stars.select("a", F.col("b").alias("rid"), (1 - F.col("inter") / (F.col("size_a") + F.col("size_b") - F.col("inter"))).alias("d"))
    parts = parts.join(open_columns, "g").join(near, ["a", "rid"], "left")
    parts = staged(parts.withColumn("d", F.when(F.col("rid") == F.col("a"), F.lit(0.0)).otherwise(F.col("d"))), "open")
    x = parts.select("g", F.col("rid").alias("a"), F.col("size").alias("size_a"), F.col("place").alias("place_a"), F.col("component").alias("ca"), F.col("d").alias("da"))
    y = parts.select("g", F.col("rid").alias("b"), F.col("size").alias("size_b"), F.col("place").alias("place_b"), F.col("component").alias("cb"), F.col("d").alias("db"))
    reach = F.coalesce(F.abs(F.col("da") - F.col("db")) <= (100 - percent) / 100 + 1e-9, F.lit(True))
    cross = x.join(y, (x["g"] == y["g"]) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & reachable("size_a", "place_a", "size_b", "place_b", percent) & reach)
    cross = cross.select("a", "b").distinct().join(stars.select("a", "b"), ["a", "b"], "left_anti")
    cross = verified(cross, sets, percent)
    found = merged(found, cross.where(linked).select("a", "b"))
    rows = matrix.select(F.col("rid").alias("class"), "size").join(found.withColumnRenamed("node", "class"), "class", "left")
    rows = staged(rows, "class-rows")  # with an exchange on either side, AQE can split a class of many copies
    whole = members.join(rows, "class").withColumn("component", F.coalesce("component", "class"))
    # Documents without n-grams are one class of equal (empty) texts, but link with nothing.
    whole = staged(whole.withColumn("component", F.when(F.col("size") == 0, -F.col("rid") - 1).otherwise(F.col("component"))), "components")
    first = staged(whole.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "rid")).alias("f")), "component-firsts")
    return whole.join(first, "component").select("doc_id", F.col("size").alias("n_shingles"), F.col("f.doc_id").alias("component_id"),
                                                 (F.col("rid") == F.col("f.rid")).alias("kept"))
