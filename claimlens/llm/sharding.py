"""Sharding by Karmarkar-Karp differencing: byte-balanced shards of indivisible groups.

Copies of one text form a group that must not be divided. Groups are dealt into cells by
hash, as many cells as keep ``per_cell`` groups in each on average. In every cell the differencing method runs over its groups: the state is a
set of partial partitions (``pieces`` subset sums each, with the groups behind them); the two
with the largest spread are combined in opposite order, again and again, until one is
left. What leaves a cell is that one partial partition: its subset sums. While there are more than
``cells`` of them, rounds of the same kind difference up to ``FAN`` partial partitions a task into
one. The pieces of the last cells, and every group larger than 1 / ``LARGE`` of a shard, are then
differenced into shards the same way. Their number is bounded by the parameters
(``cells x pieces + shards x LARGE``), whatever the size of the data, and small pieces leave room
beside a hot group.

Defined results: a null text counts as an empty text of no bytes; equal texts (nulls
included) share a shard; repeated rows are separate rows of one group; a group larger than
an even share fills a shard of its own; an empty table gives an empty result; columns
other than id and text are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import staged


#: Groups of more than this part of a shard's share are placed one by one.
LARGE = 32
#: Partial partitions that one task differences into one.
FAN = 64


def difference(partials: list[tuple[int, ...]]) -> tuple[tuple[int, ...], list[list[int]]]:
    """Karmarkar-Karp over partial partitions given as equally long tuples of subset
    sums. Returns the sums of the final partition (descending) and, for every input, the
    final subset that each of its own subsets went to."""
    k = len(partials[0])
    state, heap, nodes = {}, [], []
    for i, sums in enumerate(partials):
        order = sorted(range(k), key=lambda j: -sums[j])
        nodes.append(order)  # leaf: place in the state -> own subset
        state[i] = [sums[j] for j in order]
        heap.append((state[i][-1] - state[i][0], i))
    heapq.heapify(heap)
    parents = {}
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        sa, sb = state.pop(a), state.pop(b)
        both = [x + y for x, y in zip(sa, reversed(sb))]
        order = sorted(range(k), key=lambda j: -both[j])
        new, place = len(nodes), [0] * k
        for to, j in enumerate(order):
            place[j] = to
        parents[a], parents[b] = (new, place), (new, place[::-1])
        nodes.append(None)
        state[new] = [both[j] for j in order]
        heapq.heappush(heap, (state[new][-1] - state[new][0], new))
    root = heap[0][1]
    where = {root: list(range(k))}
    for node in range(root, -1, -1):
        if node in parents:
            up, place = parents[node]
            where[node] = [where[up][p] for p in place]
    out = []
    for i in range(len(partials)):
        own = [0] * k
        for place, j in enumerate(nodes[i]):
            own[j] = where[i][place]
        out.append(own)
    return tuple(state[root]), out


def _difference_sizes(sizes: np.ndarray, k: int) -> np.ndarray:
    """The subset each single group goes to."""
    _, placed = difference([(int(s),) + (0,) * (k - 1) for s in sizes])
    return np.array([p[0] for p in placed], dtype=np.int32)


def cell_rounds(groups: int, cells: int, per_cell: int) -> list[int]:
    """Numbers of cells, from those that take ``per_cell`` of the groups each down to ``cells`` at most."""
    rounds = [max(cells, -(-groups // per_cell))]
    while rounds[-1] > cells:
        rounds.append(max(cells, -(-rounds[-1] // FAN)))
    return rounds


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24,
                    cells: int = 64, pieces: int = 96, overhead: int = 8,
                    per_cell: int = 4096) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length plus ``overhead``. Under the law ``bytes`` the sums of
    sizes by shard are near equal. ``slot`` numbers the rows of a shard from 0 without gaps:
    rows are numbered within (shard, hash cell) and shifted by the counts of the cells
    before, so no task holds a whole shard. A cell's groups are differenced in one task, which
    holds 6.4 KB of Python objects a group (at 96 pieces), so some 26 MB a task at any size
    of the data."""
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = staged(docs.select(F.col(id_col).cast("long").alias("doc_id"), raw.alias("_raw")).select(
        "doc_id", (F.length("_raw") + overhead).cast("long").alias("size"),
        F.crc32("_raw").alias("text_crc32"), F.unhex(F.sha2("_raw", 256)).alias("_text")), "rows")

    def solve(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bytes", "_text"], ascending=[False, True], ignore_index=True)
        return part.assign(subset=_difference_sizes(part["bytes"].to_numpy(), pieces))

    def merge(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["cell", "subset"], ignore_index=True)
        sums = part.pivot(index="cell", columns="subset", values="bytes").reindex(columns=range(pieces)).fillna(0).astype("int64")
        _, placed = difference([tuple(row) for row in sums.to_numpy().tolist()])
        row = sums.index.get_indexer(part["cell"])
        return part.assign(up_subset=np.array(placed, np.int32)[row, part["subset"]])

    groups = staged(rows.groupBy("_text").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    is_large = F.col("bytes") * (shards * LARGE) > total
    large = groups.where(is_large).collect()  # at most shards x LARGE
    large.sort(key=lambda r: (-r["bytes"], bytes(r["_text"])))
    rounds = cell_rounds(groups.where(~is_large).count(), cells, per_cell)
    small = groups.where(~is_large).withColumn("cell", F.pmod(F.xxhash64("_text"), F.lit(rounds[0])).cast("int"))
    small = staged(small.groupBy("cell").applyInPandas(solve, "_text binary, bytes long, cell int, subset int"), "cells")
    sums, merged = small.groupBy("cell", "subset").agg(F.sum("bytes").alias("bytes")), []
    for n in rounds[1:]:
        up = sums.withColumn("up", F.pmod("cell", F.lit(n)).cast("int")).groupBy("up")
        merged.append(staged(up.applyInPandas(merge, "cell int, subset int, bytes long, up int, up_subset int"), "merged"))
        sums = merged[-1].groupBy(F.col("up").alias("cell"), F.col("up_subset").alias("subset")).agg(F.sum("bytes").alias("bytes"))
    sums = sums.orderBy("cell", "subset").collect()  # at most cells x pieces
    items = [(r["bytes"], r["cell"], r["subset"]) for r in sums] + [(r["bytes"], -1 - i, 0) for i, r in enumerate(large)]
    placed = _difference_sizes(np.array([i[0] for i in items]), shards).tolist() if items else []
    spark = docs.sparkSession
    plan = spark.createDataFrame([(c, j, s) for (_, c, j), s in zip(items, placed)], "cell int, subset int, shard int")
    plan = F.broadcast(plan)  # as many rows as sums and large groups
    below = plan.where("cell >= 0")
    for up in reversed(merged):
        below = up.join(below.toDF("up", "up_subset", "shard"), ["up", "up_subset"]).select("cell", "subset", "shard")
    alone = spark.createDataFrame([(r["_text"], -1 - i, 0) for i, r in enumerate(large)], "_text binary, cell int, subset int")
    groups = small.join(below, ["cell", "subset"]).select("_text", "shard").unionByName(
        alone.join(plan, ["cell", "subset"]).select("_text", "shard"))
    out = staged(rows.join(groups, "_text")
                 .withColumn("_cell", F.pmod(F.xxhash64("doc_id"), F.lit(cells)).cast("int")), "sharded")
    counts = out.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    base = counts.select("shard", "_cell", (F.sum("_n").over(Window.partitionBy("shard").orderBy("_cell")) - F.col("_n")).alias("_base"))
    inside = Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32")
    return (out.withColumn("_at", F.row_number().over(inside)).join(F.broadcast(base), ["shard", "_cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_base") + F.col("_at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
