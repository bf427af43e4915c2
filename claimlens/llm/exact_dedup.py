"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by successive byte blocks of their normalised text, most
significant block first. A group that a block leaves with one document, or whose
texts end within the block, is settled; the others are split again by the next
block. Groups are told apart by the bytes themselves, never by a digest. Blocks
widen by a constant factor, so the number of rounds is logarithmic in the longest
text that has a copy, and each round only moves documents that still share a prefix.

Defined results: a null text counts as empty; all empty texts are equal; repeated
rows (equal id and text) are copies of each other and, when their id is the largest of
the group, all are kept; a null id is never kept over another id; an empty table gives
an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import ascii_lower, staged


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                first_block: int = 32, growth: int = 16) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are compared after lower-casing A-Z; of equal texts the row with the largest
    id stays. A hot group costs one pre-aggregated row per map task in the counting
    step. The groups are staged before they are joined back, and joined by a merge at every size: with an exchange
    on either side and one row per group on one, AQE can split a hot group. Each round's survivors are a staged table."""
    raw = F.encode(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), "UTF-8")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), raw.alias("_rest")).select(
        "doc_id", F.sha2("_rest", 256).alias("text_sha256"), F.lit(b"").alias("_group"), "_rest")
    width, settled = first_block, []
    while True:
        # The bytes of this round; a text that ends inside the block is shorter than it,
        # so its key differs from that of any text that goes on.
        rows = rows.withColumn("_block", F.substring("_rest", 1, width))
        groups = staged(rows.groupBy("_group", "_block").agg(
            F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id")), "radix-groups")
        split = rows.join(groups.hint("merge"), ["_group", "_block"])
        ended = F.length("_block") < width
        split = split.select(
            "doc_id", "text_sha256", "_group", "_block", "group_size", "keep_id",
            ((F.col("group_size") == 1) | ended).alias("_done"),
            F.when(~ended & (F.col("group_size") > 1), F.expr(f"substring(_rest, {width + 1})")).alias("_rest"))
        split = staged(split, "radix")
        settled.append(split.where("_done").select("doc_id", "keep_id", "group_size", "text_sha256"))
        rows = split.where("NOT _done")
        if rows.isEmpty():
            break
        # Name each open group by one of its rows; ids of rows are stable in a staged table.
        rows = rows.select("doc_id", "text_sha256", "_group", "_block", "_rest",
                           F.monotonically_increasing_id().alias("_row"))
        names = staged(rows.groupBy("_group", "_block").agg(F.min("_row").alias("_name")), "radix-names")
        rows = rows.join(names.hint("merge"), ["_group", "_block"]).select(
            "doc_id", "text_sha256", F.encode(F.col("_name").cast("string"), "UTF-8").alias("_group"), "_rest")
        width *= growth
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256")
