"""The corpus pipeline: language ID, near duplicates, decontamination, mixing, sharding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and reread as the next stage's documents. A stage works on all that its predecessor kept; all but
the last return the columns of ``documents``.

Defined results: rows whose text is null or has no letter go in the first stage; the second stage
keeps one row of every group of near duplicates (of the smallest doc_id, null after all others), and
rows of one doc_id, or of none, are rows of their own there; an empty table passes through empty;
extra columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import decontam, langid, mixing, ngram_join, sharding
from claimlens.llm.common import named_as, numbered, staged, table

#: Near duplicates: Jaccard similarity of at least 0.8 of five-word n-grams.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those that the identifier rejects go."""
    model = langid.train(docs.where(langid.is_training(F.col("doc_id"))))
    rows = numbered(docs)
    text = rows.columns[docs.columns.index("text")]
    return named_as(langid.identify(rows, model, text_col=text).where("NOT rejected"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of near duplicates. Rows are numbered in a staged table, as ids may
    repeat or be null."""
    rows = staged(numbered(docs).withColumn("row", F.monotonically_increasing_id()), "rows", compression="zstd")
    doc_id, text = (f"_{docs.columns.index(c)}" for c in ("doc_id", "text"))
    found = ngram_join.jaccard_components(rows, "row", text, width=NEAR_WORDS, percent=NEAR_PERCENT).select(
        F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col(doc_id).isNull(), F.col(doc_id).cast("long"), "row"))["row"]
    stay = found.join(rows.select("row", doc_id), "row").groupBy("component_id").agg(first.alias("row"))
    return named_as(rows.join(stay.select("row"), "row", "left_semi"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    rows = numbered(docs)
    text = rows.columns[docs.columns.index("text")]
    found = decontam.find_leaks(rows, table(spark, sf_dir, "benchmark"), text_col=text, keep=rows.columns)
    return named_as(found.where("NOT contaminated"), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: documents repeated as often as it takes them."""
    return mixing.take_mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed rows in 24 shards of near equal bytes."""
    return sharding.shard_documents(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mix), ("sharding", sharding_stage)]

#: Language ID, near duplicates and decontamination have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
