"""The registered queries of the subpackage: thin applications to the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import (collocations, decontam, exact_dedup, langid, mixing, ngram_join, prefix_trie, sharding, suffix_dedup,
                           superkmer_dedup, tokens_bin, toxicity, warc)
from claimlens.llm.common import scratch_uri, table

QUERIES, ORACLES = {}, {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


@_query("op1_exact_dedup", """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of each text of ``documents``, the largest doc_id staying."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@_query("op2_ngram_join")
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` by Jaccard similarity 0.85 of 4-word n-grams."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


@_query("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of ``benchmark`` in ``documents``, with substituted words."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op4_mixing", mixing.oracle_sql())
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed to the sources' target weights."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@_query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of ``documents``, written and read back."""
    import public_tokenizers
    path = scratch_uri(spark, "tokens")
    manifest = tokens_bin.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens_bin.read_tokens(manifest, path)


@_query("op6_warc")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of ``pages``, written and read back."""
    path = scratch_uri(spark, "warc")
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(manifest, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` that 50-byte strings of earlier documents cover."""
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


@_query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` that 50-word windows of earlier documents cover."""
    return superkmer_dedup.substring_dedup(table(spark, sf_dir, "documents"))


@_query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(langid.is_training(F.col("doc_id"))))
    return langid.identify(docs.select("doc_id", "text"), model, keep=["doc_id"]).select(
        "doc_id", (~langid.is_training(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "rejected")


@_query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 24 shards of near equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@_query("op11_prefix_trie", prefix_trie.oracle_sql())
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of the rebuilt ``conversations``."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@_query("op12_collocations", collocations.oracle_sql())
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two and three words of each language of ``documents``."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@_query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(toxicity.is_training(F.col("doc_id"))))
    return toxicity.score_texts(docs.select("doc_id", "text"), model, keep=["doc_id"]).select(
        "doc_id", (~toxicity.is_training(F.col("doc_id"))).alias("held_out"), "score", "predicted")
