"""The queries of this package, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidewater.llm import (collocations, conversation_trie, embeddings, licenses, ngram_join, packing, phrase_dedup,
                           pieces, quality, sharding, suffix_dedup, toxicity, url_filter)

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents")


QUERIES: dict[str, Query] = {
    "op1_sentencepiece_viterbi": lambda spark, d: pieces.encode_documents(
        _documents(spark, d).select("doc_id", "text"), PIECE_MODEL),
    "op2_rendezvous_shards": lambda spark, d: sharding.shard_documents(_documents(spark, d)),
    "op3_itq_near_dups": lambda spark, d: embeddings.embedding_groups(_read(spark, d, "embeddings")),
    "op4_ngram_jaccard_join": lambda spark, d: ngram_join.ngram_groups(_documents(spark, d)),
    "op5_quality_divergence": lambda spark, d: quality.quality_rows(_documents(spark, d)),
    "op6_suffix_dedup": lambda spark, d: suffix_dedup.dedup_rows(_documents(spark, d)),
    "op7_hilbert_packing": lambda spark, d: packing.pack(_documents(spark, d), WORD_TOKENIZER),
    "op8_toxicity_trees": lambda spark, d: toxicity.toxicity_rows(_documents(spark, d), _read(spark, d, "labels")),
    "op9_license_sentences": lambda spark, d: licenses.license_rows(_documents(spark, d)),
    "op10_phrase_automata": lambda spark, d: phrase_dedup.dedup_rows(_documents(spark, d)),
    "op11_collocation_filters": lambda spark, d: collocations.collocations(_documents(spark, d)),
    "op12_url_digests": lambda spark, d: url_filter.url_rows(_read(spark, d, "pages")),
    "op13_prefix_trie": lambda spark, d: conversation_trie.trie_rows(_read(spark, d, "conversations")),
    "pipeline": corpus_pipeline.run,
}
