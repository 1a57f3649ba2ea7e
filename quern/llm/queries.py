"""The named queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quern.llm import (
    bpe_transducer,
    brown_lm,
    embedding_join,
    fill_middle,
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    mixture_packing,
    prefix_trie,
    secret_scan,
    shard_shuffle,
    token_files,
)
from quern.llm.common import held_out, table
from quern.session import scratch_path

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents")).select("doc_id", "text", "n_removed")


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, folder, "documents"))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = language_id.fit(documents.where(~held_out("doc_id", 4)))
    said = language_id.identify(documents.select("doc_id", "text"), model)
    return said.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


def op5_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    training = "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 7 <> 2"
    return brown_lm.score(table(spark, folder, "documents"), training)


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_transducer.round_trip(table(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op7_embedding_join(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_join.near_components(table(spark, folder, "embeddings"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.scan(documents, secret_scan.fit(documents)))


def op9_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    return mixture_packing.pack(table(spark, folder, "documents"), WORD_MODEL)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, folder, "documents"), path, WORD_MODEL)
    return token_files.read_token_files(spark, path)


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return fill_middle.digest(fill_middle.fill_middle(documents))


def op12_shard_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    shard_shuffle.shuffle_to_shards(table(spark, folder, "documents"), path)
    return shard_shuffle.digest(shard_shuffle.read_shards(spark, path))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_fingerprints, op3_language_id, op4_jaccard_join, op5_brown_lm, op6_byte_bpe,
        op7_embedding_join, op8_secret_scan, op9_mixture_packing, op10_token_files, op11_fill_middle,
        op12_shard_shuffle, op13_prefix_trie,
    )
}
#: SQL has no models, tokenizers, sketches or reachability; the tests use brute force for the others.
ORACLES: dict[str, str] = {"op11_fill_middle": fill_middle.SQL, "op13_prefix_trie": prefix_trie.SQL}
