"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulary.llm import (
    bagminhash, bpe, dac, hamming, langid, licences, line_dedup, mixing, periodic, quality, transducer, turns, warc,
)
from tabulary.llm.common import shared_path, table


def op1_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every vec_id divisible by 20, among all others."""
    codes = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.nearest(codes, codes.where("id % 20 = 0")).select(
        F.col("id").alias("vec_id"), F.col("rank").cast("long").alias("rank"),
        F.col("neighbour").alias("neighbour_id"), F.col("distance").cast("long").alias("hamming"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    dac.write_token_files(table(spark, sf_dir, "documents"), path, lambda: dac.library_encoder(tokenizer))
    return dac.read_documents(spark, path)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "lines_before", "lines_exact", "lines_near",
        F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


#: Part of the entropy of equal weights that the mixture is to have.
MIX_ENTROPY = 0.999


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture as large as the corpus, each source's blocks one behind the other and permuted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, entropy=MIX_ENTROPY, budget="corpus", places=True).select(
        "doc_id", "source", "mix_tokens", "mix_block", "mix_place").sort("source", "mix_block", "mix_place").select(
        "doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_block").alias("block"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs)).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).drop("places")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.count_tokens(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a fixed rule and repaired."""
    return turns.repair(turns.damage(table(spark, sf_dir, "conversations")), present="present")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives in which equal payloads stand once, and read back."""
    path = shared_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path, least_bytes=0)
    return warc.read_pages(spark, path)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every text, a tenth of them with a planted periodic end."""
    return periodic.digest(periodic.find_runs(periodic.plant_tails(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_code_search": op1_code_search,
    "op2_token_files": op2_token_files,
    "op3_line_dedup": op3_line_dedup,
    "op4_source_mixing": op4_source_mixing,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_language": op6_language,
    "op7_licences": op7_licences,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_warc": op12_warc,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op1_code_search": hamming.oracle(),
    "op3_line_dedup": line_dedup.oracle(),
    "op4_source_mixing": mixing.oracle(MIX_ENTROPY, "SELECT sum(t) FROM s"),
}
