"""The corpus pipeline: documents in, token counts and digests of the mixture out.

STAGES lists (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame with the columns of documents (the last one: its result), which is
written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulary.llm import bagminhash, bpe, langid, line_dedup, mixing
from tabulary.llm.common import free_names, staged, table
from tabulary.operators.keys import with_dense_key

#: The most often a source's tokens are repeated in the mixture.
REPEATS = 1.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: no text, or no letter in it."""
    return langid.keep_known(docs, langid.learn(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that stand earlier in the corpus, and documents of which nothing is left."""
    lost = F.col("lines_exact") + F.col("lines_near") > 0
    empty = F.trim(F.regexp_replace("text", "\n", "")) == ""
    return line_dedup.dedup_lines(docs).where(~(lost & empty)).withColumn(
        "n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def _own_ids(docs: DataFrame, own: str) -> DataFrame:
    """``docs`` with ``own``, an id of each doc_id and text: the doc_id, but one
    behind all doc_ids for further texts of a doc_id and for rows without one."""
    doc_id, key = F.col("doc_id").cast("long"), F.xxhash64("text")
    pairs = docs.select(doc_id.alias("id"), key.alias("key")).distinct()
    several = pairs.where("id IS NOT NULL").groupBy("id") \
        .agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least <> most")
    others = staged(
        pairs.join(several, "id").where("key <> least").select("id", "key")
        .unionAll(pairs.where("id IS NULL")), "other-ids")
    if others.isEmpty():
        return docs.withColumn(own, doc_id)
    last = docs.agg(F.max(doc_id)).first()[0] or 0
    of, of_key, new = free_names([*docs.columns, own], "of", "of_key", "new")
    numbered = with_dense_key(others, "new", [F.col("id").asc_nulls_last(), F.col("key")], start=last) \
        .select(F.col("id").alias(of), F.col("key").alias(of_key), F.col("new").alias(new))
    return docs.join(numbered, doc_id.eqNullSafe(F.col(of)) & (key == F.col(of_key)), "left") \
        .select(*docs.columns, F.coalesce(F.col(new), doc_id).alias(own))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each class, once: that of the least doc_id.

    Different texts of one doc_id are documents of their own, and so are texts
    without a doc_id; those come behind all doc_ids.  Of rows with the same
    doc_id and text the one whose columns are least stays (columns with maps
    compare as JSON).
    """
    (own,) = free_names(docs.columns, "own")
    marked = _own_ids(docs, own)
    first = bagminhash.near_duplicates(marked.select(F.col(own).alias("doc_id"), "text")) \
        .where("doc_id = class_id").select(F.col("doc_id").alias(own)).distinct()
    order = [F.when(F.col(f"`{f.name}`").isNotNull(), F.to_json(F.struct(f"`{f.name}`"))) if _has_map(f.dataType)
             else F.col(f"`{f.name}`") for f in docs.schema.fields]
    row = F.struct(*(f"`{c}`" for c in docs.columns))
    return marked.join(first, own, "left_semi").groupBy(own) \
        .agg(F.min_by(row, F.struct(*order)).alias("kept")).select("kept.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Raise small sources: each document at least once, and as often as the weights ask."""
    return mixing.mix(docs, repeats=REPEATS).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode each row of the mixture."""
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language ID", language), ("line dedup", lines), ("MinHash near-dedup", near_duplicates),
          ("source mixing", mixture), ("byte-level BPE", encoding)]

#: Language ID, signatures and merges can't be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
