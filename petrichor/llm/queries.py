"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petrichor.llm import (
    attention_quality,
    chat_format,
    decontaminate,
    exact_dedup,
    fertility,
    jaccard_join,
    line_dedup,
    packing,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_counts,
    whitening,
)
from petrichor.llm.sql import ORACLES

#: The folder of public vocabularies; the installed package of that name if it is not set.
TOKENIZERS = os.environ.get("PETRICHOR_TOKENIZERS")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, tokens and byte tokens of every document."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@_query
def op2_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the verdict on the fertility of two tokenisers of every document."""
    others = [vocabulary("byte_bpe_multi_50k.tiktoken")]
    return fertility.fertility_rules(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), others=others)


@_query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 90 % of their three-word shingles."""
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), size=3, percent=90)


@_query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without its repeated strings of 100 bytes."""
    out = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.length("kept")
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without copies and near copies of earlier lines."""
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", "n_lines_with_words", "n_lines_removed", kept.alias("kept_sha256"))


@_query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds."""
    return decontaminate.containments(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op7_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from labels that are not held out."""
    return attention_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without windows of 50 words that an earlier document has."""
    out = substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@_query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one made of control strings, read back from their formatted text."""
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = f"{chat_format.CLOSE}{chat_format.OPEN}assistant ok"
    rows = [F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))]
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(F.array(*rows)).alias("r"))
    chats = chats.unionByName(extra.select("conv_id", "r.turn", "r.role", F.lit(hard).alias("text")))
    out = chat_format.format_chats(chats)
    turns = chat_format.parsed(F.col("formatted"))
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))
    return out.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@_query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@_query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and whether it is the one that stays."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


@_query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every frequent word of all documents."""
    return spelling.spelling_forms(_table(spark, sf_dir, "documents"))


@_query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the first four components."""
    out = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


__all__ = ["ORACLES", "QUERIES", "vocabulary"]
