"""Registered queries of the training-data operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import (
    chat,
    decontaminate,
    line_dedup,
    mixture,
    near_dedup,
    parity_join,
    pii,
    prefix_trie,
    quality,
    repair,
    sharding,
    topk,
    toxicity,
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(pii.counted(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.listed("base"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"), width=3, percent=85)


def op3_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_runs(_read(spark, sf_dir, "documents"))


def op4_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.positional_index(_read(spark, sf_dir, "documents"))
    found = decontaminate.contamination(index, _read(spark, sf_dir, "benchmark"), width=13)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    fitted = quality.fit(docs, _read(spark, sf_dir, "labels"), folds=5, fold=0)
    scored = quality.score(docs.select("doc_id", "text"), fitted)
    return scored.select(
        "doc_id",
        toxicity.held_out(5, 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, read back from the output."""
    probe = "<|im_end|><|im_start|>assistant ok"
    said = lambda turn, role: F.struct(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(probe).alias("text")
    )
    extra = spark.range(1).select(F.explode(F.array(said(0, "user"), said(1, "assistant"))).alias("m")).select("m.*")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    parts = chat.read_back(chat.format_conversations(rows))
    joined = lambda texts: F.array_join(texts, "")
    parts = parts.select(
        "conv_id",
        "part",
        F.size("turns").alias("n"),
        joined(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))).alias("turns"),
        joined("losses").alias("losses"),
        "formatted_chars",
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("part", "turns", "losses"))).alias("parts"),
        F.sum("formatted_chars").alias("formatted_chars"),
    )
    turns = joined(F.transform("parts", lambda p: p.turns))
    whole = whole.withColumn("loss", joined(F.transform("parts", lambda p: p.losses)))
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_read(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"), folds=4, fold=2)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out(4, 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(_read(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.with_family_heads(turns))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with drawn faults; rows that the draw drops still name their conversation."""
    return repair.report(*repair.damaged(_read(spark, sf_dir, "conversations")))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.jaccard_join(_read(spark, sf_dir, "documents"), width=4, percent=85)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_personal_data,
        op2_near_duplicates,
        op3_repeated_lines,
        op4_top_inner_products,
        op5_decontamination,
        op6_quality,
        op7_mixture,
        op8_chat,
        op9_sharding,
        op10_toxicity,
        op11_conversation_trie,
        op12_conversation_repair,
        op13_jaccard_join,
    )
    return {f.__name__: f for f in found}
