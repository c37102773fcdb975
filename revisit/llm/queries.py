"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from revisit.llm import chat, dartminhash, divergence, hard_negatives, line_index, mixing, packing, phrases, rule_ensemble, simhash, suffix_dedup, token_planes, toxicity
from revisit.llm.common import materialise, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


@query
def op1_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_planes.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_report(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_windowed_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    shape = toxicity.Shape()
    net = toxicity.train(*toxicity.training_texts(docs, labels, shape), shape)
    out = toxicity.scored(docs, net)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op4_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    out = chat.formatted(chat.chain(turns.unionByName(more)))
    return chat.digests(materialise(out, "chat-formatted"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edit_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = materialise(rule_ensemble.statistics(docs).select("doc_id", "features"), "rule-features")
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    t = rule_ensemble.Training()
    model = rule_ensemble.fit(*rule_ensemble.training_rows(counted, labels, t), t)
    scored = counted.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), model.column(F.col("features")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op8_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured, verdict = divergence.judged(docs, keep=["doc_id"])
    v = F.col(verdict)
    return measured.select("doc_id", *(v[x].alias(x) for x in divergence.BASE), v["base_failed"].alias("base_failed"), v["kept"].alias("kept"))


@query
def op9_low_discrepancy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


@query
def op10_two_stage_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_stripe_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@query
def op12_segment_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), lambda i: i % 50 == 0)


@query
def op13_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_index.line_report(table(spark, sf_dir, "documents").select("doc_id", "text"))
