"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import ann, chat, decontam, licenses, mixing, simhash, sstable, suffix_dedup, token_rollup, toxicity
from quire.llm.common import materialize, table
from quire.llm.oracles import oracle_sql  # noqa: F401

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.maintain(table(spark, sf_dir, "documents"), tokenizer_path(), "byte_bpe_50k")


def op2_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_sst_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.read_shards(sstable.write_shards(table(spark, sf_dir, "documents"), tokenizer_path()))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(toxicity.sample(docs, table(spark, sf_dir, "labels"))))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    log = chat.streamed(chat.events_of_turns(turns))  # drafts, regenerations, deltas and edits, which the fold undoes
    return chat.digest(materialize(chat.render(chat.fold(log)), "chat"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def queries() -> dict:
    found = (
        op1_token_rollup, op2_cube_mixing, op3_simhash, op4_ann, op5_suffix_dedup,
        op6_sst_shards, op7_toxicity, op8_decontamination, op9_chat_format, op10_license_scan,
    )
    return {f.__name__: f for f in found}
