"""The corpus pipeline: documents -> quality -> near duplicates ->
decontamination -> mix -> shards. Every stage takes what its predecessor kept;
what it returns is written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallycast.llm import byte_cnn, latent_decontam, mixing_tree, sharding, simhash_bytes
from tallycast.llm.common import bounded_batches, read_table, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network does not reject."""
    return byte_cnn.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates."""
    bounded_batches(spark)
    return simhash_bytes.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give no benchmark item away."""
    return latent_decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often (0 to 2 times) as the sources' target weights draw them."""
    return mixing_tree.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, text_group, shard, slot) of every document of the mix."""
    return sharding.shard_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("shards", shards)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
