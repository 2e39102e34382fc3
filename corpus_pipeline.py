"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding."""

from pyspark.sql import functions as F

from cinelink.llm import decontaminate, mixing, near_dup, quality_rules, shard_ring
from cinelink.runtime import materialize

SHARDS = 40


def quality(spark, docs, sf_dir):
    """Documents that pass the base rules and are not depleted of lines of their own."""
    return quality_rules.keep_good(docs)


def dedup(spark, docs, sf_dir):
    """One document of each group of near copies: the one with the smallest id."""
    return near_dup.keep_first(docs)


def clean(spark, docs, sf_dir):
    """Documents that hold too little of the benchmark to be contaminated."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark, docs, sf_dir):
    """Documents repeated so that all sources weigh the same."""
    return mixing.replicate(docs).select(*docs.columns)


def shard(spark, docs, sf_dir):
    """Documents with their shard and place in it; counts of shards differ by one at most."""
    return shard_ring.assign(docs, F.col("doc_id"), [F.xxhash64("text")], SHARDS)


STAGES = [("quality", quality), ("near_dedup", dedup), ("decontaminate", clean), ("mix", mix), ("shard", shard)]
# Near-dedup, the hashes and the ring have no counterpart in SQL; tests run all stages against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over `documents`; what a stage returns is stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
