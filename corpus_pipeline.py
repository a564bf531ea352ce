"""A training corpus from ``documents``, in five stages, each one of the llm operators.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its
result is written as Parquet in the shared folder and read again as the next one's docs.
Toxic documents go, one document of each near-duplicate group stays, contaminated documents
go, each source is taken at its target weight (rows may repeat), and what is left is dealt
into shards of near equal bytes.  All but the last return the columns of ``docs``; the last
adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import coordjoin, mixing, shards, toxicity, winnow
from mercato.llm.tables import written

#: Near duplicates of the pipeline: Jaccard 0.8 or more over five words.  A pair at exactly 0.8
#: has fewer than 13 of 32 collisions with probability below 1e-6.
NEAR = {"similar": (4, 5), "t": 13}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return coordjoin.near_dedup(docs, repeat_ids=True, **NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnow.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", deal_shards),
]

#: Toxicity and sharding are iterative, so SQL can't state run()'s rows.  tests/llm test the
#: stages' operators and filters, and run() against its stages on whole tables (test_pipeline_run).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
