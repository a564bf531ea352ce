"""The registered queries of the dealt operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    plan = mixing.copies(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import linejoin

    return linejoin.line_matches(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), "n_links", "removed")


@register
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import tokencount

    trees = tokencount.build_trees(table(spark, sf_dir, "documents"), mask=True)
    return tokencount.apply_edits(trees, keep=False).select(
        F.col("id").alias("doc_id"), "n_tokens", "n_edits", "n_tokens_after", "chars_encoded")


@register
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import rotcodes

    return rotcodes.near_vectors(table(spark, sf_dir, "embeddings"))


@register
def op5_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import shards

    rows = shards.equal_text_shards(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@register
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import winnow

    found = winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register
def op7_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import tables, warc

    archives = tables.folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), archives)
    records = warc.read_archives(spark, archives, payloads=False).where("gap IS NULL")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import ordering, tables

    path = tables.folder(spark, "training-order")
    total = ordering.write_shards(table(spark, sf_dir, "documents"), path)
    return ordering.read_shards(spark, path, total, tokens=False).select(
        "slot", "doc_id", F.col("number").alias("sequence"), F.col("n").alias("n_tokens"), F.col("crc").alias("tokens_crc32"))


@register
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import coordjoin

    return coordjoin.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import periods

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # One text in ten is made to repeat: from word a on, its first p words come again and again.
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    w = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    docs = docs.select("*", F.when(h % 10 == 0, w).alias("w"), F.floor(h / 10).alias("g"))
    docs = docs.select("*", F.size("w").alias("n"), F.when(F.size("w") > 0, (F.col("g") % F.size("w")).cast("int")).alias("a"))
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    planted = F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), again), F.lit(1), F.col("n"))
    docs = docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    best = F.col("best")
    return periods.collapse_runs(docs).withColumn("best", periods.strongest()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import repeats

    return repeats.drop_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.expr("aggregate(spans, 0L, (n, x) -> n + x.end - x.start)").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"))


@register
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import negatives

    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)
