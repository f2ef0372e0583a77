"""The corpus pipeline: documents to packed training sequences.

Each stage reads what its predecessor kept, from the shared folder, and all
but the last return the columns of documents. Counted as part of
``yarnscope.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yarnscope.llm import decontaminate, minhash, packing, pii, quality
from yarnscope.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go. Null and empty texts fail."""
    judged = quality.quality_rules(docs).where("kept").select(F.col("doc_id").alias("id__"), F.col("hash").alias("hash__")).distinct()
    here = F.col("doc_id").eqNullSafe(F.col("id__")) & (F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("hash__"))
    return docs.join(judged, here, "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, 0.8) stays: that with the least doc_id.

    Of rows that share it, or have none, the first by a digest stays. Of
    repeated rows one stays. Documents without words are in no group and stay.
    """
    kept = minhash.kept_rows(docs, width=5, percent=80).select(F.col("doc_id").alias("id__"), F.col("hash").alias("hash__")).distinct()
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    here = F.col("doc_id").eqNullSafe(F.col("id__")) & (text_hash == F.col("hash__"))
    out = docs.join(materialize(kept, "kept"), here, "left_semi")
    # repeated rows of a kept document; without repeats every group has one row
    again = out.groupBy(F.col("doc_id").alias("id__"), text_hash.alias("hash__")).agg(F.count("*").alias("n__")).where("n__ > 1").drop("n__")
    again = materialize(again, "again")
    single = out.join(again, here, "left_anti")
    repeated = out.join(again, here, "left_semi").withColumn("hash__", text_hash).dropDuplicates(["doc_id", "hash__"]).drop("hash__")
    return single.unionByName(repeated)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hit = materialize(decontaminate.find_windows(texts, items.select("item_id", "text")).select(F.col("doc_id").alias("id__"), F.col("hash").alias("hash__")).distinct(), "leaks")
    here = F.col("doc_id").eqNullSafe(F.col("id__")) & (F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("hash__"))
    return docs.join(hit, here, "left_anti")


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in every text; all documents stay. The session's key, or the test key."""
    return pii.replace_entities(docs, pii.session_key(spark, pii.TEST_KEY)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their token ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii_surrogates", surrogates),
    ("packing", packed),
]

#: SQL can express neither the surrogates nor the token ids; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
