"""Queries over the driver tables, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yarnscope.llm import (chat_format, collocations, decontaminate, html_extract, language_id, license_scan, minhash, oracles,
                           packing, pii, quality, spelling, suffix_dedup, url_filter)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    pieces = language_id.load_pieces(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    langs, table = language_id.learn(docs.where(F.col("doc_id").isNotNull() & ~held_out), pieces)
    out = language_id.identify(docs, langs, table, pieces)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    messages = rows.withColumn("parts", chat_format.text_part(F.col("text")))
    out = chat_format.read_back(chat_format.format_messages(messages))
    joined = out.select("conv_id", "turns", "formatted",
                        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
                        F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "").alias("learned"))
    return joined.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
                         F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                         F.char_length("formatted").cast("long").alias("formatted_chars"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(_table(spark, sf_dir, "documents"), pii.session_key(spark, pii.TEST_KEY)).select("doc_id", "text", "n_replaced")


def op9_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


_QUERIES = (op1_language_id, op2_suffix_array_dedup, op3_benchmark_decontamination, op4_url_filters, op5_chat_formatting, op6_html_extraction,
            op7_sum_of_squares_packing, op8_pii_surrogates, op9_quality_divergence, op10_circulant_minhash, op11_phrase_collocations, op12_license_scan,
            op13_spelling_variants)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
