"""The registered queries: each applies one operator, with production
parameters, to the whole of its table and derives the contract's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, filter_audit, packing, sharding, token_files, url_filter
from tessera.llm._common import scratch_path, with_crc32
from tessera.llm.exact_dedup import exact_dedup, normalised
from tessera.llm.fill_middle import fill_in_middle, restored
from tessera.llm.forest import forest_search
from tessera.llm.language_id import language_id
from tessera.llm.line_dedup import line_dedup
from tessera.llm.near_dedup import near_dedup
from tessera.llm.window_fill import pack_windows
from tessera.session import table

# Fixed values of the contracts.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
END_ID = 2
SEQUENCE = 1024
SHARDS = 8
WINDOW_END_ID = 1
WINDOW = 2048


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("text_sha256")
    return exact_dedup(docs, carry=[digest])


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "embeddings")
    return forest_search(points, points.where(F.col("vec_id") % 20 == 0), k=20)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup(table(spark, sf_dir, "documents"), words=4, materialise=False)
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode_text(docs, ranks, pattern).drop("text")
    ids = ids.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"))
    return bpe.decode_ids(ids, ranks, pattern).select(
        "doc_id", "n_tokens", F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id(docs, declared=F.col("lang"), host=F.col("source"), carry=("lang", "source")).drop("rid")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, materialise=False)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), END_ID, special_as_text=False)
    back = token_files.read_token_files(spark, path).withColumn("n_tokens", F.size("ids").cast("bigint"))
    return with_crc32(back).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = url_filter.rules_frame(spark, URL_RULES)
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, SEQUENCE, special_as_text=False)
    return packing.pack(with_crc32(pieces).drop("ids"), SEQUENCE)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shard_rows(docs, SHARDS, materialise=False)
    return out.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


def op12_window_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_windows(docs, public_tokenizers.path("byte_bpe_50k.json"), WINDOW_END_ID, WINDOW, special_as_text=False, with_ids=False)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = filter_audit.text_features(docs, carry={"part": F.coalesce("source", F.lit(""))})
    rows = filter_audit.mark_labels(filter_audit.mark_copies(rows), labels, {"good_lost": F.col("quality") == 1, "toxic_lost": F.col("toxic") == 1})
    filters = {
        "A": F.col("n_words") < 50, "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
        "C": 100 * F.col("n_upper") > 5 * F.col("n_points"), "D": F.col("has_sign"), "E": F.col("is_copy")}
    return filter_audit.filter_audit(rows, F.col("part"), filters, {c: F.col(c) for c in ("good_lost", "toxic_lost")})


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_prefix_forest, op3_near_dedup, op4_byte_bpe, op5_language_id, op6_line_dedup, op7_token_files, op8_url_filter,
    op9_best_fit_packing, op10_sharding, op11_fill_middle, op12_window_fill, op13_filter_audit)}
