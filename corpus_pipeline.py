"""A small corpus pipeline: language ID, line dedup, near-duplicate removal, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the next stage's documents, which are written as Parquet and read
again in between.  The last stage returns packed pieces instead of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import packing
from tessera.llm._common import col, hidden, maybe_among, scratch_path, stored, with_crc32
from tessera.llm.language_id import language_id
from tessera.llm.line_dedup import line_dedup
from tessera.llm.near_dedup import near_dedup
from tessera.session import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
END_ID = 2
SEQUENCE = 1024


def _only(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``verdicts`` (rid, kept) do not keep."""
    rid = hidden(docs, "rid")
    gone = stored(verdicts.where(~F.col("kept")).select(F.col("rid").alias(rid)), "gone")
    numbered = docs.withColumn(rid, F.monotonically_increasing_id())
    kept = [maybe_among(numbered, gone, [rid], others=True), maybe_among(numbered, gone, [rid]).join(gone, rid, "left_anti")]
    kept = [k.select(*[col(c) for c in docs.columns]) for k in kept]
    return kept[0].union(kept[1])


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; their columns stay as they are."""
    return _only(docs, language_id(docs, declared=F.col("lang"), host=F.col("source")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays.  Documents that had lines and have none
    left go; ``n_chars`` is counted anew where the text changed."""
    out = line_dedup(docs, materialise=False)
    out = out.where((F.col("n_dropped") < F.col("n_lines")) | (F.col("n_lines") == 0))
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return _only(docs, near_dedup(docs, materialise=False))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most ``SEQUENCE`` tokens and their places in sequences."""
    pieces = packing.cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, SEQUENCE, special_as_text=False)
    return packing.pack(with_crc32(pieces).drop("ids"), SEQUENCE)


STAGES = [("language_id", identify), ("line_dedup", dedup_lines), ("near_dedup", drop_near), ("packing", pack)]

#: Fuzzy lines, sketches and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
