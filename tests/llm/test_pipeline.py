"""The pipeline's stages against brute force on the small tables."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm.packing import bin_bound

from .conftest import SF01
from .helpers import line_of, linked, word_set
from .test_near import _deduped

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_run(spark, scratch):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF01).write.parquet(f"{scratch}/{name}")
        docs = spark.read.parquet(f"{scratch}/{name}")
        assert docs.columns == COLUMNS
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    lines = _deduped([((i, 0), t) for i, t in sorted(kept["language_id"].items())])
    want = {k[0]: t for k, t in lines.items() if any(map(line_of, t.split("\n"))) or not any(map(line_of, kept["language_id"][k[0]].split("\n")))}
    assert kept["line_dedup"] == want
    root = linked({i: word_set(t, 5) for i, t in want.items()})
    assert kept["near_dedup"] == {i: t for i, t in want.items() if root[i] == i}
    last = kept["near_dedup"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = False
    size = {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in last.items()}
    rows = corpus_pipeline.run(spark, SF01).collect()
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == size
    bound = bin_bound(np.array([r["length"] for r in rows]), corpus_pipeline.SEQUENCE)
    assert bound <= len({r["sequence_id"] for r in rows}) <= bound + 3


def test_stages_on_edges(spark, edges, nothing, scratch):
    for k, frame in enumerate((edges.select(*COLUMNS).withColumn("n_chars", F.length("text").cast("bigint")), nothing.select(*COLUMNS))):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF01).write.parquet(f"{scratch}/{k}-{name}")
            docs = spark.read.parquet(f"{scratch}/{k}-{name}")
        if k:
            assert docs.count() == 0


def test_rows_that_stay_are_not_shuffled(spark, scratch):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.format_string("text %d", "id").alias("a.text"))
    docs.repartition(4).write.parquet(f"{scratch}/only")
    docs = spark.read.parquet(f"{scratch}/only")
    rid = F.monotonically_increasing_id()
    out = corpus_pipeline._only(docs, docs.select(rid.alias("rid"), (F.col("doc_id") % 100 != 7).alias("kept")))
    assert out.columns == docs.columns and {r[0] for r in out.collect()} == {i for i in range(1000) if i % 100 != 7}
    assert {r[1] for r in out.collect()} == {f"text {i}" for i in range(1000) if i % 100 != 7}
    assert "Union" in out._jdf.queryExecution().sparkPlan().toString()
