import hashlib
import re

from tessera.llm.exact_dedup import exact_dedup, normalised
from pyspark.sql import functions as F


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_edges(edges):
    got = exact_dedup(edges, carry=[F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("text_sha256"), F.col("text")]).collect()
    want = [(r["doc_id"], _norm(r["text"])) for r in edges.collect()]
    assert len(got) == len(want)
    groups = {}
    for i, t in want:
        groups.setdefault(t, []).append(i)
    for r in got:
        mine = groups[_norm(r["text"])]
        ids = [i for i in mine if i is not None]
        assert r["group_size"] == len(mine)
        assert r["keep_id"] == (min(ids) if ids else None)
        assert r["text_sha256"] == hashlib.sha256(_norm(r["text"]).encode()).hexdigest()
    for text, mine in groups.items():
        kept = [r for r in got if _norm(r["text"]) == text and r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == kept[0]["keep_id"]


def test_negative_and_extreme_ids(spark):
    rows = [(2**63 - 1, "t"), (-2**63, "t"), (0, "t"), (7, "u")]
    got = {r["doc_id"]: r for r in exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [i for i, r in got.items() if r["kept"]] and got[-2**63]["kept"] and not got[0]["kept"] and got[7]["kept"]
    assert got[0]["keep_id"] == -2**63


def test_same_length_and_prefix_other_end(spark):
    head = "x" * 400
    rows = [(1, head + "a"), (2, head + "b"), (3, head + "a")]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2)}


def test_empty(nothing):
    assert exact_dedup(nothing).collect() == []


def test_plan_is_native(spark):
    df = exact_dedup(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
